"""Queries of the training-data operators under their contract names, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import chat, decontam, html_extract, line_dedup, mixing, near_dedup, packing, quality, ranked, secret_scan, token_files, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(_table(spark, sf_dir, "pages")).drop("url")


def op2_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(_table(spark, sf_dir, "documents"))
    # shown to six digits, as sums of doubles differ in their last ones
    return found.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op3_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_context_mixing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_ids(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(_table(spark, sf_dir, "pages"))


def op7_deletion_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_verdicts(_table(spark, sf_dir, "documents"), least=1)


def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op9_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(_table(spark, sf_dir, "conversations"))


def op10_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets_of(_table(spark, sf_dir, "documents"))


def op11_length_stratified_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op13_shifted_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_normaliser": op1_warc_normaliser,
    "op2_quality_divergence": op2_quality_divergence,
    "op3_fm_index_decontamination": op3_fm_index_decontamination,
    "op4_context_mixing_ids": op4_context_mixing_ids,
    "op5_bottom_k_near_dedup": op5_bottom_k_near_dedup,
    "op6_wrapper_induction": op6_wrapper_induction,
    "op7_deletion_neighbourhood": op7_deletion_neighbourhood,
    "op8_temperature_mixing": op8_temperature_mixing,
    "op9_snapshot_collapse": op9_snapshot_collapse,
    "op10_secret_crf": op10_secret_crf,
    "op11_length_stratified_search": op11_length_stratified_search,
    "op12_configuration_packing": op12_configuration_packing,
    "op13_shifted_cholesky_whitening": op13_shifted_cholesky_whitening,
}


def _common_words() -> str:
    lists = " ".join(f"WHEN '{lang}' THEN {list(words)!r}" for lang, words in quality.COMMON_WORDS.items())
    return f"CASE lang {lists} ELSE []::VARCHAR[] END"


def _distance(p: str, q: str) -> str:
    """Square root of the Jensen-Shannon divergence of two lists of shares."""
    term = lambda v: f"CASE WHEN {v} > 0 THEN {v} * log2(2 * {v} / (z[1] + z[2])) ELSE 0 END"
    return f"sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: {term('z[1]')} + {term('z[2]')})) / 2, 0))"


#: The words of one text under the spaced rule (case folded) and under the benchmark rule.
_SPACED = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_ALNUM = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _place(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(chr(31), {', '.join(parts)})), 1, 15))::BIGINT"


def _last_exponent(name: str, holds: str) -> str:
    """The largest grid exponent at which a condition on sums over u holds, bisected; `a` stands for it."""
    tried = holds.replace(" a ", f" (((low + high) // 2)::DOUBLE / {mixing.GRID}) ")
    return f"""{name} AS (
            SELECT 0 AS low, {mixing.GRID} AS high
            UNION ALL
            SELECT CASE WHEN good THEN (low + high) // 2 ELSE low END, CASE WHEN good THEN high ELSE (low + high) // 2 END
            FROM (SELECT low, high, (SELECT {tried} FROM u) AS good FROM {name} WHERE high - low > 1)
        )"""


_ENTROPY = "(log2(sum(pow(share, a ))) - sum(pow(share, a ) * log2(share) * a ) / sum(pow(share, a )))"

#: DuckDB forms of the queries that SQL can express.
TWINS: dict[str, str] = {
    "op1_warc_normaliser": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        d AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
        b AS (
            SELECT *, list_transform(range(8), lambda g: ('0x' || substr(hex, 5 * g + 1, 5))::INTEGER) AS fives,
                max(page_id) OVER (PARTITION BY hex) AS response
            FROM d
        )
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
            list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((fives[1 + i // 4] >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response THEN response END AS refers_to
        FROM b
    """,
    "op9_snapshot_collapse": """
        WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
        c AS (SELECT conv_id, list(role || chr(31) || text ORDER BY turn) AS said FROM t GROUP BY conv_id),
        kept AS (
            SELECT conv_id FROM c WHERE NOT EXISTS (
                SELECT 1 FROM c AS d
                WHERE (len(d.said) > len(c.said) AND d.said[1:len(c.said)] = c.said)
                   OR (d.said = c.said AND d.conv_id < c.conv_id)
            )
        )
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place,
            count(*) OVER (PARTITION BY conv_id) AS n_turns, role,
            '<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10) AS rendered
        FROM t WHERE conv_id IN (SELECT conv_id FROM kept)
    """,
    "op2_quality_divergence": rf"""
        WITH w AS (
            SELECT row_number() OVER () AS row, doc_id, lang IN {tuple(quality.COMMON_WORDS)} AS listed, lang, coalesce(text, '') AS text,
                list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                {_common_words()} AS common
            FROM documents
        ),
        g AS (
            SELECT row, i, count(*) OVER (PARTITION BY row, words[i], words[i + 1], words[i + 2]) AS n
            FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM w)
        ),
        r AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY row),
        c AS (
            SELECT w.row, doc_id, listed, coalesce(lang, '') AS lang, len(words) AS n_words,
                length(list_aggregate(words, 'string_agg', '')) AS chars, coalesce(r.n, 0) AS n_repeat_words,
                len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
                length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digit,
                length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) AS n_wide,
                length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
                length(text) AS n_chars,
                list_transform(words, lambda x: list_position(common, rtrim(lower(x), '.,;:!?'))) AS places
            FROM w LEFT JOIN r ON r.row = w.row
        ),
        h AS (
            SELECT *, coalesce(chars, 0) AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                [n_lower, n_upper, n_digit, n_chars - coalesce(chars, 0), n_symbols,
                 coalesce(chars, 0) - n_lower - n_upper - n_digit - n_symbols - n_wide, n_wide] AS classes,
                list_append(list_transform(range(1, {quality.N_COMMON} + 1), lambda k: len(list_filter(places, lambda p: p = k))),
                    n_words - len(list_filter(places, lambda p: p > 0))) AS kinds
            FROM c
        ),
        q AS (
            SELECT lang, count(*) AS n,
                [{", ".join(f"sum(floor(classes[{i}] * {quality.SCALE}::DOUBLE / list_sum(classes)))" for i in range(1, len(quality.CLASSES) + 1))}] AS classes,
                [{", ".join(f"sum(floor(kinds[{i}] * {quality.SCALE}::DOUBLE / list_sum(kinds)))" for i in range(1, quality.N_COMMON + 2))}] AS kinds
            FROM h WHERE NOT base_failed GROUP BY lang
        ),
        d AS (
            SELECT h.*,
                CASE WHEN n_words >= {quality.MIN_WORDS} AND q.n >= {quality.MIN_REFERENCE} THEN {_distance(
                    "list_transform(h.classes, lambda x: x / list_sum(h.classes))", "list_transform(q.classes, lambda x: x / list_sum(q.classes))"
                )} END AS far_classes,
                CASE WHEN n_words >= {quality.MIN_WORDS_FOR_WORDS} AND q.n >= {quality.MIN_REFERENCE} AND h.listed THEN {_distance(
                    "list_transform(h.kinds, lambda x: x / list_sum(h.kinds))", "list_transform(q.kinds, lambda x: x / list_sum(q.kinds))"
                )} END AS far_words
            FROM h LEFT JOIN q ON q.lang = h.lang
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            round(far_classes, 6) AS class_distance, round(far_words, 6) AS word_distance,
            CASE WHEN far_words IS NOT NULL THEN 'classes and words' WHEN far_classes IS NOT NULL THEN 'classes' ELSE 'base' END AS judged_by,
            NOT base_failed AND coalesce(far_classes, 0) <= {quality.MAX_CLASS_DISTANCE} AND coalesce(far_words, 0) <= {quality.MAX_WORD_DISTANCE} AS kept
        FROM d
    """,
    "op3_fm_index_decontamination": rf"""
        WITH i AS (SELECT item_id, {_ALNUM} AS words FROM benchmark),
        p AS (
            SELECT DISTINCT item_id, words[k : k + {decontam.WINDOW - 1}] AS phrase
            FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {decontam.WINDOW - 2}, 2))) AS k FROM i WHERE len(words) > 0)
        ),
        d AS (SELECT row_number() OVER () AS row, doc_id, {_ALNUM} AS words FROM documents),
        s AS (SELECT DISTINCT len(phrase) AS size FROM p),
        o AS (
            SELECT w.row, w.k, p.item_id, len(p.phrase) AS size
            FROM (SELECT row, unnest(range(1, len(words) - size + 2)) AS k, size, words FROM d, s WHERE len(words) >= size) AS w
            JOIN p ON w.words[w.k : w.k + w.size - 1] = p.phrase
        ),
        hit AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(k, k + size)) AS place FROM o) GROUP BY row),
        told AS (
            SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM o WHERE item_id IS NOT NULL) GROUP BY row
        )
        SELECT doc_id, len(words) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(told.n, 0) AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * hit.n >= len(words) AS contaminated
        FROM d LEFT JOIN hit ON hit.row = d.row LEFT JOIN told ON told.row = d.row
    """,
    "op5_bottom_k_near_dedup": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, {_SPACED} AS words FROM documents),
        sets AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
                ELSE list_transform(range(1, len(words) - 3), lambda i: words[i : i + 4]) END) AS shingle
            FROM w
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
        ),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
        FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id JOIN least ON least.a = w.doc_id
    """,
    "op11_length_stratified_search": rf"""
        WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_ALNUM} AS words FROM documents),
        t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM d) GROUP BY row, term),
        g AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0),
        i AS (SELECT row_number() OVER () AS item, item_id, {_ALNUM} AS words FROM benchmark),
        q AS (SELECT DISTINCT item, item_id, unnest(words) AS term FROM i),
        w AS (
            SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM t, g WHERE term IN (SELECT term FROM q) GROUP BY term
        ),
        s AS (
            SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id,
                sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(words) * n_docs) // n_terms))))::BIGINT AS score
            FROM q JOIN w USING (term) JOIN t USING (term) JOIN d USING (row), g GROUP BY item, row
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY rank <= {ranked.TOP}
    """,
    "op8_temperature_mixing": rf"""
        WITH RECURSIVE m AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS source,
                len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens,
                {_place(f"'{mixing.SEED}'", "coalesce(doc_id::VARCHAR, '')", "coalesce(text, '')")} AS spot
            FROM documents
        ),
        s AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens) / greatest(sum(sum(n_tokens)) OVER (), 1)::DOUBLE AS share FROM m GROUP BY source),
        u AS (SELECT share FROM s WHERE share > 0),
        own AS (SELECT {_ENTROPY.replace(" a ", " 1.0::DOUBLE ")} AS h, log2(count(*)) AS even FROM u),
        {_last_exponent("rich", f"{_ENTROPY} >= (SELECT h + (even - h) * {mixing.ENTROPY_GAIN} FROM own)")},
        {_last_exponent("crowded", f"max(pow(share, a - 1)) > min(pow(share, a - 1)) * {mixing.REPETITION_LIMIT}")},
        e AS (SELECT CASE WHEN h < h + (even - h) * {mixing.ENTROPY_GAIN} THEN (SELECT max(low) FROM rich)::DOUBLE / {mixing.GRID} ELSE 1.0::DOUBLE END AS wished FROM own),
        x AS (
            SELECT CASE WHEN (SELECT max(pow(share, wished - 1)) > min(pow(share, wished - 1)) * {mixing.REPETITION_LIMIT} FROM u)
                THEN (SELECT max(low) FROM crowded)::DOUBLE / {mixing.GRID} + 1.0::DOUBLE / {mixing.GRID} ELSE wished END AS a FROM e
        ),
        r AS (
            SELECT source, tokens, CASE WHEN share > 0 THEN pow(share, a - 1) / (SELECT min(pow(share, a - 1)) FROM u) ELSE 1 END AS times FROM s, x
        ),
        p AS (SELECT source, floor(times + 1e-9) AS whole, floor((times - floor(times + 1e-9)) * tokens) AS budget FROM r),
        c AS (
            SELECT m.*, whole + CASE WHEN budget > 0 AND coalesce(sum(n_tokens) OVER lower, 0) < budget THEN 1 ELSE 0 END AS copies
            FROM m JOIN p USING (source)
            WINDOW lower AS (PARTITION BY m.source ORDER BY spot RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        )
        SELECT doc_id, source, n_tokens, epoch::BIGINT AS epoch, {_place(f"'{mixing.SEED}'", "epoch::VARCHAR", "spot::VARCHAR")} AS place
        FROM (SELECT *, unnest(range(1, copies::BIGINT + 1)) AS epoch FROM c)
    """,
}
