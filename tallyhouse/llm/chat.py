"""Chat formatting after collapse of cumulative snapshots.

A conversation that is logged again after every turn leaves snapshots, each a prefix of the next.
Every turn has the rolling hash of the turns up to it (two polynomial hashes modulo 2^64 over the
turns' fingerprints, 128 bits). A conversation whose last hash another, longer conversation passes
through at the same turn is a snapshot; an anti-join leaves the maximal ones, of equal ones that
with the smallest id, and these are rendered turn by turn.

Turns are dealt out by ranges of (conv_id, turn), so that one long conversation spreads over
tasks; hashes are rolled within a task, and a conversation that crosses task borders gets its
beginning from at most one row a task. Groups of equal prefixes are counted with partial sums.

Defined cases: rows equal in all four columns are one turn; turns are ordered by number, then by
fingerprint; nulls of role and text are empty; a null turn comes first; rows without a conv_id are
one conversation; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import settle

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_M = (1 << 64) - 1


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.xxhash64(F.lit(1), role, text).alias("f1"), F.xxhash64(F.lit(2), text, role).alias("f2"),
    )


def _roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, turn, f1, f2): equal rows once, place and hashes within this task."""
    part = TaskContext.get().partitionId()
    conv, last, place, h1, h2, begun = None, None, 0, 0, 0, False
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if begun and row == last:
                continue
            if not begun or row[0] != conv:
                conv, place, h1, h2, begun = row[0], 0, 0, 0, True
            last, place = row, place + 1
            h1, h2 = (h1 * BASES[0] + (row[2] & _M)) & _M, (h2 * BASES[1] + (row[3] & _M)) & _M
            out.append((part, conv, row[1], row[2], row[3], place, h1, h2))
        kinds = [pa.int64()] * 6 + [pa.uint64()] * 2
        columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
        columns[6:] = [pa.array(c.to_numpy(zero_copy_only=False).view(np.int64)) for c in columns[6:]]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "conv_id", "turn", "f1", "f2", "place", "h1", "h2"])


ROLLED = "part long, conv_id long, turn long, f1 long, f2 long, place long, h1 long, h2 long"


def _carry_on(carries: dict[tuple, tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, conv, turn, f1, f2, place, h1, h2 = (c.to_pylist() for c in batch.columns)
            for i, key in enumerate(zip(conv, part)):
                if key in carries:
                    n, c1, c2 = carries[key]
                    h1[i] = (c1 * pow(BASES[0], place[i], 1 << 64) + (h1[i] & _M)) & _M
                    h2[i] = (c2 * pow(BASES[1], place[i], 1 << 64) + (h2[i] & _M)) & _M
                    place[i] += n
            signed = [pa.array(np.array([x & _M for x in h], np.uint64).view(np.int64)) for h in (h1, h2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(place, pa.int64()), *signed], names=batch.schema.names)

    return run


def prefix_hashes(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, f1, f2, place, h1, h2: each distinct turn with the hash of the turns up to it."""
    key = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "f1", "f2")]
    rows = _turns(conversations).select("conv_id", "turn", "f1", "f2").repartitionByRange(*key).sortWithinPartitions(*key)
    rolled = settle(rows.mapInArrow(_roll, ROLLED))
    ends = rolled.groupBy("conv_id", "part").agg(F.max("place").alias("n"), F.max_by("h1", "place").alias("h1"), F.max_by("h2", "place").alias("h2"))
    crossing = rolled.groupBy("conv_id").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select(F.col("conv_id").alias("of"))
    # conversations that cross a border: at most one row a task
    pieces = ends.join(settle(crossing), F.col("conv_id").eqNullSafe(F.col("of")), "left_semi").orderBy("conv_id", "part").collect()
    carries: dict[tuple, tuple[int, int, int]] = {}
    now: tuple = ()
    for r in pieces:
        if now and now[0] == r.conv_id:
            _, n, c1, c2 = now
            carries[(r.conv_id, r.part)] = (n, c1, c2)
        else:
            n, c1, c2 = 0, 0, 0
        c1 = (c1 * pow(BASES[0], r.n, 1 << 64) + (r.h1 & _M)) & _M
        c2 = (c2 * pow(BASES[1], r.n, 1 << 64) + (r.h2 & _M)) & _M
        now = (r.conv_id, n + r.n, c1, c2)
    if carries:
        rolled = settle(rolled.mapInArrow(_carry_on(carries), ROLLED))
    return rolled.drop("part")


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns of the conversations that are no snapshot of a longer one, equal ones once."""
    ends = prefixes.groupBy("conv_id").agg(F.max("place").alias("n_turns"), F.max_by("h1", "place").alias("e1"), F.max_by("h2", "place").alias("e2"))
    ends = settle(ends)
    whole = ends.groupBy("n_turns", "e1", "e2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("ending"))
    passing = prefixes.groupBy("place", "h1", "h2").agg(F.count(F.lit(1)).alias("held"))
    same = (F.col("n_turns") == F.col("place")) & (F.col("e1") == F.col("h1")) & (F.col("e2") == F.col("h2"))
    whole = settle(whole)
    snapshots = settle(whole.join(passing, same).filter("held > ending").select(F.col("n_turns").alias("sn"), F.col("e1").alias("s1"), F.col("e2").alias("s2")))
    is_one = (F.col("n_turns") == F.col("sn")) & (F.col("e1") == F.col("s1")) & (F.col("e2") == F.col("s2"))
    return settle(whole.join(snapshots, is_one, "left_anti").select("conv_id", "n_turns"))


def rendered(conversations: DataFrame) -> DataFrame:
    """conv_id, place, n_turns, role, rendered: the turns of maximal conversations in chat form.

    Marks within roles and texts are broken up, so that no text can begin a turn.
    """
    prefixes = prefix_hashes(conversations)
    kept = maximal(prefixes).select(F.col("conv_id").alias("of"), "n_turns")
    chosen = settle(prefixes.join(kept, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", "turn", "f1", "f2", "place", "n_turns"))
    turns = _turns(conversations).toDF("t_conv", "t_turn", "role", "text", "t1", "t2").dropDuplicates(["t_conv", "t_turn", "t1", "t2"])
    same = F.col("conv_id").eqNullSafe(F.col("t_conv")) & F.col("turn").eqNullSafe(F.col("t_turn")) & (F.col("f1") == F.col("t1")) & (F.col("f2") == F.col("t2"))
    safe = lambda c: F.replace(F.col(c), F.lit("<|"), F.lit("< |"))
    line = F.concat(F.lit("<|"), safe("role"), F.lit("|>\n"), safe("text"), F.lit("<|end|>\n"))
    return turns.join(chosen, same).select("conv_id", "place", "n_turns", "role", line.alias("rendered"))
