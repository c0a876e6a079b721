"""Quality rules of languages without a word list."""

import random

from tallyhouse.llm import quality


def test_each_language_is_its_own_reference(spark):
    """A script that few documents use is not judged by the others' letters."""
    rng = random.Random(3)
    latin, cyrillic = "abcdefghijklmnoprstuwyz", "абвгдежзиклмнопрстуфхцчшщ"
    text = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(90)) + "."
    rows = [(i, text(latin), "pl") for i in range(150)] + [(1000 + i, text(cyrillic), "ru") for i in range(40)] + [(2000 + i, text(cyrillic), "bg") for i in range(5)]
    rows += [(3000, " ".join(f"{rng.randint(0, 99999)}" for _ in range(90)), "ru"), (4000, text(latin), None)]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(r.kept for i, r in got.items() if i != 3000) and not got[3000].kept
    assert {got[i].judged_by for i in (0, 1000, 3000)} == {"classes"}
    assert {got[i].judged_by for i in (2000, 4000)} == {"base"}
