"""Documents of a rare language are judged by their own language, or not at all."""

from __future__ import annotations

import numpy as np

from changefeed.llm import divergence


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(list(letters), rng.integers(3, 9))) for _ in range(n)) + "."


def test_a_rare_language_is_not_judged_by_others(spark):
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, "abcdefghijklmnoprstuvw", 70), "en") for i in range(3_300)]
    rows += [(10_000 + i, prose(rng, "абвгдежзиклмнопрсту", 70), "ru") for i in range(32)]
    rows += [(20_000 + i, prose(rng, "αβγδεζηθικλμνξοπρστυ", 70), lang) for i, lang in enumerate(["el", "el", None])]
    rows.append((30_000, prose(rng, "0123456789", 70), "ru"))
    rows.append((30_001, prose(rng, "0123456789", 70), "en"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in divergence.judge(df, with_text=False).collect()}
    assert len(got) == len(rows)
    assert [doc_id for doc_id, kept in sorted(got.items()) if not kept] == [30_000, 30_001]
