"""Awkward rows that every operator must take."""

from __future__ import annotations

import random
import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, "
    "row string, digest string, score double, token_ids string, decoded string, label int"
)

WORD = re.compile(r"[^ \t-\r]+")


def sentence(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 9))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base, other = sentence(1, 60), sentence(2, 60)
    near = base.split()
    near[30] = "changed"
    return [
        (5, base), (3, base.replace(" ", "\n")), (9, base + "  "), (4, base), (4, base),
        (6, " ".join(near)), (7, other), (8, base + " " + other), (10, other + " " + base),
        (11, None), (12, ""), (13, " \t\n"), (14, "one two three"), (15, "one two  three"),
        (None, other), (None, None), (16, "ha " * 40), (17, "ha " * 55 + "ho"),
        (18, "x" * 5000), (19, "Ärger <|endoftext|> Straße's ΣΑΣ ２² — “quoted”　İx"),
        (20, sentence(3, 3000)), (21, "a b c d"), (22, "a b c d"), (23, "THE!! END!! " * 30),
    ]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    extra = ("en", None, 1, "k", "r", "d", 0.5, "t", None, 1)
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
