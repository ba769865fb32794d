import random

import cases
import numpy as np
import pyarrow as pa
import pytest

from recordwash.llm import substring_dedup
from recordwash.llm.substring_dedup import WINDOW, Block


def expected(rows):
    first = {}
    split = [(i if i is not None else 1 << 63, cases.WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        for at in range(len(words) - WINDOW + 1):
            window = tuple(words[at : at + WINDOW])
            first[window] = min(first.get(window, i), i)
    out = []
    for i, words in split:
        gone = {
            at + k
            for at in range(len(words) - WINDOW + 1)
            if first[tuple(words[at : at + WINDOW])] < i
            for k in range(WINDOW)
        }
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((None if i == 1 << 63 else i, len(words), len(gone), kept))
    return out


def found(spark, rows, **sizes):
    frame = cases.frame(spark, rows)
    return list(map(tuple, substring_dedup.remove_repeats(frame, **sizes).collect()))


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 500, "bucket_bytes": 2000}])
def test_awkward_rows(spark, sizes):
    rows = cases.texts()
    assert in_order(found(spark, rows, **sizes)) == in_order(expected(rows))


def test_few_words_and_runs(spark):
    draw = random.Random(11)
    rows = []
    for i in range(150):
        words = [w for _ in range(draw.randint(0, 12)) for w in [draw.choice("abc")] * draw.choice([1, 1, 2, 15])]
        rows.append((i, " ".join(words)))
    sizes = {"block_bytes": 400, "bucket_bytes": 1200}
    assert in_order(found(spark, rows, **sizes)) == in_order(expected(rows))


def test_planted_passages(spark):
    passage = cases.sentence(99, 55)
    rows = [
        (i, cases.sentence(i, 30) + f" {passage} " + cases.sentence(500 + i, 20))
        for i in range(40)
    ]
    result = found(spark, rows, block_bytes=2000, bucket_bytes=5000)
    assert in_order(result) == in_order(expected(rows))
    assert all(r[2] >= 55 for r in result if r[0] > 0)


def test_equal_windows_have_equal_anchors():
    draw = random.Random(12)
    for _ in range(200):
        core = [draw.choice("abcdef") for _ in range(WINDOW)]
        texts = [
            " ".join([*(draw.choice("abcdef") for _ in range(draw.randint(0, 9))), *core,
                      *(draw.choice("abcdef") for _ in range(draw.randint(0, 9)))])
            for _ in range(4)
        ]
        block = Block(list(range(4)), texts)
        anchors, digests = block.anchors(), block.exact_digests(block.windows)
        for digest in np.unique(digests):
            assert len(set(anchors[digests == digest])) == 1


def test_empty_table(spark):
    assert substring_dedup.remove_repeats(cases.empty(spark)).count() == 0


def test_passes_may_get_rows_in_any_order():
    rows = [(i, cases.sentence(i % 5, 30)) for i in range(20)] + [(None, "a b"), (3, "x")]
    tables = []
    for seed in (1, 2):
        mixed = random.Random(seed).sample(rows, len(rows))
        tables.append(pa.table({"id": [r[0] for r in mixed], "text": [r[1] for r in mixed]}))
    first, second = (substring_dedup._block(t) for t in tables)
    assert first.given_ids == second.given_ids
    assert (first.anchors() == second.anchors()).all()


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_of_any_pattern_have_names_of_their_own(spark):
    """Words that sums of powers of one factor, modulo 2^64, cannot tell apart."""
    for n in (16, 32, 64, 512, 2048):
        word = thue_morse(n)
        other = word.translate(str.maketrans("ab", "ba"))
        names, _ = substring_dedup.word_names([word.encode(), other.encode()])
        assert names[0] != names[1]
        same = "one two three four five six seven eight nine ten eleven twelve"
        rows = [(1, f"{same} {word}"), (2, f"{same} {other}"), (3, f"{other} {same}")]
        assert in_order(found(spark, rows)) == in_order(expected(rows))


def test_equal_names_alone_remove_nothing(spark, monkeypatch):
    """Were all words' names equal, the windows' own words would still decide."""
    rows = [(i, cases.sentence(i % 3, 20)) for i in range(6)] + [(9, cases.sentence(1, 20) + " x")]
    block = Block([r[0] for r in rows], [r[1] for r in rows])
    block.names[:] = 7
    candidates = substring_dedup.Candidates(block, np.ones(len(block.windows), bool), 1)
    gone = {int(block.doc[w]) for w in candidates.repeated({}).tolist()}
    assert gone == {3, 4, 5, 6}


def test_long_and_short_words(spark):
    draw = random.Random(3)
    words = ["x" * n for n in (1, 63, 64, 65, 200)] + ["y" * 64 + "z", "é" * 40]
    rows = [(i, " ".join(draw.choices(words, k=30))) for i in range(40)]
    assert in_order(found(spark, rows, block_bytes=9000)) == in_order(expected(rows))
