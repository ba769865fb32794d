import math
import random

import cases
import numpy as np

from recordwash.llm import jaccard_join
from recordwash.llm.components import components
from recordwash.llm.jaccard_join import least_matches, minhash, shingles
from recordwash.plans.staging import Staging


def shingle_set(text):
    found = cases.WORD.findall(text or "")
    n = min(5, len(found))
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1)) if found else None


def expected(rows):
    """(id, links, members of the class) for each row, by brute force."""
    sets = [shingle_set(t) for _, t in rows]
    group, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                    links[a] += 1
                    links[b] += 1
                    group[root(a)] = root(b)
    members = {}
    for x in range(len(rows)):
        members.setdefault(root(x), []).append(rows[x][0])
    out = []
    for x, (i, _) in enumerate(rows):
        own = members[root(x)]
        out.append((i, min((m for m in own if m is not None), default=None), len(own), links[x]))
    return in_order(out)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or 0, *r[2:]))


def found(spark, rows):
    return in_order(map(tuple, jaccard_join.join_similar(cases.frame(spark, rows)).collect()))


def edited(text, seed, n):
    draw, words = random.Random(seed), text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"w{draw.randrange(1000)}"
    return " ".join(words)


def test_awkward_rows(spark):
    assert found(spark, cases.texts()) == expected(cases.texts())


def test_groups_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "BUCKET", 12)
    base = cases.sentence(21, 120)
    rows = [(i, edited(base, i, i % 7)) for i in range(90)]
    rows += [(100 + i, cases.sentence(200 + i // 3, 50 + i)) for i in range(60)]
    random.Random(1).shuffle(rows)
    result = found(spark, rows)
    assert result == expected(rows)
    assert max(r[3] for r in result) > 12


def test_similarity_of_just_the_threshold(spark):
    # 36 shingles each, 32 shared: 32 / 40.
    text = cases.sentence(31, 40).split()
    rows = [(1, " ".join(text)), (2, " ".join([*text[:-4], "p", "q", "r", "s"]))]
    rows.append((3, " ".join([*text[:-5], "p", "q", "r", "s", "t"])))
    assert [r[3] for r in found(spark, rows)] == [r[3] for r in expected(rows)]
    assert found(spark, rows)[0][3] == 1


def test_one_of_each_class_stays(spark):
    docs = cases.frame(spark)
    kept = jaccard_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect())
    classes = {r[1] for r in expected([r for r in cases.texts() if shingle_set(r[1])])}
    wordless = [i for i, t in cases.texts() if not shingle_set(t)]
    assert ids == sorted([*classes, *(-1 if i is None else i for i in wordless)])


def test_empty_table(spark):
    assert jaccard_join.join_similar(cases.empty(spark)).count() == 0
    assert jaccard_join.drop_near_copies(cases.empty(spark)).count() == 0


def test_posterior():
    for n, m in least_matches().items():
        chance = lambda k: sum(
            math.comb(n + 1, i) * 0.8**i * 0.2 ** (n + 1 - i) for i in range(k + 1)
        )
        assert m == 0 or chance(m - 1) < jaccard_join.TOLERANCE
        assert chance(m) >= jaccard_join.TOLERANCE


def test_minhash_estimates_similarity():
    a = cases.sentence(41, 600)
    b = edited(a, 1, 20)
    x, y = shingles(a), shingles(b)
    exact = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    assert abs((minhash(x) == minhash(y)).mean() - exact) < 0.12


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(100, i) for i in range(101, 140)]
    edges = spark.createDataFrame([*chain, *star, (100, 100), (7, 6)], "a long, b long")
    with Staging(spark) as staging:
        rows = {r["node"]: r["root"] for r in components(edges, staging, "test").collect()}
    assert rows == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 140)}
