from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordwash.llm import embed_dedup
from recordwash.llm.queries import op12_embed_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, cell long, digest string, n long, tile int, rows int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "d", 2, 3, 4) for i, v in rows], SCHEMA).repartition(4)


def test_doubles(spark):
    rows = planted(100) + AWKWARD
    doubles = frame(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert Counter(map(tuple, embed_dedup.link(doubles).collect())) == Counter(expected(rows))


def near(random, base, cosine):
    other = random.standard_normal(len(base))
    other -= (other @ base) * base / (base @ base)
    other *= np.linalg.norm(base) / np.linalg.norm(other)
    return cosine * base + (1 - cosine**2) ** 0.5 * other


def planted(n, width=64, seed=1):
    """Vectors in all directions, pairs and chains about the threshold, groups and copies."""
    random = np.random.default_rng(seed)
    base = random.standard_normal((n, width))
    rows = list(base)
    for k, v in enumerate(base[: n // 3]):
        rows.append(near(random, v, random.uniform(0.86, 0.96)) * random.uniform(0.1, 9))
        if k % 3 == 0:
            rows.append(near(random, rows[-1], 0.93))
    for v in base[-3:]:
        rows += [near(random, v, 0.99) for _ in range(60)]
    rows += [base[0]] * 200 + [base[1]] * 3
    return [(int(i), [float(np.float32(x)) for x in v]) for i, v in zip(random.permutation(len(rows)), rows)]


AWKWARD = [
    (10_001, None), (10_002, []), (10_003, [0.0] * 64), (10_004, [1.0] * 63 + [None]),
    (10_005, [float("nan")] + [1.0] * 63), (10_006, [float("inf")] * 64), (10_007, [1.0] * 3),
    (10_008, [1e38] * 64), (10_009, [1e-38] * 64), (10_010, [-0.0] * 63 + [1.0]),
    (10_011, [0.0] * 63 + [2.0]), (10_012, [-1.0] * 64),
]


def expected(rows, width=64, threshold=0.9):
    good = {
        k: v for k, (_, v) in enumerate(rows)
        if v and len(v) == width and None not in v and np.isfinite(v).all() and any(v)
    }
    at = list(good)
    found = embed_dedup.unit(np.array(list(good.values()))) if at else np.zeros((0, width))
    links = (found @ found.T >= threshold) & ~np.eye(len(at), dtype=bool)
    label = np.arange(len(at))
    while True:
        least = np.where(links, label[None, :], len(at)).min(1, initial=len(at)) if len(at) else label
        new = np.minimum(label, least)
        if np.array_equal(new, label):
            break
        label = new
    ids, out = [rows[k][0] for k in at], {}
    for k, own in zip(at, label):
        mine = [i for i, other in zip(ids, label) if other == own and i is not None]
        out[k] = min(mine) if mine else None
    counts = dict(zip(at, links.sum(1).tolist()))
    return [
        (i, counts.get(k, 0), out.get(k, i) , out.get(k, i) == i) for k, (i, _) in enumerate(rows)
    ]


def found(spark, rows, **options):
    result = embed_dedup.link(frame(spark, rows), **options)
    assert result.columns == ["vec_id", "n_links", "component_id", "kept"]
    return list(map(tuple, result.collect()))


def test_one_cell_is_exact(spark):
    rows = planted(300) + AWKWARD
    assert Counter(found(spark, rows)) == Counter(expected(rows))


def test_null_and_repeated_ids(spark):
    v, w = planted(2)[0][1], planted(2, seed=2)[0][1]
    rows = [(None, v), (4, v), (4, v), (4, w), (None, w), (None, None), (7, None)]
    assert Counter(found(spark, rows)) == Counter(expected(rows))


@pytest.mark.parametrize("cell_rows", [16_384, 30])
def test_many_cells_and_split_cells(spark, monkeypatch, cell_rows):
    """Links found are right; of those at the threshold hardly any is lost, of close ones none."""
    monkeypatch.setattr(embed_dedup, "MEAN_ROWS", 50)
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", cell_rows)
    rows = planted(900)
    mine, theirs = dict((r[0], r) for r in found(spark, rows)), expected(rows)
    assert all(mine[r[0]][1] <= r[1] for r in theirs)
    all_links = sum(r[1] for r in theirs)
    lost = sum(r[1] - mine[r[0]][1] for r in theirs)
    few = [r for r in theirs if 0 < r[1] < 10]
    lost_of_few = sum(r[1] - mine[r[0]][1] for r in few)
    assert lost <= 0.002 * all_links and lost_of_few <= 0.03 * sum(r[1] for r in few)


def test_results_do_not_depend_on_the_size(spark, monkeypatch):
    """More rows than a cell and a tile hold: every link is found all the same."""
    monkeypatch.setattr(embed_dedup, "MEAN_ROWS", 50)
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 100)
    rows = planted(900) + AWKWARD
    assert Counter(found(spark, rows)) == Counter(expected(rows))


def test_cells_only_for_a_recall(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "MEAN_ROWS", 50)
    rows = planted(900)
    mine, theirs = dict((r[0], r) for r in found(spark, rows, recall=0.97)), expected(rows)
    assert all(mine[r[0]][1] <= r[1] for r in theirs)
    assert sum(r[1] for r in mine.values()) >= 0.998 * sum(r[1] for r in theirs)


def test_split_cell_alone_is_exact(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL_ROWS", 100)
    rows = planted(300)
    assert Counter(found(spark, rows)) == Counter(expected(rows))


def test_tables_follow_from_the_recall():
    sample = np.random.default_rng(0).standard_normal((500, 64))
    one = embed_dedup.plan_for(sample, 64, 1000, 0.9, 0.97)
    small = embed_dedup.plan_for(sample, 64, 50_000, 0.9, 0.97)
    large = embed_dedup.plan_for(sample, 64, 10**9, 0.9, 0.97)
    assert one.tables == 1 < small.tables < large.tables <= 30
    sizes = [np.prod([2 * r.shape[1] for r in t]) for t in large.rotations]
    assert min(sizes) >= 10**9 / embed_dedup.MEAN_ROWS


def test_pairs_at_the_threshold_are_met():
    """Recall by brute force of pairs just at the threshold, over the tables for a large table."""
    random = np.random.default_rng(3)
    a = embed_dedup.unit(random.standard_normal((4000, 64)))
    b = embed_dedup.unit(np.array([near(random, v, 0.9001) for v in a]))
    plan = embed_dedup.plan_for(a, 64, 10**7, 0.9, 0.97)
    met = np.zeros(len(a), bool)
    for table in plan.rotations:
        met |= embed_dedup.cells(a @ plan.axes, table) == embed_dedup.cells(b @ plan.axes, table)
    assert met.mean() >= 0.96


@pytest.mark.parametrize("width", [1, 2, 16, 17, 40])
def test_widths(spark, width):
    rows = planted(60, width=width)
    assert Counter(found(spark, rows)) == Counter(expected(rows, width))


def test_empty_table(spark):
    assert found(spark, []) == []


def test_only_unusable(spark):
    rows = [(1, None), (2, []), (3, [0.0])]
    assert Counter(found(spark, rows)) == Counter((i, 0, i, True) for i, _ in rows)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    mine = Counter(map(tuple, op12_embed_dedup(spark, sf_dir).collect()))
    assert mine == Counter(expected([tuple(r) for r in rows]))
