import hashlib
import zlib

import cases
import pytest
from pyspark.sql import functions as F

from recordwash.llm import merkle
from recordwash.llm.queries import MANIFEST_COLUMNS, op13_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int, n int, hash string, data string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = [doc_id, source, lang, n_chars, text]
    return digest(*("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes):
    """The root over the nodes and each one's siblings."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for proof, i in zip(proofs, at):
            run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
            proof.append("".join(run[: i % 8] + run[i % 8 + 1 :]))
        nodes = [digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [i // 8 for i in at]
    return nodes[0], proofs


def expected(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for group in order:
        ordered = sorted(groups[group], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((ordered, *climb([leaf(*r) for r in ordered])))
    root, upper = climb([t[1] for t in trees]) if trees else (None, [])
    return root, sorted(
        (str(r[0]), leaf(*r), subroot, root, digest(*proof, *above))
        for (ordered, subroot, proofs), above in zip(trees, upper)
        for r, proof in zip(ordered, proofs)
    )


def tables(size):
    texts = [None, "", "A b", "Ärger Ö", "x" * 70_000, "THE END"]
    rows = [(i * 7 % 1000, f"{i} Text", "en", None if i % 5 else "web", i) for i in range(size)]
    rows += [(i, texts[i % 6], [None, "", "é", "z", "=", "Z"][i % 6], "s", None) for i in range(40)]
    rows += [(3, "same", "en", "web", 4)] * 3 + [(None, "no id", "en", "web", 5)] * 2
    return rows + [(i, "t", f"l{i}", "s", 1) for i in range(size // 10)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, 2, "h", "d") for r in rows], SCHEMA).repartition(5)


def found(spark, rows, path, ids=None):
    merkle.write_manifest(frame(spark, rows), path, MANIFEST_COLUMNS, "lang", "doc_id")
    proofs = merkle.proofs(spark, path, ids)
    folded = merkle.fold(F.col("leaf"), F.col("steps"))
    kept = proofs.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("steps")), 256), folded
    ).collect()
    assert all(r[5] == r["root"] for r in kept)
    return sorted((str(r[0]), *r[1:5]) for r in kept)


@pytest.mark.parametrize("size", [0, 5000])
def test_equals_trees_built_in_one_place(spark, tmp_path, size):
    rows, path = tables(size), str(tmp_path / "m")
    root, proofs = expected(rows)
    assert found(spark, rows, path) == proofs
    assert merkle.root(spark, path) == root


def test_sizes_of_groups(spark, tmp_path):
    sizes = [1, 2, 7, 8, 9, 63, 64, 65, 511, 512, 513]
    rows = [(i, f"t{i}", f"of {n}", "s", 1) for n in sizes for i in range(n)]
    assert found(spark, rows, str(tmp_path / "m")) == expected(rows)[1]


def test_one_row(spark, tmp_path):
    rows = [(1, "t", None, "s", 1)]
    assert found(spark, rows, str(tmp_path / "m")) == expected(rows)[1]


def test_some_rows(spark, tmp_path):
    rows = tables(1500)
    ids = spark.createDataFrame([(7,), (999,), (5_000,)], "doc_id long")
    some = found(spark, rows, str(tmp_path / "m"), ids)
    assert some == [r for r in expected(rows)[1] if r[0] in ("7", "999")]


def test_empty_table(spark, tmp_path):
    assert found(spark, [], str(tmp_path / "m")) == []
    assert merkle.root(spark, str(tmp_path / "m")) is None


def test_altered_rows_do_not_verify(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in op13_merkle(spark, sf_dir).collect():
        text = texts[row["doc_id"]] or ""
        altered = zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in text)
        assert row["verified"] == (not altered)
