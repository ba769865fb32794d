"""Exact dedup: two Bloom passes find digests that may repeat; only their rows shuffle.

Pass 1 counts how often each bit of a Bloom filter is hit. The bits hit at least twice make
the second filter: a digest that occurs twice has all its bits in it. Pass 2 tests every row
against it. Rows that fail are unique and pass straight through; the others are grouped by
their SHA-256, so a false positive costs a shuffled row, never a wrong result.

The filter has `BITS_PER_ROW` bits a row, in blocks of 32,768 bits, and at most `MAX_BLOCKS`
blocks (32 MB): only that is broadcast. Beyond it more unique rows shuffle, as narrow rows.

Defined results: null text counts as empty; a null id sorts after all ids; of rows that tie
in length and id, one stays; an empty table gives an empty result; other columns of any name
pass through `drop_copies` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordwash.llm.common import (
    BLANK,
    free_name,
    join_groups,
    quoted,
    row_digest,
    scratch,
    text_of,
)

BLOCK_BITS = 32_768
BITS_PER_ROW = 16
MAX_BLOCKS = 8_192


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), BLANK + "+", "")


def digest(text: str) -> Column:
    """Lowercase hex SHA-256 of the text without white space."""
    return F.sha2(normalised(text), 256)


def with_positions(rows: DataFrame, n_blocks: int) -> DataFrame:
    """A digest's block and its two bits there, which always differ."""
    first, second = F.xxhash64("digest"), F.xxhash64("digest", F.lit("second"))
    bit_a = F.pmod(second, F.lit(BLOCK_BITS))
    step = F.lit(1) + F.pmod(F.shiftright(second, 20), F.lit(BLOCK_BITS - 1))
    return (
        rows.withColumn("block", F.pmod(first, F.lit(n_blocks)))
        .withColumn("bit_a", bit_a)
        .withColumn("bit_b", F.pmod(F.col("bit_a") + step, F.lit(BLOCK_BITS)))
    )


def _hits(rows: DataFrame, n_blocks: int) -> DataFrame:
    return with_positions(rows, n_blocks).select(
        "block", F.explode(F.array("bit_a", "bit_b")).alias("bit")
    )


def repeat_filter(rows: DataFrame, n_blocks: int) -> DataFrame:
    """(block, bits): the bits that more than one row hits."""
    repeated = _hits(rows, n_blocks).groupBy("block", "bit").count().where("count > 1")
    return repeated.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def member_filter(rows: DataFrame, n_blocks: int) -> DataFrame:
    """(block, bits): the bits that any row hits."""
    hits = _hits(rows, n_blocks)
    return hits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def has_bit(bits: str, position: str) -> Column:
    byte = F.substring(F.col(bits), F.floor(F.col(position) / 8).cast("int") + 1, F.lit(1))
    value = F.ascii(F.decode(byte, "ISO-8859-1"))
    return F.getbit(value, (F.col(position) % 8).cast("int")) == 1


def may_repeat(rows: DataFrame, bloom: DataFrame, n_blocks: int, flag: str) -> DataFrame:
    """All rows with `flag`: whether the digest may occur in another row."""
    tested = with_positions(rows, n_blocks).join(F.broadcast(bloom), "block", "left")
    both = has_bit("bits", "bit_a") & has_bit("bits", "bit_b")
    return tested.withColumn(flag, F.coalesce(both, F.lit(False))).drop(
        "block", "bits", "bit_a", "bit_b"
    )


def blocks_for(n_rows: int) -> int:
    return min(MAX_BLOCKS, max(1, -(-n_rows * BITS_PER_ROW // BLOCK_BITS)))


def first_of(length: str, row_id: str, *ties: str) -> Column:
    """The row that stays: most code points, then smallest id, null last."""
    order = [(-F.col(length)).alias("shorter"), F.col(row_id).isNull().alias("no_id")]
    return F.min(F.struct(*order, F.col(row_id).alias("id"), *ties))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, keep_id, group_size, kept and text_sha256; one row of a group is kept."""
    staging = scratch(docs.sparkSession)
    narrow = docs.select(
        F.col(id_col).alias("id"),
        F.char_length(text_of(text_col)).alias("length"),
        digest(text_col).alias("digest"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    rows = staging.store(narrow, "digests")
    n_rows = rows.count()
    n_blocks = blocks_for(n_rows)
    bloom = staging.store(repeat_filter(rows, n_blocks), "filter")
    tested = may_repeat(rows, bloom, n_blocks, "maybe")

    candidates = tested.where("maybe").drop("maybe")
    found = candidates.groupBy("digest").agg(
        F.count("*").alias("group_size"), first_of("length", "id", "row_id").alias("first")
    )
    groups = staging.store(
        found.select(
            "digest", "group_size", F.col("first.id").alias("keep_id"),
            F.col("first.row_id").alias("keep_row"),
        ),
        "groups",
    )
    grouped = join_groups(candidates, groups, "digest", "group_size", n_rows)
    alone = tested.where(~F.col("maybe")).select(
        "*", F.lit(1).cast("long").alias("group_size"), F.col("id").alias("keep_id"),
        F.col("row_id").alias("keep_row"),
    )
    return grouped.unionByName(alone.drop("maybe")).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, whole. Rows that cannot repeat are not shuffled."""
    staging = scratch(docs.sparkSession)
    whole = free_name(docs, "whole_row")
    rows = docs.select(
        F.struct(*[docs[quoted(c)] for c in docs.columns]).alias(whole),
        docs[id_col].alias("id"),
        F.char_length(text_of(text_col)).alias("length"),
        digest(text_col).alias("digest"),
        row_digest(docs).alias("tie"),
    )
    narrow = staging.store(rows.drop(whole), "digests")
    n_blocks = blocks_for(narrow.count())
    bloom = staging.store(repeat_filter(narrow, n_blocks), "filter")
    keepers = staging.store(_keepers(may_repeat(narrow, bloom, n_blocks, "maybe")), "keepers")

    tested = may_repeat(rows, bloom, n_blocks, "maybe")
    alone = tested.where(~F.col("maybe")).select(whole)
    firsts = tested.where("maybe").alias("r").join(
        keepers.alias("k"),
        (F.col("r.digest") == F.col("k.digest"))
        & (F.col("r.length") == F.col("k.length"))
        & F.col("r.id").eqNullSafe(F.col("k.id"))
        & (F.col("r.tie") == F.col("k.tie")),
    )
    single = firsts.where("k.same_rows = 1").select(whole)
    same = firsts.where("k.same_rows > 1").select(whole, "r.digest").dropDuplicates(["digest"])
    return alone.unionByName(single).unionByName(same.select(whole)).select(f"{whole}.*")


def _keepers(tested: DataFrame) -> DataFrame:
    """Per digest that may repeat, the row that stays, and how many rows equal it throughout."""
    alike = (
        tested.where("maybe").groupBy("digest", "length", "id", "tie").agg(F.count("*").alias("n"))
    )
    first = alike.groupBy("digest").agg(first_of("length", "id", "tie", "n").alias("first"))
    return first.select(
        "digest", (-F.col("first.shorter")).alias("length"), "first.id", "first.tie",
        F.col("first.n").alias("same_rows"),
    )
