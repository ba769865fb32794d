"""WARC archives: write one record per page, read them back by boundary-chain verification.

Writing: pages of equal payload are found by digest; the one with the smallest id is written
in full, the others as revisits. Spark's text writer writes the records, with the blank lines
that end a record as its line end, from the tasks that read the pages.

Reading: Spark splits the archives, also within a file, wherever the magic `WARC/1.` stands. The
pieces are stored once: where Spark splits a file differs from job to job, and with it their numbers.
Each piece may be a record or part of a payload that holds the magic. Tasks emit candidates:
a piece's place and the offset at which its successor must begin, by its own header. Pointer
jumping from the start of each file keeps the candidates that are reached; the others belong
to the payload of the record before them. Only narrow rows (five numbers a piece) meet, by
file, and only pieces of records that contain the magic are put together by a shuffle.

Defined results: null html counts as empty; a null url gives an empty one; a null id is never
the first of its group if there is another; where several rows have the smallest id and the
same payload, all of them are responses; an empty table gives an archive without records and an
empty result. A record after a gap or a broken header isn't reached; a cut last record is not
returned. Other columns of the pages don't matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwash.llm.common import join_groups, scratch, text_of

MAGIC = "WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PLACE = ["file", "block", "piece"]


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: four letters from every five hexadecimal digits."""
    digits = F.sha1(payload)
    letters = []
    for first in range(1, 41, 5):
        value = F.conv(F.substring(digits, first, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            five_bits = F.shiftright(value, shift).bitwiseAND(F.lit(31))
            letters.append(F.substring(F.lit(BASE32), five_bits + 1, F.lit(1)))
    return F.concat(*letters)


def mark_revisits(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0
) -> DataFrame:
    """id, url, payload, n_bytes, digest, and first_id: the page that a revisit refers to."""
    payload = text_of(payload_col)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.regexp_replace(text_of(url_col), r"[\x00-\x20]+", "").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
        payload_digest(payload).alias("digest"),
    )
    found = (
        rows.where(F.col("n_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.count("*").alias("n_pages"), F.min("id").alias("first_id"))
        .where("n_pages > 1")
    )
    groups = scratch(pages.sparkSession).store(found, "repeated_payloads")
    repeats = groups.agg(F.coalesce(F.sum("n_pages"), F.lit(0))).first()[0]
    marked = join_groups(rows, groups, "digest", "n_pages", repeats, "left")
    is_first = F.col("id").eqNullSafe(F.col("first_id"))
    return marked.withColumn("first_id", F.when(~is_first, F.col("first_id"))).drop("n_pages")


def _record_id(page_id: Column) -> Column:
    x = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("null"))))
    parts = [F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record(date: str) -> Column:
    """A whole record, without the blank lines that end it."""
    revisit = F.col("first_id").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n_bytes").cast("string"), F.lit(END),
    )
    in_full = F.when(revisit, 0).otherwise(F.col("n_bytes"))
    fields = {
        "WARC-Type": F.when(revisit, "revisit").otherwise("response"),
        "WARC-Record-ID": _record_id(F.col("id")),
        "WARC-Date": F.lit(date),
        "WARC-Target-URI": F.col("url"),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
        "WARC-Profile": F.when(revisit, PROFILE),
        "WARC-Refers-To": F.when(revisit, _record_id(F.col("first_id"))),
        "WARC-Page-ID": F.col("id").cast("string"),
        "WARC-Refers-To-Page-ID": F.col("first_id").cast("string"),
        "WARC-Payload-Length": F.col("n_bytes").cast("string"),
        "Content-Type": F.lit("application/http; msgtype=response"),
        "Content-Length": (F.octet_length(http) + in_full).cast("string"),
    }
    lines = [
        F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value))
        for name, value in fields.items()
    ]
    head = F.concat_ws("\r\n", F.lit(MAGIC + "0"), *lines)
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    return F.concat(head, F.lit(END), http, body)


def write_archives(
    pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0,
) -> None:
    marked = mark_revisits(pages, id_col, url_col, payload_col, least_bytes)
    marked.select(record(date).alias("record")).write.text(out, lineSep=END)


def _field(head: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1), F.lit(""))


def _record_size(head: Column) -> Column:
    """The size that a piece's record must have, if it has a header."""
    size = F.octet_length("value").cast("long")
    head_size = F.octet_length(head).cast("long")
    body = _field(head, "Content-Length").try_cast("long")
    return F.when(
        head_size + len(END) <= size, len(MAGIC) + head_size + len(END) + body + len(END)
    )


def pieces(spark: SparkSession, out: str) -> DataFrame:
    """What stands between occurrences of the magic, its size and its record's, if it has a header."""
    text = spark.read.option("lineSep", MAGIC).option("pathGlobFilter", "part-*").text(out)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("piece"),
        "value",
        (F.octet_length("value").cast("long") + len(MAGIC)).alias("size"),
        _record_size(F.substring_index("value", END, 1)).alias("record_size"),
    )


def reachable(start: np.ndarray, successor: np.ndarray, end: int) -> np.ndarray:
    """Which candidates a chain of successors from offset 0 reaches, by pointer jumping.

    `start` rises; a candidate that ends at no other's start, or beyond the end, leads nowhere.
    """
    n = len(start)
    place = np.minimum(np.searchsorted(start, successor), n - 1) if n else np.zeros(0, int)
    jump = np.append(np.where(start[place] == successor, place, n), n) if n else np.array([0])
    reached = np.zeros(n + 1, bool)
    if n and start[0] == 0:
        reached[0] = True
    for _ in range(max(1, n).bit_length()):
        reached[jump[np.flatnonzero(reached)]] = True
        jump = jump[jump]
    return reached[:n] & (successor <= end)


def owners(file: pd.DataFrame) -> pd.DataFrame:
    """For each piece of one archive the record that it belongs to, if any."""
    file = file.sort_values(["block", "piece"], ignore_index=True)
    ends = np.cumsum(file["size"].to_numpy())
    start = ends - file["size"].to_numpy() - len(MAGIC)  # of the magic before the piece
    end = int(ends[-1]) - len(MAGIC)
    size = file["record_size"].to_numpy(float, na_value=np.nan)
    is_candidate = ~np.isnan(size) & (start >= 0)
    at = np.flatnonzero(is_candidate)
    successor = start[at] + size[at].astype(np.int64)
    good = at[reachable(start[at], successor, end)]
    owner = np.full(len(file), -1)
    owner[good] = good
    owner = np.maximum.accumulate(owner)
    offset = np.where(owner >= 0, start[owner], -1)
    inside = (owner >= 0) & (start < offset + np.where(owner >= 0, np.nan_to_num(size[owner]), 0))
    alone = np.zeros(len(file), bool)
    alone[good] = np.append(start[1:], end)[good] == start[good] + size[good]
    return file[PLACE].assign(record=np.where(inside, offset, -1), alone=alone)


def read_archives(spark: SparkSession, out: str) -> DataFrame:
    """Every reachable record: its fields, payload, and whether the payload fits its digest."""
    staging = scratch(spark)
    pieces(spark, out).write.option("compression", "zstd").parquet(staging.path("pieces"))
    found = spark.read.parquet(staging.path("pieces"))
    chain = found.select(*PLACE, "size", "record_size").groupBy("file").applyInPandas(
        owners, "file string, block long, piece long, record long, alone boolean"
    )
    others = staging.store(chain.where("not alone"), "joined_pieces")
    alone = found.join(others, PLACE, "left_anti").select("file", "value")
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "value")))
    joined = (
        found.join(others.where("record >= 0"), PLACE)
        .groupBy("file", "record")
        .agg(F.array_join(F.transform(parts, lambda p: p["value"]), MAGIC).alias("value"))
    )
    return _parsed(alone.unionByName(joined.select("file", "value")))


def _parsed(records: DataFrame) -> DataFrame:
    head = F.substring_index("value", END, 1)
    length = _field(F.col("head"), "Content-Length").cast("int")
    body = F.substring(
        F.col("value").cast("binary"), F.octet_length("head") + len(END) + 1, F.col("length")
    )
    http = F.substring_index(F.col("body").cast("string"), END, 1)
    http_size = F.octet_length(http) + len(END)
    payload = F.substring("body", http_size + 1, F.col("length"))
    fields = {
        "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "url": "WARC-Target-URI",
        "declared": "WARC-Payload-Digest", "page_id": "WARC-Page-ID",
        "refers_to": "WARC-Refers-To-Page-ID", "declared_bytes": "WARC-Payload-Length",
    }
    revisit = F.col("record_type") == "revisit"
    declared = F.substring_index("declared", ":", -1)
    return (
        records.withColumn("head", head)
        .withColumn("length", length)
        .withColumn("body", body)
        .select(
            *[_field(F.col("head"), f).alias(c) for c, f in fields.items()],
            payload.alias("payload"),
        )
        .withColumn("found", F.when(~revisit, payload_digest(F.col("payload"))))
        .select(
            "record_type", "record_id", "url", "page_id", "refers_to",
            F.when(revisit, F.col("declared_bytes").cast("long"))
            .otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
            F.coalesce("found", declared).alias("payload_digest"),
            F.coalesce(F.col("found") == declared, F.lit(True)).alias("digest_fits"),
            F.when(~revisit, F.col("payload")).alias("payload"),
        )
    )
