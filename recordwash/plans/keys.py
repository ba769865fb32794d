"""Tables of keys that are already stored, made for looking up a batch's keys.

A folder holds its keys, 32-byte digests, in buckets by their first bits, sorted, with Parquet's
Bloom filters. The number of buckets grows with the folder, so a bucket stays a small file. A
lookup reads the buckets its keys fall in; up to `LITERAL_KEYS` keys are also pushed into the
scan, where statistics, page indexes and Bloom filters pass over what cannot hold them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

#: Keys of a bucket on average, and bits of a key that buckets are made from.
BUCKET_KEYS, MOST_BITS = 262_144, 16
#: Keys that are pushed into the scan one by one.
LITERAL_KEYS = 64


def bits_for(n_keys: int) -> int:
    return min(MOST_BITS, max(0, (n_keys - 1) // BUCKET_KEYS).bit_length())


def prefix(key: str) -> Column:
    """The number that a key's first two bytes make."""
    return F.conv(F.hex(F.substring(key, 1, 2)), 16, 10).cast("int")


def write_keys(keys: DataFrame, path: str, bits: int) -> None:
    bucket = F.shiftright(prefix("key"), MOST_BITS - bits).alias("bucket")
    rows = keys.select(*KEY_SCHEMA.names, bucket if bits else F.lit(0).alias("bucket"))
    rows = rows.repartition("bucket") if bits else rows.coalesce(1)
    (
        rows.sortWithinPartitions("bucket", "key")
        .write.partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#key", "true")
        .option("parquet.bloom.filter.expected.ndv#key", str(BUCKET_KEYS))
        .parquet(path)
    )


def buckets_of(keys: DataFrame) -> list[int]:
    """Prefixes of the keys: at most 65,536 numbers, however many keys there are."""
    return sorted(r[0] for r in keys.select(prefix("key")).distinct().collect())


def touched(prefixes: list[int], bits: int) -> list[int]:
    """Buckets of a folder that may hold keys with these prefixes."""
    return sorted({p >> (MOST_BITS - bits) for p in prefixes})


def only(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key may be one of `keys`, a stored table: all, or the few keys' own."""
    few = [r[0] for r in keys.select("key").limit(LITERAL_KEYS + 1).collect()]
    if len(few) > LITERAL_KEYS:
        return rows
    return rows.where(reduce(or_, (F.col("key") == F.lit(bytes(k)) for k in few), F.lit(False)))
