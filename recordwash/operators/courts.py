"""One name for each court, however much of its province and city is written.

A name stands for the longest name that ends with it, if all names that end with it are endings
of that one: then they are the same court, more or less fully written. A name that ends names of
several courts ("桥东区人民法院" of two cities) is ambiguous and stands for itself.

Names are compared by equality only: each name's endings, of the lengths that names have, meet
the names themselves. So the work is the number of names times that of lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Resolved names are broadcast up to so many; they are at most a few dozen bytes each.
BROADCAST_NAMES = 200_000


def court_names(records: DataFrame, *columns: str) -> DataFrame:
    """Distinct names in these columns, as `court`."""
    names = records.select(F.explode(F.array(*columns)).alias("court"))
    return names.where(F.col("court").isNotNull()).distinct()


def canonical_courts(names: DataFrame) -> DataFrame:
    """(court, canonical) of distinct names; `names` is a stored table."""
    # As many numbers as there are lengths of names.
    lengths = sorted(r[0] for r in names.select(F.char_length("court")).distinct().collect())
    if not lengths:
        return names.withColumn("canonical", F.col("court"))
    long = names.select(
        F.col("court").alias("long"),
        F.explode(F.array(*map(F.lit, lengths))).alias("n"),
    ).where(F.col("n") < F.char_length("long"))
    endings = long.select("long", F.expr("right(long, n)").alias("court"))
    met = names.join(endings, "court")
    longest = met.groupBy("court").agg(
        F.max(F.struct(F.char_length("long"), "long")).alias("longest")
    ).select("court", F.col("longest.long").alias("canonical"))
    one = met.join(longest, "court").groupBy("court", "canonical").agg(
        F.bool_and(F.col("canonical").endswith(F.col("long"))).alias("alike")
    )
    known = one.where("alike").drop("alike")
    return names.join(known, "court", "left").select(
        "court", F.coalesce("canonical", "court").alias("canonical")
    )


def with_canonical(
    records: DataFrame, courts: DataFrame, out: str, broadcast_names: int = BROADCAST_NAMES
) -> DataFrame:
    """Records with their court's one name; a name that `courts` lacks stands for itself.

    `courts` is a stored table (court, canonical) with a row per court.
    """
    if courts.count() <= broadcast_names:
        courts = F.broadcast(courts)
    named = courts.select("court", F.col("canonical").alias(out))
    joined = records.join(named, "court", "left")
    return joined.select(*records.columns, F.coalesce(out, "court").alias(out))
