"""Replay-safe tables of the batch and streaming jobs.

A batch writes each of its tables into a folder of its own and publishes them together (see
`manifest`): a crash leaves the tables as they were, and running a batch again replaces its rows.
`run` is the id Spark keeps with a checkpoint: a fresh checkpoint, which numbers its batches from
0 again, never replaces an older run's batches.

Small folders are merged by tiers: `FAN_IN` folders merged equally often become one. So the number
of folders grows with the logarithm of the number of batches, and a row is written again as often.

Tables with keys keep them in a table of their own besides (see `keys`), by which a batch finds
out what is known without reading all keys.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordwash.operators.fields import family_view
from recordwash.operators.offsets import upsert
from recordwash.plans.keys import KEY_SCHEMA, bits_for, buckets_of, only, touched, write_keys
from recordwash.plans.manifest import Entry, Manifests, replaced
from recordwash.schema import (
    CLEANED, DUPLICATES, ECHO_SCHEMA, FIRST_SEEN_SCHEMA, LINE_SCHEMA, MAIN, OFFSET_SCHEMA, PROGRESS_SCHEMA,
    REJECT_SCHEMA, REJECTED, REVIEW, STORED_SCHEMA, WORD_COUNT_SCHEMA,
)

TABLES = {
    "records": STORED_SCHEMA,
    "rejects": REJECT_SCHEMA,
    "progress": PROGRESS_SCHEMA,
    "offsets": OFFSET_SCHEMA,
    "word_counts": WORD_COUNT_SCHEMA,
    "echo": ECHO_SCHEMA,
    "first_seen": FIRST_SEEN_SCHEMA,
    "lines": LINE_SCHEMA,
    "record_keys": KEY_SCHEMA,
    "line_keys": KEY_SCHEMA,
}
#: Destinations of the tables that have a column `dest`; each is a folder of its own.
PARTS = {"records": [MAIN, DUPLICATES, REVIEW], "lines": [CLEANED, REJECTED]}
#: Tables with keys: the key's column, the destination whose keys count (all if None), their table.
KEYED = {"records": ("match_key", MAIN, "record_keys"), "lines": ("line_key", None, "line_keys")}
BATCH = ["run", "batch_id"]
#: Folders of a tier that are merged into one of the next.
FAN_IN = 8
#: Size of the files that a merge writes.
FILE_BYTES = 128 << 20


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifests = Manifests(spark, self.root)
        self.files = self.manifests.files

    def create(self) -> None:
        """Make the store if it is absent, with all its tables empty."""
        if self.manifests.last()[0] < 0:
            # None if another writer came first.
            self.manifests.publish(lambda entries: entries or [])

    def read(self, table: str) -> DataFrame:
        """All rows of the last manifest."""
        return self._read(self.manifests.last()[1], table)

    def _read(self, entries: list[Entry], table: str) -> DataFrame:
        parts = [self._part(entries, table, part) for part in PARTS.get(table, [None])]
        return reduce(DataFrame.unionByName, parts)

    def _part(self, entries: list[Entry], table: str, part: str | None) -> DataFrame:
        """A destination's rows, with `dest`; of other tables all rows."""
        found = [e for e in entries if e.table == table and part in (None, e.part)]
        rows = self._rows(found, table)
        if table not in PARTS:
            return rows
        return rows.withColumn("dest", F.lit(part)).select(*TABLES[table].names)

    def _rows(self, entries: list[Entry], table: str) -> DataFrame:
        """The rows in these folders, but for replaced batches."""
        schema = T.StructType([f for f in TABLES[table] if f.name != "dest"])
        reader = self.spark.read.schema(schema)
        whole = [f"{self.root}/{e.folder}" for e in entries if not e.without]
        scans = [reader.parquet(*whole)] if whole else []
        for e in entries:
            if e.without:
                gone = reduce(Column.__or__, (_of_batch(*pair) for pair in e.without))
                scans.append(reader.parquet(f"{self.root}/{e.folder}").where(~gone))
        if not scans:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, scans)

    def records(self, dest: str) -> DataFrame:
        """Main, duplicates or review table; other destinations' files are not read."""
        return self._part(self.manifests.last()[1], "records", dest)

    def families(self, dest: str) -> DataFrame:
        """Stored records with their columns in the two families, keyed by row."""
        return family_view(self.records(dest), ["row_key"])

    def create_views(self, prefix: str = "") -> None:
        """Temporary views main, duplicates and review, for SQL text."""
        for dest in PARTS["records"]:
            self.records(dest).createOrReplaceTempView(prefix + dest)

    def known(self, table: str, keys: DataFrame, run: str, batch_id: int) -> DataFrame:
        """Stored keys of the table that may be among `keys`, in a column of that name.

        `keys` is a stored table of one key column. Of the stored ones only the buckets that
        these keys fall in are read; this batch's own rows of an earlier attempt don't count.
        """
        name = keys.columns[0]
        keys = keys.select(F.col(name).alias("key")).where(F.col("key").isNotNull())
        entries = [e for e in self.manifests.last()[1] if e.table == KEYED[table][2]]
        # Where no folder has more than one bucket, all are touched.
        prefixes = buckets_of(keys) if any(e.bits for e in entries) else [0]
        found = [part for e in entries for part in _buckets(e, touched(prefixes, e.bits))]
        own = (F.col("run") == run) & (F.col("batch_id") >= batch_id)
        rows = self._rows(found, KEYED[table][2]).where(~own)
        return only(rows, keys).select(F.col("key").alias(name))

    def batch(self, run: str, batch_id: int) -> Batch:
        return Batch(self, run, batch_id)

    def merge(self) -> None:
        """Merge tiers that are full. Each merge is published alone; readers are not disturbed."""
        while full := self._full_tier():
            table, part, tier = full[0].table, full[0].part, full[0].tier
            folder = _new_folder(table)
            bits, absent = 0, []
            if table in [keyed[2] for keyed in KEYED.values()]:
                rows = self._rows([part for e in full for part in _buckets(e, range(1 << e.bits))], table)
                bits, absent = self._write_keys(rows, folder)
            else:
                rows = self._rows(full, table)
                size = sum(self.files.size(f"{self.root}/{e.folder}") for e in full)
                n_files = max(1, -(-size // FILE_BYTES))
                rows.coalesce(n_files).write.parquet(f"{self.root}/{folder}")
            runs: dict[str, list[int]] = {}
            for e in full:
                for run, (low, high) in e.runs.items():
                    a, b = runs.get(run, (low, high))
                    runs[run] = [min(a, low), max(b, high)]
            merged = Entry(table, folder, part, runs, tier + 1, bits, absent)

            def change(entries: list[Entry]) -> list[Entry] | None:
                if any(e not in entries for e in full):
                    return None  # someone else merged or replaced them
                return [*(e for e in entries if e not in full), merged]

            self.manifests.publish(change)

    def _full_tier(self) -> list[Entry]:
        tiers = defaultdict(list)
        for e in self.manifests.last()[1]:
            if e.table != "offsets":
                tiers[e.table, e.part, e.tier].append(e)
        return next((found for found in tiers.values() if len(found) >= FAN_IN), [])

    def _write_keys(self, rows: DataFrame, folder: str) -> tuple[int, list[int]]:
        bits = bits_for(rows.count())
        write_keys(rows, f"{self.root}/{folder}", bits)
        names = set(self.files.names(f"{self.root}/{folder}"))
        return bits, [b for b in range(1 << bits) if f"bucket={b}" not in names]

    def drop_orphans(self) -> None:
        """Delete folders of attempts that were never published. Only while no job runs."""
        files = self.files
        numbers = self.manifests._numbers()
        named = {e.folder for n in numbers for e in self.manifests._entries(n)}
        named |= {folder.rsplit("/", 1)[0] for folder in named if "/dest=" in folder}
        for table in TABLES:
            for name in files.names(f"{self.root}/{table}"):
                if f"{table}/{name}" not in named:
                    files.delete(f"{self.root}/{table}/{name}")


def _of_batch(run: str, batch_id: int) -> Column:
    return (F.col("run") == run) & (F.col("batch_id") == batch_id)


def _buckets(e: Entry, numbers: Iterable[int]) -> list[Entry]:
    """Parts of a folder of keys."""
    return [replace(e, folder=f"{e.folder}/bucket={b}") for b in numbers if b not in e.absent]


def _new_folder(table: str) -> str:
    return f"{table}/{uuid.uuid4().hex}"


class Batch:
    """The tables of one batch, written one by one and published together."""

    def __init__(self, store: Store, run: str, batch_id: int):
        self.store, self.run, self.batch_id = store, run, batch_id
        self.entries: list[Entry] = []
        #: Tables whose rows of an earlier attempt this one replaces.
        self.tables: set[str] = set()

    def _entry(self, table: str, folder: str, **more: object) -> Entry:
        runs = {self.run: [self.batch_id, self.batch_id]}
        return Entry(table, folder, runs=runs, **more)

    def _stamped(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {"run": F.lit(self.run), "batch_id": F.lit(self.batch_id).cast("long")}
        )

    def add(self, table: str, df: DataFrame) -> None:
        store, folder = self.store, _new_folder(table)
        columns = [f.name for f in TABLES[table] if f.name not in BATCH]
        rows, path = self._stamped(df.select(*columns)), f"{store.root}/{folder}"
        self.tables.add(table)
        if table not in PARTS:
            rows.write.parquet(path)
            self.entries.append(self._entry(table, folder))
            return
        rows.write.partitionBy("dest").parquet(path)
        names = store.files.names(path)
        written = [
            self._entry(table, f"{folder}/dest={part}", part=part)
            for part in PARTS[table]
            if f"dest={part}" in names
        ]
        self.entries += written
        column, dest, keys_table = KEYED[table]
        self.tables.add(keys_table)
        keyed = [e for e in written if dest in (None, e.part)]
        if keyed:
            keys = store._rows(keyed, table).where(F.col(column).isNotNull())
            keys = keys.select(F.col(column).alias("key"), *BATCH)
            folder = _new_folder(keys_table)
            bits, absent = store._write_keys(keys, folder)
            self.entries.append(self._entry(keys_table, folder, bits=bits, absent=absent))

    def progress(self, ranges: DataFrame, group_id: str) -> None:
        """Log the batch's offset ranges, and merge them into the group's own offsets.

        Only this group's rows are written again. Their version is the number of the manifest
        they were merged on: no clock decides which is later.
        """
        store = self.store
        logged = ranges.select(
            F.lit(group_id).alias("group_id"), "topic", "part", "from_offset", "until_offset",
            F.current_timestamp().alias("committed_at"),
        )
        self.add("progress", logged.coalesce(1))
        number, entries = store.manifests.last()
        mine = [e for e in entries if e.table == "offsets" and e.part == group_id]
        incoming = store._rows(self.entries[-1:], "progress").select(
            "group_id", "topic", "part", "until_offset", F.lit(number + 1).cast("long").alias("version")
        )
        folder = _new_folder("offsets")
        merged = upsert(store._rows(mine, "offsets"), incoming, "version").coalesce(1)
        merged.write.parquet(f"{store.root}/{folder}")
        self.entries.append(self._entry("offsets", folder, part=group_id))

    def publish(self) -> None:
        groups = {e.part for e in self.entries if e.table == "offsets"}

        def change(entries: list[Entry]) -> list[Entry]:
            others = [e for e in entries if e.table != "offsets" or e.part not in groups]
            return [*replaced(others, self.run, self.batch_id, self.tables), *self.entries]

        self.store.manifests.publish(change)

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, error: type | None, *_: object) -> None:
        if error is None:
            self.publish()
            self.store.merge()


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint; the same after every restart."""
    metadata = spark.read.schema(T.StructType([T.StructField("value", T.StringType())]))
    return json.loads(metadata.text(f"{checkpoint}/metadata").first()["value"])["id"]
