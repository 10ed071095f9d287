"""Gold tables.

A gold table is either a Delta table or a folder of Parquet snapshots; which one is said by the caller, and a folder that
holds the other form is refused. A snapshot is the whole table, or one folder per load date with numbered versions. What is
written becomes visible with an empty ``_COMMITTED`` file that follows it, so a lost executor or a failed job never changes
what readers see. One writer per table at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.operators.merge import known_among, merge_frames, not_in, winners
from starfold.session import release, scratch_dir
from starfold.sources import files

try:
    from delta.tables import DeltaTable
except ImportError:
    DeltaTable = None

LOAD_DATE = "load_date"
VERSION = "version"
PREFIX = "snapshot-"
COMMITTED = "_COMMITTED"
SNAPSHOTS, DELTA = "snapshots", "delta"


def with_load_date(df: DataFrame, load_date: str) -> DataFrame:
    return df.withColumn(LOAD_DATE, F.lit(load_date).cast("date"))


class SnapshotTable:
    """A Parquet table replaced as a whole, or loaded by load date.

    ``schema`` spares the look into a file footer and lets a table whose batches were all empty be read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None):
        self.spark = spark
        self.path = path
        self.schema = schema

    def snapshots(self) -> list[str]:
        """Finished snapshots, oldest first."""
        return self._committed(self.path, PREFIX)

    def _committed(self, path: str, prefix: str) -> list[str]:
        names = files.child_names(self.spark, path)
        return [n for n in names if n.startswith(prefix) and files.exists(self.spark, f"{path}/{n}/{COMMITTED}")]

    def _commit(self, path: str) -> None:
        files.touch(self.spark, f"{path}/{COMMITTED}")

    def exists(self) -> bool:
        return bool(self.snapshots())

    def current(self) -> str:
        return f"{self.path}/{self.snapshots()[-1]}"

    def next(self) -> str:
        taken = [n for n in files.child_names(self.spark, self.path) if n.startswith(PREFIX)]
        number = int(taken[-1].removeprefix(PREFIX)) + 1 if taken else 1
        return f"{self.path}/{PREFIX}{number:08d}"

    def batches(self, snapshot: str) -> dict[str, list[str]]:
        """Load dates of a snapshot with the folders of their current versions: a replacement and what was appended."""
        found = {}
        for name in files.child_names(self.spark, snapshot):
            if name.startswith(f"{LOAD_DATE}="):
                versions = self._committed(f"{snapshot}/{name}", f"{VERSION}=")
                replaced = [v for v in versions if v.endswith("r")]
                live = [v for v in versions if not replaced or v >= replaced[-1]]
                found[name.removeprefix(f"{LOAD_DATE}=")] = [f"{snapshot}/{name}/{v}" for v in live]
        return found

    def read(self) -> DataFrame:
        """The current rows; of a table loaded by date only the folders of current versions are listed."""
        snapshot = self.current()
        batches = self.batches(snapshot)
        reader = self.spark.read
        if not batches:
            return (reader if self.schema is None else reader.schema(self.schema)).parquet(snapshot)
        if self.schema is not None:
            reader = reader.schema(T.StructType([*self.schema, T.StructField(VERSION, T.StringType())]))
        folders = [path for date in batches for path in batches[date] if files.has_data(self.spark, path)]
        if not folders and self.schema is None:
            folders = [path for date in batches for path in batches[date]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return reader.option("basePath", snapshot).parquet(*folders).drop(VERSION)

    def replace(self, df: DataFrame) -> None:
        path = self.next()
        df.write.parquet(path)
        self._commit(path)

    def upsert(
        self, df: DataFrame, key: Sequence[str], newer_by: str | None = None, keep_filled: Sequence[str] = ()
    ) -> None:
        """Create the table on first use, merge into it afterwards."""
        self.replace(merge_frames(self.read(), df, key, newer_by, keep_filled) if self.exists() else df)

    def load_batch(self, df: DataFrame, load_date: str) -> None:
        """Make ``df`` the rows of one load date; loading the date again replaces them, also by nothing."""
        self.load_batches(with_load_date(df, load_date), [load_date])

    def append_batch(self, df: DataFrame, load_date: str) -> None:
        """Add ``df`` without looking at what is stored."""
        self.load_batches(with_load_date(df, load_date), [load_date], append=True)

    def load_batches(self, df: DataFrame, load_dates: Iterable[str], append: bool = False) -> None:
        """Make the rows of ``df``, which bear their load date, those of ``load_dates``, in one job."""
        self._write_batches(df, load_dates, self.current() if self.exists() else self.next(), append)

    def replace_with_batch(self, df: DataFrame, load_date: str) -> None:
        """Start the table over with one load date."""
        self._write_batches(with_load_date(df, load_date), [load_date], self.next())

    def _write_batches(self, df: DataFrame, load_dates: Iterable[str], snapshot: str, append: bool = False) -> None:
        dates = list(load_dates)
        taken = [n for d in dates for n in files.child_names(self.spark, f"{snapshot}/{LOAD_DATE}={d}") if n.startswith(VERSION)]
        number = max((int(n.removeprefix(f"{VERSION}=")[:8]) for n in taken), default=0) + 1
        version = f"{number:08d}{'a' if append else 'r'}"
        rows = df.withColumn(VERSION, F.lit(version))
        rows.write.mode("append").partitionBy(LOAD_DATE, VERSION).parquet(snapshot)
        for load_date in dates:
            self._commit(f"{snapshot}/{LOAD_DATE}={load_date}/{VERSION}={version}")
        self._commit(snapshot)

    def drop_old_snapshots(self, keep: int = 2) -> None:
        """Free what is replaced; ``keep`` leaves the newest for readers still on them."""
        for name in self.snapshots()[: -max(keep, 1)]:
            files.delete(self.spark, f"{self.path}/{name}")
        snapshot = self.current() if self.exists() else None
        for load_date, live in self.batches(snapshot).items() if snapshot else ():
            folder = f"{snapshot}/{LOAD_DATE}={load_date}"
            old = [v for v in self._committed(folder, f"{VERSION}=") if f"{folder}/{v}" < min(live)]
            for name in old[: max(0, len(old) + 1 - max(keep, 1))]:
                files.delete(self.spark, f"{folder}/{name}")


class DeltaBackedTable(SnapshotTable):
    """The same operations on a Delta table."""

    def exists(self) -> bool:
        return DeltaTable.isDeltaTable(self.spark, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.format("delta").load(self.path)

    def replace(self, df: DataFrame) -> None:
        df.write.format("delta").mode("overwrite").save(self.path)

    def upsert(
        self, df: DataFrame, key: Sequence[str], newer_by: str | None = None, keep_filled: Sequence[str] = ()
    ) -> None:
        if not self.exists():
            return self.replace(df)
        rows = winners(self.read(), df, key, newer_by, keep_filled)
        same_key = " AND ".join(f"stored.{k} <=> batch.{k}" for k in key)
        merge = DeltaTable.forPath(self.spark, self.path).alias("stored").merge(rows.alias("batch"), same_key)
        merge.whenMatchedUpdateAll().whenNotMatchedInsertAll().execute()

    def load_batches(self, df: DataFrame, load_dates: Iterable[str], append: bool = False) -> None:
        writer = df.write.format("delta").partitionBy(LOAD_DATE).mode("append" if append else "overwrite")
        if self.exists() and not append:
            dates = ", ".join(f"date'{d}'" for d in load_dates)
            writer = writer.option("replaceWhere", f"{LOAD_DATE} in ({dates})")
        writer.save(self.path)

    def replace_with_batch(self, df: DataFrame, load_date: str) -> None:
        writer = with_load_date(df, load_date).write.format("delta").partitionBy(LOAD_DATE)
        writer.mode("overwrite").save(self.path)

    def drop_old_snapshots(self, keep: int = 2) -> None:
        """Delta keeps and vacuums its own history."""


def gold_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, form: str = SNAPSHOTS
) -> SnapshotTable:
    """A gold table in the form asked for, ``snapshots`` or ``delta``; never in the folder of the other form."""
    found = DELTA if files.exists(spark, f"{path}/_delta_log") else None
    if found is None and any(name.startswith(PREFIX) for name in files.child_names(spark, path)):
        found = SNAPSHOTS
    if form not in (SNAPSHOTS, DELTA) or found not in (None, form):
        raise ValueError(f"{path} holds {found or 'no table'} and cannot be used as {form}")
    if form == SNAPSHOTS:
        return SnapshotTable(spark, path, schema)
    if DeltaTable is None:
        raise ValueError("delta tables need the delta package")
    return DeltaBackedTable(spark, path)


def only_unknown(
    table: SnapshotTable,
    batch: DataFrame,
    key: Sequence[str],
    load_dates: Iterable[str] = (),
    hashed: tuple[str, F.Column] | None = None,
) -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet.

    The stored rows of ``load_dates`` are left out of account (and out of the scan), which makes a rerun see what the
    first run saw. ``hashed`` names a stored column with a hash of the key, and how the batch has it: then only that
    column of the history is read, and the key itself only of the rows whose hash the batch has, if there are any.
    """
    if not table.exists():
        return batch
    stored = table.read()
    dates = list(load_dates)
    if dates:
        stored = stored.filter(~F.col(LOAD_DATE).isin([F.lit(d).cast("date") for d in dates]))
    if hashed is None:
        return not_in(batch, known_among(stored, batch, key), key)
    column, of_batch = hashed
    if stored.select(column).isEmpty():
        return batch
    # Hashes are never null: plain equality spares the shuffle that telling nulls apart takes.
    met = stored.select(column).join(batch.select(of_batch.alias(column)), column, "left_semi")
    path = scratch_dir(batch.sparkSession, "known-hashes")
    met.write.parquet(path)
    release(batch.sparkSession)
    met = batch.sparkSession.read.schema(met.schema).parquet(path)
    if met.isEmpty():
        return batch
    # What is left of the store has the batch's hashes only, so the batch is read once more and not twice.
    known = stored.join(met, column, "left_semi").select(F.col(column).alias("_hash"), *key)
    return not_in(batch.withColumn("_hash", of_batch), known, ["_hash", *key]).drop("_hash")
