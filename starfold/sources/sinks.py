"""Writers."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from starfold.paths import one_day


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A whole Parquet table. ``path`` must not be read by ``df``."""
    df.write.mode(mode).parquet(path)


def write_day(df: DataFrame, base: str, day: str | date, mode: str = "overwrite") -> None:
    """One day folder; the default makes a rerun replace the day."""
    df.write.mode(mode).parquet(one_day(base, day))


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Hive-partitioned Parquet.

    The rebalance hint brings the rows of a partition value together, so a task
    does not open a file for every value, and lets adaptive execution cut a value
    that holds much of the data into several files. ``dynamic`` replaces only the
    partition values present in ``df``.
    """
    # Rows that a shuffle has mixed repeat less within a page: zstd makes up for that, in any session.
    writer = df.hint("rebalance", column).write.mode(mode).option("compression", "zstd").partitionBy(column)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def publish(df: DataFrame, fmt: str, options: Mapping[str, str], mode: str = "overwrite") -> None:
    """Hand a finished table to a serving store through any Spark connector."""
    df.write.format(fmt).options(**options).mode(mode).save()


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> dict[str, str]:
    """Options for ``publish(df, "jdbc", ...)``.

    ``connections`` bounds how many tasks write at once and so protects the
    database; it does not bound the rows.
    """
    options = {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "numPartitions": str(connections),
        "batchsize": str(batch_rows),
    }
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def parallel_read(fmt: str, options: Mapping[str, str], column: str) -> dict[str, str]:
    """Options for reading a published table back: over JDBC in as many ranges of a 64-bit hash column as may connect.

    Other connectors split by themselves, as does a table without that column if it is read without this.
    """
    if fmt != "jdbc" or "numPartitions" not in options:
        return dict(options)
    bounds = {"partitionColumn": column, "lowerBound": str(-(2**63)), "upperBound": str(2**63 - 1)}
    return {**options, **bounds}


def warehouse_options(table: str, staging_bucket: str | None = None) -> dict[str, str]:
    """Options for ``publish(df, "bigquery", ...)``; the connector is supplied by the user."""
    options = {"table": table}
    if staging_bucket is not None:
        options["temporaryGcsBucket"] = staging_bucket
    return options
