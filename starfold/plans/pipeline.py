"""The loads as plain functions: which job runs after which."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.operators.quality import key_uniqueness
from starfold.paths import ALL_DATES, LakePaths, dated, days_between, parse_day
from starfold.plans.dimensions import BUILDERS, LAST_DOSE, patients_by_race, patients_with_dose
from starfold.plans.fact import COMPLETE, FACT_SCHEMA, fact_rows, fact_surrogate, keyed_fact
from starfold.plans.silver import load_csv, load_csv_by_dose_date, load_hits
from starfold.schema import DIMENSIONS, FACT, FACT_ID, FACT_SURROGATE, MUNICIPALITIES, PATIENTS
from starfold.session import release
from starfold.sources import files
from starfold.sources.feed import read_silver, read_silver_days, read_trusted, read_untyped
from starfold.sources.tables import LOAD_DATE, SnapshotTable, gold_table, only_unknown

BY_RACE = "by_race"
LATEST = "latest"

log = logging.getLogger(__name__)


def dimension_table(spark: SparkSession, paths: LakePaths, name: str) -> SnapshotTable:
    return gold_table(spark, paths.gold(name), form=paths.gold_form)


def read_dimension(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame:
    """A dimension as published."""
    return dimension_table(spark, paths, name).read().drop(LAST_DOSE)


def fact_table(spark: SparkSession, paths: LakePaths) -> SnapshotTable:
    schema = T.StructType([*FACT_SCHEMA, T.StructField(LOAD_DATE, T.DateType())])
    return gold_table(spark, paths.gold(FACT), schema, paths.gold_form)


def read_fact(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return fact_table(spark, paths).read().drop(LOAD_DATE)


def load_dimension(
    spark: SparkSession,
    paths: LakePaths,
    name: str,
    day: str | date = ALL_DATES,
    patient_rows: str = LATEST,
    rebuild: bool = False,
    silver: DataFrame | None = None,
    null_safe: bool = False,
    check: bool = True,
    keep_filled: bool = False,
) -> None:
    """Merge one dimension from the silver of a run date (or all), or rebuild it.

    Rows are merged by their natural key, in which nulls are values. Patients also keep the date of the dose they are
    described by, and a stored patient gives way to a later dose only: days may be loaded in any order, and again.
    ``null_safe`` makes nulls part of the surrogate keys and must then be given to every load of the lake; patients by
    race need it. With ``keep_filled`` an attribute that a winning row lacks stays as the other row has it. ``check`` counts the stored keys: a natural key there twice is an error, a surrogate shared by two
    natural keys a warning.
    """
    dim, keys, newer_by = DIMENSIONS[name], list(DIMENSIONS[name].keys), None
    build = BUILDERS[name]
    if name == PATIENTS.name and patient_rows == BY_RACE:
        if not null_safe:
            raise ValueError("a patient without race and a race without patient share a plain key: use null_safe")
        build, keys = patients_by_race, [*keys, "CD_RACA_COR"]
    elif name == PATIENTS.name:
        build, newer_by = patients_with_dose, LAST_DOSE
    rows = build(read_silver(spark, paths.silver, day) if silver is None else silver, null_safe)
    table = dimension_table(spark, paths, name)
    if rebuild:
        table.replace(rows)
    else:
        table.upsert(rows, keys, newer_by, list(dim.attributes) if keep_filled else ())
    if check:
        found = key_uniqueness(table.read(), keys, dim.surrogate).first()
        if found["n_rows"] != found["n_keys"]:
            raise ValueError(f"{name} holds {found['n_rows']} rows of {found['n_keys']} keys")
        if found["n_surrogates"] != found["n_keys"]:
            log.warning("%s: %d keys share %d surrogates", name, found["n_keys"], found["n_surrogates"])
    table.drop_old_snapshots()


def load_dimensions(spark: SparkSession, paths: LakePaths, **options) -> None:
    """All dimensions at once.

    They do not depend on each other, and the short tail of one job leaves room
    for the next.
    """

    @inheritable_thread_target(spark)
    def load(name: str) -> None:
        load_dimension(spark, paths, name, **options)

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        list(pool.map(load, DIMENSIONS))
    release(spark)


def load_fact(
    spark: SparkSession,
    paths: LakePaths,
    day: str | date = ALL_DATES,
    run_date: str | date | None = None,
    mode: str = "new_only",
    complete: Iterable[str] = (),
    patient_rows: str = LATEST,
    silver: DataFrame | None = None,
    null_safe: bool = False,
) -> None:
    """Build the fact rows of a run date and store them.

    ``mode``: ``new_only`` adds doses no other load date has stored; ``batch``
    adds the whole batch without reading stored rows. Both replace what an
    earlier run of the same load date stored, so a rerun changes nothing.
    ``add_new`` adds doses stored nowhere and replaces nothing, for several
    batches on one load date. ``append`` adds blindly. ``reload`` starts the
    table over. All days at once are stored under ``run_date``, by default
    today; modes that do not look at stored rows want it said.
    """
    if day == ALL_DATES and run_date is None and mode in ("batch", "append"):
        raise ValueError(f"mode {mode} over all days needs a run date: run twice it would store every dose twice")
    load_date = str(parse_day(run_date or (date.today() if day == ALL_DATES else day)))
    rows = fact_rows(read_silver(spark, paths.silver, day) if silver is None else silver)
    table = fact_table(spark, paths)
    if mode == "new_only":
        rows = new_doses(table, rows, [load_date])
    elif mode == "add_new":
        rows = new_doses(table, rows)
    fact = keyed(spark, paths, rows, complete, patient_rows, null_safe)
    write: Callable[[DataFrame, str], None] = {
        "new_only": table.load_batch,
        "batch": table.load_batch,
        "append": table.append_batch,
        "add_new": table.append_batch,
        "reload": table.replace_with_batch,
    }[mode]
    write(fact, load_date)
    table.drop_old_snapshots()
    release(spark)


def new_doses(table: SnapshotTable, rows: DataFrame, load_dates: Iterable[str] = ()) -> DataFrame:
    """Doses that no other load date has stored; of the history only the 8-byte key is read."""
    return only_unknown(table, rows, [FACT_ID], load_dates, (FACT_SURROGATE, fact_surrogate()))


def keyed(
    spark: SparkSession, paths: LakePaths, rows: DataFrame, complete: Iterable[str], patient_rows: str, null_safe: bool,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Fact rows with the keys of the stored dimensions."""
    dims = {name: read_dimension(spark, paths, name) for name in DIMENSIONS if name not in complete}
    return keyed_fact(rows, dims, tuple(complete), null_safe, patient_rows == LATEST, tuple(keep))


def load_fact_days(
    spark: SparkSession,
    paths: LakePaths,
    days: Iterable[date],
    complete: Iterable[str] = (),
    patient_rows: str = LATEST,
    null_safe: bool = False,
) -> None:
    """The fact rows of all ``days`` in one pass, each stored under the first day that has its dose.

    What other load dates have stored is left out; what an earlier run stored for these days is replaced.
    """
    days = list(days)
    load_dates = [str(day) for day in days]
    silver = read_silver_days(spark, paths.silver, days, LOAD_DATE)
    table = fact_table(spark, paths)
    rows = new_doses(table, fact_rows(silver, first_by=LOAD_DATE), load_dates)
    table.load_batches(keyed(spark, paths, rows, complete, patient_rows, null_safe, [LOAD_DATE]), load_dates)
    table.drop_old_snapshots()
    release(spark)


def complete_dimensions(patient_rows: str = LATEST, null_safe: bool = False) -> tuple[str, ...]:
    """Dimensions sure to hold every key of the silver they were loaded from.

    Patients kept per race code are found by patient alone, and null-safe keys
    also look for municipalities without country, some of which are dropped.
    """
    joined = {PATIENTS.name} if patient_rows == BY_RACE else set()
    if null_safe:
        joined.add(MUNICIPALITIES.name)
    return tuple(name for name in COMPLETE if name not in joined)


def load_star(
    spark: SparkSession,
    paths: LakePaths,
    day: str | date,
    patient_rows: str = LATEST,
    null_safe: bool = False,
    rebuild: bool = False,
    silver: DataFrame | None = None,
    **fact_options,
) -> None:
    """Dimensions, then the fact, from the silver of a run date, or from ``silver``.

    The dimensions are loaded from the same silver just before, so the fact
    derives the keys of those that keep every key and joins the others.
    """
    complete = complete_dimensions(patient_rows, null_safe)
    shared = {"patient_rows": patient_rows, "null_safe": null_safe, "silver": silver}
    load_dimensions(spark, paths, day=day, rebuild=rebuild, **shared)
    load_fact(spark, paths, day, complete=complete, **shared, **fact_options)


def run_day(spark: SparkSession, paths: LakePaths, day: str | date, multi_line: bool = True, **options) -> None:
    """Daily load: the hits landed on a day, through silver, into the star."""
    load_hits(spark, paths, day, multi_line=multi_line)
    load_star(spark, paths, day, **options)


def run_bulk(spark: SparkSession, paths: LakePaths, day: str | date, infer: bool = False, **options) -> None:
    """First load: every landed delimited file, through silver, into the star.

    With ``infer`` it goes through the untyped folder, in the types found in the files, and is conformed when read.
    """
    load_csv(spark, paths, day, infer)
    load_star(spark, paths, day, silver=read_untyped(spark, paths.untyped, day) if infer else None, **options)


def run_bulk_trusted(
    spark: SparkSession,
    paths: LakePaths,
    day: str | date,
    dose_from: str | date | None = None,
    dose_until: str | date | None = None,
    **options,
) -> None:
    """First load through silver laid out by dose date: all doses, or those of ``[dose_from, dose_until)``."""
    load_csv_by_dose_date(spark, paths)
    silver = read_trusted(spark, paths.trusted, dose_from, dose_until)
    load_star(spark, paths, day, silver=silver, **options)


def backfill(
    spark: SparkSession,
    paths: LakePaths,
    start: str | date,
    end: str | date,
    multi_line: bool = True,
    patient_rows: str = LATEST,
    null_safe: bool = False,
) -> list[date]:
    """Loads of ``[start, end)``; days without landed files are skipped.

    Each day's hits go to that day's silver. The dimensions and the fact are then loaded once for all days, so a long
    range neither rewrites a dimension nor scans the fact's history once a day.
    """
    landed = [d for d in days_between(start, end) if files.exists(spark, dated(paths.landing_json, d))]
    if landed:
        load_landed_days(spark, paths, landed, multi_line, patient_rows, null_safe)
    return landed


def load_landed_days(
    spark: SparkSession,
    paths: LakePaths,
    days: list[date],
    multi_line: bool = True,
    patient_rows: str = LATEST,
    null_safe: bool = False,
    **dimension_options,
) -> None:
    """The hits landed on some days, each to its own silver, and then the star from all of them at once."""
    for day in days:
        load_hits(spark, paths, day, multi_line=multi_line)
    silver = read_silver_days(spark, paths.silver, days)
    load_dimensions(spark, paths, silver=silver, patient_rows=patient_rows, null_safe=null_safe, **dimension_options)
    load_fact_days(spark, paths, days, complete_dimensions(patient_rows, null_safe), patient_rows, null_safe)
