"""Files in, files out, and the whole pipelines on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from starfold.operators.clean import clean
from starfold.paths import LakePaths, dated
from starfold.plans import pipeline, serving
from starfold.plans.fact import ROLES
from starfold.plans.silver import load_csv_by_dose_date, load_hits, silver_from_csv, silver_from_hits
from starfold.queries import feed as stand_in
from starfold.queries.dimensions import PATIENT_SQL
from starfold.queries.facts import FACT_CTES, resolved
from starfold.queries.feed import EXPRESSIONS, FEED_SQL, Slice, page_of, slices, stored_slices, table, wide_feed
from starfold.queries.registry import query
from starfold.schema import DIMENSIONS, DOSE_DATE, FACT, FACT_DATE, FACT_ID, FEED, LOT, PATIENTS
from starfold.session import scratch_dir
from starfold.sources.feed import read_feed_csv, read_hits_json, read_silver, read_trusted
from starfold.sources.sinks import publish, write_day, write_partitioned, write_table
from starfold.sources.tables import SnapshotTable

# What the cleaning of a dirty feed must give back: the stand-in feed with folded names.
CLEAN_SQL = FEED_SQL.replace(
    f"{EXPRESSIONS['estabelecimento_razaoSocial'][1]} as", "concat('Acao ', s_name) as"
).replace(f"{EXPRESSIONS[LOT][1]} as", f"upper({EXPRESSIONS[LOT][1]}) as")


def dirty_feed(spark: SparkSession, sf_dir: str, part: Slice | None = None) -> DataFrame:
    """The stand-in feed, or a slice of it, as a source system sends it: all text, padded, accented, with null tokens."""
    feed = wide_feed(spark, sf_dir, *stand_in.ROLES, part=part)
    name = F.concat(F.lit("  Ação "), F.col("estabelecimento_razaoSocial"), F.lit(" "))
    iso = F.col(DOSE_DATE).cast("string")
    day = F.when(F.col("paciente_racaCor_valor") == "2-HIGH", F.regexp_replace(iso, "-", "")).otherwise(
        F.concat(iso, F.lit("T00:00:00.000Z"))
    )
    special = {
        "estabelecimento_razaoSocial": name,
        LOT: F.coalesce(F.lower(LOT), F.lit(" N/A ")),
        DOSE_DATE: F.coalesce(day, F.lit("")),
        "paciente_endereco_coPais": F.coalesce("paciente_endereco_coPais", F.lit("None")),
        "paciente_endereco_nmMunicipio": F.coalesce("paciente_endereco_nmMunicipio", F.lit("Pendente Identificação")),
    }
    return feed.select(*(special.get(n, F.col(n).cast("string")).alias(n) for n in FEED.names))


# Lines a landed file holds at most: compressed files are not split between tasks.
LINES_A_FILE = 200_000


def landing(df: DataFrame, mode: str) -> DataFrameWriter:
    """Landed files are compressed: hits repeat every field name, and take a tenth of their size so."""
    writer = df.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    return writer.option("maxRecordsPerFile", LINES_A_FILE)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    writer = landing(df, mode).option("sep", ";").option("header", True)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def hits(df: DataFrame) -> DataFrame:
    """The rows as search hits."""
    hit = F.struct(F.struct(*FEED.names).alias("_source"), F.array(DOSE_DATE, "document_id").alias("sort"))
    return df.select("document_id", hit.alias("hit"))


def write_landed(lines: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> None:
    """A column of texts as landed files."""
    writer = landing(lines, mode)
    (writer if by is None else writer.partitionBy(by)).text(path)


def write_hits(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """An object a line."""
    write_landed(hits(df).select(F.to_json("hit").alias("value")), path, mode)


def landed_csv(spark: SparkSession, sf_dir: str, label: str) -> LakePaths:
    paths = LakePaths(scratch_dir(spark, label))
    land_csv(spark, sf_dir, paths.landing_csv)
    return paths


def land_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    for part in slices(spark, sf_dir):
        write_csv(dirty_feed(spark, sf_dir, part), path, "append")


def land_hits(spark: SparkSession, sf_dir: str, path: str) -> None:
    for part in slices(spark, sf_dir):
        write_hits(dirty_feed(spark, sf_dir, part), path, "append")


@query(CLEAN_SQL + " select * from feed")
def csv_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv-door")
    land_csv(spark, sf_dir, path)
    return silver_from_csv(read_feed_csv(spark, path))


@query(CLEAN_SQL + " select * from feed")
def json_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json-door")
    land_hits(spark, sf_dir, path)
    return silver_from_hits(read_hits_json(spark, path))


def order_pages(rows: DataFrame) -> DataFrame:
    """``rows`` with the page that their order belongs to."""
    order = F.substring_index("document_id", "-", 1).cast("bigint")
    return rows.withColumn("page", page_of(order))


@query(CLEAN_SQL + " select * from feed")
def json_pages_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as they land, an array of hits a line, and a page that broke off, which makes no row."""
    path = scratch_dir(spark, "json-pages")
    for part in slices(spark, sf_dir):
        rows = hits(dirty_feed(spark, sf_dir, part))
        pages = rows.groupBy(F.substring_index("document_id", "-", 1)).agg(F.collect_list("hit").alias("page"))
        write_landed(pages.select(F.to_json("page").alias("value")), path, "append")
    # Cut from a landed page, as from the feed all pages would be made again.
    write_landed(spark.read.text(path).limit(1).select(F.left("value", F.lit(40)).alias("value")), path, "append")
    return silver_from_hits(read_hits_json(spark, path))


@query(CLEAN_SQL + " select * from feed")
def json_multiline_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are laid out over many lines, one a file, and one that broke off."""
    path = scratch_dir(spark, "json-multi-line")
    for part in slices(spark, sf_dir):
        rows = order_pages(hits(dirty_feed(spark, sf_dir, part)))
        pages = rows.groupBy("page").agg(F.to_json(F.collect_list("hit"), {"pretty": "true"}).alias("value"))
        write_landed(pages, path, "append", by="page")
    landed = spark.read.schema("value string, page bigint").option("wholetext", True).text(path)
    write_landed(landed.limit(1).select(F.lit(-1).alias("page"), F.left("value", F.lit(99)).alias("value")), path, "append", by="page")
    return silver_from_hits(read_hits_json(spark, f"{path}/*", multi_line=True))


DIRTY_DATE_SQL = f"""
    case when paciente_racaCor_valor = '2-HIGH' then strftime({DOSE_DATE}, '%Y%m%d')
         else concat(cast({DOSE_DATE} as varchar), 'T00:00:00.000Z') end"""
UNTYPED_SQL = ", ".join(
    f"case when {DOSE_DATE} is not null then {DIRTY_DATE_SQL} end as {DOSE_DATE}" if f.name == DOSE_DATE
    else f"cast({f.name} as varchar) as {f.name}"
    for f in FEED
)


@query(f"{CLEAN_SQL} select {UNTYPED_SQL} from feed")
def json_to_silver_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without conforming, values keep the text they came with, dates too."""
    path = scratch_dir(spark, "json-untyped")
    land_hits(spark, sf_dir, path)
    return silver_from_hits(read_hits_json(spark, path), conformed=False)


@query(CLEAN_SQL + " select * from feed")
def clean_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning steps alone, without files; typed columns pass through."""
    dirty = dirty_feed(spark, sf_dir)
    typed = dirty.withColumns(
        {f.name: F.col(f.name).try_cast(f.dataType) for f in FEED if f.dataType.typeName() != "string"}
    )
    return clean(typed)


@query(CLEAN_SQL + " select * from feed")
def csv_to_dose_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files to silver laid out by dose date."""
    paths = landed_csv(spark, sf_dir, "csv-dose-dates")
    load_csv_by_dose_date(spark, paths)
    return read_trusted(spark, paths.trusted)


@query("select * from orders")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwrite replaces: the second write leaves one copy."""
    path = scratch_dir(spark, "parquet")
    for _ in range(2):
        write_table(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


@query("select * from orders union all select * from orders")
def parquet_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "append")
    for mode in ("overwrite", "append"):
        write_day(table(spark, sf_dir, "orders"), root, "2024-01-31", mode)
    return spark.read.parquet(dated(root, "*"))


@query("select event_id, user_id, event_type, cast(ts as date) as day from events")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By date, then one date again: only that one is replaced."""
    path = scratch_dir(spark, "partitioned")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("day")
    )
    write_partitioned(events, path, "day")
    write_partitioned(events.filter("day = date'2024-01-15'"), path, "day", dynamic=True)
    return spark.read.parquet(path)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred from the files."""
    path = scratch_dir(spark, "csv")
    write_csv(table(spark, sf_dir, "customer"), path)
    inferred = read_feed_csv(spark, path, schema=None)
    return inferred.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("select s_suppkey, s_name, s_nationkey from supplier")
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finished table handed on through a Spark connector by name."""
    path = scratch_dir(spark, "publish")
    publish(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "orc", {"path": path})
    return spark.read.orc(path)


@query("select n_nationkey, n_name, n_regionkey from nation")
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced from itself: the copy being read is never the one written."""
    stored = SnapshotTable(spark, scratch_dir(spark, "snapshots"))
    stored.replace(table(spark, sf_dir, "nation"))
    for _ in range(3):
        stored.replace(stored.read())
        stored.drop_old_snapshots()
    return stored.read()


def gold_dims(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    return {name: pipeline.read_dimension(spark, paths, name) for name in DIMENSIONS}


@query(FACT_CTES + "select * from fact")
def pipeline_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files to the star in one load."""
    paths = landed_csv(spark, sf_dir, "pipeline-bulk")
    pipeline.run_bulk(spark, paths, "2024-01-31")
    return resolved(pipeline.read_fact(spark, paths), gold_dims(spark, paths))


@query(FACT_CTES + "select * from fact")
def pipeline_bulk_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in the types found in the files, through the untyped folder."""
    paths = landed_csv(spark, sf_dir, "pipeline-bulk-inferred")
    pipeline.run_bulk(spark, paths, "2024-01-31", infer=True)
    return resolved(pipeline.read_fact(spark, paths), gold_dims(spark, paths))


@query(FACT_CTES + "select * from fact")
def pipeline_bulk_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through silver laid out by dose date."""
    paths = landed_csv(spark, sf_dir, "pipeline-bulk-trusted")
    pipeline.run_bulk_trusted(spark, paths, "2024-01-31")
    return resolved(pipeline.read_fact(spark, paths), gold_dims(spark, paths))


def published(spark: SparkSession, sf_dir: str, label: str) -> dict[str, DataFrame]:
    """The star of one load, published twice through a file connector, as the store has it."""
    paths, out = landed_csv(spark, sf_dir, label), scratch_dir(spark, f"{label}-store")
    pipeline.run_bulk(spark, paths, "2024-01-31")
    for _ in range(2):
        serving.publish_gold(spark, paths, "parquet", lambda name: {"path": f"{out}/{name}"}, "2024-01-31")
    return {name: spark.read.parquet(f"{out}/{name}") for name in [*DIMENSIONS, FACT]}


@query(FACT_CTES + "select * from fact")
def pipeline_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load date published again adds nothing."""
    store = published(spark, sf_dir, "pipeline-publish")
    return resolved(store[FACT], store)


SOURCES_SQL = {
    "dm_campanhas": "campaigns", "dm_estabelecimentos": "establishments", "dm_municipios": "municipalities",
    "dm_pacientes": "patients", "dm_vacinas": "vaccines", "ft_vacinacao": "fact",
}
PUBLISHED_COLUMNS = {name: [*dim.keys, *dim.attributes] for name, dim in DIMENSIONS.items()}
PUBLISHED_COLUMNS[FACT] = [FACT_ID, FACT_DATE, *(column for role in ROLES for column in role.on)]
# The i-th columns of all tables, as text, are one column.
WIDEST = max(map(len, PUBLISHED_COLUMNS.values()))
PUBLISHED_SQL = " union all ".join(
    f"select '{name}' as name, "
    + ", ".join(f"{f'cast({columns[i]} as varchar)' if i < len(columns) else 'null'} as column_{i}" for i in range(WIDEST))
    + f" from {SOURCES_SQL[name]}"
    for name, columns in PUBLISHED_COLUMNS.items()
)


@query(FACT_CTES.replace(FEED_SQL, CLEAN_SQL) + PUBLISHED_SQL)
def pipeline_publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every published table, each row once."""
    store = published(spark, sf_dir, "pipeline-publish-tables")
    store[FACT] = resolved(store[FACT], store)
    frames = [
        store[name].select(
            F.lit(name).alias("name"),
            *((F.col(columns[i]) if i < len(columns) else F.lit(None)).cast("string").alias(f"column_{i}") for i in range(WIDEST)),
        )
        for name, columns in PUBLISHED_COLUMNS.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(FACT_CTES + "select * from fact")
def pipeline_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hits of one day to the star, then the same day again."""
    paths = LakePaths(scratch_dir(spark, "pipeline-day"))
    land_hits(spark, sf_dir, dated(paths.landing_json, "2024-01-31"))
    for _ in range(2):
        pipeline.run_day(spark, paths, "2024-01-31", multi_line=False)
    return resolved(pipeline.read_fact(spark, paths), gold_dims(spark, paths))


def land_in_order(spark: SparkSession, sf_dir: str, paths: LakePaths) -> None:
    """Three landing days; later ones hold later doses, undated doses come first."""
    digits = F.regexp_replace(DOSE_DATE, "-", "")
    days = {
        "2024-01-29": digits < "1997",
        "2024-01-30": (digits >= "1997") & (digits < "1999"),
        "2024-01-31": digits >= "1999",
    }
    for dirty in stored_slices(spark, sf_dir, lambda part: dirty_feed(spark, sf_dir, part)):
        for day, doses in days.items():
            write_hits(dirty.filter(doses), dated(paths.landing_json, day), "append")


@query(FACT_CTES + "select * from fact")
def pipeline_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day by day in dose order gives the fact of one bulk load; days without files are skipped."""
    paths = LakePaths(scratch_dir(spark, "pipeline-backfill"))
    land_in_order(spark, sf_dir, paths)
    pipeline.backfill(spark, paths, "2024-01-28", "2024-02-03", multi_line=False)
    return resolved(pipeline.read_fact(spark, paths), gold_dims(spark, paths))


@query(FEED_SQL + PATIENT_SQL)
def pipeline_backfill_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day by day in dose order gives the latest patients of one bulk load."""
    paths = LakePaths(scratch_dir(spark, "backfill-patients"))
    land_in_order(spark, sf_dir, paths)
    pipeline.backfill(spark, paths, "2024-01-28", "2024-02-03", multi_line=False)
    return pipeline.read_dimension(spark, paths, PATIENTS.name).drop(PATIENTS.surrogate)


@query(FEED_SQL + PATIENT_SQL)
def pipeline_day_rerun_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days one after the other and the first day again: the patients of one bulk load."""
    paths = LakePaths(scratch_dir(spark, "rerun-old"))
    land_in_order(spark, sf_dir, paths)
    for day in ("2024-01-29", "2024-01-30", "2024-01-31", "2024-01-29"):
        pipeline.run_day(spark, paths, day, multi_line=False)
    return pipeline.read_dimension(spark, paths, PATIENTS.name).drop(PATIENTS.surrogate)


@query(CLEAN_SQL + " select * from feed")
def json_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed days in one go, twice: each to its own day's silver."""
    paths = LakePaths(scratch_dir(spark, "json-all-days"))
    land_in_order(spark, sf_dir, paths)
    for _ in range(2):
        load_hits(spark, paths, "*", multi_line=False)
    return read_silver(spark, paths.silver)
