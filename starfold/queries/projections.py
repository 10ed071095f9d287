"""Projections, filters and date slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.clean import conform, pick_feed
from starfold.operators.project import drop_if_all_null, drop_if_any_null, pick
from starfold.queries.feed import EXPRESSIONS, FEED_SQL, ROLES, table, wide_feed
from starfold.queries.registry import query
from starfold.schema import FEED, HOME_COUNTRY_CODE, HOME_COUNTRY_NAME, PATIENTS
from starfold.session import scratch_dir
from starfold.sources.feed import read_silver
from starfold.sources.sinks import write_day, write_partitioned

# Each typed column as text, some of it beyond casting.
BROKEN = {
    "paciente_idade": "case when l_quantity >= 49 then concat(cast(l_quantity as int), 'a')"
    " else concat(' ', cast(l_quantity as int)) end",
    "vacina_dataAplicacao": "case o_orderstatus when 'O' then concat(cast(cast(o_orderdate as date) as string), 'T10:00:00')"
    " when 'P' then cast(cast(o_orderdate as date) as string) else 'no date' end",
    "paciente_dataNascimento": "case when l_linestatus = 'F' then '1900-13-45'"
    " else cast(cast(l_shipdate as date) as string) end",
}


@query(
    FEED_SQL.replace(EXPRESSIONS["paciente_idade"][1] + " as", "case when l_quantity < 49 then cast(l_quantity as int) end as")
    .replace(
        EXPRESSIONS["vacina_dataAplicacao"][1] + " as",
        "case when o_orderstatus in ('O', 'P') then cast(o_orderdate as date) end as",
    )
    .replace(
        EXPRESSIONS["paciente_dataNascimento"][1] + " as",
        "case when l_linestatus <> 'F' then cast(l_shipdate as date) end as",
    )
    + " select * from feed"
)
def conform_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 32 columns arrive as text and leave in their declared types."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    nation = table(spark, sf_dir, "nation")
    rows = (
        lines.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(nation.alias("patient_nation"), F.expr("c_nationkey = patient_nation.n_nationkey"))
        .join(table(spark, sf_dir, "part"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(nation.alias("establishment_nation"), F.expr("s_nationkey = establishment_nation.n_nationkey"))
    )
    texts = rows.select(
        *(F.expr(BROKEN.get(n, EXPRESSIONS[n][1])).cast("string").alias(n) for n in FEED.names)
    )
    return conform(texts)


@query(f"""{FEED_SQL}
    select paciente_id as CD_PACIENTE, paciente_dataNascimento as DT_NASCIMENTO,
           paciente_enumSexoBiologico as SG_SEXO_BIOLOGICO, paciente_racaCor_codigo as CD_RACA_COR,
           paciente_racaCor_valor as DSC_RACA_CORD, paciente_nacionalidade_enumNacionalidade as CD_NACIONALIDADE
    from feed
""")
def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pick(wide_feed(spark, sf_dir), PATIENTS.columns)


@query("select s_suppkey, s_nationkey as code, 10 as country_code, 'BRASIL' as country_name from supplier")
def const_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pick(table(spark, sf_dir, "supplier"), {"s_suppkey": "s_suppkey", "code": "s_nationkey"})
    return rows.withColumns(
        {"country_code": F.lit(HOME_COUNTRY_CODE), "country_name": F.lit(HOME_COUNTRY_NAME)}
    )


@query(f"{FEED_SQL} select * from feed")
def pick_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra columns are dropped and feed order is restored."""
    feed = wide_feed(spark, sf_dir, *ROLES).withColumn("extra", F.lit("x"))
    return pick_feed(feed.select(*sorted(feed.columns)))


@query(f"{FEED_SQL} select document_id, vacina_grupoAtendimento_nome from feed where vacina_grupoAtendimento_nome is not null")
def filter_notnull_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide_feed(spark, sf_dir).select("document_id", "vacina_grupoAtendimento_nome")
    return drop_if_any_null(rows, ["vacina_grupoAtendimento_nome"])


@query(f"""{FEED_SQL}
    select document_id, paciente_endereco_coPais, paciente_endereco_nmMunicipio from feed
    where paciente_endereco_coPais is not null or paciente_endereco_nmMunicipio is not null
""")
def filter_notnull_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["paciente_endereco_coPais", "paciente_endereco_nmMunicipio"]
    return drop_if_all_null(wide_feed(spark, sf_dir, "patient").select("document_id", *columns), columns)


def events_by_day(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """The events written by day and read back, so that a date filter prunes folders."""
    path = scratch_dir(spark, label)
    write_partitioned(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), path, "day")
    return spark.read.parquet(path)


@query("""
    select event_id, user_id, event_type, cast(ts as date) as day from events
    where cast(ts as date) = date '2024-01-15'
""")
def date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_by_day(spark, sf_dir, "date-slice")
    return events.filter("day = date'2024-01-15'").select("event_id", "user_id", "event_type", "day")


@query("""
    select event_id, user_id, event_type, cast(ts as date) as day from events
    where cast(ts as date) >= date '2024-01-10' and cast(ts as date) < date '2024-01-20'
""")
def date_range_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_by_day(spark, sf_dir, "date-range-slice")
    kept = events.filter("day >= date'2024-01-10' and day < date'2024-01-20'")
    return kept.select("event_id", "user_id", "event_type", "day")


ORDER_DAYS = {"F": "2024-01-30", "O": "2024-01-31", "P": "2024-02-01"}


def orders_by_day(spark: SparkSession, sf_dir: str, label: str, *days: str) -> DataFrame:
    """The orders in three day folders across a month's end, one per status, and what is read of them."""
    base = scratch_dir(spark, label)
    orders = table(spark, sf_dir, "orders")
    for status, day in ORDER_DAYS.items():
        write_day(orders.filter(F.col("o_orderstatus") == status), base, day)
    return read_silver(spark, base, *days, schema=orders.schema)


@query("select * from orders where o_orderstatus = 'O'")
def day_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_day(spark, sf_dir, "day-folder", "2024-01-31")


@query("select * from orders where o_orderstatus in ('O', 'P')")
def day_folder_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the range that were never loaded are skipped."""
    return orders_by_day(spark, sf_dir, "day-folder-range", "2024-01-31", "2024-02-05")


@query("select * from orders")
def day_folder_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_day(spark, sf_dir, "day-folder-all")
