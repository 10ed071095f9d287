"""Keyed merges and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.keys import surrogate_key
from starfold.functions.text import canonical_code
from starfold.operators.dedup import latest_per_key
from starfold.operators.merge import merge_frames, not_in
from starfold.plans import dimensions as dims
from starfold.queries.dimensions import PATIENT_SQL, VACCINE_SQL
from starfold.queries.feed import FEED_SQL, table, wide_feed
from starfold.queries.registry import query
from starfold.schema import PATIENTS, VACCINES
from starfold.session import scratch_dir
from starfold.sources.tables import SnapshotTable

CUT = "2001-01-01"
OLD = f"vacina_dataAplicacao < date'{CUT}'"
# Doses without date come with the second batch.
NEW = f"(vacina_dataAplicacao >= date'{CUT}' or vacina_dataAplicacao is null)"
PATIENT_KEY = list(PATIENTS.keys)
BATCHES_SQL = f"""{FEED_SQL},
    all_doses as (select * from feed),
    old as (with feed as (select * from all_doses where {OLD}) {{dim}}),
    new as (with feed as (select * from all_doses where {NEW}) {{dim}})
"""
PATIENT_BATCHES = BATCHES_SQL.format(dim=PATIENT_SQL)
MERGED_PATIENTS = f"""{PATIENT_BATCHES}
    select * from new union all
    select * from old where not exists (select 1 from new where new.CD_PACIENTE is not distinct from old.CD_PACIENTE)
"""


def patient_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    feed = wide_feed(spark, sf_dir)
    return dims.patients(feed.filter(OLD)), dims.patients(feed.filter(NEW))


@query(f"""{PATIENT_BATCHES}
    select * from old where not exists (select 1 from new where new.CD_PACIENTE is not distinct from old.CD_PACIENTE)
""")
def anti_join_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = patient_batches(spark, sf_dir)
    return not_in(old, new, PATIENT_KEY).drop(PATIENTS.surrogate)


@query("""
    select cast(s_nationkey as string) as code, s_name as name from supplier
    union all by name
    select c_name as name, case when c_mktsegment = 'BUILDING' then 'XX' else cast(c_nationkey as string) end as code
    from customer
""")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes kept as numbers on one side and as padded text on the other, columns in different order."""
    left = table(spark, sf_dir, "supplier").select(
        canonical_code(F.col("s_nationkey")).alias("code"), F.col("s_name").alias("name")
    )
    padded = F.expr("case when c_mktsegment = 'BUILDING' then 'XX' else concat('00', c_nationkey) end")
    right = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), canonical_code(padded).alias("code")
    )
    return left.unionByName(right)


@query(MERGED_PATIENTS)
def upsert_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = patient_batches(spark, sf_dir)
    return merge_frames(old, new, PATIENT_KEY).drop(PATIENTS.surrogate)


@query(f"{FEED_SQL} {VACCINE_SQL}")
def upsert_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First use creates the table."""
    stored = SnapshotTable(spark, scratch_dir(spark, "upsert-create"))
    stored.upsert(dims.vaccines(wide_feed(spark, sf_dir, "vaccine")), list(VACCINES.keys))
    return stored.read().drop(VACCINES.surrogate)


@query(MERGED_PATIENTS)
def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create, merge, and merge the same batch again: the third step changes nothing."""
    old, new = patient_batches(spark, sf_dir)
    stored = SnapshotTable(spark, scratch_dir(spark, "upsert-twice"))
    for batch in (old, new, new):
        stored.upsert(batch, PATIENT_KEY)
    return stored.read().drop(PATIENTS.surrogate)


LATEST_ORDERS_SQL = """
    select o_custkey as customer, cast(o_orderdate as date) as day, o_orderkey as order_id from orders
    where o_orderstatus {status}
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1
"""


@query(f"""
    with batches as ({LATEST_ORDERS_SQL.format(status="= 'F'")} union all {LATEST_ORDERS_SQL.format(status="<> 'F'")})
    select * from batches qualify row_number() over (partition by customer order by day desc, order_id) = 1
""")
def upsert_newer_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored row stays where it is the newer one, so batches may arrive out of order."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as customer", "cast(o_orderdate as date) as day", "o_orderkey as order_id", "o_orderstatus"
    )
    old = latest_per_key(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), ["customer"], "day")
    new = latest_per_key(orders.filter("o_orderstatus <> 'F'").drop("o_orderstatus"), ["customer"], "day")
    return merge_frames(old, new, ["customer"], newer_by="day")


NAMELESS = "code % 5 = 0"


@query(f"""
    select code, case when code % 7 = 0 then null when {NAMELESS} or code % 2 = 0 then old_name else new_name end as name,
           case when code % 3 = 0 then region else new_region end as region
    from (select c_custkey as code, concat('old ', c_name) as old_name, concat('new ', c_name) as new_name,
                 c_nationkey as region, c_nationkey + 100 as new_region from customer)
""")
def upsert_keep_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that lacks values does not wipe stored ones, column by column; what neither side has stays missing."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("code"), F.col("c_name").alias("full_name"), F.col("c_nationkey").alias("nation")
    )
    old = customers.selectExpr("code", "case when code % 7 = 0 then null else concat('old ', full_name) end as name", "nation as region")
    new = customers.selectExpr(
        "code", f"case when {NAMELESS} or code % 2 = 0 or code % 7 = 0 then null else concat('new ', full_name) end as name",
        "case when code % 3 = 0 then null else nation + 100 end as region",
    )
    stored = SnapshotTable(spark, scratch_dir(spark, "upsert-keep-filled"))
    for batch in (old, new, new):
        stored.upsert(batch, ["code"], keep_filled=["name", "region"])
    return stored.read()


@query("""
    select c_custkey as a, null as b, case when c_nationkey < 12 then 'new' else 'old' end as batch from customer
    union all select null, c_custkey, 'new' from customer
""")
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that differ in where they are null share a plain surrogate, and are merged apart."""
    customers = table(spark, sf_dir, "customer")
    left = customers.selectExpr("c_custkey as a", "cast(null as bigint) as b", "'old' as batch")
    again = customers.filter("c_nationkey < 12").selectExpr("c_custkey as a", "cast(null as bigint) as b", "'new' as batch")
    right = customers.selectExpr("cast(null as bigint) as a", "c_custkey as b", "'new' as batch")
    stored = SnapshotTable(spark, scratch_dir(spark, "upsert-null-keys"))
    for batch in (left, again.unionByName(right)):
        stored.upsert(batch.withColumn("surrogate", surrogate_key(["a", "b"])), ["a", "b"])
    return stored.read().drop("surrogate")
