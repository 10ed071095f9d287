"""Cleaning operators over the driver's texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.text import ACCENTED, ACCENTED_MORE, PLAIN, PLAIN_MORE
from starfold.operators.clean import clean_text_columns, flatten_hits, normalise_date, normalise_lot, null_tokens
from starfold.queries.feed import table
from starfold.queries.registry import query


@query(f"""
    select cast(doc_id as string) as item, translate(trim(text, ' '), '{ACCENTED}', '{PLAIN}') as text,
           translate(trim(source, ' '), '{ACCENTED}', '{PLAIN}') as label, n_chars as size
    from documents
    union all
    select concat(conv_id, '/', turn), translate(trim(text, ' '), '{ACCENTED}', '{PLAIN}'),
           translate(trim(role, ' '), '{ACCENTED}', '{PLAIN}'), turn
    from conversations
""")
def clean_text_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").selectExpr(
        "cast(doc_id as string) as item", "text", "source as label", "n_chars as size"
    )
    conversations = table(spark, sf_dir, "conversations").selectExpr(
        "concat(conv_id, '/', turn) as item", "text", "role as label", "turn as size"
    )
    return clean_text_columns(documents.unionByName(conversations))


@query(f"""
    select doc_id, translate(trim(text, ' '), '{ACCENTED + ACCENTED_MORE}', '{PLAIN + PLAIN_MORE}') as text
    from documents
""")
def clean_text_fold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text_columns(table(spark, sf_dir, "documents").select("doc_id", "text"), fold="full")


TOKENS = """
    case event_type when 'view' then 'None' when 'click' then '' when 'error' then 'N/A'
                    when 'signup' then 'Pendente Identificacao' else event_type end"""


@query("""
    select event_id, case when event_type = 'purchase' then event_type end as event_type,
           props, concat('none ', event_type) as kept
    from events
""")
def null_tokens_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return null_tokens(
        events.select(
            "event_id", F.expr(TOKENS).alias("event_type"), "props", F.expr("concat('none ', event_type)").alias("kept")
        )
    )


@query("select p_partkey, upper(p_name) as p_name, p_type from part")
def upper_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_lot(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), "p_name")


# ISO dates, timestamps, plain digits, one that is no date and one that is empty.
DATE_TEXT = """
    case o_orderpriority when '1-URGENT' then concat(cast(cast(o_orderdate as date) as string), 'T00:00:00.000Z')
                         when '2-HIGH' then replace(cast(cast(o_orderdate as date) as string), '-', '')
                         when '3-MEDIUM' then cast(cast(o_orderdate as date) as string)
                         when '5-LOW' then substring(cast(cast(o_orderdate as date) as string), 6)
                         else '' end"""


@query(f"""
    with texts as (select o_orderkey, {DATE_TEXT} as day from orders)
    select o_orderkey,
           cast(try_strptime(substring(regexp_replace(day, '[^0-9]', '', 'g'), 1, 8), '%Y%m%d') as date) as day
    from texts
""")
def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(DATE_TEXT).alias("day"))
    return normalise_date(texts, "day")


@query("""
    select event_id, cast(props ->> '$.k' as string) as k, event_type from events
""")
def json_hits_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = "struct<event_id: bigint, k: string, event_type: string>"
    hits = table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.struct("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type").alias("_source"),
                F.array(F.col("ts").cast("string"), F.col("event_id").cast("string")).alias("sort"),
            )
        ).alias("hit")
    )
    parsed = hits.select(F.from_json("hit", f"_source {source}, sort array<string>").alias("hit")).select("hit.*")
    return flatten_hits(parsed)
