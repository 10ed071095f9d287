"""Duplicates, latest rows and surrogate keys.

A hash has no SQL twin, so surrogate keys are checked by the trip back: rows
find their dimension row by hash, SQL finds it by natural key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.keys import surrogate_key
from starfold.operators.dedup import latest_per_key, one_per_key
from starfold.operators.quality import key_uniqueness
from starfold.queries.feed import FEED_SQL, table, wide_feed
from starfold.queries.registry import query


@query("select distinct l_returnflag, l_linestatus, l_tax from lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_tax").distinct()


@query(f"""{FEED_SQL}
    select estabelecimento_valor, estabelecimento_razaoSocial, estalecimento_noFantasia from feed
    qualify row_number() over (partition by estabelecimento_valor
        order by estabelecimento_razaoSocial nulls first, estalecimento_noFantasia nulls first) = 1
""")
def dedup_single_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide_feed(spark, sf_dir, "establishment").select(
        "estabelecimento_valor", "estabelecimento_razaoSocial", "estalecimento_noFantasia"
    )
    return one_per_key(rows, ["estabelecimento_valor"], few=True)


@query(f"""{FEED_SQL}
    select vacina_codigo, vacina_lote, vacina_fabricante_nome, vacina_nome from feed
    qualify row_number() over (partition by vacina_codigo, vacina_lote
        order by vacina_fabricante_nome nulls first, vacina_nome nulls first) = 1
""")
def dedup_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide_feed(spark, sf_dir, "vaccine").select(
        "vacina_codigo", "vacina_lote", "vacina_fabricante_nome", "vacina_nome"
    )
    return one_per_key(rows, ["vacina_codigo", "vacina_lote"])


@query(f"""{FEED_SQL}
    select document_id, vacina_dataAplicacao, paciente_id, paciente_idade, estabelecimento_valor from feed
    qualify row_number() over (partition by document_id
        order by vacina_dataAplicacao nulls first, paciente_id nulls first, paciente_idade nulls first,
                 estabelecimento_valor nulls first) = 1
""")
def dedup_fact_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide_feed(spark, sf_dir).select(
        "document_id", "paciente_id", "paciente_idade", "estabelecimento_valor", "vacina_dataAplicacao"
    )
    return one_per_key(rows, ["document_id"], lead=["vacina_dataAplicacao"])


@query(f"""{FEED_SQL}
    select paciente_id, vacina_dataAplicacao, paciente_racaCor_codigo, paciente_dataNascimento from feed
    qualify row_number() over (partition by paciente_id
        order by vacina_dataAplicacao desc nulls last, paciente_racaCor_codigo nulls first,
                 paciente_dataNascimento nulls first) = 1
""")
def latest_row_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wide_feed(spark, sf_dir).select(
        "paciente_id", "vacina_dataAplicacao", "paciente_racaCor_codigo", "paciente_dataNascimento"
    )
    return latest_per_key(rows, ["paciente_id"], "vacina_dataAplicacao")


def found_by_surrogate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count, per natural key, the rows that reach it through the surrogate key alone."""
    dim = rows.distinct().withColumn("sk", surrogate_key(keys))
    uses = rows.withColumn("sk", surrogate_key(keys)).groupBy("sk").agg(F.count(F.lit(1)).alias("n_rows"))
    return dim.join(uses, "sk").select(*keys, "n_rows")


@query(f"{FEED_SQL} select paciente_id, count(*) as n_rows from feed group by all")
def sk_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["paciente_id"]
    return found_by_surrogate(wide_feed(spark, sf_dir).select(*keys), keys)


@query(f"{FEED_SQL} select vacina_codigo, vacina_lote, count(*) as n_rows from feed group by all")
def sk_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["vacina_codigo", "vacina_lote"]
    return found_by_surrogate(wide_feed(spark, sf_dir, "vaccine").select(*keys), keys)


@query(f"""{FEED_SQL}
    select vacina_grupoAtendimento_codigo, vacina_categoria_codigo, vacina_descricao_dose, count(*) as n_rows
    from feed group by all
""")
def sk_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["vacina_grupoAtendimento_codigo", "vacina_categoria_codigo", "vacina_descricao_dose"]
    return found_by_surrogate(wide_feed(spark, sf_dir).select(*keys), keys)


# A null on either side of a pair hashes like the other pair, unless nulls are part of the hash.
PAIRS = """
    select case when l_linestatus = 'F' then null else l_linenumber end as a,
           case when l_linestatus = 'F' then l_linenumber end as b
    from lineitem"""


@query(f"""
    with pairs as ({PAIRS})
    select 'skips nulls' as hashed, count(*) as n_rows, count(distinct (a, b)) as n_keys,
           count(distinct coalesce(a, b)) as n_surrogates from pairs
    union all
    select 'null safe', count(*), count(distinct (a, b)), count(distinct (a, b)) from pairs
""")
def sk_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").selectExpr(
        "case when l_linestatus = 'F' then null else l_linenumber end as a",
        "case when l_linestatus = 'F' then l_linenumber end as b",
    )
    keys = ["a", "b"]

    def report(label: str, null_safe: bool) -> DataFrame:
        counts = key_uniqueness(pairs.withColumn("sk", surrogate_key(keys, null_safe)), keys, "sk")
        return counts.select(F.lit(label).alias("hashed"), "n_rows", "n_keys", "n_surrogates")

    return report("skips nulls", False).unionByName(report("null safe", True))
