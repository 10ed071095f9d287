"""A feed made of the driver tables.

One order line plays one dose: the customer is the patient, the supplier the
establishment, the nations of both are municipalities, brand and type are
vaccine and lot, priority, status and return flag are the campaign. Nulls, odd
spellings and repeated ids are placed by value, the same way in Spark and SQL.
Only the tables behind the asked-for roles are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.schema import FEED
from starfold.session import release, scratch_dir
from starfold.sources import files

ROLES = ("patient", "vaccine", "establishment", "campaign")

# Feed column -> (table role it needs, expression valid in Spark and in DuckDB).
EXPRESSIONS: dict[str, tuple[str, str]] = {
    "document_id": ("line", "concat(l_orderkey, '-', l_linenumber)"),
    "paciente_id": (
        "line",
        "case when o_orderstatus = 'O' and o_orderpriority = '5-LOW' then null else cast(o_custkey as string) end",
    ),
    "paciente_idade": ("line", "cast(l_quantity as int)"),
    "paciente_dataNascimento": ("line", "cast(l_shipdate as date)"),
    "paciente_enumSexoBiologico": ("line", "l_linestatus"),
    "paciente_racaCor_codigo": (
        "line", "case when o_orderstatus = 'P' then null else substring(o_orderpriority, 1, 1) end"
    ),
    "paciente_racaCor_valor": ("line", "o_orderpriority"),
    "paciente_endereco_coIbgeMunicipio": (
        "patient",
        "case when c_mktsegment = 'BUILDING' then concat('0', c_nationkey) else cast(c_nationkey as string) end",
    ),
    "paciente_endereco_coPais": (
        "patient",
        "case c_mktsegment when 'MACHINERY' then 'XX' when 'FURNITURE' then null else '10' end",
    ),
    "paciente_endereco_nmMunicipio": (
        "patient",
        "case when c_mktsegment in ('FURNITURE', 'AUTOMOBILE') and patient_nation.n_regionkey < 3 then null"
        " else patient_nation.n_name end",
    ),
    "paciente_endereco_nmPais": ("patient", "case when c_mktsegment = 'MACHINERY' then 'EXTERIOR' else 'BRASIL' end"),
    "paciente_endereco_uf": ("patient", "cast(patient_nation.n_regionkey as string)"),
    "paciente_endereco_cep": ("line", "cast(o_custkey as string)"),
    "paciente_nacionalidade_enumNacionalidade": ("line", "l_returnflag"),
    "estabelecimento_valor": (
        "line", "case when l_linestatus = 'F' and l_quantity = 50 then null else cast(l_suppkey as int) end"
    ),
    "estabelecimento_razaoSocial": ("establishment", "s_name"),
    "estalecimento_noFantasia": ("establishment", "concat(s_name, ' ', l_linestatus)"),
    "estabelecimento_municipio_codigo": ("establishment", "s_nationkey"),
    "estabelecimento_municipio_nome": ("establishment", "establishment_nation.n_name"),
    "estabelecimento_uf": ("establishment", "cast(establishment_nation.n_regionkey as string)"),
    "vacina_grupoAtendimento_codigo": ("line", "cast(substring(o_orderpriority, 1, 1) as int)"),
    "vacina_grupoAtendimento_nome": (
        "line", "case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end"
    ),
    "vacina_categoria_codigo": ("line", "case o_orderstatus when 'O' then 1 when 'F' then 2 end"),
    "vacina_categoria_nome": ("line", "concat(o_orderstatus, l_linestatus)"),
    "vacina_lote": ("vaccine", "case when p_type = 'SMALL' then null else p_type end"),
    "vacina_fabricante_nome": ("vaccine", "p_name"),
    "vacina_fabricante_referencia": ("vaccine", "p_brand"),
    "vacina_dataAplicacao": (
        "line", "case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then null else cast(o_orderdate as date) end"
    ),
    "vacina_descricao_dose": ("line", "l_returnflag"),
    "vacina_codigo": ("vaccine", "cast(substring(p_brand, 7) as int)"),
    "vacina_nome": ("vaccine", "concat(p_brand, ' ', p_name)"),
    "sistema_origem": ("line", "l_linestatus"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Orders a page, where the feed lands as pages: the number of pages grows with the feed, their size does not.
ORDERS_A_PAGE = 500
# Bytes of order lines that are joined at once where the feed lands.
SLICE_BYTES = 512 << 20

# The number of a slice, and how many there are.
Slice = tuple[int, int]


def slices(spark: SparkSession, sf_dir: str) -> Iterator[Slice]:
    """Slices of the feed by whole pages of orders; together they are the feed.

    A slice's joins shuffle no more than their share, and that is let go of before the next slice is asked for.
    """
    count = max(1, -(-files.size(spark, f"{sf_dir}/lineitem.parquet") // SLICE_BYTES))
    for number in range(count):
        yield number, count
        release(spark)


def stored_slices(
    spark: SparkSession, sf_dir: str, build: Callable[[Slice], DataFrame], label: str = "feed-slice"
) -> Iterator[DataFrame]:
    """What ``build`` makes of each slice as a stored table, for slices that are read more than once; gone after its turn."""
    for part in slices(spark, sf_dir):
        path, rows = scratch_dir(spark, label), build(part)
        rows.write.option("compression", "zstd").parquet(path)
        release(spark)
        yield spark.read.schema(rows.schema).parquet(path)
        files.delete(spark, path)


def page_of(order: Column) -> Column:
    return F.floor(order / ORDERS_A_PAGE)


def in_slice(page: Column, part: Slice | None) -> Column:
    if part is None or part[1] == 1:
        return F.lit(True)
    number, count = part
    return F.pmod(F.xxhash64(page), F.lit(count)) == number


def wide_feed(spark: SparkSession, sf_dir: str, *roles: str, part: Slice | None = None) -> DataFrame:
    """Silver-typed feed rows, all or those of one slice; columns of roles not asked for are left out.

    So are the joins that fill them, which changes no rows: every foreign key of the given tables resolves.
    """
    lines = table(spark, sf_dir, "lineitem").filter(in_slice(page_of(F.col("l_orderkey")), part))
    orders = table(spark, sf_dir, "orders").filter(in_slice(page_of(F.col("o_orderkey")), part))
    nation = table(spark, sf_dir, "nation")
    # Customers meet the orders, of which there are fewer than lines; names are joined to the lines after that shuffle, which
    # while Spark broadcasts parts and suppliers is the only one.
    if "patient" in roles:
        orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "vaccine" in roles:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "establishment" in roles:
        suppliers = table(spark, sf_dir, "supplier").join(
            nation.alias("establishment_nation"), F.expr("s_nationkey = establishment_nation.n_nationkey")
        )
        rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    if "patient" in roles:
        # Last, as names of nations would travel with the lines to the parts.
        rows = rows.join(nation.alias("patient_nation"), F.expr("c_nationkey = patient_nation.n_nationkey"))
    return rows.select(
        *(F.expr(sql).alias(name) for name, (role, sql) in EXPRESSIONS.items() if role == "line" or role in roles)
    )


# The same rows in SQL, as the first common table expressions of a query.
FEED_SQL = (
    "with feed as (select "
    + ", ".join(f"{EXPRESSIONS[name][1]} as {name}" for name in FEED.names)
    + """
    from lineitem
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join nation patient_nation on c_nationkey = patient_nation.n_nationkey
    join part on l_partkey = p_partkey
    join supplier on l_suppkey = s_suppkey
    join nation establishment_nation on s_nationkey = establishment_nation.n_nationkey)"""
)
