"""Lookups and the fact table, checked by the trip back from surrogate to natural keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.lookup import lookup
from starfold.operators.quality import null_counts, unresolved_keys
from starfold.paths import LakePaths
from starfold.plans import dimensions as dims
from starfold.plans import pipeline
from starfold.plans.fact import COMPLETE, ROLES, build_fact
from starfold.queries import feed as stand_in
from starfold.queries.dimensions import CAMPAIGN_SQL, ESTABLISHMENT_SQL, MUNICIPALITY_SQL, PATIENT_SQL, VACCINE_SQL
from starfold.queries.feed import FEED_SQL, wide_feed
from starfold.queries.registry import query
from starfold.schema import CAMPAIGNS, FACT_DATE, FACT_ID, FACT_SURROGATE, MUNICIPALITIES, PATIENTS, VACCINES
from starfold.session import scratch_dir
from starfold.sources.feed import read_silver
from starfold.sources.sinks import write_day, write_table
from starfold.sources.tables import LOAD_DATE, SnapshotTable


EARLY, LATE = "2024-01-01", "2024-01-02"


def stored(df: DataFrame, path: str) -> DataFrame:
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def stored_star(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Silver and its dimensions as written tables, which is how a fact job meets them."""
    paths = LakePaths(scratch_dir(spark, label))
    write_day(wide_feed(spark, sf_dir, *stand_in.ROLES), paths.silver, EARLY)
    pipeline.load_dimensions(spark, paths, day=EARLY)
    tables = {name: pipeline.read_dimension(spark, paths, name) for name in dims.BUILDERS}
    return read_silver(spark, paths.silver, EARLY), tables


def resolved(fact: DataFrame, tables: dict[str, DataFrame], of_patients: tuple[str, ...] = ()) -> DataFrame:
    """Fact rows with the natural keys their surrogate keys point at, and further columns of the patients."""
    rows = fact
    for role in ROLES:
        dim = tables[role.dim.name].select(
            F.col(role.dim.surrogate).alias(role.column),
            *(F.col(key).alias(column) for column, key in role.on.items()),
            *(of_patients if role.dim is PATIENTS else ()),
        )
        rows = rows.join(dim, role.column, "left")
    return rows.select(FACT_ID, FACT_DATE, *(column for role in ROLES for column in role.on), *of_patients)


FACT_CTES = f"""{FEED_SQL},
    campaigns as ({CAMPAIGN_SQL}), establishments as ({ESTABLISHMENT_SQL}),
    municipalities as ({MUNICIPALITY_SQL}), patients as ({PATIENT_SQL}), vaccines as ({VACCINE_SQL}),
    doses as (
        select document_id, vacina_dataAplicacao, paciente_id, vacina_codigo, vacina_lote,
               vacina_grupoAtendimento_codigo, vacina_categoria_codigo, vacina_descricao_dose, estabelecimento_valor,
               coalesce(cast(try_cast(paciente_endereco_coIbgeMunicipio as bigint) as string),
                        paciente_endereco_coIbgeMunicipio) as patient_city,
               coalesce(cast(try_cast(paciente_endereco_coPais as bigint) as string),
                        paciente_endereco_coPais) as patient_country,
               cast(estabelecimento_municipio_codigo as string) as establishment_city
        from feed
        qualify row_number() over (partition by document_id
            order by vacina_dataAplicacao nulls first, paciente_id nulls first, vacina_codigo nulls first,
                     vacina_lote nulls first, vacina_grupoAtendimento_codigo nulls first,
                     vacina_categoria_codigo nulls first, vacina_descricao_dose nulls first,
                     estabelecimento_valor nulls first, patient_city nulls first, patient_country nulls first,
                     establishment_city nulls first) = 1),
    fact as (
        select document_id as CD_VACINACAO, vacina_dataAplicacao as DT_VACINACAO, p.CD_PACIENTE,
               v.CD_VACINA, v.DSC_LOTE,
               c.CD_GRUPO_ATENDIMENTO, c.CD_CATEGORIA_GRUPO_ATENDIMENTO, c.DSC_DOSE, e.CD_ESTABELECIMENTO,
               mp.CD_MUNICIPIO_IBGE as CD_MUNICIPIO_IBGE_PACIENTE, mp.CD_PAIS as CD_PAIS_PACIENTE,
               me.CD_MUNICIPIO_IBGE as CD_MUNICIPIO_IBGE_ESTABELECIMENTO, me.CD_PAIS as CD_PAIS_ESTABELECIMENTO
        from doses
        left join patients p on paciente_id = p.CD_PACIENTE
        left join vaccines v on vacina_codigo = v.CD_VACINA and vacina_lote = v.DSC_LOTE
        left join campaigns c on vacina_grupoAtendimento_codigo = c.CD_GRUPO_ATENDIMENTO
            and vacina_categoria_codigo = c.CD_CATEGORIA_GRUPO_ATENDIMENTO and vacina_descricao_dose = c.DSC_DOSE
        left join establishments e on estabelecimento_valor = e.CD_ESTABELECIMENTO
        left join municipalities mp on patient_city = mp.CD_MUNICIPIO_IBGE and patient_country = mp.CD_PAIS
        left join municipalities me on establishment_city = me.CD_MUNICIPIO_IBGE and me.CD_PAIS = '10')
"""


@query(FACT_CTES + "select * from fact")
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every foreign key looked up in its dimension."""
    silver, tables = stored_star(spark, sf_dir, "fact-build")
    return resolved(build_fact(silver, tables), tables)


@query(FACT_CTES + "select * from fact")
def fact_build_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the dimensions that keep every key are derived instead of joined."""
    silver, tables = stored_star(spark, sf_dir, "fact-derived")
    return resolved(build_fact(silver, tables, complete=COMPLETE), tables)


@query(f"""{FACT_CTES},
    races as (select distinct paciente_id, paciente_racaCor_codigo from feed where paciente_id is not null)
    select fact.*, first_race as CD_RACA_COR
    from fact left join (
        select paciente_id, case when bool_or(paciente_racaCor_codigo is null) then null
                                 else min(paciente_racaCor_codigo) end as first_race
        from races group by paciente_id) on CD_PACIENTE = paciente_id
""")
def fact_build_by_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the patient dimension kept per race code, a dose still is one row; all keys, and the race found.

    The plain hash gives patient '5' without race the key of race '5' without
    patient, so this dimension is keyed null-safely.
    """
    silver, tables = stored_star(spark, sf_dir, "fact-by-race")
    patients = stored(dims.patients_by_race(silver, null_safe=True), scratch_dir(spark, "patients-by-race"))
    # The reduction to one row per patient takes the least surrogate: lead it by the race.
    first_race = patients.withColumn(PATIENTS.surrogate, F.struct("CD_RACA_COR", PATIENTS.surrogate))
    complete = tuple(n for n in COMPLETE if n != PATIENTS.name)
    fact = build_fact(silver, {**tables, PATIENTS.name: first_race}, complete=complete, patients_unique=False)
    fact = fact.withColumn(PATIENTS.surrogate, F.col(f"{PATIENTS.surrogate}.{PATIENTS.surrogate}"))
    return resolved(fact, {**tables, PATIENTS.name: patients}, ("CD_RACA_COR",))


@query(f"""{FACT_CTES}
    select count(*) as n_rows, count(*) filter (CD_PACIENTE is null) as null_SK_DM_PACIENTES,
           count(*) filter (CD_VACINA is null) as null_SK_DM_VACINAS,
           count(*) filter (CD_GRUPO_ATENDIMENTO is null) as null_SK_DM_CAMPANHAS,
           count(*) filter (CD_ESTABELECIMENTO is null) as null_SK_DM_ESTABELECIMENTOS,
           count(*) filter (CD_MUNICIPIO_IBGE_PACIENTE is null) as null_SK_DM_MUNICIPIOS_PACIENTE,
           count(*) filter (CD_MUNICIPIO_IBGE_ESTABELECIMENTO is null) as null_SK_DM_MUNICIPIOS_ESTABELECIMENTO
    from fact
""")
def fact_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, tables = stored_star(spark, sf_dir, "fact-nulls")
    return null_counts(build_fact(silver, tables), [role.column for role in ROLES])


LACKING = {"dm_estabelecimentos": "CD_ESTABELECIMENTO % 3 = 0", "dm_pacientes": "CD_PACIENTE like '%7'"}
UNRESOLVED_SQL = " union all ".join(
    f"select '{role.column}' as foreign_key, count(*) filter ({LACKING.get(role.dim.name, 'false')}) as n_unresolved from fact"
    for role in ROLES
)


@query(FACT_CTES + UNRESOLVED_SQL)
def fact_unresolved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived keys that point at no row, of dimensions from which rows are missing and of whole ones."""
    silver, tables = stored_star(spark, sf_dir, "fact-unresolved")
    fact = build_fact(silver, tables, complete=COMPLETE)
    left = {
        name: df.filter(~F.coalesce(F.expr(LACKING[name]), F.lit(False))) if name in LACKING else df
        for name, df in tables.items()
    }
    return unresolved_keys(fact, {r.column: (left[r.dim.name], r.dim.surrogate) for r in ROLES})


@query(FACT_CTES + """
    select count(*) as n_rows, count(distinct CD_VACINACAO) as n_ids, count(distinct CD_VACINACAO) as n_surrogates from fact
""")
def fact_own_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many surrogates as doses."""
    silver, tables = stored_star(spark, sf_dir, "fact-own-keys")
    return build_fact(silver, tables, complete=COMPLETE).agg(
        F.count("*").alias("n_rows"), F.count_distinct(FACT_ID).alias("n_ids"),
        F.count_distinct(FACT_SURROGATE).alias("n_surrogates"),
    )


def looked_up(spark: SparkSession, sf_dir: str, dim, build, *roles: str, spread: str | None = None) -> DataFrame:
    """Feed rows counted by what their natural key found in the dimension."""
    feed = wide_feed(spark, sf_dir, *roles)
    table = build(feed)
    keyed = lookup(
        feed.select("document_id", *(F.col(f).alias(k) for k, f in dim.keys.items())),
        table, {k: k for k in dim.keys}, dim.surrogate, spread=spread,
    )
    counts = keyed.groupBy(dim.surrogate).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(table, dim.surrogate, "left").select(*dim.keys, "n_rows")


@query(f"""{FEED_SQL}, patients as ({PATIENT_SQL})
    select CD_PACIENTE, count(*) as n_rows from feed left join patients on paciente_id = CD_PACIENTE group by all
""")
def lookup_left_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return looked_up(spark, sf_dir, PATIENTS, dims.patients, spread="document_id")


@query(f"""{FEED_SQL}, vaccines as ({VACCINE_SQL})
    select CD_VACINA, DSC_LOTE, count(*) as n_rows from feed
    left join vaccines on vacina_codigo = CD_VACINA and vacina_lote = DSC_LOTE group by all
""")
def lookup_left_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return looked_up(spark, sf_dir, VACCINES, dims.vaccines, "vaccine")


CAMPAIGN_COUNTS = f"""{FEED_SQL}, campaigns as ({CAMPAIGN_SQL})
    select CD_GRUPO_ATENDIMENTO, CD_CATEGORIA_GRUPO_ATENDIMENTO, DSC_DOSE, count(*) as n_rows from feed
    left join campaigns on vacina_grupoAtendimento_codigo {{same}} CD_GRUPO_ATENDIMENTO
        and vacina_categoria_codigo {{same}} CD_CATEGORIA_GRUPO_ATENDIMENTO
        and vacina_descricao_dose {{same}} DSC_DOSE
    group by all
"""


@query(CAMPAIGN_COUNTS.format(same="="))
def lookup_left_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return looked_up(spark, sf_dir, CAMPAIGNS, dims.campaigns)


@query(CAMPAIGN_COUNTS.format(same="is not distinct from"))
def lookup_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null part of the key may match a null part of the dimension."""
    feed = wide_feed(spark, sf_dir)
    table = dims.campaigns(feed, null_safe=True)
    rows = feed.select(*(F.col(f).alias(k) for k, f in CAMPAIGNS.keys.items()))
    keyed = lookup(rows, table, {k: k for k in CAMPAIGNS.keys}, CAMPAIGNS.surrogate, null_safe=True)
    counts = keyed.groupBy(CAMPAIGNS.surrogate).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(table, CAMPAIGNS.surrogate, "left").select(*CAMPAIGNS.keys, "n_rows")


@query(f"""{FEED_SQL}, municipalities as ({MUNICIPALITY_SQL})
    select mp.CD_MUNICIPIO_IBGE as patient_city, mp.CD_PAIS as patient_country,
           me.CD_MUNICIPIO_IBGE as establishment_city, me.CD_PAIS as establishment_country, count(*) as n_rows
    from feed
    left join municipalities mp
        on coalesce(cast(try_cast(paciente_endereco_coIbgeMunicipio as bigint) as string),
                    paciente_endereco_coIbgeMunicipio) = mp.CD_MUNICIPIO_IBGE
        and paciente_endereco_coPais = mp.CD_PAIS
    left join municipalities me
        on cast(estabelecimento_municipio_codigo as string) = me.CD_MUNICIPIO_IBGE and me.CD_PAIS = '10'
    group by all
""")
def lookup_role_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dimension looked up twice under two roles."""
    feed = wide_feed(spark, sf_dir, "patient", "establishment")
    root = scratch_dir(spark, "role-playing")
    table = stored(dims.municipalities(feed), f"{root}/municipalities")
    rows = feed.select(
        dims.canonical_code(F.col("paciente_endereco_coIbgeMunicipio")).alias("pc"),
        dims.canonical_code(F.col("paciente_endereco_coPais")).alias("pp"),
        dims.canonical_code(F.col("estabelecimento_municipio_codigo")).alias("ec"),
        F.lit("10").alias("ep"),
    )
    sk = MUNICIPALITIES.surrogate
    rows = lookup(rows, table, {"pc": "CD_MUNICIPIO_IBGE", "pp": "CD_PAIS"}, sk, role="patient_sk")
    rows = lookup(rows, table, {"ec": "CD_MUNICIPIO_IBGE", "ep": "CD_PAIS"}, sk, role="establishment_sk")
    counts = rows.groupBy("patient_sk", "establishment_sk").agg(F.count(F.lit(1)).alias("n_rows"))
    for role in ("patient", "establishment"):
        names = table.select(
            F.col(sk).alias(f"{role}_sk"),
            F.col("CD_MUNICIPIO_IBGE").alias(f"{role}_city"),
            F.col("CD_PAIS").alias(f"{role}_country"),
        )
        counts = counts.join(names, f"{role}_sk", "left")
    return counts.drop("patient_sk", "establishment_sk")



def early_and_all(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two overlapping batches: the doses up to 1998, and all of them."""
    return silver.filter(F.col("vacina_dataAplicacao") < "1999-01-01"), silver


@query(FACT_CTES + "select * from fact")
def fact_append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches, each loaded twice, store every dose once."""
    silver, tables = stored_star(spark, sf_dir, "fact-idempotent")
    fact = SnapshotTable(spark, scratch_dir(spark, "fact-idempotent-table"))
    for load_date, batch in zip((EARLY, LATE), early_and_all(silver)):
        rows = stored(build_fact(batch, tables, complete=COMPLETE), scratch_dir(spark, "fact-idempotent-rows"))
        for _ in range(2):
            fact.load_batch(pipeline.new_doses(fact, rows, [load_date]), load_date)
    return resolved(fact.read().drop(LOAD_DATE), tables)


@query(FACT_CTES + "select * from fact union all select * from fact where DT_VACINACAO < date '1999-01-01'")
def fact_append_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain append stores what both batches hold twice."""
    silver, tables = stored_star(spark, sf_dir, "fact-plain")
    fact = SnapshotTable(spark, scratch_dir(spark, "fact-plain-table"))
    for load_date, batch in zip((EARLY, LATE), early_and_all(silver)):
        fact.append_batch(build_fact(batch, tables, complete=COMPLETE), load_date)
    return resolved(fact.read().drop(LOAD_DATE), tables)


@query(FACT_CTES + "select * from fact")
def fact_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full reload forgets what was stored before."""
    silver, tables = stored_star(spark, sf_dir, "fact-reload")
    fact = SnapshotTable(spark, scratch_dir(spark, "fact-reload-table"))
    for load_date, batch in zip((EARLY, LATE), early_and_all(silver)):
        fact.replace_with_batch(build_fact(batch, tables, complete=COMPLETE), load_date)
    return resolved(fact.read().drop(LOAD_DATE), tables)


@query(FACT_CTES + "select * from fact where DT_VACINACAO < date '1999-01-01'")
def fact_rerun_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load date whose rerun has no rows is left with none."""
    silver, tables = stored_star(spark, sf_dir, "fact-rerun-empty")
    fact = SnapshotTable(spark, scratch_dir(spark, "fact-rerun-empty-table"))
    early, everything = early_and_all(silver)
    for load_date, batch in ((EARLY, early), (LATE, everything), (LATE, everything.limit(0))):
        fact.load_batch(build_fact(batch, tables, complete=COMPLETE), load_date)
    return resolved(fact.read().drop(LOAD_DATE), tables)
