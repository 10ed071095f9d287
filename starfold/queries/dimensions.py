"""The published dimensions; surrogate keys are left out, they have no SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starfold.plans import dimensions as dims
from starfold.queries.feed import FEED_SQL, wide_feed
from starfold.queries.registry import query
from starfold.schema import CAMPAIGNS, ESTABLISHMENTS, MUNICIPALITIES, PATIENTS, VACCINES

CAMPAIGN_SQL = """
    select vacina_grupoAtendimento_codigo as CD_GRUPO_ATENDIMENTO,
           vacina_categoria_codigo as CD_CATEGORIA_GRUPO_ATENDIMENTO, vacina_descricao_dose as DSC_DOSE,
           vacina_grupoAtendimento_nome as NM_GRUPO_ATENDIMENTO, vacina_categoria_nome as NM_CATEGORIA_GRUPO_ATENDIMENTO
    from feed where vacina_grupoAtendimento_nome is not null
    qualify row_number() over (
        partition by vacina_grupoAtendimento_codigo, vacina_categoria_codigo, vacina_descricao_dose
        order by vacina_grupoAtendimento_nome nulls first, vacina_categoria_nome nulls first) = 1
"""

ESTABLISHMENT_SQL = """
    select estabelecimento_valor as CD_ESTABELECIMENTO, estabelecimento_razaoSocial as DSC_RAZAO_SOCIAL,
           estalecimento_noFantasia as NM_FANTASIA
    from feed
    qualify row_number() over (partition by estabelecimento_valor
        order by estabelecimento_razaoSocial nulls first, estalecimento_noFantasia nulls first) = 1
"""

MUNICIPALITY_SQL = """
    select * from (
        select cast(estabelecimento_municipio_codigo as string) as CD_MUNICIPIO_IBGE, '10' as CD_PAIS,
               estabelecimento_municipio_nome as NM_MUNICIPIO, 'BRASIL' as NM_PAIS, estabelecimento_uf as SG_UF
        from feed
        union all
        select coalesce(cast(try_cast(paciente_endereco_coIbgeMunicipio as bigint) as string),
                        paciente_endereco_coIbgeMunicipio),
               coalesce(cast(try_cast(paciente_endereco_coPais as bigint) as string), paciente_endereco_coPais),
               paciente_endereco_nmMunicipio, paciente_endereco_nmPais, paciente_endereco_uf
        from feed)
    qualify row_number() over (partition by CD_MUNICIPIO_IBGE, CD_PAIS
        order by NM_MUNICIPIO is null, NM_MUNICIPIO, NM_PAIS nulls first, SG_UF nulls first) = 1
"""
MUNICIPALITY_SQL = f"select * from ({MUNICIPALITY_SQL}) where CD_PAIS is not null or NM_MUNICIPIO is not null"

PATIENT_COLUMNS_SQL = """
    select paciente_id as CD_PACIENTE, paciente_dataNascimento as DT_NASCIMENTO,
           paciente_enumSexoBiologico as SG_SEXO_BIOLOGICO, paciente_racaCor_codigo as CD_RACA_COR,
           paciente_racaCor_valor as DSC_RACA_CORD, paciente_nacionalidade_enumNacionalidade as CD_NACIONALIDADE
    from feed
"""
PATIENT_TIES = """
    paciente_dataNascimento nulls first, paciente_enumSexoBiologico nulls first, paciente_racaCor_codigo nulls first,
    paciente_racaCor_valor nulls first, paciente_nacionalidade_enumNacionalidade nulls first
"""
PATIENT_SQL = f"""{PATIENT_COLUMNS_SQL}
    qualify row_number() over (partition by paciente_id
        order by vacina_dataAplicacao desc nulls last, {PATIENT_TIES}) = 1
"""
PATIENT_BY_RACE_SQL = f"""{PATIENT_COLUMNS_SQL}
    qualify row_number() over (partition by paciente_id, paciente_racaCor_codigo order by {PATIENT_TIES}) = 1
"""

VACCINE_SQL = """
    select vacina_codigo as CD_VACINA, vacina_lote as DSC_LOTE, vacina_fabricante_nome as NM_FABRICANTE,
           vacina_nome as NM_VACINA
    from feed
    qualify row_number() over (partition by vacina_codigo, vacina_lote
        order by vacina_fabricante_nome nulls first, vacina_nome nulls first) = 1
"""


@query(FEED_SQL + CAMPAIGN_SQL)
def dim_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.campaigns(wide_feed(spark, sf_dir)).drop(CAMPAIGNS.surrogate)


@query(FEED_SQL + ESTABLISHMENT_SQL)
def dim_establishment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.establishments(wide_feed(spark, sf_dir, "establishment")).drop(ESTABLISHMENTS.surrogate)


@query(FEED_SQL + MUNICIPALITY_SQL)
def dim_municipality(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = wide_feed(spark, sf_dir, "patient", "establishment")
    return dims.municipalities(feed).drop(MUNICIPALITIES.surrogate)


@query(FEED_SQL + PATIENT_SQL)
def dim_patient_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.patients(wide_feed(spark, sf_dir)).drop(PATIENTS.surrogate)


@query(FEED_SQL + PATIENT_BY_RACE_SQL)
def dim_patient_by_race(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.patients_by_race(wide_feed(spark, sf_dir)).drop(PATIENTS.surrogate)


@query(FEED_SQL + VACCINE_SQL)
def dim_vaccine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.vaccines(wide_feed(spark, sf_dir, "vaccine")).drop(VACCINES.surrogate)
