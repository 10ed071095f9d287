"""Shapes of the feed and of the star schema.

Column names, types and column mappings below are fixed values: the feed and
the published tables are defined by them (misspellings included).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 32 feed columns, in file order.
FEED_FIELDS = """
    document_id STRING,
    paciente_id STRING,
    paciente_idade INT,
    paciente_dataNascimento DATE,
    paciente_enumSexoBiologico STRING,
    paciente_racaCor_codigo STRING,
    paciente_racaCor_valor STRING,
    paciente_endereco_coIbgeMunicipio STRING,
    paciente_endereco_coPais STRING,
    paciente_endereco_nmMunicipio STRING,
    paciente_endereco_nmPais STRING,
    paciente_endereco_uf STRING,
    paciente_endereco_cep STRING,
    paciente_nacionalidade_enumNacionalidade STRING,
    estabelecimento_valor INT,
    estabelecimento_razaoSocial STRING,
    estalecimento_noFantasia STRING,
    estabelecimento_municipio_codigo INT,
    estabelecimento_municipio_nome STRING,
    estabelecimento_uf STRING,
    vacina_grupoAtendimento_codigo INT,
    vacina_grupoAtendimento_nome STRING,
    vacina_categoria_codigo INT,
    vacina_categoria_nome STRING,
    vacina_lote STRING,
    vacina_fabricante_nome STRING,
    vacina_fabricante_referencia STRING,
    vacina_dataAplicacao STRING,
    vacina_descricao_dose STRING,
    vacina_codigo INT,
    vacina_nome STRING,
    sistema_origem STRING
"""

TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "DATE": T.DateType()}
FEED = T.StructType(
    [T.StructField(name, TYPES[kind]) for name, kind in (f.split() for f in FEED_FIELDS.split(","))]
)
DOSE_DATE = "vacina_dataAplicacao"
LOT = "vacina_lote"

# A search hit as landed: every member is read as text, so that a number and a
# quoted number both arrive intact; conforming to FEED is a later, explicit step.
HIT = T.StructType(
    [
        T.StructField("_source", T.StructType([T.StructField(f.name, T.StringType()) for f in FEED])),
        T.StructField("sort", T.ArrayType(T.StringType())),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
CORRUPT = "_corrupt_record"

# Silver as stored: the feed with its dose date read.
SILVER = T.StructType([T.StructField(f.name, T.DateType() if f.name == DOSE_DATE else f.dataType) for f in FEED])

# The country of every establishment.
HOME_COUNTRY_CODE = 10
HOME_COUNTRY_NAME = "BRASIL"


@dataclass(frozen=True)
class Dimension:
    """Natural key, attributes (published name -> feed name) and surrogate key name."""

    name: str
    keys: dict[str, str]
    attributes: dict[str, str]
    surrogate: str

    @property
    def columns(self) -> dict[str, str]:
        return {**self.keys, **self.attributes}


# Published dimensions.
CAMPAIGNS = Dimension(
    "dm_campanhas",
    {
        "CD_GRUPO_ATENDIMENTO": "vacina_grupoAtendimento_codigo",
        "CD_CATEGORIA_GRUPO_ATENDIMENTO": "vacina_categoria_codigo",
        "DSC_DOSE": "vacina_descricao_dose",
    },
    {
        "NM_GRUPO_ATENDIMENTO": "vacina_grupoAtendimento_nome",
        "NM_CATEGORIA_GRUPO_ATENDIMENTO": "vacina_categoria_nome",
    },
    "SK_DM_CAMPANHAS",
)
ESTABLISHMENTS = Dimension(
    "dm_estabelecimentos",
    {"CD_ESTABELECIMENTO": "estabelecimento_valor"},
    {"DSC_RAZAO_SOCIAL": "estabelecimento_razaoSocial", "NM_FANTASIA": "estalecimento_noFantasia"},
    "SK_DM_ESTABELECIMENTOS",
)
# The patient role of a municipality; the establishment role has a constant country.
MUNICIPALITIES = Dimension(
    "dm_municipios",
    {
        "CD_MUNICIPIO_IBGE": "paciente_endereco_coIbgeMunicipio",
        "CD_PAIS": "paciente_endereco_coPais",
    },
    {
        "NM_MUNICIPIO": "paciente_endereco_nmMunicipio",
        "NM_PAIS": "paciente_endereco_nmPais",
        "SG_UF": "paciente_endereco_uf",
    },
    "SK_DM_MUNICIPIOS",
)
PATIENTS = Dimension(
    "dm_pacientes",
    {"CD_PACIENTE": "paciente_id"},
    {
        "DT_NASCIMENTO": "paciente_dataNascimento",
        "SG_SEXO_BIOLOGICO": "paciente_enumSexoBiologico",
        "CD_RACA_COR": "paciente_racaCor_codigo",
        "DSC_RACA_CORD": "paciente_racaCor_valor",
        "CD_NACIONALIDADE": "paciente_nacionalidade_enumNacionalidade",
    },
    "SK_DM_PACIENTES",
)
VACCINES = Dimension(
    "dm_vacinas",
    {"CD_VACINA": "vacina_codigo", "DSC_LOTE": "vacina_lote"},
    {"NM_FABRICANTE": "vacina_fabricante_nome", "NM_VACINA": "vacina_nome"},
    "SK_DM_VACINAS",
)
DIMENSIONS = {d.name: d for d in (CAMPAIGNS, ESTABLISHMENTS, MUNICIPALITIES, PATIENTS, VACCINES)}

FACT = "ft_vacinacao"
FACT_ID = "CD_VACINACAO"
FACT_DATE = "DT_VACINACAO"
FACT_SURROGATE = "SK_FT_VACINACAO"
