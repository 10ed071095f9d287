"""Silver to dimensions: pure functions, one per published dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.functions.keys import surrogate_key
from starfold.functions.text import canonical_code
from starfold.operators.dedup import latest_per_key, one_per_key
from starfold.operators.project import drop_if_all_null, drop_if_any_null, pick
from starfold.schema import (
    CAMPAIGNS,
    DOSE_DATE,
    ESTABLISHMENTS,
    HOME_COUNTRY_CODE,
    HOME_COUNTRY_NAME,
    MUNICIPALITIES,
    PATIENTS,
    VACCINES,
    Dimension,
)


def keyed(rows: DataFrame, dim: Dimension, keys: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    return rows.withColumn(dim.surrogate, surrogate_key(keys or list(dim.keys), null_safe))


def campaigns(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    """One row per group, category and dose text that has a group name."""
    rows = drop_if_any_null(pick(silver, CAMPAIGNS.columns), ["NM_GRUPO_ATENDIMENTO"])
    return keyed(one_per_key(rows, list(CAMPAIGNS.keys), few=True), CAMPAIGNS, null_safe=null_safe)


def establishments(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    rows = one_per_key(pick(silver, ESTABLISHMENTS.columns), list(ESTABLISHMENTS.keys), few=True)
    return keyed(rows, ESTABLISHMENTS, null_safe=null_safe)


def municipalities(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    """Establishment and patient addresses together, codes in one spelling.

    Rows with a name win over rows without, so dropping the rows that have
    neither country nor name can happen before the shuffle. Few addresses repeat
    many times: each role is made distinct as it is, and only then respelled.
    """
    establishment_role = silver.select(
        F.col("estabelecimento_municipio_codigo").cast("string").alias("CD_MUNICIPIO_IBGE"),
        F.lit(str(HOME_COUNTRY_CODE)).alias("CD_PAIS"),
        F.col("estabelecimento_municipio_nome").alias("NM_MUNICIPIO"),
        F.lit(HOME_COUNTRY_NAME).alias("NM_PAIS"),
        F.col("estabelecimento_uf").alias("SG_UF"),
    )
    patient_role = drop_if_all_null(pick(silver, MUNICIPALITIES.columns), ["CD_PAIS", "NM_MUNICIPIO"])
    rows = establishment_role.distinct().unionByName(patient_role.distinct())
    rows = rows.withColumns({code: canonical_code(F.col(code)) for code in MUNICIPALITIES.keys})
    rows = one_per_key(rows, list(MUNICIPALITIES.keys), filled=["NM_MUNICIPIO"])
    return keyed(rows, MUNICIPALITIES, null_safe=null_safe)


# Date of the dose that a stored patient is described by; not published.
LAST_DOSE = "last_dose"


def patients_with_dose(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    """Each patient as described by the latest dose, and when that was."""
    rows = pick(silver, {**PATIENTS.columns, LAST_DOSE: DOSE_DATE})
    return keyed(latest_per_key(rows, list(PATIENTS.keys), LAST_DOSE), PATIENTS, null_safe=null_safe)


def patients(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    """Each patient as described by the latest dose."""
    return patients_with_dose(silver, null_safe).drop(LAST_DOSE)


def patients_by_race(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    """One row per patient and race code."""
    keys = [*PATIENTS.keys, "CD_RACA_COR"]
    return keyed(one_per_key(pick(silver, PATIENTS.columns), keys), PATIENTS, keys, null_safe)


def vaccines(silver: DataFrame, null_safe: bool = False) -> DataFrame:
    rows = one_per_key(pick(silver, VACCINES.columns), list(VACCINES.keys), few=True)
    return keyed(rows, VACCINES, null_safe=null_safe)


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    CAMPAIGNS.name: campaigns,
    ESTABLISHMENTS.name: establishments,
    MUNICIPALITIES.name: municipalities,
    PATIENTS.name: patients,
    VACCINES.name: vaccines,
}
