"""Silver and dimensions to the fact table."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starfold.functions.keys import surrogate_key
from starfold.functions.text import canonical_code
from starfold.operators.dedup import one_per_key
from starfold.operators.lookup import derive, lookup
from starfold.operators.project import pick
from starfold.schema import (
    CAMPAIGNS,
    DOSE_DATE,
    ESTABLISHMENTS,
    FACT_DATE,
    FACT_ID,
    FACT_SURROGATE,
    HOME_COUNTRY_CODE,
    MUNICIPALITIES,
    PATIENTS,
    VACCINES,
    Dimension,
)


@dataclass(frozen=True)
class Role:
    """A foreign key of the fact: which dimension, found by which fact columns."""

    dim: Dimension
    on: dict[str, str]
    column: str
    large: bool = False


def same_names(dim: Dimension) -> dict[str, str]:
    return {key: key for key in dim.keys}


ROLES = (
    Role(PATIENTS, same_names(PATIENTS), PATIENTS.surrogate, large=True),
    Role(VACCINES, same_names(VACCINES), VACCINES.surrogate, large=True),
    Role(CAMPAIGNS, same_names(CAMPAIGNS), CAMPAIGNS.surrogate),
    Role(ESTABLISHMENTS, same_names(ESTABLISHMENTS), ESTABLISHMENTS.surrogate),
    Role(
        MUNICIPALITIES,
        {f"{key}_PACIENTE": key for key in MUNICIPALITIES.keys},
        f"{MUNICIPALITIES.surrogate}_PACIENTE",
    ),
    Role(
        MUNICIPALITIES,
        {f"{key}_ESTABELECIMENTO": key for key in MUNICIPALITIES.keys},
        f"{MUNICIPALITIES.surrogate}_ESTABELECIMENTO",
    ),
)

# Dimensions that keep every key without a null part. A fact built from silver
# those dimensions were just loaded from can derive these keys instead of joining.
COMPLETE = (PATIENTS.name, VACCINES.name, ESTABLISHMENTS.name, MUNICIPALITIES.name)

FACT_COLUMNS = (FACT_ID, FACT_DATE, *(role.column for role in ROLES), FACT_SURROGATE)
FACT_SCHEMA = T.StructType(
    [
        T.StructField(FACT_ID, T.StringType()),
        T.StructField(FACT_DATE, T.DateType()),
        *(T.StructField(name, T.LongType()) for name in FACT_COLUMNS[2:]),
    ]
)


def fact_rows(silver: DataFrame, first_by: str | None = None, per_first: bool = False) -> DataFrame:
    """One row per dose with its natural keys, before any lookup.

    Duplicates go first: the dimensions are unique per key, so the lookups
    neither add nor remove rows and fewer, narrower rows reach them. The dose
    date leads the choice among duplicates; ``first_by`` names a silver column
    that leads before it and stays in the rows; with ``per_first`` there is one
    row per dose and value of it.
    """
    rows = pick(
        silver,
        {
            **({first_by: first_by} if first_by else {}),
            FACT_ID: "document_id",
            FACT_DATE: DOSE_DATE,
            **PATIENTS.keys,
            **VACCINES.keys,
            **CAMPAIGNS.keys,
            **ESTABLISHMENTS.keys,
            **{f"{key}_PACIENTE": feed for key, feed in MUNICIPALITIES.keys.items()},
            "CD_MUNICIPIO_IBGE_ESTABELECIMENTO": "estabelecimento_municipio_codigo",
        },
    )
    codes = ("CD_MUNICIPIO_IBGE_PACIENTE", "CD_PAIS_PACIENTE", "CD_MUNICIPIO_IBGE_ESTABELECIMENTO")
    rows = rows.withColumns({code: canonical_code(F.col(code)) for code in codes})
    lead = [first_by, FACT_DATE] if first_by else [FACT_DATE]
    keys = [FACT_ID]
    if per_first:
        keys, lead = [FACT_ID, first_by], [FACT_DATE]
    return one_per_key(rows, keys, lead=lead).withColumn(
        "CD_PAIS_ESTABELECIMENTO", F.lit(str(HOME_COUNTRY_CODE))
    )


def with_keys(
    rows: DataFrame,
    dims: Mapping[str, DataFrame],
    complete: Collection[str] = (),
    null_safe: bool = False,
    patients_unique: bool = True,
    roles: Collection[Role] = ROLES,
) -> DataFrame:
    """Add every foreign key, or those of ``roles``; ``complete`` names the dimensions whose keys are derived."""
    for role in roles:
        if role.dim.name in complete:
            rows = derive(rows, list(role.on), role.column, null_safe)
            continue
        rows = lookup(
            rows,
            dims[role.dim.name],
            role.on,
            role.dim.surrogate,
            role=role.column,
            null_safe=null_safe,
            unique=patients_unique or role.dim is not PATIENTS,
            spread=FACT_ID if role.large else None,
        )
    return rows


def keyed_fact(
    rows: DataFrame,
    dims: Mapping[str, DataFrame],
    complete: Collection[str] = (),
    null_safe: bool = False,
    patients_unique: bool = True,
    keep: Collection[str] = (),
) -> DataFrame:
    """Fact rows with natural keys to published fact rows, and the columns to ``keep`` beside them.

    ``patients_unique=False`` is for the patient dimension kept per race code:
    it is reduced to one row per patient before the lookup.
    """
    keyed = with_keys(rows, dims, complete, null_safe, patients_unique)
    return keyed.withColumn(FACT_SURROGATE, fact_surrogate()).select(*FACT_COLUMNS, *keep)


def fact_surrogate() -> Column:
    """The fact's own key, a hash of the dose id."""
    return surrogate_key([FACT_ID])


def build_fact(silver: DataFrame, dims: Mapping[str, DataFrame], **options) -> DataFrame:
    """The fact of a silver DataFrame; options as in ``keyed_fact``."""
    return keyed_fact(fact_rows(silver), dims, **options)
