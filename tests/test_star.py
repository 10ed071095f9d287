import datetime

import pytest

from minifeed import row, silver
from pyspark.sql import functions as F
from starfold.functions.keys import surrogate_key
from starfold.plans import dimensions as dims
from starfold.plans.fact import COMPLETE, FACT_COLUMNS, FACT_SCHEMA, build_fact, fact_rows
from starfold.schema import DIMENSIONS, MUNICIPALITIES


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


ROWS = [
    row("d1"),
    row("d2", paciente_racaCor_codigo="3", paciente_racaCor_valor="PARDA", vacina_dataAplicacao="2021-08-01"),
    row("d3", paciente_id="p1", vacina_dataAplicacao="2021-05-06", paciente_racaCor_codigo="4"),
    row("d4", paciente_id="p1", vacina_dataAplicacao="2021-05-06", paciente_racaCor_codigo="2"),
    row("d5", paciente_id="p2", vacina_dataAplicacao=None, paciente_racaCor_codigo="9"),
    row("d6", paciente_id="p2", vacina_dataAplicacao="2020-01-01", paciente_racaCor_codigo=None),
    row("d7", paciente_id=None),
    row("d1", vacina_dataAplicacao="2021-01-01", paciente_id="p1"),
    row("d1"),
    row("d8", vacina_grupoAtendimento_codigo=None, vacina_categoria_codigo="5", vacina_grupoAtendimento_nome="g"),
    row("d9", vacina_grupoAtendimento_codigo="7", vacina_grupoAtendimento_nome=None),
    row("d10", paciente_endereco_coIbgeMunicipio="0355030"),
    row("d11", paciente_endereco_coIbgeMunicipio="999", paciente_endereco_coPais="XX", paciente_endereco_nmMunicipio="LA"),
    row("d12", paciente_endereco_coPais=None, paciente_endereco_nmMunicipio=None),
    row("d13", paciente_endereco_coIbgeMunicipio="777", paciente_endereco_coPais=None),
    row("d14", paciente_endereco_coIbgeMunicipio="777", paciente_endereco_coPais=None, paciente_endereco_nmMunicipio=None),
    row("d15", estabelecimento_municipio_codigo="111", estabelecimento_municipio_nome="SO ESTAB"),
    row("d16", estabelecimento_valor=None),
    row("d17", estabelecimento_valor="200", estalecimento_noFantasia="B"),
    row("d18", estabelecimento_valor="200", estalecimento_noFantasia="A"),
    row("d19", vacina_lote=None),
    row("d20", vacina_codigo=None, vacina_lote="L9"),
]


@pytest.fixture(scope="module")
def feed(spark):
    return silver(spark, ROWS).cache()


@pytest.fixture(scope="module")
def star(feed):
    return {name: build(feed).cache() for name, build in dims.BUILDERS.items()}


def test_published_columns(star):
    for name, dim in DIMENSIONS.items():
        assert set(star[name].columns) == {*dim.columns, dim.surrogate}


def test_patients_keep_the_latest_dose(star):
    got = {r.CD_PACIENTE: r.CD_RACA_COR for r in star["dm_pacientes"].collect()}
    assert got == {"p0": "3", "p1": "2", "p2": None, None: "1"}


def test_patients_by_race(feed):
    got = rows_of(dims.patients_by_race(feed), "CD_PACIENTE", "CD_RACA_COR")
    assert got == sorted(
        [("p0", "1"), ("p0", "3"), ("p1", "1"), ("p1", "2"), ("p1", "4"), ("p2", "9"), ("p2", None), (None, "1")], key=str
    )


def test_campaigns_without_name_are_dropped(star):
    keys = rows_of(star["dm_campanhas"], "CD_GRUPO_ATENDIMENTO", "CD_CATEGORIA_GRUPO_ATENDIMENTO", "DSC_DOSE")
    assert keys == sorted([(2, 5, "1a Dose"), (None, 5, "1a Dose")], key=str)


def test_establishments_keep_one_row_each(star):
    assert rows_of(star["dm_estabelecimentos"], "CD_ESTABELECIMENTO", "NM_FANTASIA") == sorted(
        [(100, "UBS CENTRO"), (200, "A"), (None, "UBS CENTRO")], key=str
    )


def test_municipalities_unite_both_roles(star):
    got = rows_of(star["dm_municipios"], "CD_MUNICIPIO_IBGE", "CD_PAIS", "NM_MUNICIPIO")
    assert got == sorted(
        [
            ("355030", "10", "SAO PAULO"), ("999", "XX", "LA"), ("777", None, "SAO PAULO"), ("111", "10", "SO ESTAB"),
        ],
        key=str,
    )


def test_vaccines(star):
    assert rows_of(star["dm_vacinas"], "CD_VACINA", "DSC_LOTE") == sorted([(86, "L1"), (86, None), (None, "L9")], key=str)


def test_keys_hash_the_declared_types(spark, star):
    vaccine = star["dm_vacinas"].filter("CD_VACINA = 86 and DSC_LOTE = 'L1'").first()
    want = spark.sql("select xxhash64(cast(86 as int), 'L1')").first()[0]
    assert vaccine.SK_DM_VACINAS == want


def test_natural_and_surrogate_keys_are_unique(star):
    for name, dim in DIMENSIONS.items():
        table = star[name]
        assert table.count() == table.select(*dim.keys).distinct().count() == table.select(dim.surrogate).distinct().count()


@pytest.fixture(scope="module")
def fact(feed, star):
    return build_fact(feed, star).cache()


def test_fact_has_one_row_per_dose(fact):
    assert fact.columns == list(FACT_COLUMNS)
    assert [f.dataType for f in fact.schema] == [f.dataType for f in FACT_SCHEMA]
    ids = [r.CD_VACINACAO for r in fact.collect()]
    assert sorted(ids) == sorted({r["document_id"] for r in ROWS})


def test_fact_duplicates_keep_the_earliest_dose(fact):
    kept = fact.filter("CD_VACINACAO = 'd1'").first()
    assert kept.DT_VACINACAO == datetime.date(2021, 1, 1)


def test_fact_keys(fact, star):
    by_id = {r.CD_VACINACAO: r for r in fact.collect()}
    nulls = {i: {c for c in FACT_COLUMNS[2:] if r[c] is None} for i, r in by_id.items()}
    assert nulls["d2"] == set() and nulls["d11"] == set() and nulls["d15"] == set()
    assert nulls["d7"] == {"SK_DM_PACIENTES"}
    assert nulls["d8"] == nulls["d9"] == {"SK_DM_CAMPANHAS"}
    assert nulls["d12"] == nulls["d13"] == {"SK_DM_MUNICIPIOS_PACIENTE"}
    assert nulls["d16"] == {"SK_DM_ESTABELECIMENTOS"}
    assert nulls["d19"] == nulls["d20"] == {"SK_DM_VACINAS"}
    assert by_id["d10"].SK_DM_MUNICIPIOS_PACIENTE == by_id["d2"].SK_DM_MUNICIPIOS_PACIENTE
    assert by_id["d2"].SK_DM_MUNICIPIOS_PACIENTE == by_id["d2"].SK_DM_MUNICIPIOS_ESTABELECIMENTO


def test_missing_dimension_row_gives_null_key(feed, star):
    partial = {**star, "dm_estabelecimentos": star["dm_estabelecimentos"].filter("CD_ESTABELECIMENTO <> 200")}
    got = {r.CD_VACINACAO: r.SK_DM_ESTABELECIMENTOS for r in build_fact(feed, partial).collect()}
    assert got["d17"] is None and got["d1"] is not None


def test_derived_keys_equal_looked_up_keys(feed, star, fact):
    assert rows_of(build_fact(feed, star, complete=COMPLETE)) == rows_of(fact)


def test_null_safe_fact_finds_null_parts(feed):
    safe = {name: build(feed, null_safe=True) for name, build in dims.BUILDERS.items()}
    complete = [name for name in COMPLETE if name != MUNICIPALITIES.name]
    looked_up, derived = build_fact(feed, safe, null_safe=True), build_fact(feed, safe, complete=complete, null_safe=True)
    assert rows_of(looked_up) == rows_of(derived)
    by_id = {r.CD_VACINACAO: r for r in looked_up.collect()}
    assert by_id["d7"].SK_DM_PACIENTES is not None and by_id["d8"].SK_DM_CAMPANHAS is not None
    assert by_id["d9"].SK_DM_CAMPANHAS is None


def test_patients_by_race_do_not_multiply_the_fact(feed, star):
    by_race = {**star, "dm_pacientes": dims.patients_by_race(feed, null_safe=True)}
    fact = build_fact(feed, by_race, patients_unique=False)
    assert fact.count() == fact.select("CD_VACINACAO").distinct().count()
    assert fact.filter("CD_VACINACAO = 'd2'").first().SK_DM_PACIENTES is not None


def test_fact_does_not_depend_on_partitioning(spark, feed, star):
    other = feed.repartition(13, F.rand(1))
    assert rows_of(fact_rows(other)) == rows_of(fact_rows(feed))


def test_surrogate_of_the_fact(fact):
    got = fact.withColumn("want", surrogate_key(["CD_VACINACAO"]))
    assert got.filter("SK_FT_VACINACAO <> want").count() == 0
