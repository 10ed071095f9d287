from datetime import date
from functools import partial

import pytest

from minifeed import CASES, row, write_csv, write_page
from pyspark.sql import functions as F
from pyspark.sql import types as T
from starfold.paths import LakePaths, dated, dated_range, days_between
from starfold.plans.silver import load_csv, load_csv_by_dose_date, load_hits, silver_from_csv, silver_from_hits
from starfold.schema import DOSE_DATE, FEED, HIT
from starfold.sources.feed import read_feed_csv, read_hits_json, read_silver, read_untyped, with_day
from starfold.sources.feed import read_silver as read_days
from starfold.sources.sinks import jdbc_options, publish, warehouse_options, write_day, write_partitioned


@pytest.fixture(scope="module")
def by_csv(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    write_csv(list(CASES.values()), folder)
    return {r.document_id: r for r in silver_from_csv(read_feed_csv(spark, str(folder))).collect()}


@pytest.fixture(scope="module")
def by_json(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("json")
    write_page(list(CASES.values()), folder)
    return {r.document_id: r for r in silver_from_hits(read_hits_json(spark, str(folder))).collect()}


def test_both_doors_give_the_same_rows(by_csv, by_json):
    assert len(by_csv) == len(CASES)
    assert by_csv == by_json


def test_silver_types(spark, tmp_path):
    write_page(list(CASES.values()), tmp_path)
    types = {f.name: f.dataType.typeName() for f in silver_from_hits(read_hits_json(spark, str(tmp_path))).schema}
    assert list(types) == FEED.names
    assert types[DOSE_DATE] == "date" and types["vacina_codigo"] == "integer"


def test_cleaned_values(by_csv):
    spaces, accents, tokens = by_csv["c01"], by_csv["c02"], by_csv["c03"]
    assert spaces.vacina_nome == "Vacina"
    assert spaces.sistema_origem == "\tSI\t" and spaces.vacina_fabricante_referencia == " r "
    assert accents.estabelecimento_razaoSocial == "Sao Joao"
    assert accents.estalecimento_noFantasia == "Bebê à ñ Acao s"
    assert tokens.paciente_endereco_nmPais is None and tokens.paciente_endereco_uf is None
    assert tokens.paciente_endereco_cep is None and tokens.vacina_categoria_nome is None
    assert tokens.sistema_origem == "none"
    assert by_csv["c04"].vacina_lote == "AB-12C"
    assert by_csv["c11"].paciente_idade is None and by_csv["c12"].paciente_dataNascimento is None


def test_dose_dates(by_csv):
    days = {k: by_csv[k][DOSE_DATE] for k in ("c05", "c06", "c07", "c08", "c09", "c10")}
    assert list(days.values()) == [date(2021, 5, 6), date(2021, 5, 7), date(2021, 5, 8), None, None, None]


def test_full_fold_maps_the_rest(spark, tmp_path):
    write_csv([CASES["accents"]], tmp_path)
    folded = silver_from_csv(read_feed_csv(spark, str(tmp_path)), fold="full").first()
    assert folded.estalecimento_noFantasia == "Bebe a n Acao s"


def test_multi_line_pages(spark, tmp_path, by_json):
    write_page(list(CASES.values()), tmp_path, indent=2)
    rows = silver_from_hits(read_hits_json(spark, str(tmp_path), multi_line=True)).collect()
    assert {r.document_id: r for r in rows} == by_json


def test_untyped_hits_keep_their_text(spark, tmp_path):
    write_page([CASES["date stamp"], CASES["lot"]], tmp_path)
    rows = {r.document_id: r for r in silver_from_hits(read_hits_json(spark, str(tmp_path)), conformed=False).collect()}
    assert rows["c06"][DOSE_DATE] == "2021-05-07T00:00:00.000Z" and rows["c06"].paciente_idade == "30"
    assert rows["c04"].vacina_lote == "AB-12C"


def test_inferred_schemas(spark, tmp_path):
    write_csv([row("1"), row("2")], tmp_path / "csv")
    write_page([row("1"), row("2")], tmp_path / "json")
    inferred = read_feed_csv(spark, str(tmp_path / "csv"), schema=None)
    assert inferred.schema["vacina_codigo"].dataType.typeName() == "integer"
    hits = read_hits_json(spark, str(tmp_path / "json"), schema=None)
    assert hits.select("_source.vacina_codigo").schema[0].dataType.typeName() == "long"
    assert silver_from_hits(hits).schema == silver_from_hits(read_hits_json(spark, str(tmp_path / "json"))).schema


def test_json_schema_reads_numbers_and_texts(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"_source": {"vacina_codigo": 86}}, {"_source": {"vacina_codigo": "86"}}]')
    codes = [r[0] for r in read_hits_json(spark, str(tmp_path), schema=HIT).select("_source.vacina_codigo").collect()]
    assert codes == ["86", "86"]


def test_day_folders(spark, tmp_path):
    base = f"{tmp_path}/silver"
    for day in ("2021-05-06", "2021-05-07", "2021-06-01"):
        write_day(spark.createDataFrame([(day,)], ["day"]), base, day)
    write_day(spark.createDataFrame([("2021-05-06",)], ["day"]), base, "2021-05-06")

    def days(frame):
        return sorted(r.day for r in frame.collect())

    read_silver = partial(read_days, schema=T.StructType([T.StructField("day", T.StringType())]))
    assert days(read_silver(spark, base)) == ["2021-05-06", "2021-05-07", "2021-06-01"]
    assert days(read_silver(spark, base, "2021-05-07")) == ["2021-05-07"]
    assert days(read_silver(spark, base, "2021-05-07", "2021-06-02")) == ["2021-05-07", "2021-06-01"]
    write_day(spark.createDataFrame([("again",)], ["day"]), base, "2021-05-07", mode="append")
    assert days(read_silver(spark, base, date(2021, 5, 7))) == ["2021-05-07", "again"]


def test_paths():
    assert dated("b", "*") == "b/*/*/*" and dated("b", "2021-05-06") == "b/2021/05/06"
    assert dated_range("b", "2021-05-31", "2021-06-02") == "b/{2021/05/31,2021/06/01}"
    assert days_between("2021-05-06", "2021-05-06") == []


def test_csv_jobs(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_csv(list(CASES.values()), tmp_path / "bronze/vacinacao/csv")
    load_csv(spark, paths, "2021-06-01")
    load_csv_by_dose_date(spark, paths)
    run_dated, dose_dated = read_silver(spark, paths.silver, "2021-06-01"), spark.read.parquet(paths.trusted)
    assert sorted(map(str, run_dated.collect())) == sorted(map(str, dose_dated.select(run_dated.columns).collect()))
    scan = dose_dated.filter(F.col(DOSE_DATE) == "2021-05-07")
    assert "PartitionFilters: [isnotnull(vacina_dataAplicacao" in scan._jdf.queryExecution().toString()


def test_hits_job_replaces_or_appends(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page(list(CASES.values()), tmp_path / "bronze/vacinacao/json/2021/06/01")
    for _ in range(2):
        load_hits(spark, paths, "2021-06-01")
    assert read_silver(spark, paths.silver).count() == len(CASES)
    load_hits(spark, paths, "2021-06-01", mode="append")
    assert read_silver(spark, paths.silver).count() == 2 * len(CASES)


def test_partitioned_write_keeps_few_files_per_value(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 8).select("id", (F.col("id") % 4).alias("v"))
    write_partitioned(rows, str(tmp_path / "p"), "v")
    files = list((tmp_path / "p").rglob("*.parquet"))
    assert len(files) <= 8
    assert spark.read.parquet(str(tmp_path / "p")).count() == 4000


def test_publish_passes_options_through(spark, tmp_path):
    publish(spark.range(3).toDF("id"), "csv", {"path": str(tmp_path / "out"), "header": "true"})
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3


def test_connector_options():
    options = jdbc_options("jdbc:postgresql://host/db", "dm_vacinas", "org.postgresql.Driver", "u", "p")
    assert options["dbtable"] == "dm_vacinas" and options["user"] == "u" and options["numPartitions"] == "16"
    assert "user" not in jdbc_options("jdbc:x", "t", "d")
    assert warehouse_options("ds.t", "bucket") == {"table": "ds.t", "temporaryGcsBucket": "bucket"}
