"""Gold tables, doors and publishing where things go wrong, come twice, or come late."""

import logging

import pytest
from minifeed import row, silver, write_csv, write_page
from pyspark.sql import functions as F

from starfold.operators.lookup import lookup
from starfold.operators.merge import merge_frames
from starfold.paths import LakePaths, dated
from starfold.plans import dimensions as dims
from starfold.plans import pipeline, serving
from starfold.plans.silver import load_csv, load_hits
from starfold.schema import DIMENSIONS, FACT, MUNICIPALITIES, SILVER
from starfold.sources.feed import read_silver, read_trusted, read_untyped
from starfold.sources.sinks import write_day
from starfold.sources.tables import LOAD_DATE, SnapshotTable, gold_table, only_unknown
from starfold.streaming.landing import load_new_landings

JSON = "bronze/vacinacao/json"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def by_date(table):
    return {str(r[LOAD_DATE]): r["count"] for r in table.read().groupBy(LOAD_DATE).count().collect()}


def test_tables_do_not_need_success_files(spark, tmp_path):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        table = SnapshotTable(spark, str(tmp_path / "t"))
        table.upsert(spark.range(5).withColumn("v", F.lit("old")), ["id"])
        table.upsert(spark.range(2).withColumn("v", F.lit("new")), ["id"])
        assert rows_of(table.read()) == [(0, "new"), (1, "new"), (2, "old"), (3, "old"), (4, "old")]
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_batches_are_replaced_appended_and_emptied(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.load_batch(spark.range(5), "2021-06-01")
    table.append_batch(spark.range(2), "2021-06-01")
    table.load_batch(spark.range(3), "2021-06-02")
    assert by_date(table) == {"2021-06-01": 7, "2021-06-02": 3}
    table.load_batch(spark.range(0), "2021-06-01")
    assert by_date(table) == {"2021-06-02": 3}
    table.append_batch(spark.range(4), "2021-06-01")
    assert by_date(table) == {"2021-06-01": 4, "2021-06-02": 3}
    table.drop_old_snapshots(keep=1)
    assert by_date(table) == {"2021-06-01": 4, "2021-06-02": 3}
    table.replace_with_batch(spark.range(1), "2021-06-03")
    assert by_date(table) == {"2021-06-03": 1}


def test_an_unfinished_batch_is_not_seen(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.load_batch(spark.range(2), "2021-06-01")
    left = tmp_path / "t/snapshot-00000001/load_date=2021-06-01/version=00000002r"
    left.mkdir()
    (left / "part-0.parquet").write_text("half written")
    assert by_date(table) == {"2021-06-01": 2}
    table.load_batch(spark.range(3), "2021-06-01")
    assert by_date(table) == {"2021-06-01": 3}


def test_one_job_loads_several_dates(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.load_batch(spark.range(9), "2021-06-02")
    days = spark.range(4).withColumn(LOAD_DATE, F.expr("date_add(date'2021-06-01', cast(id % 2 as int) * 2)"))
    table.load_batches(days, ["2021-06-01", "2021-06-02", "2021-06-03"])
    assert by_date(table) == {"2021-06-01": 2, "2021-06-03": 2}


def test_the_form_of_a_table_is_kept(spark, tmp_path):
    with pytest.raises(ValueError):
        gold_table(spark, str(tmp_path / "new"), form="other")
    gold_table(spark, str(tmp_path / "snapshots")).replace(spark.range(1))
    with pytest.raises(ValueError):
        gold_table(spark, str(tmp_path / "snapshots"), form="delta")
    (tmp_path / "delta/_delta_log").mkdir(parents=True)
    with pytest.raises(ValueError):
        gold_table(spark, str(tmp_path / "delta"))


def test_merges_tell_nulls_apart_and_keep_the_newer(spark):
    schema = "a string, b string, day int, v string"
    old = spark.createDataFrame([("5", None, 3, "old"), (None, None, 9, "old"), ("x", "y", None, "old")], schema)
    new = spark.createDataFrame([(None, "5", 1, "new"), (None, None, 2, "new"), ("x", "y", 1, "new"), ("5", None, None, "new")], schema)
    want = [("5", None, 3, "old"), (None, "5", 1, "new"), (None, None, 9, "old"), ("x", "y", 1, "new")]
    merged = merge_frames(old, new, ["a", "b"], "day")
    assert rows_of(merged) == sorted(want, key=str)
    assert rows_of(merge_frames(merged, new, ["a", "b"], "day")) == sorted(want, key=str)
    assert rows_of(merge_frames(new, old, ["a", "b"], "day")) == sorted(want, key=str)


def test_hashed_known_keys(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    hashed = ("h", F.xxhash64("id"))
    batch = spark.range(3, 8)
    assert only_unknown(table, batch, ["id"], hashed=hashed).count() == 5
    table.load_batch(spark.range(5).withColumn("h", F.xxhash64("id")), "2021-06-01")
    assert rows_of(only_unknown(table, batch, ["id"], hashed=hashed)) == [(5,), (6,), (7,)]
    assert only_unknown(table, batch, ["id"], ["2021-06-01"], hashed).count() == 5
    # Another key with the hash of a stored one is still new.
    clash = spark.range(20, 21).withColumn("other", F.lit(2))
    assert only_unknown(table, clash, ["id"], hashed=("h", F.xxhash64(F.col("other").cast("long")))).count() == 1


def test_history_is_read_by_its_short_key(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page([row("1"), row("2")], tmp_path / JSON / "2021/06/01")
    pipeline.run_day(spark, paths, "2021-06-01")
    table = pipeline.fact_table(spark, paths)
    fresh = dims.pick(silver(spark, [row("9")]), {"CD_VACINACAO": "document_id"})
    seen = []
    real = SnapshotTable.read

    def read(self):
        seen.append(real(self))
        return seen[-1]

    SnapshotTable.read = read
    try:
        assert pipeline.new_doses(table, fresh).count() == 1
    finally:
        SnapshotTable.read = real
    from starfold.operators.merge import known_among

    scan = known_among(seen[0].select("SK_FT_VACINACAO"), fresh.select(F.xxhash64("CD_VACINACAO").alias("SK_FT_VACINACAO")), ["SK_FT_VACINACAO"])
    plan = scan._jdf.queryExecution().toString()
    assert "ReadSchema: struct<SK_FT_VACINACAO:bigint>" in plan


def test_silver_of_all_doors_reads_together(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_csv([row("1")], tmp_path / "bronze/vacinacao/csv")
    load_csv(spark, paths, "2021-05-31")
    load_csv(spark, paths, "2021-05-31", infer=True)
    write_page([row("2")], tmp_path / JSON / "2021/06/01")
    load_hits(spark, paths, "2021-06-01")
    load_hits(spark, paths, "2021-06-01", conformed=False)
    write_page([row("3")], tmp_path / JSON / "2021/06/02")
    write_page([row("4")], tmp_path / JSON / "2021/06/03")
    for _ in range(2):
        load_new_landings(spark, paths, "2021-06-10", f"{tmp_path}/checkpoint").awaitTermination()
    everything = read_silver(spark, paths.silver)
    assert everything.schema == SILVER
    assert sorted({r.document_id for r in everything.collect()}) == ["1", "2", "3", "4"]
    pipeline.run_day(spark, paths, "2021-06-03")
    assert [r.document_id for r in read_silver(spark, paths.silver, "2021-06-03").collect()] == ["4"]
    # Inference takes the leading zero of a post code; all else comes back as declared.
    typed = read_silver(spark, paths.silver, "2021-05-31", "2021-06-02").distinct().drop("paciente_endereco_cep")
    assert rows_of(read_untyped(spark, paths.untyped).drop("paciente_endereco_cep")) == rows_of(typed)
    assert dims.vaccines(read_silver(spark, paths.silver)).select("SK_DM_VACINAS").distinct().count() == 1


def test_all_days_each_to_its_own(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    for day in ("01", "02", "03"):
        write_page([row(f"{day}a"), row(f"{day}b")], tmp_path / JSON / "2021/06" / day)
    for _ in range(2):
        assert load_hits(spark, paths, "*") == 0
    assert read_silver(spark, paths.silver).count() == 6
    assert read_silver(spark, paths.silver, "2021-06-02").count() == 2
    with pytest.raises(ValueError):
        write_day(spark.range(1), paths.silver, "*")


def test_broken_records_are_set_aside(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    folder = tmp_path / JSON / "2021/06/01"
    write_page([row("1"), row("2")], folder, indent=2)
    (folder / "cut.json").write_text('[{"_source": {"document_id": "3"')
    (folder / "other.json").write_text('[{"error": "none"}]')
    assert load_hits(spark, paths, "2021-06-01") == 2
    assert sorted(r.document_id for r in read_silver(spark, paths.silver).collect()) == ["1", "2"]
    assert spark.read.text(dated(paths.rejected, "2021-06-01")).count() == 2
    # A page of many lines in line mode gives no rows out of nothing.
    assert load_hits(spark, paths, "2021-06-01", multi_line=False) > 0
    assert read_silver(spark, paths.silver).filter("document_id is null").count() == 0


def test_old_day_again(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page([row("1", paciente_racaCor_codigo="1", vacina_dataAplicacao="2021-05-01")], tmp_path / JSON / "2021/06/01")
    write_page([row("2", paciente_racaCor_codigo="2", vacina_dataAplicacao="2021-05-02")], tmp_path / JSON / "2021/06/02")
    for day in ("2021-06-01", "2021-06-02", "2021-06-01"):
        pipeline.run_day(spark, paths, day)
    assert [r.CD_RACA_COR for r in pipeline.read_dimension(spark, paths, "dm_pacientes").collect()] == ["2"]


def test_patients_by_race_need_null_safe_keys(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    for day, changes in (("01", {"paciente_id": "5", "paciente_racaCor_codigo": None}), ("02", {"paciente_id": None, "paciente_racaCor_codigo": "5"})):
        write_page([row(day, **changes)], tmp_path / JSON / "2021/06" / day)
        load_hits(spark, paths, f"2021-06-{day}")
    with pytest.raises(ValueError):
        pipeline.load_dimension(spark, paths, "dm_pacientes", patient_rows=pipeline.BY_RACE)
    for day in ("2021-06-01", "2021-06-02"):
        pipeline.load_dimension(spark, paths, "dm_pacientes", day, patient_rows=pipeline.BY_RACE, null_safe=True)
    stored = pipeline.read_dimension(spark, paths, "dm_pacientes")
    assert stored.count() == stored.select("SK_DM_PACIENTES").distinct().count() == 2


def test_shared_surrogates_are_told(spark, tmp_path, caplog):
    paths = LakePaths(str(tmp_path))
    rows = silver(spark, [
        row("1", paciente_endereco_coIbgeMunicipio=None, paciente_endereco_coPais="355030", paciente_endereco_nmMunicipio="A"),
        row("2", paciente_endereco_coIbgeMunicipio="355030", paciente_endereco_coPais=None, paciente_endereco_nmMunicipio="B"),
    ])
    with caplog.at_level(logging.WARNING):
        pipeline.load_dimension(spark, paths, MUNICIPALITIES.name, silver=rows)
    assert "share" in caplog.text
    assert pipeline.read_dimension(spark, paths, MUNICIPALITIES.name).count() == 3


def test_backfill_merges_once_and_keeps_load_dates(spark, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path))
    write_page([row("1"), row("2")], tmp_path / JSON / "2021/06/01")
    write_page([], tmp_path / JSON / "2021/06/02")
    write_page([row("2"), row("3")], tmp_path / JSON / "2021/06/03")
    merges = []
    real = SnapshotTable.upsert
    monkeypatch.setattr(SnapshotTable, "upsert", lambda self, *args: merges.append(self.path) or real(self, *args))
    for times in (1, 2):
        pipeline.backfill(spark, paths, "2021-06-01", "2021-06-05")
        assert len(merges) == times * len(DIMENSIONS)
        assert by_date(pipeline.fact_table(spark, paths)) == {"2021-06-01": 2, "2021-06-03": 1}
    pipeline.run_day(spark, paths, "2021-06-03")
    assert by_date(pipeline.fact_table(spark, paths)) == {"2021-06-01": 2, "2021-06-03": 1}


def test_publishing_again_adds_nothing(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page([row("1"), row("2")], tmp_path / JSON / "2021/06/01")
    write_page([row("3")], tmp_path / JSON / "2021/06/02")
    pipeline.backfill(spark, paths, "2021-06-01", "2021-06-03")

    def publish(**options):
        serving.publish_gold(spark, paths, "parquet", lambda t: {"path": f"{tmp_path}/out/{t}"}, **options)
        return sorted(r.CD_VACINACAO for r in spark.read.parquet(f"{tmp_path}/out/{FACT}").collect())

    assert publish(fact_load_date="2021-06-01") == ["1", "2"]
    assert publish(fact_load_date="2021-06-01") == ["1", "2"]
    assert publish(fact_load_date="2021-06-02") == ["1", "2", "3"]
    assert publish() == publish() == ["1", "2", "3"]
    for options in ({"fact_mode": "append"}, {"fact_mode": "overwrite", "fact_load_date": "2021-06-01"}):
        with pytest.raises(ValueError):
            publish(**options)


def test_all_days_under_one_run_date(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page([row("1")], tmp_path / JSON / "2021/06/01")
    pipeline.run_day(spark, paths, "2021-06-01")
    with pytest.raises(ValueError):
        pipeline.load_fact(spark, paths, mode="batch")
    for _ in range(2):
        pipeline.load_fact(spark, paths, run_date="2021-06-01", mode="batch")
    assert by_date(pipeline.fact_table(spark, paths)) == {"2021-06-01": 1}


def test_star_from_doses_of_a_range(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    doses = [row(str(n), vacina_dataAplicacao=f"2021-05-0{n}") for n in range(1, 6)] + [row("9", vacina_dataAplicacao=None)]
    write_csv(doses, tmp_path / "bronze/vacinacao/csv")
    pipeline.run_bulk_trusted(spark, paths, "2021-06-01", "2021-05-02", "2021-05-04")
    assert sorted(r.CD_VACINACAO for r in pipeline.read_fact(spark, paths).collect()) == ["2", "3"]
    assert read_trusted(spark, paths.trusted).count() == 6
    plan = read_trusted(spark, paths.trusted, "2021-05-02", "2021-05-04")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(vacina_dataAplicacao" in plan


def test_null_safe_lookup_deals_nulls_out(spark):
    rows = spark.range(200).selectExpr("id", "if(id % 2 = 0, null, cast(id % 5 as string)) as k", "'a' as j")
    dim = spark.createDataFrame([(None, "a", 1), ("1", "a", 2), ("3", "a", 3), ("3", None, 4)], "k string, j string, s int")
    on = {"k": "k", "j": "j"}
    plain = lookup(rows, dim, on, "s", null_safe=True)
    dealt = lookup(rows, dim, on, "s", null_safe=True, spread="id")
    assert rows_of(dealt) == rows_of(plain) and dealt.columns == plain.columns


def test_cleaning_leaves_the_session_alone(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "65535")
    try:
        silver(spark, [row("1")]).count()
        assert spark.conf.get(key) == "65535"
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)

