from minifeed import row, write_csv, write_page

from starfold.__main__ import main
from starfold.paths import LakePaths
from starfold.plans import pipeline, serving
from starfold.schema import DIMENSIONS, FACT
from starfold.sources.tables import LOAD_DATE, SnapshotTable
from starfold.streaming.landing import load_new_landings

FEED = "bronze/vacinacao"
DAY1 = [row("1", paciente_id="a"), row("2", paciente_id="b", paciente_racaCor_codigo="1"), row("3", paciente_id="c")]
DAY2 = [
    row("3", paciente_id="c"),
    row("4", paciente_id="b", paciente_racaCor_codigo="2", vacina_dataAplicacao="2021-06-01"),
    row("5", paciente_id="d", vacina_dataAplicacao="2021-06-01"),
]


def fact_ids(spark, paths):
    return sorted(r.CD_VACINACAO for r in pipeline.read_fact(spark, paths).collect())


def patients(spark, paths):
    return {r.CD_PACIENTE: r.CD_RACA_COR for r in pipeline.dimension_table(spark, paths, "dm_pacientes").read().collect()}


def test_days_and_reruns(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page(DAY1, tmp_path / FEED / "json/2021/06/01")
    write_page(DAY2, tmp_path / FEED / "json/2021/06/03")
    assert [str(d) for d in pipeline.backfill(spark, paths, "2021-05-30", "2021-06-05")] == ["2021-06-01", "2021-06-03"]
    assert fact_ids(spark, paths) == ["1", "2", "3", "4", "5"]
    assert patients(spark, paths) == {"a": "1", "b": "2", "c": "1", "d": "1"}
    before = sorted(map(str, pipeline.read_fact(spark, paths).collect()))
    pipeline.run_day(spark, paths, "2021-06-03")
    assert sorted(map(str, pipeline.read_fact(spark, paths).collect())) == before
    assert all(len(pipeline.dimension_table(spark, paths, n).snapshots()) <= 2 for n in DIMENSIONS)


def test_bulk_equals_days(spark, tmp_path):
    by_day, at_once = LakePaths(f"{tmp_path}/days"), LakePaths(f"{tmp_path}/bulk")
    write_page(DAY1, tmp_path / "days" / FEED / "json/2021/06/01")
    write_page(DAY2, tmp_path / "days" / FEED / "json/2021/06/02")
    write_csv(DAY1 + DAY2, tmp_path / "bulk" / FEED / "csv")
    pipeline.backfill(spark, by_day, "2021-06-01", "2021-06-03")
    pipeline.run_bulk(spark, at_once, "2021-06-03")
    for read in (pipeline.read_fact, lambda s, p: pipeline.dimension_table(s, p, "dm_pacientes").read()):
        assert sorted(map(str, read(spark, by_day).collect())) == sorted(map(str, read(spark, at_once).collect()))


def test_fact_modes(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page(DAY1, tmp_path / FEED / "json/2021/06/01")
    pipeline.run_day(spark, paths, "2021-06-01")
    pipeline.load_fact(spark, paths, "2021-06-01", mode="batch")
    assert fact_ids(spark, paths) == ["1", "2", "3"]
    pipeline.load_fact(spark, paths, "2021-06-01", mode="add_new")
    assert fact_ids(spark, paths) == ["1", "2", "3"]
    pipeline.load_fact(spark, paths, "2021-06-01", mode="append")
    assert fact_ids(spark, paths) == ["1", "1", "2", "2", "3", "3"]
    pipeline.load_fact(spark, paths, "2021-06-01", mode="reload")
    assert fact_ids(spark, paths) == ["1", "2", "3"]


def test_first_batch_may_be_empty(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page([], tmp_path / FEED / "json/2021/06/01")
    write_page(DAY1, tmp_path / FEED / "json/2021/06/02")
    pipeline.backfill(spark, paths, "2021-06-01", "2021-06-03")
    assert fact_ids(spark, paths) == ["1", "2", "3"]


def test_patients_by_race_pipeline(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page(DAY1 + DAY2, tmp_path / FEED / "json/2021/06/01")
    pipeline.run_day(spark, paths, "2021-06-01", patient_rows=pipeline.BY_RACE, null_safe=True)
    rows = pipeline.dimension_table(spark, paths, "dm_pacientes").read()
    assert sorted((r.CD_PACIENTE, r.CD_RACA_COR) for r in rows.collect()) == [
        ("a", "1"), ("b", "1"), ("b", "2"), ("c", "1"), ("d", "1")
    ]
    fact = pipeline.read_fact(spark, paths)
    assert fact.count() == 5 and fact.filter("SK_DM_PACIENTES is null").count() == 0


def test_unfinished_snapshot_is_ignored(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.replace(spark.range(3))
    (tmp_path / "t/snapshot-00000002").mkdir()
    (tmp_path / "t/snapshot-00000002/part-0.parquet").write_text("half written")
    assert table.read().count() == 3
    table.upsert(spark.range(2, 5), ["id"])
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2, 3, 4]
    assert table.current().endswith("snapshot-00000003")
    table.drop_old_snapshots(keep=1)
    assert table.snapshots() == ["snapshot-00000003"]


def test_load_date_rerun_touches_one_partition(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.load_batch(spark.range(2), "2021-06-01")
    table.load_batch(spark.range(5), "2021-06-02")
    table.load_batch(spark.range(1), "2021-06-02")
    counts = {str(r[LOAD_DATE]): r["count"] for r in table.read().groupBy(LOAD_DATE).count().collect()}
    assert counts == {"2021-06-01": 2, "2021-06-02": 1}


def test_publish_gold(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_page(DAY1, tmp_path / FEED / "json/2021/06/01")
    pipeline.run_day(spark, paths, "2021-06-01")
    for _ in range(2):
        serving.publish_gold(spark, paths, "parquet", lambda t: {"path": f"{tmp_path}/out/{t}"}, "2021-06-01")
    out = {t: spark.read.parquet(f"{tmp_path}/out/{t}") for t in [*DIMENSIONS, FACT]}
    assert out["dm_pacientes"].count() == 3 and out[FACT].count() == 3
    assert "last_dose" not in out["dm_pacientes"].columns
    assert LOAD_DATE not in out[FACT].columns


def test_stream_door_loads_each_landing_once(spark, tmp_path):
    paths = LakePaths(f"{tmp_path}/lake")
    landing = tmp_path / "lake" / FEED / "json/2021/06"

    def run():
        load_new_landings(spark, paths, "2021-06-10", f"{tmp_path}/checkpoint", files_per_batch=1).awaitTermination()

    write_page(DAY1, landing / "01")
    run()
    assert fact_ids(spark, paths) == ["1", "2", "3"]
    write_page(DAY2, landing / "02", "late.json")
    run()
    run()
    assert fact_ids(spark, paths) == ["1", "2", "3", "4", "5"]
    assert patients(spark, paths) == {"a": "1", "b": "2", "c": "1", "d": "1"}


def test_command_line(spark, tmp_path):
    root = ["--root", str(tmp_path)]
    write_csv(DAY1, tmp_path / FEED / "csv")
    write_page(DAY2, tmp_path / FEED / "json/2021/06/02")
    main([*root, "silver-csv", "--date", "2021-06-01"])
    main([*root, "dimension", "all", "--date", "2021-06-01"])
    main([*root, "fact", "--date", "2021-06-01"])
    main([*root, "silver-json", "--date", "2021-06-02"])
    for name in DIMENSIONS:
        main([*root, "dimension", name, "--date", "2021-06-02"])
    main([*root, "fact", "--date", "2021-06-02"])
    paths = LakePaths(str(tmp_path))
    assert fact_ids(spark, paths) == ["1", "2", "3", "4", "5"]
    assert patients(spark, paths)["b"] == "2"
    main([*root, "backfill", "--start", "2021-06-02", "--end", "2021-06-03"])
    main([*root, "bulk", "--date", "2021-06-01"])
    assert fact_ids(spark, paths) == ["1", "2", "3", "4", "5"]


def test_command_line_of_all_days_and_dose_dates(spark, tmp_path):
    root = ["--root", str(tmp_path)]
    write_page(DAY1, tmp_path / FEED / "json/2021/06/01", indent=2)
    write_page(DAY2, tmp_path / FEED / "json/2021/06/02", indent=2)
    main([*root, "silver-json", "--date", "*"])
    main([*root, "dimension", "all"])
    main([*root, "fact", "--run-date", "2021-06-05", "--mode", "batch"])
    main([*root, "fact", "--run-date", "2021-06-05", "--mode", "batch"])
    paths = LakePaths(str(tmp_path))
    assert fact_ids(spark, paths) == ["1", "2", "3", "4", "5"]
    write_csv(DAY1 + DAY2, tmp_path / FEED / "csv")
    main([*root, "bulk", "--date", "2021-06-05", "--by-dose-date", "--dose-from", "2021-06-01"])
    assert fact_ids(spark, paths) == ["4", "5"]
