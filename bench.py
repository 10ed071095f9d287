"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. Each query runs to the end of its
plan without collecting rows; the better of two runs counts. Landing files, silver and stored dimensions that a step starts
from are laid down once, before the clock starts.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starfold.paths import LakePaths
from starfold.plans import pipeline
from starfold.plans.fact import COMPLETE, build_fact, fact_rows, keyed_fact
from starfold.plans.silver import silver_from_csv, silver_from_hits
from starfold.queries import QUERIES
from starfold.queries.doors import dirty_feed, write_csv, write_hits
from starfold.queries.facts import stored_star
from starfold.session import build_session, scratch_dir
from starfold.sources.feed import read_feed_csv, read_hits_json
from starfold.sources.tables import SnapshotTable

QUERY_NAMES = (
    "clean_text_fold",
    "dedup_fact_id",
    "latest_row_per_key",
    "dim_campaign",
    "dim_establishment",
    "dim_municipality",
    "dim_patient_latest",
    "dim_patient_by_race",
    "dim_vaccine",
    "lookup_left_one",
    "lookup_role_playing",
    "upsert_dimension",
)


def finished(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def staged(spark: SparkSession, sf_dir: str, tasks: int) -> dict[str, Callable[[], None]]:
    """Steps of the loads, each from files that are there already."""
    root = scratch_dir(spark, "bench")
    feed = dirty_feed(spark, sf_dir).repartition(tasks)
    paths = LakePaths(f"{root}/lake")
    write_csv(feed, paths.landing_csv)
    write_hits(feed, f"{root}/hits")
    silver, tables = stored_star(spark, sf_dir, "bench-star")
    history = SnapshotTable(spark, f"{root}/fact")
    history.load_batch(build_fact(silver.filter("vacina_dataAplicacao < '1998-01-01'"), tables, complete=COMPLETE), "2024-01-01")

    def append() -> None:
        day = fact_rows(silver.filter("vacina_dataAplicacao >= '1997-07-01' and vacina_dataAplicacao < '1998-07-01'"))
        rows = pipeline.new_doses(history, day, ["2024-01-02"])
        history.load_batch(keyed_fact(rows, tables, COMPLETE), "2024-01-02")

    runs = iter(range(100))

    def bulk() -> None:
        lake = LakePaths(f"{root}/bulk-{next(runs)}")
        linked(paths.landing_csv, lake.landing_csv)
        pipeline.run_bulk(spark, lake, "2024-01-31")

    return {
        "csv_to_silver": lambda: finished(silver_from_csv(read_feed_csv(spark, paths.landing_csv))),
        "json_to_silver": lambda: finished(silver_from_hits(read_hits_json(spark, f"{root}/hits"))),
        "fact_build": lambda: finished(build_fact(silver, tables)),
        "fact_build_derived": lambda: finished(build_fact(silver, tables, complete=COMPLETE)),
        "fact_daily_append": append,
        "pipeline_bulk": bulk,
    }


def linked(source: str, target: str) -> None:
    """The landing files of one lake in another one, without writing them again."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    os.symlink(source.removeprefix("file:"), target)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    steps = {name: lambda query=QUERIES[name]: finished(query(spark, sf_dir)) for name in QUERY_NAMES}
    steps |= staged(spark, sf_dir, int(cpus))
    seconds = {}
    for name, step in steps.items():
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            step()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
