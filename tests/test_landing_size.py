"""Landed files take a tenth of their texts and stay short enough to be shared by tasks; wide cleaning stays compiled."""

import gzip
import re

from minifeed import CASES, row
from pyspark.sql import functions as F

from starfold.operators.clean import clean
from starfold.plans.silver import silver_from_hits
from starfold.queries import doors
from starfold.schema import FEED
from starfold.sources.feed import read_hits_json


def dirty(spark, ids):
    rows = [tuple(row(n)[name] for name in FEED.names) for n in ids]
    return spark.createDataFrame(rows, ", ".join(f"`{name}` string" for name in FEED.names))


def landed(folder):
    return sorted(folder.rglob("part-*"))


def test_landed_hits_are_compressed_and_files_are_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(doors, "LINES_A_FILE", 4, raising=False)
    doors.write_hits(dirty(spark, map(str, range(10))).coalesce(1), str(tmp_path / "hits"))
    files = landed(tmp_path / "hits")
    assert len(files) == 3 and all(f.name.endswith(".gz") for f in files)
    assert sorted(len(gzip.open(f).readlines()) for f in files) == [2, 4, 4]
    assert silver_from_hits(read_hits_json(spark, str(tmp_path / "hits"))).count() == 10


def test_compressed_pages_are_read_whole(spark, tmp_path):
    rows = doors.hits(dirty(spark, [f"{n}-1" for n in range(9)]))
    pages = rows.groupBy((F.substring_index("document_id", "-", 1).cast("int") % 3).alias("page"))
    doors.write_landed(
        pages.agg(F.to_json(F.collect_list("hit"), {"pretty": "true"}).alias("value")), str(tmp_path / "pages"), by="page"
    )
    assert len(landed(tmp_path / "pages")) == 3 and all(f.name.endswith(".gz") for f in landed(tmp_path / "pages"))
    assert silver_from_hits(read_hits_json(spark, f"{tmp_path}/pages/*", multi_line=True)).count() == 9


def test_wide_cleaning_has_no_method_that_the_jvm_leaves_uncompiled(spark, tmp_path, capsys):
    rows = [tuple(r[n] for n in FEED.names) for r in CASES.values()]
    spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in FEED.names)).write.parquet(str(tmp_path / "feed"))
    clean(spark.read.parquet(str(tmp_path / "feed"))).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
