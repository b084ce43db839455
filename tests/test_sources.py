import json

import pytest

from bazaarline.functions.staging import stage, work_dir
from bazaarline.plans import tables
from bazaarline.settings import Settings
from bazaarline.sources import dimensions, readers, sinks
from bazaarline.sources.validate import validate_table
from conftest import SMALL


def test_scan_json_filters_and_types(spark, tmp_path):
    record = dict(area="Algeria", area_code="4", item="Tomatoes", item_code="TOM", element="Producer Price", unit="DZD/kg", flag="A")
    rows = [dict(record, year=2015, value=80.5), dict(record, year=2009, value=1.0), dict(record, year=2016, value="n/a", item_code="POT")]
    (tmp_path / "reply.json").write_text(json.dumps({"data": rows}, indent=1))
    found = readers.scan_json(spark, str(tmp_path), (2010, 2024), multiline=True)
    assert {(r.year, r.value) for r in found.collect()} == {(2015, 80.5), (2016, None)}
    assert readers.scan_json(spark, str(tmp_path), None, ["POT"], multiline=True).count() == 1


def test_food_balance_without_file_is_empty(spark, tmp_path):
    assert readers.scan_food_balance(spark, str(tmp_path / "none")).count() == 0


def test_normalise_columns(spark):
    df = spark.createDataFrame([("a", "1.5"), ("b", "x")], ["Area  Code-Name", "_Value_"])
    out = readers.normalise_columns(df)
    assert out.columns == ["area_code_name", "value"]
    assert [r.value for r in out.collect()] == [1.5, None]


def test_standardise_source(spark):
    df = spark.createDataFrame(
        [("2023-01-01", "X", "M", "Tomato", " 80 ", "0"), ("bad", "X", "M", "Tomato", "1", "0"), ("2023-01-02", "X", "M", "Tomato", "?", "0")],
        "` DATE ` string, Admin1 string, ADMIN2 string, commodity string, price string, Region string",
    )
    out = readers.standardise_source(df)
    assert out.columns == ["date", "region", "market", "product", "price"]
    assert [(r.region, r.market, r.price) for r in out.collect()] == [("X", "M", 80.0)]


def test_priority_union_keeps_real_regions(spark):
    real = spark.createDataFrame([("A", 1.0)], "region string, price double")
    fallback = spark.createDataFrame([("A", 2.0, "m"), ("B", 3.0, "n")], "region string, price double, market string")
    out = readers.priority_union(real, fallback).collect()
    assert {(r.region, r.price, r.market, r.source) for r in out} == {("A", 1.0, None, "WFP_real"), ("B", 3.0, "n", "synthetic")}


def test_market_locations_only_existing_columns(spark):
    df = spark.createDataFrame([("2020-01-02", "m", "b"), ("2020-01-01", "m", "a")], "date string, market string, region string")
    assert [tuple(r) for r in readers.market_locations(df).collect()] == [("m", "a")]


def test_read_safe_write_and_reuse(spark, panel, tmp_path):
    path = str(tmp_path / "deep" / "t")
    assert readers.read_parquet_safe(spark, path) is None
    built = []
    build = lambda: built.append(1) or panel
    readers.materialise_or_reuse(spark, path, build)
    readers.materialise_or_reuse(spark, path, build)
    assert len(built) == 1
    readers.materialise_or_reuse(spark, path, build, force=True)
    assert len(built) == 2
    sinks.write_csv(panel, str(tmp_path / "csv"))
    assert readers.scan_csv(spark, str(tmp_path / "csv"), None).count() == 240


def test_stage_uses_the_folder_of_the_session(spark, panel):
    staged = stage(panel.limit(3))
    assert staged.count() == 3 and work_dir(spark).split(":")[-1] in staged.inputFiles()[0]


def test_validate(spark, panel):
    assert validate_table(panel, ["price"])
    with pytest.raises(ValueError, match="None or empty"):
        validate_table(None, ["price"])
    with pytest.raises(ValueError, match="None or empty"):
        validate_table(panel.where("false"), ["price"])
    with pytest.raises(ValueError, match="Missing required columns"):
        validate_table(panel, ["price", "nope"])
    with pytest.raises(ValueError, match="at least"):
        validate_table(panel.limit(1), ["price"], 5)
    assert validate_table(spark.range(30_000), ["id"], 30_000)
    with pytest.raises(ValueError, match="has 30000 rows, expected at least 30001"):
        validate_table(spark.range(30_000), ["id"], 30_001)


def test_version_follows_files_and_settings(spark, tmp_path):
    source = str(tmp_path / "prices.parquet")
    spark.range(10).coalesce(1).write.parquet(source)
    first = tables.version(spark, [source])
    assert tables.version(spark, [source]) == first and len(first) == 24
    assert tables.version(spark, [source], Settings(trees=7)) != first
    spark.range(3).coalesce(1).write.mode("append").parquet(source)
    assert tables.version(spark, [source]) != first


def test_scored_panel_reads_the_callers_table(spark, tmp_path):
    path = str(tmp_path / "scored")
    spark.createDataFrame([("P", 0.5)], "product string, anomaly_score double").write.parquet(path)
    assert [tuple(r) for r in tables.scored_panel(spark, SMALL, path=path).collect()] == [("P", 0.5)]


def test_dimensions(spark):
    assert dimensions.region_dimension(spark).count() == 10
    assert dimensions.product_dimension(spark).count() == 16
    assert dimensions.board_regions(spark).count() == 20
    df = spark.createDataFrame([("Tomates", 100.0), ("Tomates", 200.0), ("?", 1.0)], "product string, price double")
    out = {(r.product, r.price): r.in_range for r in dimensions.with_typical_range(df, dimensions.product_dimension(spark)).collect()}
    assert out == {("Tomates", 100.0): True, ("Tomates", 200.0): False, ("?", 1.0): None}


def test_scratch_tables_go(spark):
    import os

    from bazaarline.functions.staging import scratch

    with scratch(spark) as folder:
        staged = stage(spark.range(3))
        path = staged.inputFiles()[0].split(":")[-1].lstrip("/")
        assert os.path.exists(f"/{path}") and folder.split(":")[-1].lstrip("/") in path
    assert not os.path.exists(f"/{path}")
    assert folder not in work_dir(spark)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master, applicationId = "spark://host:7077", "app-1"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session())
    Context.master = "local-cluster[3,2,1000]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session())
