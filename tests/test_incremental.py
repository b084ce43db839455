"""The incremental panel against a full build, after adding, replacing and removing files."""

import shutil
from datetime import date, timedelta

import pandas as pd
import pytest

from bazaarline.operators.cleaning import aggregate_monthly
from bazaarline.sources import incremental


def rows_of(seed, n=400):
    """A year and a half of days for three series, a third without a price, and rows without a key."""
    out = []
    for i in range(n):
        k = i * 7 + seed * 13
        price = None if k % 3 == 0 else 1e6 + (k % 101) / 7
        out.append((date(2021, 1, 3) + timedelta(days=(k * 5) % 540), ["Figs", "Oil", None][k % 11 % 3], ["N", "S"][k % 2], price))
    return pd.DataFrame(out, columns=["date", "product", "region", "price"])


def put(folder, name, frame):
    frame.astype({"date": "datetime64[us]"}).to_parquet(folder / name)


def same(spark, source, state, freq="MS"):
    full = aggregate_monthly(spark.read.parquet(str(source)), freq).toPandas()
    kept = incremental.panel(spark, str(state), freq).toPandas()
    keys = ["product", "region", "date"]
    full, kept = (f.sort_values(keys).reset_index(drop=True) for f in (full, kept))
    pd.testing.assert_frame_equal(full, kept[full.columns], rtol=1e-7, check_dtype=False)


def names(paths):
    return [p.rsplit("/", 1)[1] for p in paths]


@pytest.fixture
def folders(tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    for i in range(3):
        put(source, f"{i}.parquet", rows_of(i))
    return source, tmp_path / "state"


def test_adding_replacing_removing(spark, folders):
    source, state = folders
    go = lambda **more: names(incremental.refresh(spark, str(source), str(state), **more))
    assert go() == ["0.parquet", "1.parquet", "2.parquet"]
    same(spark, source, state)
    assert go() == []
    put(source, "3 é%20[x].parquet", rows_of(9))
    assert len(go()) == 1
    same(spark, source, state)
    put(source, "1.parquet", rows_of(20, 900))
    assert go() == ["1.parquet"]
    same(spark, source, state)
    (source / "0.parquet").unlink()
    assert go() == []
    same(spark, source, state)
    assert len(go(version="2")) == 3
    same(spark, source, state)
    assert len(list((state / "manifests").iterdir())) == 2


def test_parts_are_put_together(spark, folders):
    source, state = folders
    for i in range(5):
        put(source, f"more{i}.parquet", rows_of(30 + i, 50))
        incremental.refresh(spark, str(source), str(state), most_parts=2)
        assert incremental._manifest(spark, str(state), incremental._finished(spark, str(state))[-1]).select("part").distinct().count() <= 2
    same(spark, source, state)


def test_a_lost_refresh_changes_nothing(spark, folders):
    source, state = folders
    incremental.refresh(spark, str(source), str(state))
    before = incremental.panel(spark, str(state)).count()
    put(source, "9.parquet", rows_of(40))

    def lost(scan):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        incremental.refresh(spark, str(source), str(state), rows=lost)
    shutil.copytree(state / "manifests" / "000000001", state / "manifests" / "000000002")
    (state / "manifests" / "000000002" / "_SUCCESS").unlink()
    assert incremental.panel(spark, str(state)).count() == before
    shutil.rmtree(state / "manifests" / "000000002")
    assert names(incremental.refresh(spark, str(source), str(state))) == ["9.parquet"]
    same(spark, source, state)


def test_only_changed_files_are_in_the_scan(spark, folders):
    source, state = folders
    incremental.refresh(spark, str(source), str(state))
    put(source, "new.parquet", rows_of(50))
    seen = []

    def rows(scan):
        seen.extend(scan.inputFiles())
        return scan

    incremental.refresh(spark, str(source), str(state), rows=rows)
    assert names(seen) == ["new.parquet"]


def test_other_periods_and_nothing_at_all(spark, folders, tmp_path):
    source, state = folders
    incremental.refresh(spark, str(source), str(state), freq="W")
    same(spark, source, state, "W")
    with pytest.raises(ValueError):
        incremental.panel(spark, str(state), "MS")
    with pytest.raises(ValueError):
        incremental.panel(spark, str(tmp_path / "none"))
