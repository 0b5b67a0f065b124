"""Deliveries, manifests and the step-wise sequence dataset."""

import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from harvestlens.operators.mart import label_stages
from harvestlens.plans.sequence_steps import write_step_dataset
from harvestlens.plans.sequences import sequence_dataset
from harvestlens.sources.ingest import StationIngest
from harvestlens.sources.stations import station_to_region_hourly
from harvestlens.sources.versions import Manifest

HEADER = "NUM_POSTE,LAT,LON,ALTI,AAAAMMJJHH,T,RR1,EXTRA"


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, rows in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join([HEADER, *[",".join("" if x is None else str(x) for x in r) for r in rows]]) + "\n")
    return str(folder)


def _row(station, hour, t, rain=0.5):
    return (station, 1.0, 2.0, 100, f"20200101{hour:02d}", t, rain, "x")


def _panel(df):
    return {(r.dept_id, r.datetime.hour): (r.temp_air_c, r.precipitations_1h_mm) for r in df.collect()}


def _direct(spark, files):
    """All rows at once, the region from the file's name."""
    rows = [(name[5:].split("_")[0].split(".")[0], *map(str, r[:5]), r[5], r[6])
            for name, rs in files.items() for r in rs if r[0] != "NUM_POSTE"]
    df = spark.createDataFrame(rows, "region string, NUM_POSTE string, LAT string, LON string, ALTI string, AAAAMMJJHH string, T double, RR1 double")
    return _panel(station_to_region_hourly(df, "region"))


def test_deliveries_count_each_file_once(spark, tmp_path):
    first = {"dept_01.csv": [_row(1, 0, 10.0), _row(2, 0, None), _row(1, 1, 12.5)],
             "dept_2A.csv": [_row(9, 0, -3.25), tuple(HEADER.split(",")), _row(9, 1, None)]}
    late = {"dept_01_late.csv": [_row(3, 0, 20.0), _row(3, 7, 1.0)], "dept_01.csv": first["dept_01.csv"]}
    ingest = StationIngest(spark, str(tmp_path / "state"))
    with pytest.raises(LookupError):
        ingest.hourly()
    a, b = _write(tmp_path / "a", first), _write(tmp_path / "b", late)
    assert ingest.deliver(a) == ["dept_01.csv", "dept_2A.csv"]
    assert _panel(ingest.hourly()) == _direct(spark, first)
    assert ingest.deliver(b) == ["dept_01_late.csv"]      # dept_01.csv came again
    assert _panel(ingest.hourly()) == _direct(spark, first | late)
    assert ingest.deliver(a) == [] and ingest.deliver(b) == []
    # a corrected file takes the place of the earlier one
    mended = {"dept_01.csv": [_row(1, 0, 11.0)]}
    assert ingest.deliver(_write(tmp_path / "c", mended)) == ["dept_01.csv"]
    assert _panel(ingest.hourly()) == _direct(spark, first | late | mended)
    # another reader of the same state sees the same
    assert _panel(StationIngest(spark, str(tmp_path / "state")).hourly()) == _panel(ingest.hourly())
    day = {r.dept_id: (r.temp_air_c, r.precipitations_1h_mm) for r in ingest.daily().collect()}
    assert day["2A"] == (-3.25, 1.0)


def test_a_file_without_an_id_raises(spark, tmp_path):
    path = _write(tmp_path / "x", {"stations.csv": [_row(1, 0, 1.0)]})
    with pytest.raises(Exception, match="no id in file name"):
        StationIngest(spark, str(tmp_path / "s")).deliver(path)


def test_two_writers_of_a_delivery(spark, tmp_path, monkeypatch):
    """While one delivery is being computed another brings one of its files: it counts once."""
    files = {"dept_01.csv": [_row(1, 0, 10.0)], "dept_02.csv": [_row(2, 0, 20.0)]}
    both, one = _write(tmp_path / "both", files), _write(tmp_path / "one", {"dept_02.csv": files["dept_02.csv"]})
    slow, fast = (StationIngest(spark, str(tmp_path / "state")) for _ in range(2))
    update = slow.manifest.update

    def late_update(change):
        assert fast.deliver(one) == ["dept_02.csv"]
        return update(change)

    monkeypatch.setattr(slow.manifest, "update", late_update)
    assert slow.deliver(both) == ["dept_01.csv"]
    assert _panel(slow.hourly()) == _direct(spark, files)


def test_manifest_versions(spark, tmp_path, monkeypatch):
    m = Manifest(spark, str(tmp_path / "m"))
    assert m.current() == (0, {})
    assert m.update(lambda c: {"n": c.get("n", 0) + 1}) == {"n": 1}
    assert m.update(lambda c: None) == {"n": 1} and m.versions() == [1]
    # another writer is first: the change is made again on what it left
    other, first = Manifest(spark, m.root), []

    def change(content):
        if not first:
            first.append(other.update(lambda c: {**c, "other": True}))
        return {**content, "mine": True}

    assert m.update(change) == {"n": 1, "other": True, "mine": True}
    assert m.versions() == [1, 2, 3]
    # a version that a lost driver left half-written is passed over
    (tmp_path / "m" / "v0000000004.json").write_text('{"n": ')
    assert m.current() == (4, {"n": 1, "other": True, "mine": True})
    assert m.update(lambda c: {**c, "n": 2})["n"] == 2 and m.versions()[-1] == 5


# ---- step-wise sequences

def _inputs(spark):
    rows, rng = [], np.random.default_rng(1)
    for region in ("01", "02", "99"):
        for y in (2011, 2012, 2013):
            t = datetime.datetime(y, 5, 20)
            for h in range(4 if y == 2012 else 8):
                rows.append((region, t + datetime.timedelta(hours=h), None if (region, y, h) == ("01", 2011, 2) else float(rng.normal(10, 3))))
    panel = label_stages(spark.createDataFrame(rows, "DEPT_ID string, datetime timestamp, t double").repartition(5), "datetime")
    mart = spark.createDataFrame([(r, y, 5.0 + k, float(k * y % 7), None if y == 2013 else 1.5 * k + y)
                                  for k, r in enumerate(("01", "02")) for y in (2011, 2012, 2013, 2020)],
                                 "DEPT_ID string, harvest_year int, RENDEMENT double, s double, agro double")
    return panel, mart


@pytest.mark.parametrize("length", [1, 6, 40])
def test_steps_equal_the_arrays(spark, tmp_path, length):
    panel, mart = _inputs(spark)
    options = dict(length=length, excluded=["99"], min_year_exclusive=2010, max_year=2015, train_max=2011,
                   val_years=(2012,), test_min=2013, target="RENDEMENT")
    ds = write_step_dataset(panel, mart, ["s", "agro"], str(tmp_path / "d"), **options)
    # the array form keeps pairs without weather (2020), this one drops them
    arrays, feats = sequence_dataset(panel, mart.filter("harvest_year < 2020"), ["s", "agro"], **options)
    assert list(ds.features) == feats
    want = {(r.DEPT_ID, r.harvest_year): r for r in arrays.collect()}
    got: dict = {}
    for r in ds.steps().collect():
        got.setdefault((r.DEPT_ID, r.harvest_year), []).append(r)
    assert set(got) == set(want)
    for key, steps in got.items():
        steps.sort(key=lambda r: r.step)
        assert [r.step for r in steps] == list(range(1, length + 1))
        assert sum(r.observed for r in steps) == want[key].n_steps and {r.split for r in steps} == {want[key].split}
        assert np.allclose([[r[c] for c in feats] for r in steps], want[key].seq)
    for r in ds.statics().collect():
        w = want[r.DEPT_ID, r.harvest_year]
        assert (r.split, r.RENDEMENT, r.n_steps) == (w.split, w.RENDEMENT, w.n_steps)
        assert r.s == pytest.approx(w.s) and r.agro == pytest.approx(w.agro)


def test_steps_lie_in_order(spark, tmp_path):
    panel, mart = _inputs(spark)
    ds = write_step_dataset(panel, mart, ["s"], str(tmp_path / "d"), length=6, min_year_exclusive=2010, max_year=2015,
                            train_max=2011, val_years=(2012,), test_min=2013)
    rows = ds.steps().select("*", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i")).collect()
    files: dict = {}
    for r in sorted(rows, key=lambda r: r.i):
        files.setdefault(r.p, []).append((r.DEPT_ID, r.harvest_year, r.step))
    assert all(f == sorted(f) for f in files.values())
    whole = [k[:2] for f in files.values() for k in dict.fromkeys(x[:2] for x in f)]
    assert len(whole) == len(set(whole))  # no pair in two files


def test_known_files_are_not_read_again(spark, tmp_path, monkeypatch):
    """Of a delivery only the files that are new or changed are parsed."""
    from harvestlens.sources.ingest import StationIngest

    def put(folder, region, t):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"dept_{region}.csv").write_text(
            f"NUM_POSTE,LAT,LON,ALTI,AAAAMMJJHH,T\n1,1.0,2.0,10,1998010103,{t}\n")

    put("one a", "01", 5), put("one a", "02", 6), put("two b", "01", 5), put("two b", "03", 7)
    ingest, read = StationIngest(spark, str(tmp_path / "state")), []
    readings = ingest._readings
    monkeypatch.setattr(ingest, "_readings", lambda paths, files: read.append(paths) or readings(paths, files))
    assert ingest.deliver(str(tmp_path / "one a")) == ["dept_01.csv", "dept_02.csv"]
    assert ingest.deliver(str(tmp_path / "two b")) == ["dept_03.csv"]
    assert [[p.rsplit("/", 1)[1] for p in paths] for paths in read] == [["dept_01.csv", "dept_02.csv"], ["dept_03.csv"]]
    assert sorted((r.dept_id, r.temp_air_c) for r in ingest.hourly().collect()) == [("01", 5.0), ("02", 6.0), ("03", 7.0)]
