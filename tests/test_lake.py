"""Commits, keyed tables in buckets and layers."""

import os

import pytest

from menulake.operators.upsert import upsert
from menulake.sources import lake
from menulake.sources.io import has_snapshot, latest_snapshot, snapshot_before, write_snapshot

SCHEMA = "_id string, a int, b string"


def _rows(spark, ids, a, b="x"):
    return spark.createDataFrame([(f"k{i}", a, b) for i in ids], SCHEMA)


def _read(spark, root, name="t"):
    return sorted((tuple(r) for r in lake.read_table(spark, root, lake.newest(spark, root, name)).collect()), key=repr)


def _merge(spark, root, run, fresh, **options):
    entry, counts = lake.merge(fresh, root, "t", run, "_id", "a", **options)
    lake.commit(spark, root, run, {"t": entry})
    return entry, counts


def _append(spark, root, run, fresh, **options):
    entry = lake.append(fresh, root, "t", run, "_id", "a", **options)
    lake.commit(spark, root, run, {"t": entry})
    return entry


def test_a_run_is_seen_whole_or_not_at_all(spark, scratch):
    one = {n: _rows(spark, range(3), 1) for n in ("brands", "menu_items", "variations")}
    write_snapshot(one, scratch, "2024-01-01")
    broken = {n: _rows(spark, range(9), 2) for n in one}
    broken["variations"] = broken["variations"].selectExpr("_id", "a", "raise_error('disk full') AS b")
    with pytest.raises(Exception, match="disk full"):
        write_snapshot(broken, scratch, "2024-01-02")
    assert os.path.isdir(os.path.join(scratch, "brands", "run_ts=2024-01-02"))
    for n in one:
        got = latest_snapshot(spark, scratch, n)
        assert got.count() == 3 and got.first()["run_ts"] == "2024-01-01"
    # a folder that nothing commits is never newest
    _rows(spark, range(5), 3).write.parquet(os.path.join(scratch, "brands", "run_ts=2024-01-03"))
    assert latest_snapshot(spark, scratch, "brands").count() == 3
    # written again, the run replaces its own folders
    write_snapshot({n: _rows(spark, range(4), 2) for n in one}, scratch, "2024-01-02")
    assert all(latest_snapshot(spark, scratch, n).count() == 4 for n in one)
    assert snapshot_before(spark, scratch, "brands", "2024-01-02").count() == 3
    assert not has_snapshot(spark, scratch, "photos") and lake.runs(spark, os.path.join(scratch, "none")) == []


def test_a_failed_rewrite_shows_the_run_before(spark, scratch):
    write_snapshot({"brands": _rows(spark, range(3), 1)}, scratch, "r1")
    write_snapshot({"brands": _rows(spark, range(4), 1), "menu_items": _rows(spark, [1], 1)}, scratch, "r2")
    with pytest.raises(Exception, match="gone"):
        write_snapshot({"brands": _rows(spark, range(4), 1).selectExpr("_id", "raise_error('gone') AS a", "b")}, scratch, "r2")
    assert latest_snapshot(spark, scratch, "brands").count() == 3     # r2's folder is no longer whole
    assert latest_snapshot(spark, scratch, "menu_items").count() == 1


def test_an_upsert_reads_and_writes_the_touched_buckets_only(spark, scratch):
    first, counts = _merge(spark, scratch, "r1", _rows(spark, range(1000), 1), buckets=64)
    assert counts == {"inserted": 1000, "matched": 0, "modified": 0, "errors": 0}
    assert {f[0] for f in first["files"]} == set(range(64)) and sum(f[3] for f in first["files"]) == 1000
    fresh = spark.createDataFrame([(f"k{i}", 2, None) for i in range(995, 1005)], SCHEMA)      # 1% of the keys
    touched = {r[0] for r in fresh.select(lake.bucket_of("_id", 64)).collect()}
    assert len(touched) <= 10
    base = lake.read_table(spark, scratch, first, touched)
    names = {os.path.basename(f) for f in base.inputFiles()}
    assert names == {os.path.basename(f[2]) for f in first["files"] if f[0] in touched}         # the scan's files
    second, counts = _merge(spark, scratch, "r2", fresh)
    assert counts == {"inserted": 5, "matched": 5, "modified": 5, "errors": 0}
    assert [f for f in first["files"] if f[0] not in touched] == [f for f in second["files"] if f[0] not in touched]
    assert {f[0] for f in second["files"] if "run_ts=r2" in f[2]} == touched
    want = upsert(_rows(spark, range(1000), 1), fresh, "_id", "a").table
    assert _read(spark, scratch) == sorted((tuple(r) for r in want.collect()), key=repr)
    # a replay builds on the run before it
    assert _merge(spark, scratch, "r2", fresh)[1]["inserted"] == 5
    assert len(_read(spark, scratch)) == 1005


def test_a_late_replay_leaves_the_files_of_later_runs(spark, scratch):
    _merge(spark, scratch, "r1", _rows(spark, range(40), 1), buckets=4)
    _merge(spark, scratch, "r2", _rows(spark, [1], 2))
    before = _read(spark, scratch)
    _merge(spark, scratch, "r1", _rows(spark, range(40), 1), buckets=4)
    assert _read(spark, scratch) == before
    _merge(spark, scratch, "r2", _rows(spark, [1], 2))
    assert _read(spark, scratch) == before


def test_a_batch_writes_its_own_rows_only(spark, scratch):
    base = _rows(spark, range(2000), 1)
    entry = _append(spark, scratch, "b0", _rows(spark, [5, 5, 3000], 2, "y"), base=base, buckets=8)
    assert len(_read(spark, scratch)) == 2001 and ("k5", 2, "y") in _read(spark, scratch)
    for k in range(1, 6):
        before = {f[2] for f in entry["files"]}
        entry = _append(spark, scratch, f"b{k}", _rows(spark, range(10 * k, 10 * k + 10), 10 + k))
        new = [f for f in entry["files"] if f[2] not in before]
        assert sum(f[3] for f in new) == 10
    got = dict((i, a) for i, a, _ in _read(spark, scratch))
    assert len(got) == 2001 and got["k55"] == 15 and got["k9"] == 1
    # a replayed batch gives the same table
    rows = _read(spark, scratch)
    _append(spark, scratch, "b5", _rows(spark, range(50, 60), 15))
    assert _read(spark, scratch) == rows


def test_layers_are_rewritten_in_proportion(spark, scratch):
    _append(spark, scratch, "b00", _rows(spark, range(400), 0), buckets=2)
    written, layers = 400, set()
    for k in range(1, 13):
        entry = _append(spark, scratch, f"b{k:02d}", _rows(spark, range(400 + 50 * k, 450 + 50 * k), k))
        written += sum(f[3] for f in entry["files"] if f"run_ts=b{k:02d}" in f[2])
        layers.add(len({f[1] for f in entry["files"] if f[0] == 0}))
    assert len(_read(spark, scratch)) == 1000
    assert max(layers) > 1 and min(layers) == 1     # buckets were rewritten as one layer
    assert written <= 4 * 1000


def test_layers_overlay_columns_or_rows(spark, scratch):
    base = spark.createDataFrame([("k1", 1, "keep"), ("k2", 1, "keep"), (None, 1, "null")], SCHEMA)
    lake.commit(spark, scratch, "r1", {"t": lake.append(spark.createDataFrame([("k1", 5, 9), (None, 6, 9)], "_id string, a int, c int"), scratch, "t", "r1", "_id", "a", base=base, buckets=2)})
    assert _read(spark, scratch) == sorted([("k1", 5, "keep", 9), ("k2", 1, "keep", None), (None, 1, "null", None), (None, 6, None, 9)], key=repr)
    lake.commit(spark, scratch, "r2", {"t": lake.append(spark.createDataFrame([("k1", 7)], "_id string, a int"), scratch, "t", "r2", "_id", "a", whole_rows=True)})
    assert ("k1", 7, None, None) in _read(spark, scratch) and len(_read(spark, scratch)) == 4
    # an upsert over layers, and a fresh null that overwrites
    _merge(spark, scratch, "r3", spark.createDataFrame([("k2", None, None)], SCHEMA))
    assert ("k2", None, None, None) in _read(spark, scratch)
    empty = spark.createDataFrame([], SCHEMA)
    assert _merge(spark, scratch, "r4", empty)[1]["matched"] == 0 and len(_read(spark, scratch)) == 4


def test_buckets_grow_with_the_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(lake, "ROWS", 10)
    monkeypatch.setattr(lake, "LEAST_BUCKETS", 2)
    first, _ = _merge(spark, scratch, "r1", _rows(spark, range(15), 1))
    assert first["buckets"] == 2
    _merge(spark, scratch, "r2", _rows(spark, range(15, 100), 1))
    grown, counts = _merge(spark, scratch, "r3", _rows(spark, range(99, 101), 3))
    assert grown["buckets"] == 10 and counts["matched"] == 1 and len(_read(spark, scratch)) == 101


def test_a_merge_shuffles_each_side_once(spark, scratch, monkeypatch):
    plans, write = [], lake._write_buckets

    def seen(df, folder):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, folder)

    monkeypatch.setattr(lake, "_write_buckets", seen)  # an exchange for the base and one for the fresh rows
    _merge(spark, scratch, "r1", _rows(spark, range(100), 1), buckets=4)
    entry, counts = _merge(spark, scratch, "r2", _rows(spark, range(50, 150), 2))
    assert counts == {"inserted": 50, "matched": 50, "modified": 50, "errors": 0}
    assert [p.count("Exchange ") for p in plans] == [2, 2] and "max_by" not in plans[1]
    assert {f[0] for f in entry["files"]} == set(range(4)) and sum(f[3] for f in entry["files"]) == 150


def test_hot_keys_are_thinned_before_they_are_dealt(spark, scratch, monkeypatch):
    fresh = spark.createDataFrame([("hot", n, f"v{n}") for n in range(400)] + [(None, n, "null") for n in range(300)] + [(f"k{n}", n, "x") for n in range(50)], SCHEMA)
    monkeypatch.setattr(lake, "HOT", 100)
    thin = lake._thinned(fresh, "_id", "a")
    assert sorted((tuple(r) for r in thin.where("_id IS NULL OR _id = 'hot'").collect()), key=repr) == [("hot", 399, "v399"), (None, 299, "null")]
    _merge(spark, scratch, "r1", fresh)
    got = _read(spark, scratch)
    assert len(got) == 52 and ("hot", 399, "v399") in got and (None, 299, "null") in got


def test_a_write_leaves_no_shuffle_files_and_packs_its_files(spark, scratch):
    import time

    import pyarrow.parquet as pq

    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))

    setting, before = spark.conf.get(lake.CLEANUP), shuffled()
    rows = spark.range(100_000).selectExpr("sha2(string(id), 256) AS _id", "int(id) AS a", "sha2(string(-id), 256) AS b")
    folder = os.path.join(scratch, "b")
    lake._write_buckets(lake._by_key(rows, "_id", 4), folder)
    entry = lake.write_table(lake._by_key(rows, "_id", 4), scratch, "w", "r1")
    time.sleep(2)  # removal is asked for, not waited for
    assert shuffled() - before < 1_000_000      # 13 MB of ids are dealt in each write
    assert spark.conf.get(lake.CLEANUP) == setting
    for d in (folder, os.path.join(scratch, entry["folder"])):
        files = [os.path.join(d, f) for f in os.listdir(d) if f.endswith(".parquet")]
        assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
        assert spark.read.parquet(d).count() == 100_000
    with pytest.raises(Exception, match="gone"):
        lake._write_buckets(rows.selectExpr("_id", "raise_error('gone') AS a"), folder)
    assert spark.conf.get(lake.CLEANUP) == setting


def test_a_large_merge_goes_by_turns_and_holds_the_shuffle_of_one(spark, scratch, monkeypatch):
    turns, write = [], lake._write_buckets

    def seen(df, folder, mode="overwrite"):
        turns.append((mode, {r[0] for r in df.select(lake.bucket_of("_id", 32).alias("b")).distinct().collect()}))
        write(df, folder, mode)

    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 4)
    monkeypatch.setattr(lake, "_write_buckets", seen)
    first, counts = _merge(spark, scratch, "r1", _rows(spark, range(1000), 1), buckets=32)
    assert counts == {"inserted": 1000, "matched": 0, "modified": 0, "errors": 0}
    # eight turns of four buckets each, no bucket in two of them
    assert [m for m, _ in turns] == ["overwrite"] + ["append"] * 7
    assert [len(b) for _, b in turns] == [4] * 8 and set().union(*(b for _, b in turns)) == set(range(32))
    assert {f[0] for f in first["files"]} == set(range(32)) and len(first["files"]) == 32
    monkeypatch.setattr(lake, "HOT", 100)
    fresh = _rows(spark, range(500, 1200), 2, None).unionByName(spark.createDataFrame([("hot", n, "v") for n in range(200)] + [(None, 7, "null")], SCHEMA))
    for _ in range(2):      # a replay gives the same
        second, counts = _merge(spark, scratch, "r2", fresh)
        assert counts == {"inserted": 202, "matched": 500, "modified": 500, "errors": 0}
        want = upsert(_rows(spark, range(1000), 1), fresh, "_id", "a").table
        assert _read(spark, scratch) == sorted((tuple(r) for r in want.collect()), key=repr)
        assert sum(f[3] for f in second["files"]) == 1202
    # a few touched buckets are one turn
    del turns[:]
    _merge(spark, scratch, "r3", _rows(spark, [5], 3))
    assert [(m, len(b)) for m, b in turns] == [("overwrite", 1)]
    # buckets that grow in number are dealt anew by turns too
    monkeypatch.setattr(lake, "ROWS", 9)
    grown, counts = _merge(spark, scratch, "r4", _rows(spark, range(1199, 1201), 4))
    assert grown["buckets"] == 134 and [m for m, _ in turns[1:]] == ["overwrite"] + ["append"] * 7
    assert counts["inserted"] == 1 and counts["matched"] == 1 and len(_read(spark, scratch)) == 1203
