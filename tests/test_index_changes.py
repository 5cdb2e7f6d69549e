"""Partial rewrites of the index, listings kept as snapshots, and checks of what changed."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docketspark.plans.check import check_changes, check_in_place, check_index
from docketspark.schemas import INDEX
from docketspark.sinks.index_table import append_index, read_index, replace_folders, stored_entries
from docketspark.sinks.manifest_table import read_snapshot, snapshot_difference, write_snapshot
from docketspark.sources.files import MANIFEST_SCHEMA


def path(cik, year, n):
    return f"{cik:010d}/8-K/{cik:010d}{year:02d}{n:06d}/a.htm"


def entries(spark, keys):
    rows = [(f"{c:010d}", "8-K", f"001-{n}", path(c, y, n), datetime(1900 + y, 1, 1).date()) for c, y, n in keys]
    return spark.createDataFrame(rows, INDEX)


def files(table):
    found = {}
    for folder, _, names in os.walk(table):
        for name in names:
            if name.startswith("part-"):
                full = f"{folder}/{name}"
                found[os.path.relpath(full, table)] = os.stat(full).st_mtime_ns
    return found


def paths_of(spark, table):
    return sorted(r.file_path for r in read_index(spark, table).collect())


@pytest.fixture
def table(spark, tmp_path):
    name = str(tmp_path / "index")
    append_index(entries(spark, [(c, y, n) for c in (1, 2) for y in (93, 94, 95) for n in range(4)]), name, "1")
    append_index(entries(spark, [(3, y, n) for y in (94, 96) for n in range(4)]), name, "2")
    return name


def manifest(spark, table, without):
    present = read_index(spark, table).select("file_path").distinct()
    return present.where(~F.col("file_path").isin(list(without) or [""]))


def test_only_folders_that_lose_rows_are_written(spark, table):
    gone = [path(1, 94, 2), path(2, 94, 0), path(3, 96, 1)]
    listing = manifest(spark, table, gone)
    listing = spark.createDataFrame(listing.collect(), listing.schema)
    before, all_paths = files(table), paths_of(spark, table)
    assert check_in_place(spark, table, listing) == (3, 2)
    after = files(table)
    touched = {os.path.dirname(p) for p in before.keys() ^ after.keys()}
    assert touched == {"batch=1/filed_in=94", "batch=2/filed_in=96"}
    assert all(after[p] == t for p, t in before.items() if os.path.dirname(p) not in touched)
    assert paths_of(spark, table) == [p for p in all_paths if p not in gone]
    assert check_in_place(spark, table, listing) == (0, 0)


def test_a_folder_that_loses_all_rows_is_left_empty(spark, table):
    gone = [path(c, 95, n) for c in (1, 2) for n in range(4)]
    listing = spark.createDataFrame(manifest(spark, table, gone).collect(), "file_path string")
    assert check_in_place(spark, table, listing) == (8, 1)
    assert not set(paths_of(spark, table)) & set(gone)
    append_index(entries(spark, [(1, 95, 0)]), table, "3")  # the key is free again
    assert path(1, 95, 0) in paths_of(spark, table)


def test_repeats_stay_in_the_first_batch(spark, table):
    again = stored_entries(spark, table).where("batch = '1' and filed_in = '93'")
    rows = spark.createDataFrame(again.collect(), again.schema).withColumn("batch", F.lit("0"))
    rows.unionAll(rows).write.mode("append").partitionBy("batch", "filed_in").parquet(table)
    spark.catalog.refreshByPath(table)
    listing = spark.createDataFrame(manifest(spark, table, []).collect(), "file_path string")
    all_paths = sorted(set(paths_of(spark, table)))
    assert check_in_place(spark, table, listing) == (16, 2)
    assert paths_of(spark, table) == all_paths
    assert {r.batch for r in stored_entries(spark, table).where("filed_in = '93'").collect()} == {"0"}


def test_in_place_equals_a_whole_rewrite(spark, table, tmp_path):
    gone = [path(1, 93, 1), path(3, 94, 3)]
    listing = spark.createDataFrame(manifest(spark, table, gone).collect(), "file_path string")
    where, n = check_index(spark, table, listing, str(tmp_path / "new"))
    expected = paths_of(spark, where)
    assert check_in_place(spark, table, listing)[0] == n and paths_of(spark, table) == expected


def test_a_replacement_that_failed_can_be_run_again(spark, table, tmp_path):
    there = stored_entries(spark, table).where("batch = '1' and filed_in = '94'")
    kept = spark.createDataFrame(there.limit(3).collect(), there.schema)
    kept.write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    folders = spark.createDataFrame([("1", "94"), ("1", "95")], "batch string, filed_in string")
    for _ in range(2):
        assert replace_folders(kept, folders, table) == 2
        found = stored_entries(spark, table).where("batch = '1' and filed_in in ('94', '95')")
        assert found.count() == 3
    with pytest.raises(ValueError, match="not replaced"):
        replace_folders(kept, folders.where("filed_in = '95'"), table)


def listing(spark, rows):
    return spark.createDataFrame([(p, n, datetime(2020, 1, d)) for p, n, d in rows], MANIFEST_SCHEMA)


def test_difference_of_snapshots(spark, tmp_path):
    table = str(tmp_path / "manifest")
    old = [("a", 1, 1), ("b", 2, 1), ("c", 3, 1), ("d", 4, 1), ("d", 5, 2)]
    write_snapshot(listing(spark, [*old, (None, 1, 1)]), table, "one")
    write_snapshot(listing(spark, [("a", 1, 1), ("b", 9, 1), ("c", 3, 3), ("e", 1, 1)]), table, "two")
    one, two = (read_snapshot(spark, table, name) for name in ("one", "two"))
    assert {r.file_path: r.length for r in one.collect()} == {"a": 1, "b": 2, "c": 3, "d": 5}
    found = snapshot_difference(one, two).collect()
    assert {(r.file_path, r.change) for r in found} == {
        ("b", "changed"), ("c", "changed"), ("d", "removed"), ("e", "added")
    }
    assert snapshot_difference(one, one).collect() == []
    empty = listing(spark, [])
    assert {r.change for r in snapshot_difference(empty, one).collect()} == {"added"}
    assert {r.change for r in snapshot_difference(one, empty).collect()} == {"removed"}


def test_check_of_changes_equals_the_full_check(spark, table, tmp_path):
    """Batch 1 agreed with the last snapshot; batch 2 came later and was never checked."""
    known = [r.file_path for r in stored_entries(spark, table).where("batch = '1'").collect()]
    one = listing(spark, [(p, 1, 1) for p in known])
    gone = {path(1, 95, 3), path(3, 94, 0)}
    two = listing(spark, [(p, 1, 1) for p in paths_of(spark, table) if p not in gone] + [("x/y/z/w", 1, 1)])
    where, n = check_index(spark, table, two, str(tmp_path / "new"))
    expected = paths_of(spark, where)
    before = files(table)
    assert check_changes(spark, table, snapshot_difference(one, two), two, ["1"]) == (n, 2)
    assert paths_of(spark, table) == expected
    touched = {os.path.dirname(p) for p in before.keys() ^ files(table).keys()}
    assert touched == {"batch=1/filed_in=95", "batch=2/filed_in=94"}
    assert check_changes(spark, table, snapshot_difference(two, two), two, ["1", "2"]) == (0, 0)


def test_entries_without_a_path_go_with_the_full_check(spark, tmp_path):
    name = str(tmp_path / "index")
    rows = entries(spark, [(1, 93, 1)]).unionAll(spark.createDataFrame([("1", "8-K", None, None, None)] * 3, INDEX))
    append_index(rows, name, "1")
    assert check_in_place(spark, name, spark.createDataFrame([(path(1, 93, 1),)], "file_path string")) == (1, 1)
    assert paths_of(spark, name) == [path(1, 93, 1)]


def test_paths_of_the_derived_index_are_built_once(spark, tmp_path, monkeypatch):
    """What the check of a stored index is given is read from paths that were written."""
    from docketspark.queries import catalog

    given, check = [], catalog.check_in_place

    def watched(spark, table, manifest):
        given.append(manifest._jdf.queryExecution().optimizedPlan().toString())
        return check(spark, table, manifest)

    monkeypatch.setattr(catalog, "check_in_place", watched)
    orders = spark.range(30).selectExpr(
        "id as o_orderkey", "id % 5 as o_custkey", "'O' as o_orderstatus", "'2-HIGH' as o_orderpriority",
        "timestamp_ntz'1995-03-01 00:00:00' + make_dt_interval(int(id) * 40) as o_orderdate",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert 0 < catalog.index_check_in_place(spark, str(tmp_path)).count() < 30
    assert "o_orderkey" not in given[0]
