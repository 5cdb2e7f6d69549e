"""Archives as a data source and as a stream."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from docketspark.sources import archive_source, archives


def write(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in members.items():
            z.writestr(name, data)


@pytest.fixture
def folder(spark, tmp_path):
    archive_source.register(spark)
    rng = random.Random(2)
    (tmp_path / "in" / "deep").mkdir(parents=True)
    write(tmp_path / "in" / "one.zip", {f"m{i}.bin": rng.randbytes(rng.randrange(9_000)) for i in range(60)} | {"dir/": b"", "e": b""})
    write(tmp_path / "in" / "deep" / "two ü.zip", {"zeros": bytes(300_000), "a é": b"text"}, zipfile.ZIP_STORED)
    write(tmp_path / "in" / "none.zip", {})
    (tmp_path / "in" / "other.txt").write_text("no archive")
    return tmp_path / "in"


def rows(df):
    return sorted((r.archive.split("/")[-1], r.member, r.part, bytes(r.content)) for r in df.collect())


@pytest.mark.parametrize("range_bytes", [1 << 10, 50_000, 1 << 30])
def test_rows_are_those_of_the_members(spark, folder, range_bytes):
    reader = spark.read.format(archive_source.FORMAT).option("partBytes", 100_000)
    found = reader.option("rangeBytes", range_bytes).load(str(folder))
    members = archives.archive_members(archives.list_archives(spark, str(folder)))
    expected = archives.archive_contents(members, part_bytes=100_000)
    assert rows(found) == rows(expected) and len(rows(found)) == 61 + 4
    assert {r.archive for r in found.collect()} <= {r.archive for r in archives.list_archives(spark, str(folder)).collect()}
    if range_bytes == 1 << 10:
        assert found.rdd.getNumPartitions() > 100  # a partition per range


def test_one_archive_and_bad_options(spark, folder):
    reader = spark.read.format(archive_source.FORMAT)
    assert reader.load(str(folder / "one.zip")).count() == 61
    assert reader.load(str(folder / "missing")).count() == 0
    with pytest.raises(Exception, match="give a path"):
        reader.load().collect()
    with pytest.raises(Exception, match="at least 1"):
        reader.option("rangeBytes", 0).load(str(folder)).collect()


def test_damaged_members_stop_or_are_rows(spark, folder):
    path = folder / "deep" / "two ü.zip"
    raw = bytearray(path.read_bytes())
    raw[1000] ^= 1
    path.write_bytes(raw)
    reader = spark.read.format(archive_source.FORMAT)
    with pytest.raises(Exception, match="wrong checksum"):
        reader.load(str(path)).collect()
    found = reader.option("rejects", "true").load(str(path))
    assert {(r.member, r.error is None) for r in found.select("member", "error").collect()} == {("zeros", False), ("a é", True)}


def run(spark, folder, root, **options):
    stream = spark.readStream.format(archive_source.FORMAT).options(log=f"{root}/log", **options).load(str(folder))
    query = (
        stream.writeStream.format("parquet").option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/rows")


def test_stream_gives_each_member_once_over_triggers_and_restarts(spark, folder, tmp_path):
    assert run(spark, folder, tmp_path).count() == 63
    assert run(spark, folder, tmp_path).count() == 63  # nothing new
    write(folder / "aaa.zip", {"late": b"an earlier name"})
    import os

    os.utime(folder / "aaa.zip", (1, 1))  # and an earlier time
    assert run(spark, folder, tmp_path).count() == 64
    write(folder / "zzz.zip", {"last": b"1", "more": b"2"})
    found = run(spark, folder, tmp_path)
    assert found.count() == 66 == found.select("archive", "member").distinct().count()
    named = [json.loads(p.read_text()) for p in sorted((tmp_path / "log").glob("*.json"))]
    assert [len(entry) for entry in named] == [3, 1, 1]


def test_archives_per_trigger(spark, folder, tmp_path):
    seen = []
    stream = spark.readStream.format(archive_source.FORMAT).options(log=f"{tmp_path}/log", archivesPerTrigger=1)
    query = (
        stream.load(str(folder)).writeStream.foreachBatch(lambda df, i: seen.append(sorted({r.archive for r in df.collect()})))
        .option("checkpointLocation", f"{tmp_path}/checkpoint").start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    names = [a for batch in seen for a in batch]
    assert all(len(batch) <= 1 for batch in seen) and len(names) == len(set(names)) == 2


def test_a_stream_needs_a_log(spark, folder):
    with pytest.raises(Exception, match="needs the option log"):
        spark.readStream.format(archive_source.FORMAT).load(str(folder)).writeStream.format("noop").start().processAllAvailable()


def test_members_up_to_the_limit_of_a_value_are_whole(spark, tmp_path, monkeypatch):
    """A document longer than a part is still one row; only longer ones are rejects."""
    monkeypatch.setattr(archives, "PART_BYTES", 1_000)
    monkeypatch.setattr(archives, "WHOLE_BYTES", 50_000)
    write(tmp_path / "x.zip", {"long": b"l" * 50_000, "longer": b"l" * 50_001, "short": b"s"})
    members = archives.archive_members(archives.list_archives(spark, str(tmp_path)))
    contents = archives.whole_contents(members, rejects=True)
    texts = {r.member: len(r.v) for r in archives.member_text(contents).collect()}
    assert texts == {"long": 50_000, "short": 1}
    assert [(r.member, r.reason) for r in archives.member_rejects(members, contents).collect()] == [
        ("longer", "too long for one row")
    ]


def test_empty_folder_streams_nothing(spark, tmp_path):
    archive_source.register(spark)
    (tmp_path / "in").mkdir()
    stream = spark.readStream.format(archive_source.FORMAT).options(log=f"{tmp_path}/log").load(str(tmp_path / "in"))
    query = stream.select(F.length("content")).writeStream.format("noop").trigger(availableNow=True)
    query.option("checkpointLocation", f"{tmp_path}/checkpoint").start().awaitTermination()
