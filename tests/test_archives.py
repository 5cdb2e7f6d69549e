from __future__ import annotations

import json
import random
import zipfile

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from docketspark.plans.watch import archive_catalog, archive_rejects
from docketspark.sources import archives


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(3)
    with zipfile.ZipFile(tmp_path / "one.zip", "w", compression=zipfile.ZIP_DEFLATED) as z:
        z.writestr("file1.txt", "this will become a zip file")
        z.writestr("dir/", b"")
        z.writestr("dir/empty.txt", b"")
        z.writestr("dir/zeros.bin", b"\0" * 3_000_000)
        z.writestr("dir/noise.bin", rng.randbytes(2_500_000))
        z.writestr("stored é.bin", rng.randbytes(100_000), zipfile.ZIP_STORED)
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("file1.txt", "same name, other archive")
    (tmp_path / "note.txt").write_text("not an archive")
    return tmp_path


def expected(folder):
    found = {}
    for name in ("one.zip", "two.zip"):
        with zipfile.ZipFile(folder / name) as z:
            for info in z.infolist():
                if not info.is_dir():
                    found[(name, info.filename)] = z.read(info)
    return found


def joined(rows):
    parts = {}
    for row in sorted(rows, key=lambda r: r.part):
        key = (row.archive.rsplit("/", 1)[-1], row.member)
        parts[key] = parts.get(key, b"") + bytes(row.content)
    return parts


def test_members_equal_what_a_direct_reading_gives(spark, folder):
    listed = archives.list_archives(spark, str(folder))
    assert listed.count() == 2
    members = archives.archive_members(listed)
    assert members.count() == len(expected(folder))
    contents = archives.archive_contents(members)
    assert joined(contents.collect()) == expected(folder)


def test_long_members_come_in_parts_and_whole(spark, folder):
    members = archives.archive_members(archives.list_archives(spark, str(folder)))
    rows = archives.archive_contents(members, part_bytes=700_000).collect()
    assert max(row.part for row in rows) >= 3
    assert max(len(row.content) for row in rows) <= 700_000 + 300
    assert joined(rows) == expected(folder)


def test_only_wanted_members_are_read(spark, folder):
    members = archives.archive_members(archives.list_archives(spark, str(folder)))
    rows = archives.archive_contents(members.where(F.col("member") == "file1.txt")).collect()
    assert sorted(bytes(r.content) for r in rows) == [
        b"same name, other archive", b"this will become a zip file",
    ]


def test_archive_kept_as_it_is(spark, folder):
    row = archives.list_archives(spark, str(folder)).where(F.col("archive").endswith("two.zip")).first()
    assert row.length == (folder / "two.zip").stat().st_size


def test_unsupported_method_is_an_error_not_a_gap(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_BZIP2) as z:
        z.writestr("a", "data")
    members = archives.archive_members(archives.list_archives(spark, str(tmp_path)))
    with pytest.raises(PythonException, match="unsupported method"):
        archives.archive_contents(members).collect()


def test_members_too_long_for_a_row_are_rejects(spark, folder, monkeypatch):
    monkeypatch.setattr(archives, "WHOLE_BYTES", 1_000_000)
    members = archives.archive_members(archives.list_archives(spark, str(folder)))
    contents = archives.whole_contents(members, rejects=True)
    assert {r.member for r in archives.member_text(contents).collect()} == {
        "file1.txt", "dir/empty.txt",
    }
    rejects = archives.member_rejects(members, contents).collect()
    assert {(r.member, r.reason) for r in rejects} == {
        ("dir/zeros.bin", "too long for one row"), ("dir/noise.bin", "too long for one row"),
        ("stored é.bin", "not UTF-8"),
    }


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_damaged_members_are_errors_or_rejects(spark, tmp_path, method):
    data = random.Random(1).randbytes(5_000)
    with zipfile.ZipFile(tmp_path / "x.zip", "w", method) as z:
        z.writestr("bad", data)
        z.writestr("good", b"sound")
    raw = bytearray((tmp_path / "x.zip").read_bytes())
    raw[2_000] ^= 0x55
    (tmp_path / "x.zip").write_bytes(raw)
    members = archives.archive_members(archives.list_archives(spark, str(tmp_path)))
    with pytest.raises(PythonException, match="checksum|damaged|bytes, not"):
        archives.archive_contents(members).collect()
    contents = archives.archive_contents(members, rejects=True)
    assert [r.v for r in archives.member_text(contents).collect()] == ["sound"]
    (reject,) = archives.member_rejects(members, contents).collect()
    assert reject.member == "bad" and reject.reason != "not UTF-8"


@pytest.mark.parametrize("length", [0, 10, 31])
def test_data_that_ends_early_is_an_error_not_a_loop(length):
    import io

    packed = zipfile.ZIP_DEFLATED if length == 31 else zipfile.ZIP_STORED
    header = b"PK\x03\x04" + bytes(22) + b"\x00\x00\x00\x00"
    entry = {"archive": "a", "member": "m", "offset": 0, "method": packed, "length": 100,
             "compressed_length": 100, "crc": 0}
    with pytest.raises(ValueError, match="cut short"):
        list(archives._inflate(io.BytesIO(header + b"x" * length), entry, 64))


def test_cut_archives_are_errors(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("a", "data")
    raw = (tmp_path / "x.zip").read_bytes()
    (tmp_path / "x.zip").write_bytes(raw[:-30])
    with pytest.raises(PythonException, match="no ZIP archive"):
        archives.archive_members(archives.list_archives(spark, str(tmp_path))).collect()


def test_directories_with_wide_fields_and_leading_data(tmp_path):
    path = tmp_path / "wide.zip"
    with zipfile.ZipFile(path, "w") as z:
        for n in range(66_000):  # more entries than the plain end record can count
            z.writestr(zipfile.ZipInfo(f"m{n}"), b"")
        with z.open(zipfile.ZipInfo("wide"), "w", force_zip64=True) as out:
            out.write(b"x" * 1000)
    (tmp_path / "shifted.zip").write_bytes(b"#!/bin/sh\n" + path.read_bytes())
    for name, before in (("wide.zip", 0), ("shifted.zip", 10)):
        with open(tmp_path / name, "rb") as handle:
            found = list(archives._entries(name, handle))
            assert len(found) == 66_001
            entry = dict(zip(archives._MEMBER_ARROW.names, found[-1], strict=True))
            assert entry["offset"] >= before
            assert b"".join(archives._inflate(handle, entry, 300)) == b"x" * 1000


def test_documents_without_rows_are_reported(spark, tmp_path):
    sound = {"filings": {"recent": {n: ["a"] for n in (
        "form", "accessionNumber", "filingDate", "primaryDocument", "fileNumber")}}}
    short = {"filings": {"recent": {**sound["filings"]["recent"], "form": []}}}
    with zipfile.ZipFile(tmp_path / "s.zip", "w") as z:
        z.writestr("CIK0000000001.json", json.dumps(sound))
        z.writestr("CIK0000000002.json", json.dumps(short))
        z.writestr("CIK0000000003.json", "{cut")
    zips = archives.list_archives(spark, str(tmp_path))
    assert [r.cik for r in archive_catalog(zips).collect()] == ["0000000001"]
    assert sorted(r.member for r in archive_rejects(zips).collect()) == [
        "CIK0000000002.json", "CIK0000000003.json",
    ]


def test_catalog_from_an_archive(spark, tmp_path):
    doc = {
        "filings": {
            "recent": {
                "form": ["4"], "accessionNumber": ["0000000001-20-000007"],
                "filingDate": ["2020-01-02"], "primaryDocument": ["x/a.xml"], "fileNumber": ["001-1"],
            }
        }
    }
    with zipfile.ZipFile(tmp_path / "submissions.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for key in range(1, 40):
            z.writestr(f"CIK{key:010d}.json", json.dumps(doc))
        z.writestr("readme.txt", "x")
    rows = archive_catalog(archives.list_archives(spark, str(tmp_path))).collect()
    assert sorted(row.cik for row in rows) == [f"{key:010d}" for key in range(1, 40)]
