"""Listing, ledger, loads that go on, and files that cannot be read."""

import gzip
import os
from datetime import date

import pytest

from hearthline.__main__ import main
from hearthline.operators.quarantine import load_summary, rejected_records
from hearthline.plans.load import listing_table, load_new, stage_files
from hearthline.sources.archive import scan_archive, scan_files, unread_files
from hearthline.sources.ledger import LoadLedger
from hearthline.sources.listing import list_files
from tests.conftest import listing, put_array

ODD = "a b+c%20{d}[e]*ü.json"


def names(df):
    return sorted(row["path"].rsplit("/", 1)[1] for row in df.collect())


def test_every_file_is_listed(spark, tmp_path):
    put_array(tmp_path / "2024/01/02", "a.json", [listing(1)])
    put_array(tmp_path / "2024/01/02/deep", ODD, [listing(2)])
    (tmp_path / "2024/01/02" / "empty.json").write_text("")
    put_array(tmp_path / "2024/01/02", "other.txt", [listing(3)])
    found = list_files(spark, str(tmp_path))
    assert names(found) == sorted(["a.json", ODD, "empty.json", "other.txt"])
    rows = {row["path"]: row for row in found.collect()}
    for path, row in rows.items():
        assert path.startswith("file:/") and row["length"] == os.path.getsize(path[5:])
    assert names(list_files(spark, str(tmp_path), "*.json")) == sorted(["a.json", ODD, "empty.json"])
    assert list_files(spark, str(tmp_path / "absent")).count() == 0


def test_names_are_no_patterns(spark, tmp_path):
    put_array(tmp_path / "in", ODD, [listing(1)])
    put_array(tmp_path / "in", "a bXc.json", [listing(2)])
    found = [row["path"] for row in list_files(spark, str(tmp_path / "in")).filter("path like '%+c%'").collect()]
    assert [row.zpid for row in scan_files(spark, found).collect()] == ["1"]
    assert scan_files(spark, []).count() == 0 and scan_files(spark, [], "lines").count() == 0


def test_new_and_changed_files_are_new(spark, tmp_path):
    ledger = LoadLedger(spark, str(tmp_path / "ledger"))
    put_array(tmp_path / "in", "a.json", [listing(1)])
    (tmp_path / "in" / "empty.json").write_text("")
    first = list_files(spark, str(tmp_path / "in"))
    assert names(ledger.new_files(first)) == ["a.json", "empty.json"]
    ledger.record(first)
    assert names(ledger.new_files(list_files(spark, str(tmp_path / "in")))) == []
    put_array(tmp_path / "in", "b.json", [listing(2)])
    put_array(tmp_path / "in", "empty.json", [listing(3)])
    os.utime(tmp_path / "in" / "a.json", (1, 1))
    assert names(ledger.new_files(list_files(spark, str(tmp_path / "in")))) == ["a.json", "b.json", "empty.json"]
    assert ledger.read().count() == 2


def test_loads_go_on_where_the_last_one_ended(spark, tmp_path, monkeypatch):
    root, ledger = tmp_path / "in", LoadLedger(spark, str(tmp_path / "ledger"))
    table = listing_table(spark, "ledgered", "listings", 2, str(tmp_path / "table"))
    put_array(root / "2024/01/01", "a.json", [listing(1, 10, price=1), listing(2, 10, price=2)])
    put_array(root / "2024/01/02", "b.json", [listing(1, 20, price=3)])
    assert load_new(spark, str(root), ledger, table) == 2
    assert load_new(spark, str(root), ledger, table) == 0
    # A file that comes late for the first day is found, and its older event replaces nothing.
    put_array(root / "2024/01/01", "late.json", [listing(1, 15, price=9), listing(3, 5, price=4)])
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "record", lambda files: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_new(spark, str(root), ledger, table)
    assert load_new(spark, str(root), ledger, table) == 1, "the load that did not end is repeated"
    assert sorted((r.zpid, r.price) for r in table.read().collect()) == [("1", 3), ("2", 2), ("3", 4)]
    # Read: only what is new, by days if they are given, so many at a time.
    for n in range(5):
        put_array(root / f"2024/02/0{n + 1}", "c.json", [listing(10 + n, 30, price=n)])
    read = []
    from hearthline.plans import load as module

    real = module.scan_files
    monkeypatch.setattr(module, "scan_files", lambda spark, files, *a, **k: read.append(list(files)) or real(spark, files, *a, **k))
    assert load_new(spark, str(root), ledger, table, start=date(2024, 2, 5)) == 1
    assert load_new(spark, str(root), ledger, table, max_files=3) == 3
    assert load_new(spark, str(root), ledger, table, max_files=3) == 1
    assert load_new(spark, str(root), ledger, table, max_files=3) == 0
    assert [len(files) for files in read] == [1, 3, 1]
    assert table.read().count() == 8


def test_the_command_loads_what_is_new(spark, tmp_path, capfd):
    root = tmp_path / "in"
    put_array(root / "2024/01/01", "a.json", [listing(1), listing(2)])
    (root / "2024/01/01" / "empty.json").write_text("")
    args = ["load", "--root", str(root), "--layout", "array", "--namespace", "ledger_jobs", "--ledger", str(tmp_path / "l")]
    rejected = ["--rejected", str(tmp_path / "rejected")]
    assert main([*args, *rejected]) == 0 and "2 new files" in capfd.readouterr().out
    assert [r.reject_reason for r in spark.read.json(str(tmp_path / "rejected")).collect()] == ["is empty"]
    for n in range(3):
        put_array(root / "2024/01/02", f"{n}.json", [listing(10 + n)])
    assert main([*args, "--max-files", "2"]) == 0 and "3 new files" in capfd.readouterr().out
    assert main(args) == 0 and "0 new files" in capfd.readouterr().out
    assert spark.table("ledger_jobs.current").count() == 5


def put_broken(folder):
    put_array(folder, "good.json", [listing(1), listing(2)])
    put_array(folder, "none.json", [])
    put_array(folder, "bad.json", [listing(3), listing(4, price="n/a")])
    (folder / "empty.json").write_bytes(b"")
    whole = gzip.compress(b"[" + b",".join(b'{"zpid":"%d"}' % n for n in range(5, 5000)) + b"]")
    (folder / "whole.json.gz").write_bytes(whole)
    (folder / "cut.json.gz").write_bytes(whole[: len(whole) // 2])
    (folder / "not.json.gz").write_bytes(b"this is not gzip")
    (folder / "noise.json").write_bytes(bytes(range(128, 256)))


def test_files_that_cannot_be_read_are_rejected_and_the_others_loaded(spark, tmp_path):
    put_broken(tmp_path / "in")
    staged = stage_files(spark, list_files(spark, str(tmp_path / "in")))
    reasons = {r.source_file.rsplit("/", 1)[1]: r.reject_reason for r in rejected_records(staged).collect()}
    assert reasons == {
        "bad.json": "does not fit the schema",
        "empty.json": "is empty",
        "cut.json.gz": "cannot be read",
        "not.json.gz": "cannot be read",
        "noise.json": "is not UTF-8 text",
    }
    file = load_summary(staged, "file").first().asDict()
    assert file == {"found": 8, "processed": 3, "failed": 5, "loaded": 2 + 4995, "rejected": 6}
    record = load_summary(staged, "record").first().asDict()
    assert record == {"found": 8, "processed": 4, "failed": 4, "loaded": 3 + 4995, "rejected": 5}


def test_a_scan_that_is_not_told_to_skip_fails(spark, tmp_path):
    put_broken(tmp_path / "in")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        scan_archive(spark, str(tmp_path / "in")).collect()
    with pytest.raises(ValueError, match="array layout"):
        scan_archive(spark, str(tmp_path / "in"), layout="lines", skip_broken=True)


def test_only_broken_files(spark, tmp_path):
    (tmp_path / "empty.json").write_bytes(b"")
    staged = stage_files(spark, list_files(spark, str(tmp_path)))
    assert load_summary(staged).first().asDict() == {"found": 1, "processed": 0, "failed": 1, "loaded": 0, "rejected": 1}
    assert unread_files(staged, list_files(spark, str(tmp_path))).count() == 0, "it has a row already"
