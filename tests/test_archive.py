import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from hearthline.operators.curate import curate
from hearthline.operators.quarantine import (
    bad_records,
    file_status,
    good_records,
    load_summary,
    rejected_records,
)
from hearthline.sources.archive import NoInputError, scan_archive
from hearthline.sources.events import event_batch, event_stream
from hearthline.streaming.archive import archive_batch, archive_stream, write_array_files
from hearthline.streaming.queries import drain
from tests.conftest import listing, put_array

DAY = date(2025, 11, 15)


def keys(df):
    return sorted(row.zpid for row in df.select("zpid").collect())


@pytest.fixture
def mixed(tmp_path):
    """Good and bad array files of one day."""
    day = tmp_path / "2025/11/15"
    put_array(day, "good.json", [listing(1), listing(2)])
    put_array(day, "other_extension.txt", json.dumps([listing(3)], indent=2))
    put_array(day, "empty.json", [])
    put_array(day, "one_bad.json", [listing(4), listing(5, price="n/a"), listing(6)])
    put_array(day, "unused_field_bad.json", [listing(7, videoCount="n/a")])
    put_array(day, "null_key.json", [listing(None), listing(8)])
    put_array(day, "truncated.json", '[{"zpid": 9, "price": 1}, {"zpid": 10,')
    put_array(day, "not_an_array.json", '{"zpid": 11}')
    put_array(day, "two_arrays.json", '[{"zpid": 12}] [{"zpid": 13}]')
    put_array(day, "null_record.json", '[null, {"zpid": 14}]')
    put_array(day, "zero.json", "")
    return str(tmp_path)


def test_a_bad_record_fails_its_whole_file(spark, mixed):
    scanned = scan_archive(spark, mixed, DAY)
    assert keys(good_records(scanned, "file")) == ["1", "2", "3"]
    found = {"found": 10, "processed": 3, "failed": 7, "loaded": 3, "rejected": 11}
    assert load_summary(scanned, "file").first().asDict() == found
    found = {"found": 10, "processed": 6, "failed": 4, "loaded": 7, "rejected": 7}
    assert load_summary(scanned).first().asDict() == found


def test_errors_outside_the_selected_columns_still_count(spark, mixed):
    narrow = curate(good_records(scan_archive(spark, mixed, DAY), "file"), {"zpid": "zpid"})
    assert keys(narrow) == ["1", "2", "3"]


def test_record_policy_keeps_the_good_records_of_bad_files(spark, mixed):
    good = good_records(scan_archive(spark, mixed, DAY), "record")
    assert keys(good) == sorted(map(str, (1, 2, 3, 4, 6, 8, 14)))


def test_bad_records_name_their_file(spark, mixed):
    names = bad_records(scan_archive(spark, mixed, DAY)).select(
        F.regexp_extract("source_file", "([^/]+)$", 1)
    )
    assert sorted(row[0] for row in names.collect()) == [
        "not_an_array.json",
        "null_key.json",
        "null_record.json",
        "one_bad.json",
        "truncated.json",
        "two_arrays.json",
        "unused_field_bad.json",
    ]


def test_rejected_records_have_their_text_and_a_reason(spark, mixed):
    rows = rejected_records(scan_archive(spark, mixed, DAY)).collect()
    found = {r.source_file.rsplit("/", 1)[1]: (r.record_index, r.record_text, r.reject_reason) for r in rows}
    index, text, reason = found["one_bad.json"]
    assert (index, json.loads(text)["price"], reason) == (1, "n/a", "does not fit the schema")
    index, text, reason = found["null_key.json"]
    assert (index, json.loads(text)["city"], reason) == (0, "Encino", "has no key")
    assert found["not_an_array.json"][1:] == (None, "is not a JSON array")


def test_file_status_counts(spark, mixed):
    status = file_status(scan_archive(spark, mixed, DAY))
    found = {r.source_file.rsplit("/", 1)[1]: (r.records, r.bad_records) for r in status.collect()}
    assert found["one_bad.json"] == (3, 1) and found["empty.json"] == (0, 0)


def test_every_message_is_decoded_once(spark, mixed):
    text = curate(good_records(scan_archive(spark, mixed, DAY)))._jdf.queryExecution()
    assert text.executedPlan().toString().count("from_json") == 2  # the array, then its records


def test_unknown_policy_and_layout_are_refused(spark, mixed):
    with pytest.raises(ValueError):
        good_records(scan_archive(spark, mixed, DAY), "nothing")
    with pytest.raises(ValueError):
        scan_archive(spark, mixed, DAY, layout="xml")


def test_only_the_asked_days_are_read(spark, tmp_path):
    for day in (13, 14, 15, 16):
        put_array(tmp_path / f"2025/11/{day}", "a.json", [listing(day)])
    scan = lambda *days: keys(scan_archive(spark, str(tmp_path), *days))
    assert scan(date(2025, 11, 14)) == ["14"]
    assert scan(date(2025, 11, 14), date(2025, 11, 15)) == ["14", "15"]
    assert scan(date(2025, 11, 15), date(2025, 12, 24)) == ["15", "16"]
    assert scan() == ["13", "14", "15", "16"]


@pytest.mark.parametrize("make_day", [False, True], ids=["missing", "empty"])
def test_fallback_takes_json_files_at_any_depth(spark, tmp_path, make_day):
    put_array(tmp_path / "x/y", "a.json", [listing(1)])
    put_array(tmp_path, "b.json", [listing(2)])
    put_array(tmp_path, "c.csv", [listing(3)])
    if make_day:
        (tmp_path / "dated/2025/11/15").mkdir(parents=True)
    scanned = scan_archive(spark, str(tmp_path / "dated"), DAY, fallback_root=str(tmp_path))
    assert keys(scanned) == ["1", "2"]


def test_no_input_is_an_error(spark, tmp_path):
    with pytest.raises(NoInputError):
        scan_archive(spark, str(tmp_path / "dated"), DAY, fallback_root=str(tmp_path))
    with pytest.raises(NoInputError):
        scan_archive(spark, str(tmp_path / "nothing"), layout="lines")


def test_random_archive_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    good_files, good, failed = set(), [], 0
    for number in range(60):
        records = [
            {
                "zpid": rng.choice([number * 100 + n, number * 100 + n, str(number * 100 + n), None]),
                "bedrooms": rng.choice([1, 2, 2, 3, None, 2**31, 1.5, True]),
                "lotAreaValue": rng.choice([1, 1.5, 1.5, None, "1.5"]),
                "isFeatured": rng.choice([True, False, True, None, 0]),
                "city": rng.choice(["a", 7, {"b": 1}, None]),
            }
            for n in range(rng.choice([0, 1, 1, 2]))
        ]
        put_array(tmp_path, f"{number}.json", records)

        def fits(record):
            rooms, lot, flag = (record[k] for k in ("bedrooms", "lotAreaValue", "isFeatured"))
            return (
                record["zpid"] is not None
                and (rooms is None or (type(rooms) is int and -(2**31) <= rooms < 2**31))
                and (lot is None or type(lot) in (int, float))
                and (flag is None or type(flag) is bool)
            )

        if all(map(fits, records)):
            good_files.add(number)
            good += [str(record["zpid"]) for record in records]
        else:
            failed += 1
    scanned = scan_archive(spark, str(tmp_path))
    assert keys(good_records(scanned, "file")) == sorted(good) and good
    summary = load_summary(scanned, "file").first()
    assert (summary.found, summary.processed, summary.failed) == (60, len(good_files), failed)
    assert summary.loaded == len(good)


def lines(spark, *records):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(texts, "value string")


def test_lines_layout_round_trip_by_day(spark, tmp_path):
    root = str(tmp_path)
    for day, key in (("2025-11-15", 1), ("2025-11-16", 2), ("2025-12-05", 3)):
        pretty = json.dumps(listing(key), indent=1)
        archive_batch(lines(spark, pretty), root, F.to_timestamp(F.lit(day)))
    assert (tmp_path / "year=2025/month=12/day=05").is_dir()
    scan = lambda *days: scan_archive(spark, root, *days, layout="lines")
    assert keys(scan()) == ["1", "2", "3"]
    assert keys(scan(date(2025, 11, 16), date(2025, 12, 31))) == ["2", "3"]
    files = scan(date(2025, 12, 5)).inputFiles()
    assert len(files) == 1 and "/month=12/day=05/" in files[0], "no other day is listed"
    with pytest.raises(NoInputError):
        scan(date(2024, 1, 1))


def test_stream_and_batches_share_a_root(spark, tmp_path):
    root, source = str(tmp_path / "root"), str(tmp_path / "in")
    when = F.to_timestamp(F.lit("2025-11-15"))
    archive_batch(lines(spark, listing(1)), root, when)
    lines(spark, listing(2), listing(3)).write.text(source)
    for number in range(2):  # another checkpoint archives the same messages again
        stream = event_stream(spark, "text", path=source)
        drain(archive_stream(stream, root, str(tmp_path / f"c{number}"), {"availableNow": True}, when))
    archive_batch(lines(spark, listing(4)), root, when)
    for days in ((), (DAY,)):
        found = scan_archive(spark, root, *days, layout="lines")
        assert keys(good_records(found)) == ["1", "2", "2", "3", "3", "4"]


def test_a_batch_that_runs_again_replaces_its_files(spark, tmp_path):
    root, source = str(tmp_path / "root"), str(tmp_path / "in")
    lines(spark, listing(1), listing(2)).write.text(source)
    checkpoint = tmp_path / "c"
    for _ in range(2):
        stream = event_stream(spark, "text", path=source)
        drain(archive_stream(stream, root, str(checkpoint), {"availableNow": True}))
        for commit in (checkpoint / "commits").iterdir():  # as if it had died before the commit
            commit.unlink()
    assert keys(scan_archive(spark, root, layout="lines")) == ["1", "2"]


def test_array_files_leave_out_what_is_not_json(spark, tmp_path):
    messages = lines(spark, *map(listing, range(9)), "not json").coalesce(1)
    with pytest.raises(ValueError, match="not JSON"):
        write_array_files(messages, str(tmp_path / "a"))
    write_array_files(messages, str(tmp_path / "a"), rejected=str(tmp_path / "r"))
    assert len(keys(good_records(scan_archive(spark, str(tmp_path / "a")), "file"))) == 9
    assert [row.value for row in spark.read.text(str(tmp_path / "r")).collect()] == ["not json"]


def test_lines_layout_policies(spark, tmp_path):
    root = str(tmp_path)
    when = F.to_timestamp(F.lit("2025-11-15"))
    archive_batch(lines(spark, listing(1), "", "not json", listing(2)).coalesce(1), root, when)
    archive_batch(lines(spark, listing(3), listing(3)).coalesce(1), root, when)
    scanned = scan_archive(spark, root, layout="lines")
    assert keys(good_records(scanned)) == ["1", "2", "3", "3"]
    assert keys(good_records(scanned, "file")) == ["3", "3"]
    summary = load_summary(scanned, "file").first()
    assert (summary.found, summary.processed, summary.failed) == (2, 1, 1)
    rejected = rejected_records(scanned).collect()
    assert [(r.record_text, r.reject_reason) for r in rejected] == [("not json", "does not fit the schema")]


def test_lines_layout_checks_fields_nobody_selects(spark, tmp_path):
    bad = (listing(2, videoCount="n/a"), listing(None), listing(3, price=1.5), listing(4, x=1))
    archive_batch(lines(spark, listing(1), *bad).coalesce(1), str(tmp_path), F.current_timestamp())
    scanned = scan_archive(spark, str(tmp_path), layout="lines")
    for policy, good in (("record", ["1", "4"]), ("file", [])):
        narrow = curate(good_records(scanned, policy), {"zpid": "zpid"})
        assert keys(narrow) == good
    assert bad_records(scanned).count() == 3


def test_messages_can_be_read_once(spark, tmp_path):
    lines(spark, listing(1), listing(2)).write.text(str(tmp_path / "in"))
    assert event_batch(spark, "text", path=str(tmp_path / "in")).count() == 2


def test_array_writer_makes_small_files(spark, tmp_path):
    df = spark.range(25).select(F.to_json(F.struct(F.col("id").alias("zpid"))).alias("value"))
    write_array_files(df.coalesce(1), str(tmp_path / "a"))
    files = [json.loads(f.read_text()) for f in (tmp_path / "a").glob("part-*")]
    assert sorted(map(len, files)) == [5, 10, 10]
    assert len(keys(good_records(scan_archive(spark, str(tmp_path / "a"))))) == 25


def test_stream_archive_restarts_without_loss_or_repeats(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def run():
        messages = event_stream(spark, "text", path=source, max_files_per_trigger=1)
        drain(archive_stream(messages, out, checkpoint, {"availableNow": True}))

    for first in (0, 10, 20):
        lines(spark, *(listing(first + n) for n in range(10))).coalesce(1).write.mode("append").text(source)
        if first != 10:
            run()
    run()
    archived = scan_archive(spark, out, layout="lines")
    assert sorted(int(r.zpid) for r in archived.collect()) == list(range(30))
