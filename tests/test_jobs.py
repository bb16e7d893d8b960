"""Sync, ledger, merge, maintenance, restore and streaming jobs, end to end on files."""

import os
import random
import time
from datetime import date, datetime, timedelta, timezone
from uuid import uuid4

import pytest
from support import rows
from pyspark.sql import functions as F

from changevault.model import (
    ChangeVaultError, ColumnDef, DriftHalted, NothingToRestore, ObjectSpec, PartitionBy, RequiredValueMissing,
)
from changevault.objects import STANDARD_OBJECTS
from changevault.operators.watermark import (
    drop_seen, incremental, job_start_watermark, watermarks,
)
from changevault.plans.current import merge_all, read_current, refresh_current
from changevault.plans.maintain import compact, expire
from changevault.plans.restore import restore_export, restore_preview
from changevault.plans.sync import sync_all, sync_object, sync_violations
from changevault.operators.latest import latest_per_key, table_as_of
from changevault.operators.merge import VERSION, merge_state, versioned
from changevault.sources.canonical import read_ids, register_ids
from changevault.sources.current import read_state
from changevault.sources.extract import read_extract
from changevault.sources.ledger import get_watermark, history, live_commits, read_ledger
from changevault.sources.raw import append_raw, columns_of, read_columns, read_raw, read_rejects, stage, stamp_rows
from changevault.streaming.current import current_stream
from changevault.streaming.sync import sync_stream

LEAD = ObjectSpec("Lead", partition_by=(PartitionBy("SystemModstamp", "day"),))
FIELDS = (("Id", "id", False), ("SystemModstamp", "datetime", False), ("IsDeleted", "boolean", False))
F1 = (
    "Id,SystemModstamp,IsDeleted\n"
    "001,2024-01-01T00:00:00.000+0000,false\n"
    "002,2024-01-02T00:00:00.000+0000,true\n"
    "003,2024-01-03T00:00:00.000+0000,false\n"
)
UTC = timezone.utc


def catalog(spark, *fields, objects=("Lead",)):
    return spark.createDataFrame(
        [(o, n, t, nil) for o in objects for n, t, nil in (fields or FIELDS)],
        "object string, name string, type string, nillable boolean",
    )


def extract(tmp_path, name, text):
    folder = tmp_path / "extract" / name
    os.makedirs(folder, exist_ok=True)
    (folder / "page1.csv").write_text(text)
    return str(folder)


def test_sync_writes_and_advances(spark, tmp_path, root):
    path = extract(tmp_path, "a", F1)
    result = sync_object(spark, LEAD, path, catalog(spark), root, sync_id="s1", job_id="job1", max_records_per_file=2)
    assert result.rows == 3 and result.watermark == datetime(2024, 1, 3, tzinfo=UTC)
    raw = read_raw(spark, LEAD, root)
    assert rows(raw.select("Id", "IsDeleted", "_sync_id")) == [("001", False, "s1"), ("002", True, "s1"), ("003", False, "s1")]
    assert get_watermark(spark, root, "Lead") == datetime(2024, 1, 3, tzinfo=UTC)
    assert get_watermark(spark, root, "Other") is None
    # Same sync id again: skipped. New id, same extract: all rows are at or before the watermark.
    assert sync_object(spark, LEAD, path, catalog(spark), root, sync_id="s1").skipped
    again = sync_object(spark, LEAD, path, catalog(spark), root, sync_id="s2")
    assert again.rows == 0 and again.commit_id is None and again.watermark == datetime(2024, 1, 3, tzinfo=UTC)
    assert read_raw(spark, LEAD, root).count() == 3
    row = watermarks(read_ledger(spark, root)).first()
    assert (row.object, row.last_job_id) == ("Lead", "job1")


def test_empty_extract(spark, tmp_path, root):
    result = sync_object(spark, LEAD, extract(tmp_path, "a", "Id,SystemModstamp,IsDeleted\n"), catalog(spark), root)
    assert result.rows == 0 and result.watermark is None
    assert read_raw(spark, LEAD, root).count() == 0


def test_failed_sync_changes_nothing(spark, tmp_path, root):
    sync_object(spark, LEAD, extract(tmp_path, "a", F1), catalog(spark), root)
    bad = extract(tmp_path, "b", "Id,SystemModstamp,IsDeleted\n004,2024-01-04T00:00:00Z,false\n005,2024-01-05T00:00:00Z,maybe\n")
    with pytest.raises(Exception, match="column IsDeleted: cannot read 'maybe' as boolean in record '005'"):
        sync_object(spark, LEAD, bad, catalog(spark), root)
    assert get_watermark(spark, root, "Lead") == datetime(2024, 1, 3, tzinfo=UTC)
    assert read_raw(spark, LEAD, root).count() == 3
    with pytest.raises(Exception):
        sync_object(spark, LEAD, str(tmp_path / "nowhere"), catalog(spark), root)


def test_rejected_rows_are_set_aside(spark, tmp_path, root):
    spec = ObjectSpec("Lead", "Id", partition_by=LEAD.partition_by)
    fields = catalog(spark, *FIELDS, ("Amount", "double", True), ("Note", "string", True))
    head = "Id,SystemModstamp,IsDeleted,Amount,Note\n"
    page = extract(tmp_path, "a", head + (
        "1,2024-01-01T00:00:00Z,false,1.5,fine\n2,2024-01-02T00:00:00Z,maybe,x,both\n3,yesterday,true,,stamp\n"
        "4,2024-01-03T00:00:00Z,true,,no amount\n"))
    done = sync_object(spark, spec, page, fields, root, sync_id="s1", on_error="reject")
    assert (done.rows, done.rejects, done.watermark) == (2, 2, datetime(2024, 1, 3, tzinfo=UTC))
    assert rows(read_raw(spark, spec, root).select("Id", "Amount", "Note")) == [("1", 1.5, "fine"), ("4", None, "no amount")]
    told = read_rejects(spark, spec, root)
    assert rows(told.drop("page")) == [
        ("s1", "2", "Amount", "x"), ("s1", "2", "IsDeleted", "maybe"), ("s1", "3", "SystemModstamp", "yesterday")]
    assert told.where("page LIKE '%page1.csv'").count() == 3
    # a row whose stamp cannot be read is not lost behind the watermark; one whose stamp is old is no news
    later = extract(tmp_path, "b", head + "5,tomorrow,true,,late\n6,2024-01-01T00:00:00Z,no,,old\n7,2024-02-01T00:00:00Z,true,,new\n")
    done = sync_object(spark, spec, later, fields, root, sync_id="s2", on_error="reject")
    assert (done.rows, done.rejects) == (1, 1)
    assert rows(read_rejects(spark, spec, root, "s2").select("record_key")) == [("5",)]
    # all rows rejected: nothing gets in, the rejects are kept, the watermark stays
    bad = extract(tmp_path, "c", head + "8,2024-03-01T00:00:00Z,perhaps,,\n")
    done = sync_object(spark, spec, bad, fields, root, sync_id="s3", on_error="reject")
    assert (done.rows, done.rejects, done.commit_id, done.watermark) == (0, 1, None, datetime(2024, 2, 1, tzinfo=UTC))
    assert read_raw(spark, spec, root).count() == 3 and read_rejects(spark, spec, root).count() == 5
    # the typed part equals on_error="null" without the rejected rows
    other = str(tmp_path / "other")
    sync_object(spark, spec, page, fields, other, sync_id="s1", on_error="null")
    columns = ["Id", "SystemModstamp", "IsDeleted", "Amount", "Note"]
    assert rows(read_raw(spark, spec, other).where("Id NOT IN ('2', '3')").select(columns)) == rows(
        read_raw(spark, spec, root).where("_sync_id = 's1'").select(columns))
    # nothing to reject, and a key that is NULL
    fine = sync_object(spark, spec, extract(tmp_path, "d", head + "9,2024-04-01T00:00:00Z,true,,\n"), fields, root, on_error="reject")
    assert (fine.rows, fine.rejects) == (1, 0) and read_rejects(spark, spec, root).count() == 5
    with pytest.raises(ValueError):
        sync_object(spark, spec, page, fields, root, on_error="ignore")


def test_missing_key_is_refused(spark, root):
    df = spark.createDataFrame([("1", 1.0), (None, 2.0)], "Id string, Amount double")
    with pytest.raises(RequiredValueMissing):
        append_raw(df, ObjectSpec("Lead"), root, "s1")
    assert read_raw(spark, ObjectSpec("Lead"), root).count() == 0


def test_watermark_never_moves_back(spark, tmp_path, root):
    df = lambda d: spark.sql(f"SELECT '1' AS Id, timestamp'{d} 00:00:00' AS SystemModstamp, false AS IsDeleted")
    append_raw(df("2024-01-05"), LEAD, root, "s1")
    append_raw(df("2024-01-02"), LEAD, root, "s2")
    assert get_watermark(spark, root, "Lead") == datetime(2024, 1, 5, tzinfo=UTC)
    assert watermarks(read_ledger(spark, root)).select(F.unix_micros("watermark")).first()[0] == 1704412800000000


def test_job_start_strategy_and_overlap(spark, tmp_path, root):
    assert job_start_watermark("2026-04-25T09:00:00Z") == datetime(2026, 4, 25, 8, 55, tzinfo=UTC)
    first = extract(tmp_path, "a", F1)
    start = "2024-01-02T00:04:00Z"
    result = sync_object(spark, LEAD, first, catalog(spark), root, job_start=start, strategy="job_start")
    assert result.watermark == datetime(2024, 1, 1, 23, 59, tzinfo=UTC)
    second = extract(tmp_path, "b", F1 + "002,2024-01-04T00:00:00Z,false\n002,2024-01-04T00:00:00Z,false\n")
    result = sync_object(
        spark, LEAD, second, catalog(spark), root, job_start="2024-01-05T00:00:00Z", strategy="job_start",
        dedupe_overlap=True,
    )
    assert result.rows == 1
    assert read_raw(spark, LEAD, root).count() == 4


def test_drop_seen_keeps_rows_without_stamp(spark):
    spec = ObjectSpec("x", "k", "t")
    make = lambda *r: spark.createDataFrame(list(r), "k string, t timestamp_ntz, n int")
    t = [datetime(2024, 1, d) for d in (1, 2, 3)]
    batch = make(("a", t[1], 1), ("a", t[2], 2), ("a", t[2], 3), ("b", None, 4), ("b", None, 4))
    seen = make(("a", t[1], 9), ("a", t[0], 9))
    assert rows(drop_seen(batch, seen, spec, tiebreak=["n"]).select("k", "n")) == [("a", 3), ("b", 4), ("b", 4)]
    assert rows(drop_seen(batch, seen, spec, since="2024-01-02T00:00:00Z", tiebreak=["n"]).select("n")) == [(1,), (3,), (4,), (4,)]


def test_incremental_is_exclusive(spark):
    df = spark.sql("SELECT explode(array(timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:00.000001')) AS SystemModstamp")
    assert incremental(df, LEAD, "2024-01-01T00:00:00Z").count() == 1
    assert incremental(df, LEAD, None).count() == 2
    assert incremental(df, LEAD, "").count() == 2


def test_drift_policies(spark, tmp_path, root):
    wide = (*FIELDS, ("ExtraCol", "string", True), ("PhotoUrl", "url", True))
    text = F1.replace("\n", ",x\n").replace("IsDeleted,x", "IsDeleted,ExtraCol")
    sync_object(spark, LEAD, extract(tmp_path, "a", text), catalog(spark, *wide), root, sync_id="s1")
    halt = ObjectSpec("Lead", partition_by=LEAD.partition_by, removed_field_policy="halt")
    fresh = extract(tmp_path, "b", "Id,SystemModstamp,IsDeleted,New\n009,2024-02-01T00:00:00Z,false,hello\n")
    changed = catalog(spark, *FIELDS, ("PhotoUrl", "url", True), ("New", "int", True))
    with pytest.raises(DriftHalted, match="ExtraCol"):
        sync_object(spark, halt, fresh, changed, root)
    # Still at the source but excluded: no removal, even under halt.
    excluded = ObjectSpec("Lead", partition_by=LEAD.partition_by, removed_field_policy="halt", exclude_fields=("PhotoUrl",))
    text = F1.replace("2024-01", "2024-02").replace("\n", ",x\n").replace("IsDeleted,x", "IsDeleted,ExtraCol")
    assert sync_object(spark, excluded, extract(tmp_path, "c", text), catalog(spark, *wide), root).rows == 3
    # Tombstone: the column stays, new rows are NULL there; the new field becomes a column.
    textual = catalog(spark, ("Id", "int", False), *FIELDS[1:], ("PhotoUrl", "url", True), ("New", "string", True))
    later = extract(tmp_path, "d", "Id,SystemModstamp,IsDeleted,New\n009,2024-03-01T00:00:00Z,false,hello\n")
    result = sync_object(spark, LEAD, later, textual, root)
    assert (result.new_columns, result.removed_columns, result.type_changes) == (("New",), ("ExtraCol",), ("Id",))
    got = read_raw(spark, LEAD, root)
    assert rows(got.where("Id = '009'").select("Id", "ExtraCol", "New")) == [("009", None, "hello")]
    assert got.where("Id != '009' AND New IS NULL").count() == 6
    assert [c.name for c in read_columns(spark, LEAD, root)] == [n for n, _, _ in wide] + ["New"]


def test_overflow_mode(spark, tmp_path, root):
    spec = ObjectSpec("Lead", overflow=True, removed_field_policy="halt")
    sync_object(spark, spec, extract(tmp_path, "a", F1), catalog(spark), root)
    wide = catalog(spark, *FIELDS, ("Zip", "string", True), ("Area", "double", True))
    text = "Id,SystemModstamp,IsDeleted,Zip,Area\n009,2024-02-01T00:00:00Z,false,12345,1.5\n"
    sync_object(spark, spec, extract(tmp_path, "b", text), wide, root)
    got = read_raw(spark, spec, root)
    assert rows(got.select("Id", "_overflow")) == [
        ("001", None), ("002", None), ("003", None), ("009", '{"Area":"1.5","Zip":"12345"}'),
    ]
    assert [c.name for c in read_columns(spark, spec, root)] == ["Id", "SystemModstamp", "IsDeleted"]


def test_required_violations_are_reported(spark, tmp_path, root):
    text = "Id,SystemModstamp,IsDeleted\n001,2024-01-01T00:00:00Z,\n"
    result = sync_object(spark, LEAD, extract(tmp_path, "a", text), catalog(spark), root)
    assert rows(sync_violations(spark, LEAD, root, result.commit_id)) == [("IsDeleted", 1)]


def test_sync_all_standard_objects(spark, tmp_path, root):
    objects = [s.name for s in STANDARD_OBJECTS]
    fields = catalog(spark, *FIELDS, ("StageName", "picklist", True), objects=objects)
    paths = {
        n: extract(tmp_path, n, F1 if n == "Opportunity" else "Id,SystemModstamp,IsDeleted\n") for n in objects
    }
    results = sync_all(spark, STANDARD_OBJECTS, paths, fields, root)
    assert [(r.object, r.rows) for r in results] == [(n, 3 if n == "Opportunity" else 0) for n in objects]
    one = sync_all(spark, STANDARD_OBJECTS, paths, fields, root, only="Lead")
    assert [r.object for r in one] == ["Lead"]
    with pytest.raises(ValueError, match="Nope"):
        sync_all(spark, STANDARD_OBJECTS, paths, fields, root, only="Nope")


def test_first_error_cancels_the_rest(spark, tmp_path, root):
    specs = [ObjectSpec(n) for n in ("A", "B", "C")]
    paths = {"A": extract(tmp_path, "A", F1.replace("true", "maybe")), "B": extract(tmp_path, "B", F1), "C": extract(tmp_path, "C", F1)}
    with pytest.raises(Exception, match="maybe"):
        sync_all(spark, specs, paths, catalog(spark, objects="ABC"), root, max_in_flight=1)
    assert get_watermark(spark, root, "C") is None


def test_unpublished_attempt_is_invisible(spark, root):
    df = spark.sql("SELECT '1' AS Id, timestamp'2024-01-05 00:00:00' AS SystemModstamp, false AS IsDeleted")
    append_raw(df, LEAD, root, "s1")
    columns = columns_of(df)
    stage(stamp_rows(df, columns, "lost", datetime.now(UTC)), LEAD, root, columns)
    assert read_raw(spark, LEAD, root).count() == 1
    with pytest.raises(ChangeVaultError, match="no table"):
        read_raw(spark, ObjectSpec("Nope"), root)


def leads(spark, *data):
    stamped = [(i, n, datetime.fromisoformat(t).replace(tzinfo=UTC), d) for i, n, t, d in data]
    return spark.createDataFrame(stamped, "Id string, Name string, SystemModstamp timestamp, IsDeleted boolean")


def test_merge_follows_schema_and_commits(spark, root):
    append_raw(leads(spark, ("1", "a", "2024-01-01", False), ("2", "b", "2024-01-01", False)), LEAD, root, "s1")
    assert len(refresh_current(spark, LEAD, root).merged) == 1
    assert refresh_current(spark, LEAD, root).commit_id is None
    append_raw(leads(spark, ("1", "a2", "2024-01-02", False), ("2", "b", "2024-01-02", True)), LEAD, root, "s2")
    append_raw(leads(spark, ("3", "c", "2024-01-01", True)), LEAD, root, "s3")
    assert len(refresh_current(spark, LEAD, root).merged) == 2
    assert rows(read_current(spark, LEAD, root).select("Id", "Name")) == [("1", "a2")]
    # An older row of a deleted key arrives late.
    append_raw(leads(spark, ("2", "old", "2023-12-31", False)), LEAD, root, "s4")
    refresh_current(spark, LEAD, root)
    assert rows(read_current(spark, LEAD, root).select("Id")) == [("1",)]
    before = rows(read_current(spark, LEAD, root))
    refresh_current(spark, LEAD, root, full=True)
    assert rows(read_current(spark, LEAD, root)) == before


def test_merge_sees_evolved_columns(spark, tmp_path, root):
    sync_object(spark, LEAD, extract(tmp_path, "a", F1), catalog(spark), root)
    merge_all(spark, [LEAD], root)
    text = "Id,SystemModstamp,IsDeleted,New\n001,2024-02-01T00:00:00Z,false,7\n"
    sync_object(spark, LEAD, extract(tmp_path, "b", text), catalog(spark, *FIELDS, ("New", "int", True)), root)
    merge_all(spark, [LEAD], root)
    assert rows(read_current(spark, LEAD, root).select("Id", "New")) == [("001", 7), ("003", None)]


def test_merge_all_goes_on_after_a_failure(spark, root):
    other = ObjectSpec("Other")
    append_raw(leads(spark, ("1", "a", "2024-01-01", False)), other, root, "s1")
    with pytest.raises(ChangeVaultError, match="Missing"):
        merge_all(spark, [ObjectSpec("Missing"), other], root)
    assert read_current(spark, other, root).count() == 1


def test_merge_after_compaction_of_unmerged_commits(spark, root):
    append_raw(leads(spark, ("1", "a", "2024-01-01", False)), LEAD, root, "s1")
    append_raw(leads(spark, ("2", "b", "2024-01-01", False)), LEAD, root, "s2")
    assert len(compact(spark, LEAD, root, day=date(2024, 1, 1)).replaced) == 2
    refresh_current(spark, LEAD, root)
    assert rows(read_current(spark, LEAD, root).select("Id")) == [("1",), ("2",)]
    assert refresh_current(spark, LEAD, root).commit_id is None
    append_raw(leads(spark, ("3", "c", "2024-01-01", False)), LEAD, root, "s3")
    assert len(refresh_current(spark, LEAD, root).merged) == 1


def test_compact_keeps_rows(spark, root):
    for i in range(4):
        append_raw(leads(spark, (str(i), "x", f"2024-01-04T0{i}:00:00", False)), LEAD, root, f"s{i}")
    raw_before = rows(read_raw(spark, LEAD, root).drop("_commit"))
    day = date(2024, 1, 4)
    assert compact(spark, LEAD, root, day=day - timedelta(days=3)).replaced == ()
    planned = compact(spark, LEAD, root, day=day, dry_run=True)
    assert (len(planned.replaced), planned.rows, planned.files, planned.commits) == (4, 4, 4, ()) and planned.bytes > 0
    assert len(history(spark, root, "Lead").live) == 4
    result = compact(spark, LEAD, root, day=day)
    assert len(result.replaced) == 4 and result.rows == 4 and result.bytes == planned.bytes
    assert history(spark, root, "Lead").live == [result.commit_id]
    assert [r.commit_id for r in live_commits(read_ledger(spark, root)).collect()] == [result.commit_id]
    assert rows(read_raw(spark, LEAD, root).drop("_commit")) == raw_before
    assert get_watermark(spark, root, "Lead") == datetime(2024, 1, 4, 3, tzinfo=UTC)


def day_of_leads(spark, root, day, syncs=2, n=10):
    for sync in range(syncs):
        data = [(f"{sync}-{i}", "x", f"2024-01-{day:02d}T{sync:02d}:00:{i:02d}", False) for i in range(n)]
        append_raw(leads(spark, *data), LEAD, root, uuid4().hex)


def test_compaction_of_five_days_rewrites_each_row_once(spark, root):
    rewritten = []
    for day in range(1, 6):
        day_of_leads(spark, root, day)
        rewritten.append(compact(spark, LEAD, root, day=date(2024, 1, day)).rows)
        assert compact(spark, LEAD, root, day=date(2024, 1, day)).rows == 0
    assert rewritten == [20] * 5 and read_raw(spark, LEAD, root).count() == 100
    # the default day is yesterday, of which there is nothing
    assert compact(spark, LEAD, root).replaced == ()


def test_compaction_of_a_growing_day_rewrites_in_size_classes(spark, root):
    rewritten = []
    for _ in range(9):
        day_of_leads(spark, root, 1, n=2)
        rewritten.append(compact(spark, LEAD, root, day=date(2024, 1, 1), fan_in=4).rows)
    # a packed commit is taken up again once four times its rows stand together
    assert rewritten == [4, 4, 4, 16, 4, 4, 4, 16, 4]
    assert read_raw(spark, LEAD, root).count() == 36 and len(history(spark, root, "Lead").live) == 3
    assert compact(spark, LEAD, root, day=date(2024, 1, 1), file_bytes=1).replaced == ()


def test_large_files_are_not_packed(spark, root):
    day_of_leads(spark, root, 1)
    assert compact(spark, LEAD, root, day=date(2024, 1, 1), file_bytes=1000).replaced == ()
    assert len(compact(spark, LEAD, root, day=date(2024, 1, 1)).replaced) == 2


def test_a_baseline_stays_one(spark, root):
    for day in range(1, 5):
        day_of_leads(spark, root, day)
    window = dict(keep_days=0, as_of="2024-01-03T00:00:00Z")
    first = expire(spark, LEAD, root, **window)
    baseline = first.commit_id
    before = rows(table_as_of(read_raw(spark, LEAD, root), LEAD, "2024-01-03T00:00:00Z").drop("_commit"))
    for day in range(1, 5):
        compact(spark, LEAD, root, day=date(2024, 1, day))
    assert baseline in history(spark, root, "Lead").live
    assert expire(spark, LEAD, root, **window).replaced == ()
    assert rows(table_as_of(read_raw(spark, LEAD, root), LEAD, "2024-01-03T00:00:00Z").drop("_commit")) == before
    # the next day's run takes the baseline and the day that crossed, not the days after
    day_of_leads(spark, root, 5)
    second = expire(spark, LEAD, root, keep_days=0, as_of="2024-01-04T00:00:00Z")
    assert baseline in second.replaced and len(second.replaced) == 2 and second.rows == 20


def test_what_a_write_tells_is_what_is_stored(spark, root):
    entry = append_raw(leads(spark, ("1", "a", "2024-01-01", False), ("2", "b", "2024-03-01", False)), LEAD, root, "s1")
    assert (entry.n_rows, entry.min_stamp, entry.max_stamp) == (2, datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 3, 1, tzinfo=UTC))
    none = spark.sql("SELECT '1' AS Id, CAST(NULL AS TIMESTAMP) AS SystemModstamp")
    plain = ObjectSpec("Plain")
    entry = append_raw(none, plain, root, "s1")
    assert (entry.n_rows, entry.min_stamp, entry.watermark) == (1, None, None)
    assert append_raw(none.limit(0), plain, root, "s2") is None


def test_an_append_runs_one_scan(spark, root, tmp_path):
    """The batch is read by the write alone: neither counted before nor read back after."""
    leads(spark, ("1", "a", "2024-01-01", False)).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    append_raw(df, LEAD, root, "s0")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-append", "")
    append_raw(df, LEAD, root, "s1")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # look the sync id up, shuffle map stage and write of the batch, schema, publish
    assert len(tracker.getJobIdsForGroup("one-append")) <= 6


def test_reading_through_waiting_commits_equals_a_merge(spark, root):
    rng = random.Random(3)
    for spec in (LEAD, ObjectSpec("Bucketed", current_buckets=3)):
        with pytest.raises(ChangeVaultError):
            read_current(spark, spec, root)
        for step in range(3):
            for sync in range(2):  # late, repeated and deleting versions
                data = [(f"k{rng.randrange(12)}", f"v{step}{sync}{i}", (datetime(2024, 1, 1) + timedelta(hours=rng.randrange(60), minutes=i)).isoformat(), rng.random() < 0.3) for i in range(15)]
                append_raw(leads(spark, *data), spec, root, f"{step}-{sync}")
                append_raw(leads(spark, *data[:5]), spec, root, f"{step}-{sync}-again")
            commits = history(spark, root, spec.name)
            through = rows(read_current(spark, spec, root, pending=True))
            assert history(spark, root, spec.name) == commits
            refresh_current(spark, spec, root)
            assert rows(read_current(spark, spec, root)) == through == rows(read_current(spark, spec, root, pending=True))


def test_ids_are_registered_from_new_commits_only(spark, root):
    append_raw(leads(spark, ("1", "a", "2024-01-01", False)), LEAD, root, "s1")
    append_raw(leads(spark, ("2", "b", "2024-01-01", False)), LEAD, root, "s2")
    assert len(register_ids(spark, LEAD, root)) == 2
    assert register_ids(spark, LEAD, root) == ()
    compact(spark, LEAD, root, day=date(2024, 1, 1))
    assert register_ids(spark, LEAD, root) == ()
    late = append_raw(leads(spark, ("1", "a0", "2023-01-01", False), ("3", "c", "2024-02-01", False)), LEAD, root, "s3")
    before = rows(read_ids(spark, LEAD, root))
    assert register_ids(spark, LEAD, root) == (late.commit_id,)
    ids = read_ids(spark, LEAD, root)
    assert ids.count() == 3 and set(before) <= set(rows(ids))
    # a run that stored ids and failed before its ledger row reads them once more and adds nothing
    import shutil
    shutil.rmtree(f"{root}/ledger/object=Lead/kind=ids")
    assert len(register_ids(spark, LEAD, root)) == 2 and read_ids(spark, LEAD, root).count() == 3
    assert refresh_current(spark, LEAD, root).merged and history(spark, root, "Lead").pending == []


def test_expire_keeps_every_moment_in_the_window(spark, root):
    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    for sync in range(3):
        data = [
            (f"k{rng.randrange(8)}", f"v{sync}-{i}", (start + timedelta(days=sync * 40, hours=i)).isoformat(), rng.random() < 0.2)
            for i in range(40)
        ]
        append_raw(leads(spark, *data), LEAD, root, f"s{sync}")
    cutoff = datetime(2024, 2, 10, 12, tzinfo=UTC)
    moments = [cutoff + timedelta(hours=h) for h in (0, 1, 30, 400, 2000)]
    as_of = lambda t: rows(table_as_of(read_raw(spark, LEAD, root), LEAD, t).select("Id", "Name"))
    before = [as_of(t) for t in moments]
    total = read_raw(spark, LEAD, root).count()
    result = expire(spark, LEAD, root, keep_days=10, as_of=cutoff + timedelta(days=10))
    assert len(result.replaced) == 2
    assert read_raw(spark, LEAD, root).count() < total
    assert [as_of(t) for t in moments] == before
    assert expire(spark, LEAD, root, keep_days=10, as_of=start.replace(tzinfo=UTC)).replaced == ()


def test_restore(spark, tmp_path, root):
    append_raw(leads(spark, ("001", "a", "2024-01-01", False), ("001", "b", "2024-01-03", False), ("002", 'q"', "2024-01-01", None)), LEAD, root, "s1")
    raw = read_raw(spark, LEAD, root)
    preview = [r.record_json for r in restore_preview(raw, LEAD, "2024-01-02T00:00:00Z").orderBy("record_json").collect()]
    assert preview[0] == '{"Id":"001","IsDeleted":"false","Name":"a","SystemModstamp":"2024-01-01T00:00:00.000000Z","_overflow":""}'
    assert '"IsDeleted":""' in preview[1]
    restore_export(raw, LEAD, "2024-01-02T00:00:00Z", str(tmp_path / "out"), exclude=["SystemModstamp"])
    assert rows(read_extract(spark, str(tmp_path / "out"), ["Id", "Name"])) == [("001", "a"), ("002", 'q"')]
    restore_export(raw, LEAD, "2024-02-02T00:00:00Z", str(tmp_path / "one"), record_id="001")
    assert rows(read_extract(spark, str(tmp_path / "one"), ["Id", "Name"])) == [("001", "b")]
    with pytest.raises(NothingToRestore):
        restore_export(raw, LEAD, "2023-01-02T00:00:00Z", str(tmp_path / "none"))
    with pytest.raises(NothingToRestore):
        restore_export(raw, LEAD, "2024-02-02T00:00:00Z", str(tmp_path / "none"), record_id="999")


def test_streams_equal_batch(spark, tmp_path, root):
    pages = [F1, "Id,SystemModstamp,IsDeleted\n001,2024-01-05T00:00:00Z,true\n004,2023-12-01T00:00:00Z,false\n"]
    landing = tmp_path / "landing"
    os.makedirs(landing)
    (landing / "p1.csv").write_text(pages[0])
    run = lambda: sync_stream(
        spark, LEAD, str(landing), catalog(spark), root, str(tmp_path / "cp1"), max_files_per_trigger=1
    ).awaitTermination()
    merge = lambda: current_stream(
        spark, LEAD, root, str(tmp_path / "cp2"), max_commits_per_trigger=1
    ).awaitTermination()
    run()
    merge()
    assert rows(read_current(spark, LEAD, root).select("Id")) == [("001",), ("003",)]
    (landing / "p2.csv").write_text(pages[1])
    time.sleep(0.01)
    run()
    run()
    merge()
    merge()
    batch_root = str(tmp_path / "batch")
    for i, page in enumerate(pages):
        sync_object(spark, LEAD, extract(tmp_path, f"e{i}", page), catalog(spark), batch_root, filter_watermark=False)
    merge_all(spark, [LEAD], batch_root)
    columns = ["Id", "SystemModstamp", "IsDeleted"]
    assert rows(read_raw(spark, LEAD, root).select(columns)) == rows(read_raw(spark, LEAD, batch_root).select(columns))
    assert rows(read_current(spark, LEAD, root)) == rows(read_current(spark, LEAD, batch_root))
    assert rows(read_current(spark, LEAD, root).select("Id")) == [("003",), ("004",)]
    assert read_ledger(spark, root).where("kind = 'raw' AND sync_id LIKE 'sync-Lead-%'").count() == 2


def test_hot_day_is_split_over_files(spark, root):
    """A partition with most of the batch is written by several tasks; a small one by one."""
    spec = ObjectSpec("Lead", "Id", "SystemModstamp", partition_by=(PartitionBy("SystemModstamp", "day"),))
    df = spark.range(60000).selectExpr(
        "cast(id as string) AS Id", "sha2(cast(id as string), 512) AS Name",
        "if(id % 3 = 0, timestamp'2024-01-02 00:00:00', timestamp'2024-01-01 00:00:00') AS SystemModstamp",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        entry = append_raw(df, spec, root, "s1")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    base = f"{root}/raw/Lead/_commit={entry.commit_id}/_p_SystemModstamp_day="
    files = lambda d: [f for f in os.listdir(base + d) if f.endswith(".parquet")]
    assert len(files("2024-01-01")) > 1
    one = spark.read.parquet(f"{base}2024-01-01/{files('2024-01-01')[0]}").select("Id").collect()
    assert [r.Id for r in one] == sorted(r.Id for r in one)


def test_columns_of_refuses_other_types(spark):
    with pytest.raises(ChangeVaultError, match="TimestampNTZType"):
        columns_of(spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t"))
    assert columns_of(spark.sql("SELECT 1 AS a, date'2024-01-01' AS d")) == [
        ColumnDef("a", "int", True), ColumnDef("d", "date", True),
    ]


def exchanges_under(plan, marker):
    """Exchange nodes on the path from the root to the scan that mentions ``marker``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    found = 0
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-"))
        if indent < depth:
            depth = indent
            found += "Exchange" in line
    return found


def test_bucketed_state_is_not_shuffled(spark, root):
    spec = ObjectSpec("Lead", current_buckets=3)
    plain = ObjectSpec("Plain")
    rng = random.Random(11)
    for sync in range(3):
        data = [(f"k{rng.randrange(30)}", f"v{sync}-{i}", (datetime(2024, 1, 1) + timedelta(hours=rng.randrange(99), minutes=i)).isoformat(), rng.random() < 0.3) for i in range(40)]
        for s in (spec, plain):
            append_raw(leads(spark, *data), s, root, f"s{sync}", synced_at=datetime(2024, 5, 1 + sync, tzinfo=UTC))
            refresh_current(spark, s, root)
        assert rows(read_current(spark, spec, root)) == rows(read_current(spark, plain, root))
    folder = f"{root}/current/Lead/_commit={history(spark, root, 'Lead').current.commit_id}"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) == 3
    assert [t.name for t in spark.catalog.listTables() if "changevault" in t.name] == []

    state = read_state(spark, spec, root)
    newest = latest_per_key(versioned(read_raw(spark, spec, root), spec), "Id", VERSION[0], VERSION[1:])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_state(state, newest.repartition(3, "Id"), spec)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert exchanges_under(plan, "Bucketed: true") == 0
    # Another bucket count takes effect with the next merge.
    wider = ObjectSpec("Lead", current_buckets=5)
    append_raw(leads(spark, ("new", "n", "2025-01-01", False)), wider, root, "s9")
    refresh_current(spark, wider, root)
    assert read_current(spark, wider, root).where("Id = 'new'").count() == 1
    assert history(spark, root, "Lead").current.buckets == 5


def test_watermark_field_that_is_no_column(spark, tmp_path, root):
    fields = catalog(spark, ("Id", "id", False), ("IsDeleted", "boolean", False))
    for spec in (ObjectSpec("Lead"), ObjectSpec("Task", overflow=True)):
        named = fields.withColumn("object", F.lit(spec.name))
        result = sync_object(spark, spec, extract(tmp_path, "a", F1), named, root)
        assert (result.rows, result.watermark) == (3, datetime(2024, 1, 3, tzinfo=UTC))
        again = sync_object(spark, spec, extract(tmp_path, "a", F1 + "004,2024-01-04T00:00:00Z,false\n"), named, root)
        assert (again.rows, again.watermark) == (1, datetime(2024, 1, 4, tzinfo=UTC))
    spilled = read_raw(spark, ObjectSpec("Task"), root).where("Id = '001'").first()._overflow
    assert spilled == '{"SystemModstamp":"2024-01-01T00:00:00.000+0000"}'
    assert read_raw(spark, ObjectSpec("Lead"), root).where("_overflow IS NOT NULL").count() == 0


def test_running_sync_is_cancelled(spark, tmp_path, root):
    """B has far more rows to write than A takes to fail."""
    os.makedirs(tmp_path / "extract" / "B")
    with open(tmp_path / "extract" / "B" / "page.csv", "w") as f:
        f.write("Id,SystemModstamp,IsDeleted\n")
        f.writelines(f"{i},2024-01-01T00:00:00Z,false\n" for i in range(2_000_000))
    paths = {"A": extract(tmp_path, "A", F1.replace("true", "maybe")), "B": str(tmp_path / "extract" / "B")}
    with pytest.raises(Exception, match="maybe"):
        sync_all(spark, [ObjectSpec("A"), ObjectSpec("B")], paths, catalog(spark, objects="AB"), root)
    assert get_watermark(spark, root, "B") is None
