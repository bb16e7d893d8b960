"""Nothing is lost silently: streams, appends, zones, maintenance."""

import contextlib
import os
from datetime import date

import pytest
from support import rows
from pyspark.sql import functions as F
from test_jobs import FIELDS, F1, LEAD, catalog, extract

from changevault.model import ChangeVaultError, ObjectSpec, PartitionBy
from changevault.operators.latest import record_as_of, table_as_of
from changevault.operators.lineage import canonical_ids
from changevault.plans.current import merge_all, read_current, refresh_current
from changevault.plans.maintain import compact, expire
from changevault.plans.restore import restore_preview, restore_related
from changevault.plans.sync import sync_all, sync_object
from changevault.session import now
from changevault.sources.canonical import read_ids, record_key, register_ids
from changevault.sources.extract import read_extract
from changevault.sources.ledger import get_watermark, history
from changevault.sources.raw import append_raw, read_raw
from changevault.streaming.current import current_stream
from changevault.streaming.sync import sync_stream


def versions(spark, *stamped):
    text = ", ".join(f"('{i}', timestamp'{t}', '{n}')" for i, t, n in stamped)
    return spark.sql(f"SELECT Id, SystemModstamp, Name, false AS IsDeleted FROM VALUES {text} AS t(Id, SystemModstamp, Name)")


@contextlib.contextmanager
def zone(spark, name):
    spark.conf.set("spark.sql.session.timeZone", name)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stream_with_a_new_checkpoint_brings_new_pages(spark, tmp_path, root):
    def run(landing, checkpoint):
        sync_stream(spark, LEAD, landing, catalog(spark), root, str(tmp_path / checkpoint)).awaitTermination()
        current_stream(spark, LEAD, root, str(tmp_path / f"{checkpoint}-current")).awaitTermination()

    run(extract(tmp_path, "a", F1), "c1")
    run(extract(tmp_path, "b", F1.replace("\n00", "\n01")), "c2")
    assert read_raw(spark, LEAD, root).count() == 6
    assert read_current(spark, LEAD, root).count() == 4


def test_stream_takes_up_new_headers_and_columns(spark, tmp_path, root):
    landing = tmp_path / "landing pages"
    landing.mkdir()
    fields = list(FIELDS)

    def run():
        sync_stream(spark, LEAD, str(landing), lambda: catalog(spark, *fields), root, str(tmp_path / "c")).awaitTermination()

    (landing / "p1.csv").write_text(F1)
    run()
    fields.append(("Name", "string", True))
    (landing / "p2.csv").write_text("Name,Id,IsDeleted,SystemModstamp\nAda,009,false,2024-02-01T00:00:00Z\n")
    (landing / "p3.csv").write_text("Id,SystemModstamp,IsDeleted\n010,2024-02-02T00:00:00Z,false\n")
    run()
    got = rows(read_raw(spark, LEAD, root).select("Id", "Name"))
    assert got == [("001", None), ("002", None), ("003", None), ("009", "Ada"), ("010", None)]


def test_pages_under_a_path_with_blanks(spark, tmp_path):
    folder = tmp_path / "my 100% pages"
    folder.mkdir()
    (folder / "a.csv").write_text("Id,N\n1,2\n")
    (folder / "b.csv").write_text("N,Id\n4,3\n")
    assert rows(read_extract(spark, str(folder), ["Id", "N"], mixed_headers=True)) == [("1", "2"), ("3", "4")]


@pytest.mark.parametrize("change, match", [
    (lambda df: df.withColumn("Extra", F.lit(1)), "no column Extra"),
    (lambda df: df.withColumn("Name", F.lit(1).cast("bigint")), "Name is bigint, not string"),
])
def test_a_frame_that_does_not_fit_is_refused(spark, root, change, match):
    df = versions(spark, ("1", "2024-01-01 00:00:00", "a"))
    append_raw(df, LEAD, root, "s1")
    with pytest.raises(ChangeVaultError, match=match):
        append_raw(change(df), LEAD, root, "s2")
    assert rows(read_raw(spark, LEAD, root).select("Id", "Name")) == [("1", "a")]
    assert history(spark, root, "Lead").watermark.year == 2024


def test_unknown_columns_overflow_where_they_may(spark, root):
    spec = ObjectSpec("Lead", overflow=True)
    df = versions(spark, ("1", "2024-01-01 00:00:00", "a"))
    append_raw(df, spec, root, "s1")
    append_raw(df.withColumn("Extra", F.lit("x")), spec, root, "s2")
    assert rows(read_raw(spark, spec, root).select("_overflow")) == [(None,), ('{"Extra":"x"}',)] or \
        rows(read_raw(spark, spec, root).where("_overflow IS NOT NULL").select("_overflow")) == [('{"Extra":"x"}',)]


def test_a_text_watermark_is_refused(spark, root):
    df = spark.sql("SELECT '1' AS Id, '2024-01-01' AS SystemModstamp")
    with pytest.raises(ChangeVaultError, match="gives no watermark"):
        append_raw(df, ObjectSpec("Lead"), root, "s1")


@pytest.mark.parametrize("transform", ["day", "hour", "month", "year"])
def test_past_states_are_the_same_in_every_zone(spark, root, transform):
    spec = ObjectSpec("Lead", partition_by=(PartitionBy("SystemModstamp", transform),))
    append_raw(versions(spark, ("1", "2024-01-01 01:00:00", "a"), ("1", "2024-01-01 06:30:00", "b"), ("2", "2024-01-31 23:59:00", "c"),
                        ("3", "2024-01-01 00:00:00", "d")), spec, root, "s1")

    def answers():
        raw = read_raw(spark, spec, root)
        out = []
        for at in ("2024-01-01T02:00:00Z", "2024-01-01T07:00:00Z", "2024-02-01T00:00:00Z"):
            out.append(rows(table_as_of(raw, spec, at).select("Id", "Name")))
            out.append(rows(restore_preview(raw, spec, at)))
        return out, rows(canonical_ids(raw, spec))

    want = answers()
    for name in ("America/Los_Angeles", "Asia/Kathmandu"):
        with zone(spark, name):
            assert answers() == want


def test_an_id_takes_the_type_of_the_key(spark, root):
    append_raw(versions(spark, ("x1", "2024-01-01 00:00:00", "a"), ("7", "2024-01-01 00:00:00", "b")), LEAD, root, "s1")
    raw = read_raw(spark, LEAD, root)
    assert record_as_of(raw, LEAD, 7, "2025-01-01T00:00:00Z").first().Name == "b"
    numbers = raw.where("Id = '7'").withColumn("Id", F.col("Id").cast("bigint"))
    assert record_as_of(numbers, LEAD, "7", "2025-01-01T00:00:00Z").first().Name == "b"
    assert record_as_of(numbers, LEAD, "x1", "2025-01-01T00:00:00Z").count() == 0


def test_an_empty_job_moves_a_job_start_watermark(spark, tmp_path, root):
    sync_object(spark, LEAD, extract(tmp_path, "a", F1), catalog(spark), root, job_start="2024-01-05T00:00:00Z", strategy="job_start")
    empty = extract(tmp_path, "b", "Id,SystemModstamp,IsDeleted\n")
    done = sync_object(spark, LEAD, empty, catalog(spark), root, job_start="2024-01-09T00:00:00Z", strategy="job_start")
    assert done.rows == 0 and done.commit_id is None
    assert get_watermark(spark, root, "Lead").isoformat() == "2024-01-08T23:55:00+00:00"
    assert read_raw(spark, LEAD, root).count() == 3


def files(root, commit):
    return [f for _, _, names in os.walk(f"{root}/raw/Lead/_commit={commit}") for f in names if f.endswith(".parquet")]


def test_compaction_packs_unpartitioned_objects_and_single_commits(spark, root):
    spec = ObjectSpec("Lead")
    df = spark.range(200).selectExpr("cast(id AS string) AS Id", "timestamp'2024-01-01 00:00:00' AS SystemModstamp")
    append_raw(df, spec, root, "s1", max_records_per_file=10)
    assert len(files(root, history(spark, root, "Lead").live[0])) >= 20
    done = compact(spark, spec, root, day=date(2024, 1, 1))
    assert len(done.replaced) == 1 and len(files(root, done.commit_id)) == 1
    assert compact(spark, spec, root, day=date(2024, 1, 1)).replaced == ()
    for i in range(3):
        append_raw(df, spec, root, f"t{i}")
    done = compact(spark, spec, root, day=date(2024, 1, 1))
    assert len(done.replaced) == 3 and len(files(root, done.commit_id)) == 1
    assert read_raw(spark, spec, root).count() == 800


def test_retention_leaves_alone_what_does_not_cross(spark, root):
    stamped = [(str(k), f"2024-01-{d:02d} 00:00:00", f"{k}-{d}") for k in range(3) for d in range(1, 29)]
    append_raw(versions(spark, *stamped), LEAD, root, "s1")

    def run(day):
        return expire(spark, LEAD, root, keep_days=0, as_of=f"2024-01-{day:02d}T00:00:00Z")

    first = run(10)
    assert first.rows == 3 + 3 * 19 and len(first.commits) > 3
    assert run(10).replaced == ()
    second = run(11)
    assert len(second.replaced) == 2  # the baseline and the one day that crossed
    assert set(first.commits) - set(second.replaced) <= set(history(spark, root, "Lead").live)
    left = read_raw(spark, LEAD, root)
    assert left.count() == 3 + 3 * 18
    assert rows(table_as_of(left, LEAD, "2024-01-11T00:00:00Z").select("Name")) == [("0-10",), ("1-10",), ("2-10",)]


def test_merge_reads_only_what_waits_after_compaction(spark, root):
    def add(i):
        append_raw(versions(spark, (str(i), f"2024-01-01 {i:02d}:00:00", "a")), LEAD, root, f"s{i}")

    add(1)
    add(2)
    merge_all(spark, [LEAD], root)
    assert compact(spark, LEAD, root, day=date(2024, 1, 1)).rows == 2
    assert history(spark, root, "Lead").pending == []
    add(3)
    add(4)
    live = history(spark, root, "Lead")
    assert len(live.pending) == 2 and len(live.live) == 3
    result = refresh_current(spark, LEAD, root)
    assert len(result.merged) == 2
    add(5)
    packed = compact(spark, LEAD, root, day=date(2024, 1, 1))
    assert history(spark, root, "Lead").pending == [packed.commit_id]
    refresh_current(spark, LEAD, root)
    assert rows(read_current(spark, LEAD, root).select("Id")) == [(str(i),) for i in range(1, 6)]
    assert refresh_current(spark, LEAD, root).commit_id is None


def test_batches_limit_the_rows_of_a_file(spark, tmp_path, root):
    import pyarrow.parquet as pq

    spec = ObjectSpec("Lead")
    done = sync_object(spark, spec, extract(tmp_path, "a", F1), catalog(spark), root, max_records_per_file=2)
    folder = f"{root}/raw/Lead/_commit={done.commit_id}"
    assert sorted(pq.ParquetFile(f"{folder}/{f}").metadata.num_rows for f in files(root, done.commit_id)) == [1, 2]


def test_one_object_of_several_is_synced_alone(spark, tmp_path, root):
    specs = [LEAD, ObjectSpec("Case")]
    paths = {"Lead": extract(tmp_path, "a", F1), "Case": str(tmp_path / "nowhere")}
    done = sync_all(spark, specs, paths, catalog(spark, objects=("Lead", "Case")), root, only="Lead")
    assert [r.object for r in done] == ["Lead"] and not os.path.exists(f"{root}/raw/Case")
    with pytest.raises(ValueError, match="Contact"):
        sync_all(spark, specs, paths, catalog(spark), root, only="Contact")


def test_ids_survive_late_versions_and_retention(spark, root):
    append_raw(versions(spark, ("1", "2024-01-10 00:00:00", "b"), ("1", "2024-01-20 00:00:00", "c")), LEAD, root, "s1")
    register_ids(spark, LEAD, root)
    first = rows(read_ids(spark, LEAD, root))
    append_raw(versions(spark, ("1", "2024-01-01 00:00:00", "a"), ("2", "2024-01-02 00:00:00", "x")), LEAD, root, "s2")
    register_ids(spark, LEAD, root)
    expire(spark, LEAD, root, keep_days=0, as_of="2024-01-15T00:00:00Z")
    register_ids(spark, LEAD, root)
    ids = read_ids(spark, LEAD, root)
    assert ids.count() == 2 and first[0] in rows(ids)
    assert record_key(ids, LEAD, first[0][1]) == "1"
    with pytest.raises(ChangeVaultError, match="canonical id"):
        record_key(ids, LEAD, "nothing")


def test_related_objects_are_written_parents_first(spark, tmp_path, root):
    account, contact = ObjectSpec("Account"), ObjectSpec("Contact")
    make = lambda text: spark.sql(f"SELECT *, timestamp'2024-01-01 00:00:00' AS SystemModstamp FROM VALUES {text}")
    append_raw(make("('a1', 'Acme') AS t(Id, Name)"), account, root, "s")
    append_raw(make("('c1', 'a1'), ('c2', 'gone') AS t(Id, AccountId)"), contact, root, "s")
    fields = spark.createDataFrame(
        [("Contact", "AccountId", "reference", "Account"), ("Contact", "OwnerId", "reference", "User"), ("Account", "Name", "string", None)],
        "object string, name string, type string, reference_to string")
    pages = restore_related(spark, [contact, account], fields, root, "2025-01-01T00:00:00Z", str(tmp_path / "out"))
    assert [(p.object, p.level) for p in pages] == [("Account", 0), ("Contact", 1)]
    parent = read_extract(spark, pages[0].path).first().canonical_id
    child = read_extract(spark, pages[1].path)
    assert rows(child.select("Id", "AccountId:Account:canonical_id")) == [("c1", parent), ("c2", "")]
    # a field that is no column of its object refers to nothing
    loop = fields.union(spark.createDataFrame([("Account", "MainId", "reference", "Contact")], fields.schema))
    pages = restore_related(spark, [contact, account], loop, root, "2025-01-01T00:00:00Z", str(tmp_path / "loop"))
    assert [(p.object, p.level, p.fills) for p in pages] == [("Account", 0, ()), ("Contact", 1, ())]


STAMPED = "SELECT *, timestamp'2024-01-01 00:00:00' AS SystemModstamp FROM VALUES "
REFS = "object string, name string, type string, reference_to array<string>"


def ids_of(spark, spec, root):
    return {r[spec.primary_key]: r.canonical_id for r in read_ids(spark, spec, root).collect()}


def test_owner_of_two_objects_and_a_third_unknown(spark, tmp_path, root):
    user, team, task = ObjectSpec("User"), ObjectSpec("Team"), ObjectSpec("Task")
    append_raw(spark.sql(STAMPED + "('u1'), ('both') AS t(Id)"), user, root, "s")
    append_raw(spark.sql(STAMPED + "('t1'), ('both') AS t(Id)"), team, root, "s")
    append_raw(spark.sql(STAMPED + "('1', 'u1'), ('2', 't1'), ('3', 'both'), ('4', 'q1'), ('5', NULL) AS t(Id, OwnerId)"), task, root, "s")
    fields = spark.createDataFrame([("Task", "OwnerId", "reference", ["Team", "User", "Queue"])], REFS)
    pages = restore_related(spark, [user, team, task], fields, root, "2025-01-01T00:00:00Z", str(tmp_path / "out"))
    assert [(p.object, p.level) for p in pages] == [("Team", 0), ("User", 0), ("Task", 1)]
    users, teams = ids_of(spark, user, root), ids_of(spark, team, root)
    got = read_extract(spark, pages[-1].path).select("Id", "`OwnerId:User:canonical_id`", "`OwnerId:Team:canonical_id`", "OwnerId")
    assert rows(got) == [
        ("1", users["u1"], "", ""), ("2", "", teams["t1"], ""), ("3", "", teams["both"], ""), ("4", "", "", "q1"), ("5", "", "", "")]


def test_staff_follows_managers_and_record_cycles_are_filled_later(spark, tmp_path, root):
    user = ObjectSpec("User")
    staff = "('a', NULL), ('b', 'a'), ('c', 'b'), ('x', 'y'), ('y', 'x'), ('z', 'x'), ('s', 's'), ('o', 'gone') AS t(Id, ManagerId)"
    append_raw(spark.sql(STAMPED + staff), user, root, "s")
    fields = spark.createDataFrame([("User", "ManagerId", "reference", ["User"])], REFS)
    pages = restore_related(spark, [user], fields, root, "2025-01-01T00:00:00Z", str(tmp_path / "out"))
    ids, column = ids_of(spark, user, root), "ManagerId:User:canonical_id"
    got = [rows(read_extract(spark, p.path, ["Id", column])) for p in pages if not p.fills]
    assert [(p.wave, bool(p.fills)) for p in pages] == [(0, False), (1, False), (2, False), (3, False), (4, False), (4, True)]
    assert got == [
        [("a", ""), ("o", ""), ("s", ids["s"])], [("b", ids["a"])], [("c", ids["b"])], [("x", ""), ("y", "")], [("z", ids["x"])]]
    filled = read_extract(spark, pages[-1].path)
    assert pages[-1].fills == (column,) and filled.columns == [column, "canonical_id"]
    assert rows(filled) == sorted([(ids["y"], ids["x"]), (ids["x"], ids["y"])])


def test_objects_on_a_cycle_go_twice(spark, tmp_path, root):
    account, contact, case = ObjectSpec("Account"), ObjectSpec("Contact"), ObjectSpec("Case")
    append_raw(spark.sql(STAMPED + "('a1', 'c1'), ('a2', NULL) AS t(Id, MainId)"), account, root, "s")
    append_raw(spark.sql(STAMPED + "('c1', 'a1'), ('c2', 'a1') AS t(Id, AccountId)"), contact, root, "s")
    append_raw(spark.sql(STAMPED + "('k1', 'c2') AS t(Id, ContactId)"), case, root, "s")
    fields = spark.createDataFrame([
        ("Account", "MainId", "reference", ["Contact"]), ("Contact", "AccountId", "reference", ["Account"]),
        ("Case", "ContactId", "reference", ["Contact"])], REFS)
    pages = restore_related(spark, [account, contact, case], fields, root, "2025-01-01T00:00:00Z", str(tmp_path / "out"))
    assert [(p.object, p.level, bool(p.fills)) for p in pages] == [
        ("Account", 0, False), ("Contact", 0, False), ("Account", 1, True), ("Case", 1, False), ("Contact", 1, True)]
    accounts, contacts = ids_of(spark, account, root), ids_of(spark, contact, root)
    assert rows(read_extract(spark, pages[0].path, ["Id", "MainId:Contact:canonical_id"])) == [("a1", ""), ("a2", "")]
    assert rows(read_extract(spark, pages[2].path, ["canonical_id", "MainId:Contact:canonical_id"])) == [(accounts["a1"], contacts["c1"])]
    assert rows(read_extract(spark, pages[3].path, ["Id", "ContactId:Contact:canonical_id"])) == [("k1", contacts["c2"])]
    assert rows(read_extract(spark, pages[4].path, ["canonical_id"])) == sorted([(contacts["c1"],), (contacts["c2"],)])


def test_each_state_is_ranked_once(spark, tmp_path, root, monkeypatch):
    """Looking for hot keys used to rank the versions and look up the ids again, for the key and for each reference."""
    frame, counts = type(spark.range(1)), []

    def noted(found, plain=frame.collect):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        if "__groups" in plan:
            counts.append(plan)
        return plain(found)

    account, contact = ObjectSpec("Account"), ObjectSpec("Contact")
    append_raw(spark.sql(STAMPED + "('a1'), ('a2') AS t(Id)"), account, root, "s")
    append_raw(spark.sql(STAMPED + "('c1', 'a1', 'a2'), ('c2', NULL, 'a2') AS t(Id, AccountId, PayerId)"), contact, root, "s")
    fields = spark.createDataFrame([("Contact", "AccountId", "reference", ["Account"]), ("Contact", "PayerId", "reference", ["Account"])], REFS)
    monkeypatch.setattr(frame, "collect", noted)
    pages = restore_related(spark, [account, contact], fields, root, "2025-01-01T00:00:00Z", str(tmp_path / "out"))
    monkeypatch.undo()
    assert counts and not [plan for plan in counts if "Window" in plan or "Join" in plan]
    ids = ids_of(spark, account, root)
    got = read_extract(spark, pages[-1].path, ["Id", "AccountId:Account:canonical_id", "PayerId:Account:canonical_id"])
    assert rows(got) == [("c1", ids["a1"], ids["a2"]), ("c2", "", ids["a2"])]
