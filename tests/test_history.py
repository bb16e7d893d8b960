"""Newest version, as-of, merge: fixed cases and randomized comparison with plain Python."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from support import rows
from pyspark.sql import functions as F

from changevault.model import ObjectSpec, PartitionBy
from changevault.operators.latest import (
    before, last_good_state, latest_per_key, record_as_of, record_history, since, table_as_of,
)
from changevault.operators.merge import (
    empty_state, live_rows, merge_actions, merge_current, merge_state, versioned,
)
from changevault.operators.partitions import with_partitions

SPEC = ObjectSpec("Lead", partition_by=(PartitionBy("SystemModstamp", "day"),))
ANCHOR = "2026-04-25T09:00:00Z"
SCHEMA = (
    "Id string, Name string, SystemModstamp timestamp, IsDeleted boolean, _synced_at timestamp, _row_hash bigint"
)


def ts(text):
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


@pytest.fixture
def versions(spark):
    sync = {1: ts("2026-04-24T12:00:00Z"), 2: ts("2026-04-25T12:00:00Z")}
    data = [
        ("001", "a1", "2026-04-24T10:00:00Z", False, 1),
        ("001", "a2", "2026-04-25T09:00:00Z", False, 2),
        ("002", "b1", "2026-04-24T10:00:00Z", False, 1),
        ("002", "b1", "2026-04-24T11:00:00Z", True, 2),
        ("003", "c1", "2026-04-24T10:00:00Z", True, 1),
        ("004", "d1", "2026-04-24T10:00:00Z", None, 1),
        ("005", "e1", "2026-04-24T10:00:00Z", False, 1),
        ("005", "e2", "2026-04-24T10:00:00Z", False, 2),
        ("006", "f1", None, False, 1),
    ]
    return spark.createDataFrame(
        [(i, n, ts(t), d, sync[s], hash((i, n)) % 1000) for i, n, t, d, s in data], SCHEMA
    )


def test_table_as_of(versions):
    got = table_as_of(versions, SPEC, ANCHOR).select("Id", "Name", "IsDeleted")
    assert rows(got) == [
        ("001", "a1", False), ("002", "b1", True), ("003", "c1", True), ("004", "d1", None), ("005", "e2", False),
    ]
    assert got.columns == ["Id", "Name", "IsDeleted"]
    assert table_as_of(versions, SPEC, ANCHOR).columns == versions.columns


def test_record_as_of(versions):
    assert rows(record_as_of(versions, SPEC, "001", ANCHOR).select("Name")) == [("a1",)]
    assert rows(record_as_of(versions, SPEC, "001", "2026-04-25T09:00:00.000001Z").select("Name")) == [("a2",)]
    assert rows(record_as_of(versions, SPEC, "006", ANCHOR)) == []
    assert rows(record_as_of(versions, SPEC, "999", ANCHOR)) == []
    history = [r.Name for r in record_history(versions, SPEC, "005").collect()]
    assert history == ["e2", "e1"]


@pytest.mark.parametrize("bad", ["not-an-id", "has spaces in it!", "dropit;SELECT 1", "abc\n"])
def test_bad_record_id(versions, bad):
    with pytest.raises(ValueError, match="not a valid record id"):
        last_good_state(versions, SPEC, ANCHOR, bad)


@pytest.mark.parametrize("at", ["", None, "2026-04-25", "yesterday", "2026-04-25T09:00:00"])
def test_bad_moment(versions, at):
    with pytest.raises(ValueError):
        last_good_state(versions, SPEC, at)


@pytest.mark.parametrize("good", ["001C000000XyzABC", "001C000000XyzAB", "7503S000003XXXXX", "001C000000XyzABCXX"])
def test_good_record_ids(versions, good):
    assert rows(last_good_state(versions, SPEC, ANCHOR, good)) == []


def test_merge_into_empty(spark, versions):
    latest = latest_per_key(versions, "Id", "SystemModstamp")
    merged = merge_current(versions.limit(0), latest, "Id", "IsDeleted")
    assert rows(merged.select("Id", "Name")) == [("001", "a2"), ("005", "e2"), ("006", "f1")]


def test_merge_branches(spark):
    current = spark.createDataFrame(
        [("del", "t"), ("upd", "t"), ("nul", "t"), ("own", "t")], "Id string, Name string"
    ).withColumn("Extra", F.lit("kept"))
    latest = spark.createDataFrame(
        [("del", "s", True), ("upd", "s", False), ("nul", "s", None), ("ins", "s", False), ("ign", "s", True),
         ("nu2", "s", None)],
        "Id string, Name string, IsDeleted boolean",
    )
    assert rows(merge_actions(current, latest, "Id", "IsDeleted")) == [
        ("del", "delete"), ("ign", "none"), ("ins", "insert"), ("nu2", "none"), ("nul", "none"), ("upd", "update"),
    ]
    assert rows(merge_current(current, latest, "Id", "IsDeleted")) == [
        ("ins", "s", False, None), ("nul", "t", None, "kept"), ("own", "t", None, "kept"), ("upd", "s", False, "kept"),
    ]
    text_flag = latest.withColumn("IsDeleted", F.col("IsDeleted").cast("string"))
    assert rows(merge_actions(current, text_flag, "Id", "IsDeleted")) == rows(
        merge_actions(current, latest, "Id", "IsDeleted")
    )
    with pytest.raises(ValueError, match="IsDeleted"):
        merge_current(current, latest.drop("IsDeleted"), "Id", "IsDeleted")


def random_history(seed, n=400, keys=25):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    out = []
    for i in range(n):
        # One key holds a third of all versions.
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        stamp = None if rng.random() < 0.03 else start + timedelta(hours=rng.randrange(300))
        flag = rng.choices([False, True, None], [6, 3, 1])[0]
        out.append((key, f"v{i}", stamp, flag, start + timedelta(days=i // 100), i))
    return out


def newest(history):
    best = {}
    for row in history:
        rank = (row[2] is not None, row[2] or datetime.min.replace(tzinfo=timezone.utc), row[4], row[5])
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    return {k: v for k, (_, v) in best.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_matches_fold(spark, seed):
    history = random_history(seed)
    df = spark.createDataFrame(history, SCHEMA).repartition(5)
    parted, _ = with_partitions(df, SPEC.partition_by)
    for hours in (1, 77, 150, 299):
        at = datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=hours, microseconds=seed)
        want = newest([r for r in history if r[2] and r[2] < at])
        for frame in (df, parted):
            got = table_as_of(frame, SPEC, at)
            assert {r.Id: r.Name for r in got.collect()} == {k: v[1] for k, v in want.items()}
        assert before(parted, SPEC, at).count() + since(parted, SPEC, at).count() == len(history)


@pytest.mark.parametrize("seed", [3, 4])
def test_incremental_merges_equal_reference_rule(spark, seed):
    """Merging batch by batch = merging the newest version over all batches so far, each time."""
    history = random_history(seed)
    current: dict = {}
    state = None
    for upto in (100, 200, 300, 400):
        for key, row in newest(history[:upto]).items():
            if row[3] is True:
                current.pop(key, None)
            elif row[3] is False:
                current[key] = row[1]
        batch = spark.createDataFrame(history[upto - 100:upto], SCHEMA)
        latest = latest_per_key(versioned(batch, SPEC), "Id", "_ver_stamp", ("_ver_synced", "_ver_hash"))
        state = merge_state(empty_state(latest) if state is None else state, latest, SPEC)
        again = merge_state(state, latest, SPEC)
        for merged in (state, again):
            assert {r.Id: r.Name for r in live_rows(merged).collect()} == current


def test_late_older_version_does_not_revive(spark):
    day = [datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3)]
    first = spark.createDataFrame([("1", "gone", day[2], True, day[0], 1)], SCHEMA)
    late = spark.createDataFrame([("1", "old", day[0], False, day[1], 2)], SCHEMA)
    state = merge_state(empty_state(versioned(first, SPEC)), versioned(first, SPEC), SPEC)
    assert live_rows(merge_state(state, versioned(late, SPEC), SPEC)).count() == 0


def test_plan_ranks_before_the_shuffle(spark, versions, tmp_path):
    parted, names = with_partitions(versions, SPEC.partition_by)
    parted.write.partitionBy(*names).parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = table_as_of(raw, SPEC, ANCHOR).select("Id", "Name")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan and "Python" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "_p_SystemModstamp_day" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "LessThan(SystemModstamp" in scan
    assert "IsDeleted" not in scan.split("ReadSchema")[1]
