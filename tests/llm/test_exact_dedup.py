import duckdb
import pytest
from helpers import SF, frame

from changevault.llm import exact_dedup, queries

ROWS = [(1, "a", "x"), (2, "a", "y"), (3, None, "x"), (4, "", "x"), (None, "a", "z"), (5, "b", None), (5, "b", None),
        (6, "B", "x"), (7, "b ", "x"), (8, "long " * 20_000, "x"), (9, "long " * 20_000, "y")]
SCHEMA = "doc_id long, text string, kept string"


def answers(frame_):
    return sorted(((r.doc.doc_id or -1, r.doc.text or "", r.keep_id, r.group_size, r.kept) for r in frame_.collect()),
                  key=repr)


def plain(rows, keep):
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(text or "", []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        left = 1
        for i in ids:
            stays = i == best and left == 1
            left -= stays
            out.append((i or -1, text, best, len(ids), stays))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_copies_whether_hot_or_sorted(spark, keep, hot_rows):
    docs = frame(spark, ROWS, SCHEMA).repartition(3)
    assert answers(exact_dedup.mark_copies(docs, keep=keep, hot_rows=hot_rows)) == plain(ROWS, keep)


def test_empty_table_and_column_names_survive(spark):
    docs = frame(spark, ROWS, SCHEMA)
    assert exact_dedup.mark_copies(docs.limit(0)).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({t or "" for _, t, _ in ROWS})


def test_unknown_keep_is_refused(spark):
    with pytest.raises(ValueError):
        exact_dedup.mark_copies(frame(spark, ROWS, SCHEMA), keep="first")


def test_query_agrees_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES["op1_exact_dedup"]).fetchall()
    assert sorted(map(tuple, queries.op1_exact_dedup(spark, SF).collect())) == sorted(want)


def test_no_python_in_the_plan_and_one_sort(spark):
    plan = queries.op1_exact_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("rangepartitioning") == 1
