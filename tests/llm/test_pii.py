import hashlib
import re

from helpers import SF, frame
from pyspark.sql import functions as F

from changevault.llm import pii, queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "plain words", "a@b@c.d e%f@g.h%i@j.k", "x.y@z", "1.2.3.4 256.1.1.1 0001.002.003.04 1.2.3 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 and 4111-1111-1111-1112", "12 4111111111111111", "card 378282246310005!", "+1 (017) 555-7713",
    "+1 5", "+12345678901234567", "call +49 30 901820 or +49 (30) 90-18.20.", "ünïcödé 😀 me@ex.org 😀 10.0.0.1",
    "4111111111111111 4111111111111111", "9" * 5000, "a" * 30_000 + "@b.c", "1 " * 5000, "+1" + "(" * 5000,
    "1." * 3000, "x@" + "y." * 3000 + "z", "line\nmail me@a.b\r\n1.1.1.1", "\u0001a@b.c\u0001", "write to bob (at) example (dot) com",
    'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "tel 415-555-0132", "my card 4929 1234 5678 9012 0",
]


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def good(kind, text):
    digits = sum(c.isdigit() for c in text)
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in text.split(".")),
            "card": 13 <= digits <= 19 and luhn(text), "phone": 9 <= digits <= 15}[kind]


def base(text):
    return [f"{k}:{m.start()}:{m.end()}" for k in PLAIN for m in re.finditer(PLAIN[k], text or "") if good(k, m.group())]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    docs = frame(spark, list(enumerate(TEXTS)), "doc_id long, text string")
    found = pii.find(docs, pii.fit(docs)).select("doc.doc_id", pii.digest(F.col("base")).alias("base"), pii.digest(F.col("spans")).alias("spans"))
    for row in found.collect():
        assert row.base == ",".join(base(TEXTS[row.doc_id])), TEXTS[row.doc_id][:60]
        assert set(row.base.split(",")) - {""} <= set(row.spans.split(","))


def test_spans_are_added_beside_base_spans(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(TEXTS * 4)], "doc_id long, text string")
    rows = pii.find(docs, pii.fit(docs)).select("spans").collect()
    kinds = {s.kind for r in rows for s in r.spans}
    assert "secret" in kinds


def test_model_without_candidates_and_empty_table(spark):
    docs = frame(spark, [(1, "nothing here"), (2, None)], "doc_id long, text string")
    model = pii.fit(docs)
    assert model.weights == {}
    assert [r.spans for r in pii.find(docs, model).collect()] == [[], []]
    assert pii.find(docs.limit(0), model).count() == 0


def test_labelers_are_weighed():
    from pyspark.sql import Row

    def pattern(kind, form, gazetteer, context, edges, n):
        return Row(kind=kind, form=form, gazetteer=gazetteer, context=context, edges=edges, size=2, n=n)

    model = pii._train([pattern("card", 1, 1, 1, 1, 90), pattern("card", -1, -1, 0, 1, 60), pattern("card", 1, 1, 0, 1, 50),
                        pattern("card", -1, 1, -1, -1, 40)], 30)
    assert model.weights["form", 1] > model.weights["form", -1]
    assert model.reliability["form"][1][0] > model.reliability["form"][1][1]


def test_masking(spark):
    spans = "array(named_struct('start', 5, 'end', 9, 'kind', 'phone'), named_struct('start', 0, 'end', 3, 'kind', 'email'), " \
            "named_struct('start', 7, 'end', 12, 'kind', 'card'))"
    row = spark.range(1).select(pii.masked(F.lit("ab😀d ef hijklmnop"), F.expr(spans)).alias("m"),
                                pii.masked(F.lit("as is"), F.array().cast("array<struct<start:int,end:int,kind:string>>")).alias("n")).first()
    assert (row.m, row.n) == ("<EMAIL>d <PHONE>lmnop", "as is")


def test_query(spark):
    texts = dict(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = queries.op3_pii(spark, SF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want) for k in PLAIN]
