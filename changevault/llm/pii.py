"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs the labelers, and
a classifier trained on the result decides. DataFrame operations only; the driver sees counts of vote patterns."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
#: What the method may add, besides further spans of the kinds above.
ADDED_KINDS = ("secret",)
LABELERS = ("form", "gazetteer", "context", "edges")

# Base patterns. Where a quantifier is possessive or a start is tied to the edge of a run, the matches are those of the
# plain pattern: what follows cannot match what is given up. Long runs then take linear time and no stack.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",  # shorter runs of digits fail anyway
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns, whose spans stand only if the classifier takes them.
WIDE = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]{1,63}"
             r"(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[\x20.-])?\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}(?![0-9A-Za-z])",
}
#: A cheap test that must hold before a pattern is tried on a text.
_NEEDS = {
    "email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike("[0-9]"),
    "phone": lambda t: t.contains("+"),
}
_WIDE_NEEDS = {
    "email": lambda t: t.rlike(r"[(\[](?:at|AT)[)\]]"), "ip": lambda t: t.contains(":"),
    "card": lambda t: t.rlike("[0-9]{4}"), "phone": lambda t: t.rlike("[0-9]{4}"),
    "secret": lambda t: t.rlike("[0-9a-fA-F]{32}"),
}

# Gazetteers and cue words.
_DOMAINS = "com|org|net|edu|gov|io|info|biz|de|fr|es|uk|it|nl|eu|us|example"
_CALLING_CODES = "1|33|34|39|44|49|31|32|41|43|351|52|54|55|61|81|86|91"
_ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6[05]|35|30|36|38"
CUES = {
    "email": "mail|contact|write|reach|from:|to:", "ip": r"ip\b|address|host|server|client|login",
    "card": "card|visa|master|amex|credit|payment|debit", "phone": "phone|call|tel|mobile|fax|cell|whatsapp",
    "secret": "token|key|secret|passw|auth|credential|bearer",
}
AGAINST = r"isbn|version|\bv[0-9]|order|invoice|sku|page|commit|sha|md5|checksum|serial"

_SPAN = "struct<start:int,end:int,span:string,before:string>"


def _found(text: Column, pattern: str, needs: Callable[[Column], Column]) -> Column:
    """All matches from left to right, with their places in code points and up to 32 characters before each.

    Each match is taken together with what lies between it and the one before, so lengths add up to places.
    """
    whole = F.lit(rf"\G(?s)(.*?)({pattern})")
    parts = F.arrays_zip(F.regexp_extract_all(text, whole, F.lit(1)).alias("gap"),
                         F.regexp_extract_all(text, whole, F.lit(2)).alias("span"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["span"])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(
            start.alias("start"), end.alias("end"), part["span"].alias("span"),
            F.substring(part["gap"], -32, 32).alias("before")))).alias("spans"))

    nothing = F.array().cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    return F.when(needs(text), F.aggregate(parts, start, step)["spans"]).otherwise(nothing)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def _luhn(span: Column) -> Column:
    digits = F.split(F.reverse(_digits(span)), "")

    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 0, c.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(digits, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return span.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(span)).between(13, 19) & _luhn(span)
    if kind == "phone":
        return F.length(_digits(span)).between(9, 15)
    return F.lit(True)


def _gazetteer(kind: str, span: Column) -> Column:
    known = {
        "email": rf"(?i)(?:{_DOMAINS})$", "ip": r"^(?!0+\.|255\.|24[0-9]\.|25[0-4]\.)", "card": rf"^(?:{_ISSUERS})",
        "phone": rf"^\+?(?:00)?(?:{_CALLING_CODES})(?![0-9]{{4}})", "secret": "(?:[0-9].*?[a-fA-F].*?){6}",
    }[kind]
    return F.when(span.rlike(known), 1).otherwise(-1)


def _votes(kind: str, text: Column, span: Column, valid: Column) -> list[Column]:
    """One vote of each labeler: 1 for personal data, -1 against, 0 none."""
    before, after = F.substring(span["before"], -1, 1), F.substring(text, span["end"] + 1, 1)
    return [
        F.when(valid, 1).otherwise(-1).alias("form"),
        _gazetteer(kind, span["span"]).alias("gazetteer"),
        F.when(span["before"].rlike(rf"(?i)(?:{CUES[kind]})"), 1).when(span["before"].rlike(rf"(?i)(?:{AGAINST})"), -1)
        .otherwise(0).alias("context"),
        F.when(before.rlike(r"[\p{L}\p{N}_]") | after.rlike(r"[\p{L}\p{N}_]"), -1).otherwise(1).alias("edges"),
    ]


def candidates(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` as (doc, text, base, wide): arrays of spans with kind, place and votes. Base spans are the valid matches
    of the base patterns; wide spans are those of the wider patterns that overlap none of them."""
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    found = rows.withColumns(
        {f"base_{k}": _found(text, BASE[k], _NEEDS[k]) for k in KINDS}
        | {f"wide_{k}": _found(text, WIDE[k], _WIDE_NEEDS[k]) for k in WIDE}
    )

    def labelled(kind: str, spans: Column, valid: Callable[[Column], Column]) -> Column:
        rank = (*KINDS, *ADDED_KINDS).index(kind)
        return F.transform(spans, lambda s: F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            *_votes(kind, text, s, valid(s["span"])), F.least(F.length(s["span"]) / F.lit(8), F.lit(7)).cast("int").alias("size")))

    def checked(kind: str) -> Column:
        return F.filter(F.col(f"base_{kind}"), lambda s: _valid(kind, s["span"]))

    sure = found.withColumn("base", F.concat(*(labelled(k, checked(k), lambda _: F.lit(True)) for k in KINDS)))
    # a wide span has the form only if the base checks hold for it: digits that fail theirs are voted down
    wide = F.concat(*(labelled(
        k, F.col(f"wide_{k}"), (lambda k: lambda s: _valid(k, s) if k in ("card", "phone") else F.lit(True))(k)) for k in WIDE))
    return sure.select("doc", "text", "base", wide.alias("all_wide")).select(
        "doc", "text", "base",
        F.filter("all_wide", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))).alias("wide"))


class Model(NamedTuple):
    """Weights of the span classifier by (feature, value); reliability is P(vote | class) by labeler, for inspection."""

    weights: dict[tuple[str, object], float]
    reliability: dict[str, dict[int, tuple[float, float]]]


FEATURES = ("kind", *LABELERS, "size")


def fit(docs: DataFrame, text_col: str = "text", rounds: int = 50) -> Model:
    """Train on the candidates of all of ``docs``. Spark counts each pattern of kind, votes and size, of which there are
    some thousands at most whatever the input; expectation-maximisation and the classifier work on these counts."""
    spans = candidates(docs, text_col).select(F.explode(F.concat("base", "wide")).alias("s")).select("s.*")
    return _train(spans.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n")).collect(), rounds)


def _train(patterns: list, rounds: int) -> Model:
    if not patterns:
        return Model({}, {})
    patterns = sorted(patterns, key=repr)
    n = np.array([p["n"] for p in patterns], float)
    votes = np.array([[p[name] for name in LABELERS] for p in patterns])
    kinds = sorted({p["kind"] for p in patterns})
    kind = np.array([kinds.index(p["kind"]) for p in patterns])
    truth = 1 / (1 + np.exp(-votes.sum(axis=1)))
    said = np.stack([votes == -1, votes == 1], axis=2).astype(float)  # a labeler that does not vote says nothing
    hopes = np.array([[1.0, 4.0], [4.0, 1.0]])  # labelers are taken to be better than chance
    table = np.empty((2, len(LABELERS), 2))
    for _ in range(rounds):
        prior = np.array([((n * truth)[kind == k].sum() + 1) / (n[kind == k].sum() + 2) for k in range(len(kinds))])
        for c, weight in enumerate((n * truth, n * (1 - truth))):
            count = np.einsum("p,plv->lv", weight, said) + hopes[c]
            table[c] = count / count.sum(axis=1, keepdims=True)
        logs = np.einsum("plv,clv->cp", said, np.log(table)) + np.log([prior[kind], 1 - prior[kind]])
        truth = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
    known = [[(f, p[f]) for f in FEATURES if f not in LABELERS or p[f]] for p in patterns]
    columns = {key: i for i, key in enumerate(sorted({key for keys in known for key in keys}, key=repr))}
    x = np.zeros((len(patterns), len(columns)))
    for i, keys in enumerate(known):
        x[i, [columns[key] for key in keys]] = 1
    share, w = n / n.sum(), np.zeros(len(columns))
    for _ in range(100):  # Newton steps on the soft labels, with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (share * (p - truth)) + 1e-4 * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        move = np.linalg.solve(bend, slope)
        w -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    reliability = {name: {v: (float(table[0, i, j]), float(table[1, i, j])) for j, v in enumerate((-1, 1))}
                   for i, name in enumerate(LABELERS)}
    return Model({key: float(w[i]) for key, i in columns.items()}, reliability)


def _score(model: Model, span: Column) -> Column:
    """The classifier's logit for a span."""
    total = F.lit(0.0)
    for feature in FEATURES:
        known = [(value, w) for (name, value), w in model.weights.items() if name == feature]
        if known:
            term = F.when(span[feature] == known[0][0], known[0][1])
            for value, w in known[1:]:
                term = term.when(span[feature] == value, w)
            total = total + term.otherwise(0.0)
    return total


def find(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` as (doc, text, base, spans): the row, its text, the base spans and all spans.

    Spans are structs with kind, start and end (code points, end exclusive), ordered by kind and then start. Base spans
    always stay; wider candidates are added where the classifier finds them likelier than not. NULL text counts as
    empty and has no span; each of several equal rows gets the same spans; an empty frame gives an empty frame; text of
    any length is searched whole. Columns of ``docs`` may have any name: they travel in ``doc``.
    """
    both = F.col("base")
    if model.weights:
        both = F.concat("base", F.filter("wide", lambda s: _score(model, s) > 0))

    def placed(spans: Column) -> Column:
        return F.array_sort(F.transform(spans, lambda s: F.struct(
            *(s[name].alias(name) for name in ("rank", "start", "end", "kind")))))

    return candidates(docs, text_col).select("doc", "text", placed(F.col("base")).alias("base"), placed(both).alias("spans"))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in capitals between angle brackets; overlapping spans as one."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]),
                                     F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
