"""Strict text-to-type coercion as column expressions.

Spark's casts are more lenient than the source format (they trim blanks, accept ``1.0d``,
``yes`` or ``2024``), so each cast sits behind a pattern that must match the whole text.
Empty text means NULL for every type but string. Nothing here leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from changevault.model import PAGE, REJECT_FIELDS, REJECT_KEY, REJECTS, SPARK_TYPES, ColumnDef, col, quoted
from changevault.session import local_frame

# The accepted text forms.
INTEGER = r"\A[+-]?[0-9]+\z"
DECIMAL = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
SPECIAL_NUMBER = r"\A(?i)([+-]?inf(inity)?|nan)\z"
DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
RFC3339 = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}"
    r"(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"
)
UTC_MILLIS = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}\+0000\z"
TRUE_TEXT = ("1", "t", "T", "TRUE", "true", "True")
FALSE_TEXT = ("0", "f", "F", "FALSE", "false", "False")


def coerced_sql(text: str, type_name: str) -> str:
    """SQL of the typed value of a text; NULL for NULL, for empty text (string excepted) and for bad text."""
    if type_name == "string":
        return text
    if type_name in ("long", "int"):
        target = "BIGINT" if type_name == "long" else "INT"
        return f"CASE WHEN {text} RLIKE r'{INTEGER}' THEN try_cast({text} AS {target}) END"
    if type_name in ("double", "float"):
        number = f"try_cast({text} AS DOUBLE)"
        value = (
            f"CASE WHEN {text} RLIKE r'{DECIMAL}' THEN CASE WHEN abs({number}) < double('Infinity') THEN {number} END "
            f"WHEN {text} RLIKE r'{SPECIAL_NUMBER}' THEN {number} END"
        )
        return value if type_name == "double" else f"CAST({value} AS FLOAT)"
    if type_name == "boolean":
        return f"CASE WHEN {text} IN ({_texts(TRUE_TEXT)}) THEN true WHEN {text} IN ({_texts(FALSE_TEXT)}) THEN false END"
    if type_name == "date":
        return f"CASE WHEN {text} RLIKE r'{DATE}' THEN try_cast({text} AS DATE) END"
    if type_name == "timestamp":
        return f"CASE WHEN {text} RLIKE r'{RFC3339}' OR {text} RLIKE r'{UTC_MILLIS}' THEN try_cast({text} AS TIMESTAMP_LTZ) END"
    if type_name == "binary":
        return f"CASE WHEN {text} <> '' THEN encode({text}, 'UTF-8') END"
    raise ValueError(f"unknown column type {type_name!r}")


def rejected_sql(text: str, type_name: str) -> str:
    """SQL that is true where non-empty text cannot be read as the type."""
    if type_name in ("string", "binary"):
        return "false"
    return f"coalesce({text} <> '' AND ({coerced_sql(text, type_name)}) IS NULL, false)"


def coerced(name: str, type_name: str) -> Column:
    """The typed value of a text column."""
    return F.expr(coerced_sql(quoted(name), type_name))


def is_rejected(name: str, type_name: str) -> Column:
    """True where a column's text cannot be read as the type."""
    return F.expr(rejected_sql(quoted(name), type_name))


def _texts(values: Sequence[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _literal(text: str) -> str:
    """Any text as a SQL literal."""
    return f"decode(unhex('{text.encode('utf-8').hex()}'), 'UTF-8')"


def _typed(name: str, type_name: str, on_error: str, key: str | None = None) -> str:
    text = quoted(name)
    value = coerced_sql(text, type_name)
    if on_error == "fail" and type_name not in ("string", "binary"):
        record = f", ' in record ', char(39), coalesce(CAST({quoted(key)} AS STRING), ''), char(39)" if key else ""
        message = f"concat({_literal(f'column {name}: cannot read ')}, char(39), {text}, char(39), ' as {type_name}'{record})"
        target = SPARK_TYPES[type_name].simpleString()
        value = f"coalesce({value}, CASE WHEN {text} <> '' THEN CAST(raise_error({message}) AS {target}) END)"
    return f"{value} AS {text}"


def coerce(df: DataFrame, columns: Sequence[ColumnDef], on_error: str = "fail", key: str | None = None) -> DataFrame:
    """Turn the named text columns into typed ones; other columns pass through.

    ``fail`` stops the job on the first bad value, naming column and value, and the record where ``key`` names its
    column; ``null`` stores NULL instead (see :func:`coercion_rejects` for the values concerned). ``reject`` does so
    too and adds ``_rejects``, the columns and values of a row that do not fit, NULL where all do; beside it
    ``_reject_key``, the key's text, and ``_page`` if the frame has it, both NULL in rows that fit. All three read a row
    once. A column that is pruned from the plan is not checked.
    """
    if on_error not in ("fail", "null", "reject"):
        raise ValueError("on_error must be 'fail', 'null' or 'reject'")
    types = {c.name: c.type for c in columns if c.name in set(df.columns)}
    typed = [
        _typed(name, types[name], on_error, key if key in df.columns else None) if name in types else quoted(name)
        for name in df.columns if on_error != "reject" or name != PAGE
    ]
    if on_error != "reject":
        return df.selectExpr(*typed)
    found = f"array_compact({_bad_cells([c for c in columns if c.name in types])})"
    told = {
        REJECT_KEY: f"CAST({quoted(key)} AS STRING)" if key in df.columns else "CAST(NULL AS STRING)",
        PAGE: quoted(PAGE) if PAGE in df.columns else "CAST(NULL AS STRING)",
    }
    return df.selectExpr(
        *typed, f"nullif({found}, array()) AS {REJECTS}",
        *[f"CASE WHEN size({found}) > 0 THEN {value} END AS {name}" for name, value in told.items()],
    )


def _bad_cells(columns: Sequence[ColumnDef]) -> str:
    """An array with a struct of column and value for each text that does not fit, else NULL in its place."""
    cells = [
        f"CASE WHEN {rejected_sql(quoted(c.name), c.type)} "
        f"THEN struct({_literal(c.name)} AS column, {quoted(c.name)} AS value) END"
        for c in columns
    ]
    kind = REJECT_FIELDS[0].dataType.simpleString()
    return f"CAST(array({', '.join(cells)}) AS {kind})"


def coercion_rejects(df: DataFrame, columns: Sequence[ColumnDef]) -> DataFrame:
    """``(column, value, n)`` for all text that does not fit its column's type, in one pass."""
    found = F.array_compact(F.expr(_bad_cells(columns)))
    return (
        df.select(F.explode(found).alias("bad"))
        .groupBy("bad.column", "bad.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def required_violations(df: DataFrame, columns: Sequence[ColumnDef]) -> DataFrame:
    """``(column, n)``: how many NULLs each required column holds, where there are any."""
    required = [c.name for c in columns if c.required]
    if not required:
        return local_frame(df.sparkSession, [], "column string, n bigint")
    counts = df.agg(*[F.count_if(col(name).isNull()).alias(f"c{i}") for i, name in enumerate(required)])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(f"c{i}").alias("n"))
        for i, name in enumerate(required)
    ])
    return counts.select(F.inline(pairs)).where("n > 0")
