"""Declared data-quality checks as Spark jobs: one result row per check."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marelake.functions import UNKNOWN_NUMBER, member_key, surrogate_key
from marelake.functions.scalars import NULL_KEY_PART


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, unique, accepted_values or relationships.

    ``of`` may name the column whose surrogate key (in a relationship: member key) the
    checked column holds.
    """

    model: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    to: str = ""
    field: str = ""
    where: str | None = None
    of: str = ""


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(model, column, check, failures) for every check.

    One pass over each table, whatever checks it takes part in and in whatever part: the
    pass gives a row per broken not_null or accepted_values check and per value that is
    counted.  Checks on the same values (a key that is unique and a parent's, say) share
    those rows.  All rows meet in one count by (rows, value), which combines map-side, and
    the relationships in one window over what is left of them.

    Whole numbers travel as such, other values as text.  A surrogate key travels as the
    number it is the digest of (``Check.of``), a fifth of its bytes, where no row of the
    table has another key; if one has, digests are compared.  For keys that are made in
    the table's own plan, Spark sees that from the plan and reads nothing.
    """
    kinds = {t: dict(tables[t].dtypes) for t in sorted({c.model for c in checks} | {c.to for c in checks if c.to})}
    coded = _coded_keys(tables, checks, kinds)
    ends = sorted({(c.to, c.field) for c in checks if c.kind == "relationships"})
    numbers = {e for e in ends if e in coded and all((c.model, c.column) in coded for c in checks if (c.to, c.field) == e)}
    found: dict[str, list[tuple[object, Column, Column, Column]]] = {t: [] for t in kinds}  # (name, there, number, text) of rows
    uses: dict[tuple[str, object], list[tuple[int | None, int | None, bool]]] = {}  # (end or None, check or None for the parent, unique)

    def add(table: str, rows: list[tuple[object, Column, Column, Column]], use: tuple[int | None, int | None, bool]) -> None:
        for row in rows:
            if (table, row[0]) not in uses:
                found[table].append(row)
            uses.setdefault((table, row[0]), []).append(use)

    for n, (t, f) in enumerate(ends):
        add(t, _keys(f, coded[t, f], None) if (t, f) in numbers else _values(f, kinds[t][f], None), (n, None, False))
    for i, c in enumerate(checks):
        own, to = kinds[c.model][c.column], (c.to, c.field)
        code = coded.get((c.model, c.column))
        if c.kind == "unique":
            add(c.model, _keys(c.column, code, c.where) if code else _values(c.column, own, c.where), (None, i, True))
        elif c.kind == "relationships":
            rows = _keys(c.column, code, c.where) if to in numbers else _values(c.column, own, c.where, kinds[c.to][c.field])
            add(c.model, rows, (ends.index(to), i, False))
        else:
            add(c.model, [(i, F.col(f"_broken{i}"), _null("bigint"), _null("string"))], (None, i, False))
    numbered = {row: n for n, row in enumerate(uses)}
    passes = []
    for table, rows in found.items():
        broken = {f"_broken{i}": _violation(c, kinds[table]) for i, c in enumerate(checks) if c.model == table and c.kind in ("not_null", "accepted_values")}
        structs = [_row(numbered[table, name], there, number, text) for name, there, number, text in rows]
        passes.append(_unpivoted(tables[table].withColumns(broken) if broken else tables[table], structs))
    counts = reduce(DataFrame.unionAll, passes).groupBy("_no", "_k", "_v").agg(F.count(F.lit(1)).alias("_n"))
    failed = _failed(counts, list(uses.values()), bool(ends))
    return _named(failed.groupBy("_no").agg(F.sum("_n").alias("failures")), list(enumerate(checks)))


WHOLE = ("tinyint", "smallint", "int", "bigint")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _row(no: int, there: Column, number: Column, text: Column) -> Column:
    return F.when(there, F.struct(F.lit(no).alias("_no"), number.alias("_k"), text.alias("_v")))


def _values(column: str, kind: str, where: str | None, parent: str = "") -> list[tuple[object, Column, Column, Column]]:
    """Rows of a column's values, in the type of the parent's column if there is one."""
    value, there = F.col(column), _held(F.col(column), where)
    if not parent or kind == parent:
        number, text = (value.cast("bigint"), _null("string")) if kind in WHOLE else (_null("bigint"), _text(value, kind))
        return [((column, kind, where), there, number, text)]
    as_parent = value.try_cast(parent)
    # what the parent's type can't hold, the parent lacks
    other = F.when(as_parent.isNull(), F.concat(F.lit("other type: "), value.cast("string")))
    number, text = (as_parent.cast("bigint"), other) if parent in WHOLE else (_null("bigint"), F.coalesce(_text(as_parent, parent), other))
    return [((column, parent, where), there, number, text)]


def _keys(column: str, code: tuple[str, bool], where: str | None) -> list[tuple[object, Column, Column, Column]]:
    """Rows of a surrogate key's numbers: a NULL has a key too, which for a member is that of the unknown one."""
    of, member = code
    value = F.col(of)
    if member:
        value = F.coalesce(value, F.lit(UNKNOWN_NUMBER).cast("bigint"))
        return [((of, "member", where), _held(value, where), value, _null("string"))]
    null_key = value.isNull() if where is None else value.isNull() & F.expr(where)
    return [*_values(of, "bigint", where), ((of, "null key", where), null_key, _null("bigint"), F.lit(NULL_KEY_PART))]


def _coded_keys(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], kinds: Mapping[str, Mapping[str, str]]
) -> dict[tuple[str, str], tuple[str, bool]]:
    """(table, column) -> (the column whose key it holds in every row, whether as a member)."""
    claims: dict[str, dict[str, tuple[str, bool]]] = {}
    for c in checks:
        if c.of and kinds[c.model].get(c.of) == "bigint" and kinds[c.model][c.column] == "string":
            claims.setdefault(c.model, {})[c.column] = (c.of, c.kind == "relationships")
    held = {}
    for table, keys in claims.items():
        differs = [~F.col(k).eqNullSafe(member_key(of) if member else surrogate_key(of)) for k, (of, member) in keys.items()]
        if tables[table].where(reduce(Column.__or__, differs)).isEmpty():
            held |= {(table, k): code for k, code in keys.items()}
    return held


def _failed(counts: DataFrame, uses: Sequence[Sequence[tuple[int | None, int | None, bool]]], related: bool) -> DataFrame:
    """(_no, _n): what each counted value adds to the failures of each check that it is counted for.

    A value held by more than one row fails a unique check once.  The values of a relationship
    fail with all their rows unless the parent holds them.  Child rows are counted per value
    before, so a value that fills a third of the table is one row here, and the rows of a value
    are at most as many as the checks.
    """
    parts = []
    for rows in uses:
        own: dict[tuple[int | None, bool], list[int]] = {}
        for end, check, unique in rows:
            own.setdefault((end, unique), []).extend([] if check is None else [check])
        parts.append([(end, (end, None, False) in rows, unique, checks) for (end, unique), checks in own.items()])
    kind = "array<array<struct<_end:int,_parent:boolean,_unique:boolean,_checks:array<int>>>>"
    as_json = json.dumps([[dict(zip(("_end", "_parent", "_unique", "_checks"), p)) for p in own] for own in parts])
    part = F.explode(F.get(F.from_json(F.lit(as_json), kind), F.col("_no"))).alias("p")
    out = counts.select("_k", "_v", "_n", part).where(~F.col("p._unique") | (F.col("_n") > 1))
    if related:
        known = F.max("p._parent").over(Window.partitionBy("p._end", "_k", "_v"))
        out = out.withColumn("_known", known).where(~F.col("_known"))
    n = F.when(F.col("p._unique"), F.lit(1)).otherwise(F.col("_n"))
    return out.select(F.explode("p._checks").alias("_no"), n.alias("_n"))


def _violation(check: Check, kinds: Mapping[str, str]) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        bad = c.isNull()
    elif kinds[check.column] == "string":
        # a pattern, unlike IN, is folded away by Spark over a CASE that has allowed texts only; NULL breaks nothing
        bad = ~c.rlike("\\A(?:" + "|".join(_quoted(v) for v in check.values) + ")\\z") if check.values else c.isNotNull()
    else:
        bad = c.isNotNull() & ~c.isin(list(check.values))
    return bad if check.where is None else F.expr(check.where) & bad


def _quoted(value: str) -> str:
    return "\\Q" + value.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _named(failures: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """A row for every check, those without failures too."""
    rows = [(i, c.model, c.column, c.kind) for i, c in checks]
    listed = failures.sparkSession.createDataFrame(rows, "_no int, model string, column string, check string")
    found = listed.join(F.broadcast(failures), "_no", "left")  # a row per check
    return found.select("model", "column", "check", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"))


def _text(c: Column, kind: str) -> Column:
    """A value as text, so that columns of any type share one aggregate."""
    if kind in ("double", "float"):
        return (c + F.lit(0.0)).cast("string")  # one zero
    return F.hex(c) if kind == "binary" else F.to_json(c) if kind.startswith(("struct", "map", "array")) else c.cast("string")


def _unpivoted(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """One row for each of ``rows`` (structs) that is there; one scan of ``df``."""
    return df.select(F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("r")).select("r.*")


def _held(value: Column, where: str | None) -> Column:
    """Whether a row takes part: its value is there and the check's condition holds."""
    return value.isNotNull() if where is None else value.isNotNull() & F.expr(where)
