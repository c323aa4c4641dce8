"""Comparison of two snapshots: added, removed and changed rows.

A snapshot carries ``ord``, the row's place in its source; it decides which row of an id is the first, and is never compared.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import comparable, strip
from ..functions.udfs import compatibility_form_once

ORD = "ord"
CHANGED = "Value_Changed"


def find_id_column(columns: list[str]) -> str:
    for exact in ("Certificate_ID", "Certificate ID"):
        if exact in columns:
            return exact
    for c in columns:
        plain = c.strip().lower().replace(" ", "_")
        if "cert" in plain and "id" in plain:
            return c
    raise KeyError("no certificate id column, such as Certificate_ID, was found")


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _values(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ORD]


def normalized(df: DataFrame) -> DataFrame:
    """All values as trimmed strings, missing ones empty; ord stays."""
    return df.select(*(strip(F.coalesce(F.col(_q(c)).cast("string"), F.lit(""))).alias(c) for c in _values(df)), *([ORD] if ORD in df.columns else []))


def _only_in(rows: DataFrame, other: DataFrame | None, schema_of: DataFrame) -> DataFrame:
    if other is None:
        return normalized(schema_of).limit(0)
    rows, other = normalized(rows), normalized(other)
    key, other_key = find_id_column(_values(rows)), find_id_column(_values(other))
    ids = other.select(F.col(_q(other_key)).alias("__other_id")).where("__other_id <> ''")
    return rows.where(F.col(_q(key)) != "").join(ids, F.col(_q(key)) == F.col("__other_id"), "left_anti")


def added(previous: DataFrame | None, current: DataFrame) -> DataFrame:
    """Rows of current whose non-blank id isn't in previous; repeated rows stay. No previous: none."""
    return _only_in(current, previous, current)


def removed(previous: DataFrame | None, current: DataFrame) -> DataFrame:
    """Rows of previous whose non-blank id isn't in current; repeated rows stay. No previous: none."""
    return _only_in(previous if previous is not None else current, current if previous is not None else None, current)


def comparable_columns(current: list[str], previous: list[str], ignore_cols=None, ignore_patterns=None) -> list[str]:
    """Shared columns in current's order, without ids and ignored ones."""
    out = [c for c in current if c in previous and c not in (find_id_column(current), find_id_column(previous), ORD) and c not in (ignore_cols or [])]
    out = [c for c in out if not any(re.search(p, c, re.IGNORECASE) for p in ignore_patterns or [])]
    if not out:
        raise ValueError("no comparable columns are left")
    return out


def _trimmed_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def first_per_id(df: DataFrame, key: str) -> DataFrame:
    """The first row of each id, by ord; partial results are merged before the shuffle, so one id may hold any share of the rows."""
    order = F.col(ORD) if ORD in df.columns else F.lit(0)
    rest = [c for c in df.columns if c != key]
    return df.groupBy(_q(key)).agg(F.min_by(F.struct(*map(_q, rest)), order).alias("__row")).select(_q(key), *(F.col(f"__row.{_q(c)}") for c in rest)).select(*map(_q, df.columns))


def changed(
    previous: DataFrame | None,
    current: DataFrame,
    ignore_cols: list[str] | None = None,
    ignore_patterns: list[str] | None = None,
    case_insensitive: bool = True,
    apply_location_suffix_rule: bool = True,
    location_suffix_patterns: list[str] | None = None,
    custom_equivalence_rules: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Current first rows of ids in both snapshots whose comparable columns differ, and the names of those that do.

    Ids are compared untrimmed, a blank one like any other. Rows equal as they stand leave before any text is normalised.
    """
    current = _trimmed_names(current)
    if previous is None:
        return current.select("*", F.lit(None).cast("string").alias(CHANGED)).limit(0)
    previous = _trimmed_names(previous)
    text = lambda df: df.select(*((F.date_format(_q(c), "yyyy-MM-dd HH:mm:ss") if t.startswith("timestamp") else F.col(_q(c)).cast("string")).alias(c) if c != ORD else F.col(ORD) for c, t in df.dtypes)).fillna("", _values(df))
    now, then = text(current), text(previous)
    key, other = find_id_column(_values(now)), find_id_column(_values(then))
    shared = comparable_columns(_values(now), _values(then), ignore_cols, ignore_patterns)
    then = first_per_id(then.select(_q(other), *map(_q, shared), *([ORD] if ORD in then.columns else [])), other)
    then = then.select(F.col(_q(other)).alias("__id"), F.struct(*map(_q, shared)).alias("__then"))
    both = first_per_id(now, key).join(then, F.col(_q(key)) == F.col("__id"))
    both = both.where(~F.struct(*map(_q, shared)).eqNullSafe(F.col("__then")))
    sides = [*(compatibility_form_once(_q(c)).alias(f"__a{i}") for i, c in enumerate(shared)), *(compatibility_form_once(F.col(f"__then.{_q(c)}")).alias(f"__b{i}") for i, c in enumerate(shared))]
    both = both.select(*map(_q, now.columns), *sides)
    form = lambda c: comparable(F.col(c), case_insensitive, apply_location_suffix_rule, location_suffix_patterns, custom_equivalence_rules)
    differ = F.array_compact(F.array(*(F.when(form(f"__a{i}") != form(f"__b{i}"), F.lit(c)) for i, c in enumerate(shared))))
    return both.select(*map(_q, now.columns), F.array_join(differ, ", ").alias(CHANGED)).where(F.col(CHANGED) != "")


def without_change(report: DataFrame, value: str = "Company_Name, City", loose_space: bool = False) -> DataFrame:
    """The changed report without rows whose whole change is value; loose_space lets any white space follow its commas."""
    if loose_space:
        pattern = "^" + r",\s*".join(re.escape(p) for p in value.split(", ")) + "$"
        return report.where(~F.coalesce(F.col(CHANGED).rlike(pattern), F.lit(False)))
    return report.where(~F.col(CHANGED).eqNullSafe(F.lit(value)))


def summary(**reports: DataFrame) -> DataFrame:
    """metric, value: the number of rows of each report."""
    counted = [df.select(F.lit(name).alias("metric"), F.lit(1).alias("one")) for name, df in reports.items()]
    spark = next(iter(reports.values())).sparkSession
    names = spark.createDataFrame([(n,) for n in reports], "metric string")
    union = counted[0]
    for c in counted[1:]:
        union = union.unionByName(c)
    return names.join(union.groupBy("metric").agg(F.count("*").alias("n")), "metric", "left").select("metric", F.coalesce("n", F.lit(0)).cast("long").alias("value"))
