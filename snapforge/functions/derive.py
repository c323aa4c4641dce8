"""Derivations of snapshot columns from raw ones, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .text import WHITE, capitalize, strip


def lookup(table: dict, key: Column) -> Column:
    """Null where the key isn't in the table."""
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))[key]


def parts(c: Column, separator: str = ",") -> Column:
    return F.transform(F.split(c, separator), strip)


def owner(c: Column) -> Column:
    """struct(company, city, country) of 'Company, City, Country'; the country is the last of three and more parts."""
    p = parts(F.coalesce(c, F.lit("")))
    part = lambda i: F.coalesce(F.try_element_at(p, F.lit(i)), F.lit(""))
    return F.struct(part(1).alias("company"), part(2).alias("city"), F.when(F.size(p) >= 3, part(-1)).otherwise("").alias("country"))


def country(c: Column) -> Column:
    words = F.filter(F.split(c, f"{WHITE}+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.when(w.isin(*K.COUNTRY_SMALL_WORDS), w).otherwise(capitalize(w))), " ")


def country_override(c: Column) -> Column:
    return F.coalesce(lookup(K.COUNTRY_OVERRIDES, c), c)


def facility_grouping(scope: Column) -> Column:
    groups = F.array_sort(F.array_distinct(F.array_compact(F.transform(parts(scope), lambda x: lookup(K.FACILITY_GROUP_OF, x)))))
    return F.when(scope.isNull(), "").when(F.size(groups) > 0, F.array_join(groups, ", ")).otherwise("Unclassified")


def scope_description(scope: Column) -> Column:
    named = F.transform(parts(scope), lambda x: F.coalesce(lookup(K.SCOPE_DESCRIPTIONS, x), F.lit("No Mapping")))
    return F.when(F.coalesce(scope, F.lit("")) == "", "Unknown").otherwise(F.array_join(named, ", "))


def status(code: Column) -> Column:
    s = strip(F.coalesce(code.cast("string"), F.lit("")))
    number = F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))
    return F.when(~s.rlike(r"^[+-]?[0-9]+$"), "").otherwise(F.coalesce(lookup(K.STATUSES, number), F.lit("Unknown")))


def certificate_type(number: Column) -> Column:
    head = F.upper(F.array_join(F.slice(parts(F.coalesce(number, F.lit("")), "-"), 1, 2), " "))
    return F.coalesce(lookup(K.TYPE_ALIASES | {k: v for k, v in K.CERTIFICATE_TYPES.items() if k not in K.TYPE_ALIASES}, head), F.lit("Undefined"))


def certificate_class(kind: Column) -> Column:
    return F.coalesce(lookup({v: k for k, v in reversed(K.CERTIFICATE_TYPES.items())}, kind), F.lit("Unknown"))


def coordinate(link: Column, which: int) -> Column:
    """Latitude (0) or longitude (1) behind the link's last marker, or Unknown."""
    found = F.filter(parts(F.split_part(link, F.lit("maps?q="), F.lit(-1))), lambda x: x != "")
    known = F.coalesce(F.contains(link, F.lit("maps?q=")), F.lit(False)) & (F.size(found) >= 2)
    return F.when(known, F.get(found, F.lit(which))).otherwise("Unknown")
