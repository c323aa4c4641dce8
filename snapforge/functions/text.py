"""Cleaning and normalising of text, as native column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import COMPANY_REMOVALS, INVISIBLE, LOCATION_SUFFIXES

#: White space as Python knows it.
WHITE = r"(?U)[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WHITE}+\z|\A{WHITE}+", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WHITE}+", " ")


def safe(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def clean_cell(c: Column) -> Column:
    """Control characters, quotes and invisible characters out, white space to single spaces; null is empty."""
    s = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    s = F.translate(s, "\t\u00a0\r", "  ")
    s = F.replace(s, F.lit("&nbsp;"), F.lit(" "))
    s = F.translate(s, '\n\u200b\u200c\u200d\ufeff\u00ad"', " ")
    return collapse(strip(s))


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def company_key(c: Column) -> Column:
    """The company name for fuzzy comparison: fixed literals to spaces, one after the other."""
    s = reduce(lambda x, w: F.replace(x, F.lit(w), F.lit(" ")), COMPANY_REMOVALS, F.lower(F.coalesce(c, F.lit(""))))
    return strip(collapse(s))


def match_key(c: Column, strict_punct: bool = False) -> Column:
    """The asset identifier for exact comparison: lower case without outer white space.

    With strict_punct also punctuation to spaces and white space to single ones.
    """
    s = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    if strict_punct:
        return strip(collapse(F.regexp_replace(s, r"[.,;:/\-()\[\]&\\]", " ")))
    s = F.regexp_replace(s, r"[\\.,;:/()\[]&\]", " ")
    return strip(F.regexp_replace(s, r"\\s+", " "))


def plain_key(c: Column) -> Column:
    """Lower case without spaces and quotes; a missing value reads nan and so matches another one."""
    return F.translate(F.lower(F.coalesce(c.cast("string"), F.lit("nan"))), " \"'", "")


def asset_identifier(company: Column, city: Column) -> Column:
    return strip(F.concat(safe(company), F.lit(" "), safe(city)))


def tidy(c: Column) -> Column:
    """What is left of a comparison's text clean-up once it is in compatibility form."""
    return collapse(strip(F.translate(c, INVISIBLE, "")))


def comparable(c: Column, case_insensitive: bool = True, suffix_rule: bool = True, suffixes: list[str] | None = None, rules: list[tuple[str, str]] | None = None) -> Column:
    """Text (in compatibility form) as two snapshots compare it; rules are (expression, replacement) with \\1 for groups."""
    s = tidy(c)
    s = F.lower(s) if case_insensitive else s
    for pattern, replacement in rules or []:
        s = F.regexp_replace(s, pattern, _groups(replacement))
    for pattern in (LOCATION_SUFFIXES if suffixes is None else suffixes) if suffix_rule else []:
        s = F.regexp_replace(s, pattern, "")
    return s


def _groups(replacement: str) -> str:
    import re

    return re.sub(r"\\(\d+)", r"$\1", replacement.replace("$", r"\$"))
