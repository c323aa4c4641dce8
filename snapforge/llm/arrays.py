"""Column expressions over arrays of words: rolling windows without a row a word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space as the contracts define it.
SPACE = "[\\x20\\x09-\\x0D]"
#: What separates words of letters and digits, once A-Z are lower case.
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def split_words(text: Column, separator: str) -> Column:
    """The words between runs of separator; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{separator}+"), "")


def ahead(c: Column, by: int, size: Column) -> Column:
    """The array without its first entries; size is any bound on its length."""
    return F.slice(c, by + 1, F.greatest(size - by, F.lit(0)))


def joined(a: Column, b: Column) -> Column:
    """A hash for each pair of neighbours in two arrays."""
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def running(values: Column, combine=lambda a, b: a + b, neutral: Column | None = None) -> Column:
    """What combine makes of each entry and all before it, in log n passes over the array; neutral changes nothing."""
    neutral = F.lit(0) if neutral is None else neutral

    def step(held: Column, k: Column) -> Column:
        before = F.slice(F.concat(F.array_repeat(neutral, F.call_function("shiftleft", F.lit(1), k)), held), F.lit(1), F.size(held))
        return F.zip_with(held, before, combine)

    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(values).cast("long"))) - 1), values, step)
