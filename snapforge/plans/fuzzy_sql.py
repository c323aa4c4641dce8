"""DuckDB SQL for the fuzzy scores, all pairs: the oracle of the blocked comparison. Strings are ASCII and at most 60 characters long."""

from __future__ import annotations

from ..functions import constants as K

PROCESS = "trim(regexp_replace(lower({0}), '[^a-z0-9]', ' ', 'g'))"


def common(a: str, b: str) -> str:
    """Length of the longest common subsequence: a bit for each place of a, gone over once for each character of b."""
    every = f"((CAST(1 AS BIGINT) << length({a})) - 1)"
    mask = f"CAST(coalesce(list_sum(list_transform(range(length({a})), lambda i: CASE WHEN {a}[i + 1] = c THEN CAST(1 AS BIGINT) << i ELSE 0 END)), 0) AS BIGINT)"
    masks = f"list_transform(string_split({b}, ''), lambda c: {mask})"
    return f"(length({a}) - bit_count(list_reduce({masks}, lambda v, m: ((v + (v & m)) | (v - (v & m))) & {every}, {every})))"


def rounded(common_length: str, total: str) -> str:
    return f"CASE WHEN {total} = 0 THEN 100 ELSE CAST(round_even(CAST(200 * {common_length} AS DOUBLE) / {total}, 0) AS INT) END"


def companies(rows: str, company_key: str, least: int, name: str) -> str:
    """CTEs that end in name: rows with "Company_Name" replaced where a company in assets is similar enough."""
    key = company_key.format
    return f"""
universe AS (SELECT {key('"Company/Producer"')} AS choice, "Company/Producer Short Name" AS short, 2 * ord AS seq, ord AS pos FROM assets
  UNION ALL SELECT {key('"Company/Producer Short Name"')}, "Company/Producer Short Name", 2 * ord + 1, 1000000000 + ord FROM assets),
choices AS (SELECT choice, max_by(short, seq) AS short, min(pos) AS pos, {PROCESS.format('choice')} AS c FROM universe WHERE choice <> '' GROUP BY choice),
names AS (SELECT *, {PROCESS.format('k')} AS q FROM (SELECT DISTINCT {key('"Company_Name"')} AS k FROM {rows})),
near AS (SELECT k, short, pos, q, c FROM names, choices WHERE q <> '' AND 200 * least(length(q), length(c)) >= {least - 0.5} * (length(q) + length(c))),
scored AS (SELECT k, short, pos, {rounded(common('q', 'c'), '(length(q) + length(c))')} AS score FROM near),
best AS (SELECT k, short FROM scored WHERE score >= {least} QUALIFY row_number() OVER (PARTITION BY k ORDER BY score DESC, pos) = 1),
{name} AS (SELECT r.* REPLACE (coalesce(best.short, r."Company_Name") AS "Company_Name") FROM {rows} r LEFT JOIN best ON {key('r."Company_Name"')} = best.k)"""


def assets(rows: str, least: int, name: str) -> str:
    """CTEs that end in name: rows with "Asset_Identifier" and "Match_Found"."""
    tokens = "list_sort(list_distinct(string_split_regex({0}, ' +')))"
    joined = "array_to_string({0}, ' ')"
    without = "list_filter({0}, lambda x: NOT list_contains({1}, x))"
    return f"""
identified AS (SELECT *, trim(trim("Company_Name") || ' ' || trim("City")) AS "Asset_Identifier" FROM {rows}),
ids AS (SELECT DISTINCT "Asset_Identifier" AS id FROM identified WHERE trim(lower("Asset_Identifier")) <> '' AND trim(lower("Asset_Identifier")) NOT IN (SELECT trim(lower("Asset Identifier")) FROM assets)),
left_sets AS (SELECT id, {tokens.format('q')} AS a FROM (SELECT id, {PROCESS.format('id')} AS q FROM ids) WHERE q <> ''),
right_sets AS (SELECT DISTINCT {tokens.format('c')} AS b FROM (SELECT {PROCESS.format('"Asset Identifier"')} AS c FROM assets) WHERE c <> ''),
sets AS (SELECT id, a, b, list_filter(a, lambda x: list_contains(b, x)) AS i FROM left_sets, right_sets),
sides AS (SELECT id, len(i) > 0 AND (len(i) = len(a) OR len(i) = len(b)) AS within, {joined.format('i')} AS s, trim({joined.format('i')} || ' ' || {joined.format(without.format('a', 'b'))}) AS x, trim({joined.format('i')} || ' ' || {joined.format(without.format('b', 'a'))}) AS y FROM sets),
found AS (SELECT DISTINCT id FROM sides WHERE within OR s <> '' AND {rounded('length(s)', '(length(s) + least(length(x), length(y)))')} >= {least} OR {rounded(common('x', 'y'), '(length(x) + length(y))')} >= {least}),
{name} AS (SELECT r.*, CASE WHEN found.id IS NOT NULL OR trim(lower("Asset_Identifier")) IN (SELECT trim(lower("Asset Identifier")) FROM assets) THEN 1 ELSE 0 END AS "Match_Found" FROM identified r LEFT JOIN found ON r."Asset_Identifier" = found.id)"""
