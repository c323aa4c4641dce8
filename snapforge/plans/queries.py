"""The registered queries over the driver's tables, and their DuckDB SQL.

The tables hold no certificates, so inputs are made from customers, nations and suppliers by SQL that both engines read: a
fixture's text stands once, runs in Spark with its tables as arguments, and opens the oracle as a common table expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import derive as D
from ..functions import text as T
from ..functions.udfs import html_cell
from ..operators import diff, resolve
from . import fuzzy_sql
from .snapshot import build_snapshot, derive, with_status_style

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Fixtures in SQL that Spark and DuckDB read alike.
FIXTURES = {
    "prev": """SELECT 'C-' || CAST(c_custkey AS STRING) AS Certificate_ID, c_name AS Company_Name, 'city ' || CAST(c_nationkey AS STRING) AS City, c_mktsegment AS Segment, c_custkey AS ord
        FROM customer WHERE c_custkey % 17 <> 0""",
    "cur": """SELECT 'C-' || CAST(c_custkey AS STRING) AS Certificate_ID, CASE WHEN c_custkey % 5 = 0 THEN upper(c_name) || '  ' WHEN c_custkey % 11 = 0 THEN c_name || ' x' ELSE c_name END AS Company_Name,
        CASE WHEN c_custkey % 13 = 0 THEN 'town ' || CAST(c_nationkey AS STRING) ELSE 'city ' || CAST(c_nationkey AS STRING) END AS City,
        CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || ' II' ELSE c_mktsegment END AS Segment, c_custkey AS ord FROM customer WHERE c_custkey % 19 <> 0""",
    "prev_dups": """SELECT CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN 'P-' || CAST(c_custkey AS STRING) ELSE 'D-' || CAST(c_custkey % 500 AS STRING) END AS Certificate_ID,
        c_mktsegment AS V, c_custkey AS ord FROM customer""",
    "cur_dups": """SELECT CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 19 = 0 THEN ' N-' || CAST(c_custkey % 40 AS STRING) ELSE 'D-' || CAST(c_custkey % 500 AS STRING) END AS Certificate_ID,
        CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || '!' ELSE c_mktsegment END AS V, c_custkey AS ord FROM customer""",
    "raw": """SELECT c_custkey AS ord, '' AS cert_ikon,
        CASE c_custkey % 8 WHEN 0 THEN 'EU-ISCC-Cert-X' WHEN 1 THEN 'ISCC-PLUS-' WHEN 2 THEN 'ISCC-CORSIA-' WHEN 3 THEN 'CORSIA-ISCC-' WHEN 4 THEN 'DE-B-BLE-BM-' WHEN 5 THEN ' iscc - japan -' WHEN 6 THEN 'foo' ELSE '' END || CAST(c_custkey AS STRING) AS cert_number,
        CASE c_custkey % 5 WHEN 0 THEN c_name WHEN 1 THEN c_name || ', CITY ' || CAST(c_nationkey AS STRING) WHEN 2 THEN c_name || ', Inc., new YORK, ' || n_name
          WHEN 3 THEN c_name || ' , lyon,' || CASE c_custkey % 7 WHEN 0 THEN 'Republic of' WHEN 1 THEN 'viet nam' WHEN 2 THEN 'HONG KONG' WHEN 3 THEN 'United  Republic of' ELSE 'the NETHERLANDS' END ELSE '' END AS cert_owner,
        CASE c_custkey % 6 WHEN 0 THEN 'TR, BP,TR' WHEN 1 THEN 'EL' WHEN 2 THEN '' WHEN 3 THEN 'TR,XX,WH' WHEN 4 THEN ' PoC-TR ,HVO , IPEL' ELSE 'WR36,CP' END AS cert_scope,
        'u' || CAST(c_custkey % 9 AS STRING) AS cert_processingunittype, c_mktsegment AS cert_in_put, '' AS cert_add_on, ' a  b ' AS cert_products, '' AS cert_valid_from, '' AS cert_valid_until, '' AS cert_suspended_date, 'cb' AS cert_issuer,
        CASE c_custkey % 5 WHEN 0 THEN 'https://m/maps?q=' || CAST(c_custkey AS STRING) || '.5, -' || CAST(c_nationkey AS STRING) || '.25' WHEN 1 THEN 'maps?q=1,2 maps?q=3,' || CAST(c_custkey AS STRING) WHEN 2 THEN 'maps?q=,,3' WHEN 3 THEN 'nothing' ELSE '' END AS cert_map,
        'f' AS cert_file, 'a' AS cert_audit,
        CASE c_custkey % 11 WHEN 0 THEN '1' WHEN 1 THEN ' 5 ' WHEN 2 THEN '10' WHEN 3 THEN '12' WHEN 4 THEN '13' WHEN 5 THEN '15' WHEN 6 THEN '20' WHEN 7 THEN '21' WHEN 8 THEN '99' WHEN 9 THEN '1.0' ELSE '' END AS cert_status
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "geo": """SELECT n_name AS "Country", 'r' || CAST(n_regionkey AS STRING) AS "Region", 's' || CAST(n_nationkey AS STRING) AS "Sub Region", n_nationkey AS ord FROM nation WHERE n_nationkey % 6 <> 0
        UNION ALL SELECT n_name AS "Country", 'last' AS "Region", 'x' || CAST(n_nationkey AS STRING) AS "Sub Region", n_nationkey + 100 AS ord FROM nation WHERE n_nationkey % 4 = 0""",
    "holders": """SELECT c_custkey AS ord, CASE c_custkey % 4 WHEN 0 THEN upper(c_name) WHEN 1 THEN 'S ' || CAST(c_custkey % 90 AS STRING) ELSE c_name END AS "Company_Name", 'town ' || CAST(c_nationkey AS STRING) AS "City", n_name AS "Country" FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "assets": """SELECT 'Customer#' || substr('00000000' || CAST(s_suppkey * 8 AS STRING), length('00000000' || CAST(s_suppkey * 8 AS STRING)) - 8, 9) AS "Company/Producer", 's' || CAST(s_suppkey % 60 AS STRING) AS "Company/Producer Short Name",
        'plant ' || CAST(s_nationkey AS STRING) AS "City", 'Customer#' || substr('00000000' || CAST(s_suppkey * 8 AS STRING), length('00000000' || CAST(s_suppkey * 8 AS STRING)) - 8, 9) || ' town ' || CAST(s_nationkey AS STRING) AS "Asset Identifier", s_suppkey AS ord FROM supplier""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    import re

    sql = FIXTURES[name].replace('"', "`")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)}
    return spark.sql(re.sub(r"\b(FROM|JOIN) (\w+)\b", r"\1 {\2}", sql), **used)


def with_fixtures(sql: str, *names: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({FIXTURES[n]})" for n in names) + ("," if sql.lstrip().startswith("+") else "") + "\n" + sql.lstrip().removeprefix("+")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None, run: Callable[[SparkSession, str], DataFrame]) -> None:
    QUERIES[name] = run
    if sql:
        ORACLE_SQL[name] = sql


def _pair(operator: Callable, a: str = "prev", b: str = "cur", **options):
    return lambda spark, sf: operator(fixture(spark, sf, a), fixture(spark, sf, b), **options)


def case_map(table: dict, expression: str, default: str) -> str:
    quoted = lambda s: "'" + str(s).replace("'", "''") + "'"
    return f"CASE {expression} " + " ".join(f"WHEN {k if isinstance(k, int) else quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + f" ELSE {default} END"


NORM = r"regexp_replace(trim(regexp_replace({}, '[ \t\n\r\f\v]+', ' ', 'g')), '\s+$', '')"
TRIM = "trim({})"


def _changed_sql(cols: list[str], lower: bool = True, prev: str = "prev", cur: str = "cur") -> str:
    form = lambda side, c: ("lower(" if lower else "(") + NORM.format(f"coalesce({side}.{c}, '')") + ")"
    names = "concat_ws(', ', " + ", ".join(f"CASE WHEN {form('c', x)} <> {form('p', x)} THEN '{x}' END" for x in cols) + ")"
    first = lambda t: f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Certificate_ID ORDER BY ord) AS rn FROM {t}) WHERE rn = 1)"
    return f"SELECT * FROM (SELECT c.* EXCLUDE (rn), {names} AS Value_Changed FROM {first(cur)} c JOIN {first(prev)} p ON c.Certificate_ID = p.Certificate_ID) WHERE Value_Changed <> ''"


def _trimmed(t: str, cols: list[str]) -> str:
    return f"SELECT {', '.join(f'trim({c}) AS {c}' for c in cols)}, ord FROM {t}"


SNAP, DUP = ["Certificate_ID", "Company_Name", "City", "Segment"], ["Certificate_ID", "V"]


def _only_sql(rows: str, other: str, cols: list[str]) -> str:
    return f"SELECT * FROM ({_trimmed(rows, cols)}) WHERE Certificate_ID <> '' AND Certificate_ID NOT IN (SELECT trim(Certificate_ID) FROM {other})"


register("added", with_fixtures(_only_sql("cur", "prev", SNAP), "prev", "cur"), _pair(diff.added))
register("removed", with_fixtures(_only_sql("prev", "cur", SNAP), "prev", "cur"), _pair(diff.removed))
register("added_dups", with_fixtures(_only_sql("cur_dups", "prev_dups", DUP), "prev_dups", "cur_dups"), _pair(diff.added, "prev_dups", "cur_dups"))
register("removed_dups", with_fixtures(_only_sql("prev_dups", "cur_dups", DUP), "prev_dups", "cur_dups"), _pair(diff.removed, "prev_dups", "cur_dups"))
register("changed", with_fixtures(_changed_sql(SNAP[1:]), "prev", "cur"), _pair(diff.changed))
register("changed_ignore", with_fixtures(_changed_sql(["Segment"]), "prev", "cur"), _pair(diff.changed, ignore_cols=["City"], ignore_patterns=["^company"]))
register("changed_case_sensitive", with_fixtures(_changed_sql(SNAP[1:], lower=False), "prev", "cur"), _pair(diff.changed, case_insensitive=False))
register("changed_first_per_id", with_fixtures(_changed_sql(["V"], prev="prev_dups", cur="cur_dups"), "prev_dups", "cur_dups"), _pair(diff.changed, "prev_dups", "cur_dups"))
RULES_SQL = f"""SELECT * FROM (SELECT c.* EXCLUDE (rn), concat_ws(', ', CASE WHEN lower({NORM.format('c.Company_Name')}) <> lower({NORM.format('p.Company_Name')}) THEN 'Company_Name' END,
  CASE WHEN lower({NORM.format('c.City')}) <> lower({NORM.format('p.City')}) THEN 'City' END,
  CASE WHEN regexp_replace(lower(c.Segment), '^(\\w+) ii$', '\\1') <> regexp_replace(lower(p.Segment), '^(\\w+) ii$', '\\1') THEN 'Segment' END) AS Value_Changed
  FROM (SELECT *, 1 AS rn FROM cur) c JOIN prev p ON c.Certificate_ID = p.Certificate_ID) WHERE Value_Changed <> ''"""
register("changed_rules", with_fixtures(RULES_SQL, "prev", "cur"), _pair(diff.changed, custom_equivalence_rules=[(r"^(\w+) ii$", r"\1")]))
register("blank_ids", with_fixtures(f"SELECT trim(Certificate_ID) = '' AS blank, count(*) AS n FROM (SELECT Certificate_ID FROM prev_dups UNION ALL SELECT Certificate_ID FROM cur_dups) GROUP BY 1", "prev_dups", "cur_dups"), lambda s, d: _blank(fixture(s, d, "prev_dups").unionByName(fixture(s, d, "cur_dups"))))


def _blank(rows: DataFrame) -> DataFrame:
    return diff.normalized(rows).groupBy((F.col("Certificate_ID") == "").alias("blank")).agg(F.count("*").alias("n"))


register("post_filter", with_fixtures(f"SELECT * FROM ({_changed_sql(SNAP[1:])}) WHERE Value_Changed IS DISTINCT FROM 'Company_Name, City'", "prev", "cur"), lambda s, d: diff.without_change(_pair(diff.changed)(s, d)))
register(
    "diff_summary",
    with_fixtures(f"SELECT 'added' AS metric, count(*) AS value FROM ({_only_sql('cur', 'prev', SNAP)}) UNION ALL SELECT 'removed', count(*) FROM ({_only_sql('prev', 'cur', SNAP)}) UNION ALL SELECT 'changed', count(*) FROM ({_changed_sql(SNAP[1:])})", "prev", "cur"),
    lambda s, d: diff.summary(added=_pair(diff.added)(s, d), removed=_pair(diff.removed)(s, d), changed=_pair(diff.changed)(s, d)),
)


def _from(name: str, columns: Callable[[], tuple]):
    return lambda spark, sf: fixture(spark, sf, name).select(*columns())


def _table(name: str, columns: Callable[[], tuple]):
    return lambda spark, sf: spark.read.parquet(f"{sf}/{name}.parquet").select(*columns())


CLEAN = "trim(regexp_replace(trim(replace(replace(replace(replace(replace(regexp_replace({0}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g'), chr(13), ''), chr(9), ' '), '&nbsp;', ' '), chr(10), ' '), '\"', '')), '\\s+', ' ', 'g'))"
register("clean_text", f"SELECT doc_id, {CLEAN.format('text')} AS cleaned FROM documents", _table("documents", lambda: ("doc_id", T.clean_cell(F.col("text")).alias("cleaned"),)))
register("sanitize", None, lambda s, d: s.read.parquet(f"{d}/documents.parquet").select("doc_id", T.tidy(_nfkc("text")).alias("sanitized")))


def _nfkc(c: str) -> Column:
    from ..functions.udfs import compatibility_form

    return compatibility_form(c)


def _company_sql(c: str) -> str:
    s = f"lower({c})"
    for w in K.COMPANY_REMOVALS:
        s = f"replace({s}, '{w}', ' ')"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


NAMES = "s_name || CASE s_suppkey % 6 WHEN 0 THEN ' Holdings Ltd.' WHEN 1 THEN ' Agri Company GmbH' WHEN 2 THEN ', Corn Corp Inc' WHEN 3 THEN ' & Sons S.p.A' WHEN 4 THEN '  O' || chr(39) || 'Neil \"X\" Co' ELSE '' END"
register("company_norm", f"SELECT s_suppkey, {_company_sql(NAMES)} AS k FROM supplier", _table("supplier", lambda: ("s_suppkey", T.company_key(F.expr(NAMES)).alias("k"),)))
register("make_key", f"SELECT s_suppkey, replace(replace(replace(lower({NAMES}), ' ', ''), '\"', ''), '''', '') AS k FROM supplier", _table("supplier", lambda: ("s_suppkey", T.plain_key(F.expr(NAMES)).alias("k"),)))
register("match_norm", f"SELECT s_suppkey, trim(lower({NAMES})) AS k FROM supplier", _table("supplier", lambda: ("s_suppkey", T.match_key(F.expr(NAMES)).alias("k"),)))

PARTS = "list_transform(string_split({0}, ','), lambda x: trim(x))"
OWNER = f"SELECT ord, p[1] AS company, coalesce(p[2], '') AS city, CASE WHEN len(p) >= 3 THEN p[-1] ELSE '' END AS country FROM (SELECT ord, {PARTS.format('cert_owner')} AS p FROM raw)"
register("owner_split", with_fixtures(OWNER, "raw"), lambda s, d: fixture(s, d, "raw").select("ord", D.owner(F.col("cert_owner")).alias("o")).select("ord", "o.*"))
CAP = "upper({0}[1:1]) || lower({0}[2:])"
register("city_cap", with_fixtures(f"SELECT ord, {CAP.format('city')} AS city FROM ({OWNER})", "raw"), lambda s, d: fixture(s, d, "raw").select("ord", T.capitalize(D.owner(F.col("cert_owner"))["city"]).alias("city")))
COUNTRY = f"SELECT ord, array_to_string(list_transform(list_filter(regexp_split_to_array(country, '\\s+'), lambda w: w <> ''), lambda w: CASE WHEN w IN ('of', 'the', 'and') THEN w ELSE {CAP.format('w')} END), ' ') AS country FROM ({OWNER})"
register("country_name", with_fixtures(COUNTRY, "raw"), lambda s, d: fixture(s, d, "raw").select("ord", D.country(D.owner(F.col("cert_owner"))["country"]).alias("country")))
register("country_override", with_fixtures(f"SELECT ord, {case_map(K.COUNTRY_OVERRIDES, 'country', 'country')} AS country FROM ({COUNTRY})", "raw"), lambda s, d: fixture(s, d, "raw").select("ord", D.country_override(D.country(D.owner(F.col("cert_owner"))["country"])).alias("country")))
register("scope_desc", with_fixtures(f"SELECT ord, CASE WHEN cert_scope = '' THEN 'Unknown' ELSE array_to_string(list_transform({PARTS.format('cert_scope')}, lambda x: {case_map(K.SCOPE_DESCRIPTIONS, 'x', chr(39) + 'No Mapping' + chr(39))}), ', ') END AS description FROM raw", "raw"), _from("raw", lambda: ("ord", D.scope_description(F.col("cert_scope")).alias("description"),)))
register("facility_group", with_fixtures(f"SELECT ord, CASE WHEN len(g) = 0 THEN 'Unclassified' ELSE array_to_string(g, ', ') END AS grouping FROM (SELECT ord, list_sort(list_distinct(list_filter(list_transform({PARTS.format('cert_scope')}, lambda x: {case_map(K.FACILITY_GROUP_OF, 'x', 'NULL')}), lambda g: g IS NOT NULL))) AS g FROM raw)", "raw"), _from("raw", lambda: ("ord", D.facility_grouping(F.col("cert_scope")).alias("grouping"),)))
STATUS = "CASE WHEN regexp_full_match(trim(cert_status), '[+-]?[0-9]+') THEN " + case_map(K.STATUSES, "CAST(trim(cert_status) AS INT)", "'Unknown'") + " ELSE '' END"
register("status_map", with_fixtures(f"SELECT ord, {STATUS} AS status FROM raw", "raw"), _from("raw", lambda: ("ord", D.status(F.col("cert_status")).alias("status"),)))
TYPE = case_map(K.TYPE_ALIASES | {k: v for k, v in K.CERTIFICATE_TYPES.items()}, "upper(array_to_string(list_slice(list_transform(string_split(cert_number, '-'), lambda x: trim(x)), 1, 2), ' '))", "'Undefined'")
register("cert_type", with_fixtures(f"SELECT ord, {TYPE} AS type FROM raw", "raw"), _from("raw", lambda: ("ord", D.certificate_type(F.col("cert_number")).alias("type"),)))
register("cert_class", with_fixtures(f"SELECT ord, {case_map({v: k for k, v in K.CERTIFICATE_TYPES.items()}, TYPE, chr(39) + 'Unknown' + chr(39))} AS class FROM raw", "raw"), _from("raw", lambda: ("ord", D.certificate_class(D.certificate_type(F.col("cert_number"))).alias("class"),)))
register(
    "lat_lon",
    with_fixtures(f"SELECT ord, CASE WHEN ok THEN p[1] ELSE 'Unknown' END AS lat, CASE WHEN ok THEN p[2] ELSE 'Unknown' END AS lon FROM (SELECT ord, p, contains(cert_map, 'maps?q=') AND len(p) >= 2 AS ok FROM (SELECT ord, cert_map, list_filter({PARTS.format('string_split(cert_map, ' + chr(39) + 'maps?q=' + chr(39) + ')[-1]')}, lambda x: x <> '') AS p FROM raw))", "raw"),
    _from("raw", lambda: ("ord", D.coordinate(F.col("cert_map"), 0).alias("lat"), D.coordinate(F.col("cert_map"), 1).alias("lon"),)),
)
REGION = """+ lastgeo AS (SELECT "Country" AS k, max_by("Region", ord) AS r, max_by("Sub Region", ord) AS s FROM geo GROUP BY 1)
SELECT holders.*, CASE WHEN k IS NULL THEN 'Unknown' ELSE r END AS "Region", CASE WHEN k IS NULL THEN 'Unknown' ELSE s END AS "Sub_Region" FROM holders LEFT JOIN lastgeo ON "Country" = k"""
register("region_lookup", with_fixtures(REGION, "geo", "holders"), lambda s, d: resolve.with_regions(fixture(s, d, "holders"), fixture(s, d, "geo")))
KEY = "replace(replace(replace(lower(coalesce({0}, 'nan')), ' ', ''), '\"', ''), '''', '')"
STANDARD = f"""+ full_t AS (SELECT {KEY.format('"Company/Producer"')} AS k, min_by("Company/Producer Short Name", ord) AS s, min_by("City", ord) AS c FROM assets GROUP BY 1),
short_t AS (SELECT {KEY.format('"Company/Producer Short Name"')} AS k, min_by("Company/Producer Short Name", ord) AS s, min_by("City", ord) AS c FROM assets GROUP BY 1),
m AS (SELECT h.*, {KEY.format('h."Company_Name"')} AS company_norm, f.k IS NOT NULL OR t.k IS NOT NULL AS matched, CASE WHEN f.k IS NOT NULL THEN f.s ELSE t.s END AS matched_shortname, CASE WHEN f.k IS NOT NULL THEN f.c ELSE t.c END AS matched_city
  FROM holders h LEFT JOIN full_t f ON {KEY.format('h."Company_Name"')} = f.k LEFT JOIN short_t t ON {KEY.format('h."Company_Name"')} = t.k)
SELECT ord, CASE WHEN matched THEN matched_shortname ELSE "Company_Name" END AS "Company_Name", CASE WHEN matched THEN matched_city ELSE "City" END AS "City", "Country", company_norm, matched, matched_shortname, matched_city,
  coalesce(CASE WHEN matched THEN matched_shortname ELSE "Company_Name" END, 'nan') || ' ' || coalesce(CASE WHEN matched THEN matched_city ELSE "City" END, 'nan') AS asset_location FROM m"""
register("standardise", with_fixtures(STANDARD, "assets", "holders"), lambda s, d: resolve.standardise(fixture(s, d, "holders"), fixture(s, d, "assets")))
register("standardise_summary", with_fixtures(STANDARD.rpartition("\nSELECT")[0] + "\nSELECT count(*) AS n, count(*) FILTER (matched) AS n_matched FROM m", "assets", "holders"), lambda s, d: resolve.standardise(fixture(s, d, "holders"), fixture(s, d, "assets")).agg(F.count("*").alias("n"), F.count_if("matched").alias("n_matched")))
register(
    "asset_exact",
    with_fixtures("""SELECT h.ord, CASE WHEN EXISTS (SELECT 1 FROM assets WHERE trim(lower("Asset Identifier")) = trim(lower(h."Company_Name" || ' ' || h."City"))) THEN 1 ELSE 0 END AS exact FROM holders h""", "assets", "holders"),
    lambda s, d: _asset_exact(fixture(s, d, "holders"), fixture(s, d, "assets")),
)


def _asset_exact(holders: DataFrame, assets: DataFrame) -> DataFrame:
    return resolve.exact_assets(holders, assets).select("ord", F.col("__exact").isNotNull().cast("int").alias("exact"))


MATCH_STYLE = STANDARD.rpartition("\nSELECT")[0] + f"\nSELECT ord, CASE WHEN matched THEN '{K.MATCH_STYLE}' END AS match_style FROM m"
register("match_style", with_fixtures(MATCH_STYLE, "assets", "holders"), lambda s, d: resolve.with_match_style(resolve.standardise(fixture(s, d, "holders"), fixture(s, d, "assets"))).select("ord", "match_style"))
FIXTURES["prev_seen"] = "SELECT 'C-' || CAST(o_orderkey AS STRING) AS Certificate_ID, o_orderdate AS Seen, o_orderstatus AS V, o_orderkey AS ord FROM orders"
FIXTURES["cur_seen"] = "SELECT 'C-' || CAST(o_orderkey AS STRING) AS Certificate_ID, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '1' SECOND ELSE o_orderdate END AS Seen, CASE WHEN o_orderkey % 5 = 0 THEN '!' ELSE o_orderstatus END AS V, o_orderkey AS ord FROM orders WHERE o_orderkey % 2 = 0"
SEEN_SQL = """SELECT c.Certificate_ID, strftime(c.Seen, '%Y-%m-%d %H:%M:%S') AS Seen, c.V, c.ord, concat_ws(', ', CASE WHEN strftime(c.Seen, '%Y-%m-%d %H:%M:%S') <> strftime(p.Seen, '%Y-%m-%d %H:%M:%S') THEN 'Seen' END, CASE WHEN lower(c.V) <> lower(p.V) THEN 'V' END) AS Value_Changed
FROM cur_seen c JOIN prev_seen p ON c.Certificate_ID = p.Certificate_ID WHERE strftime(c.Seen, '%Y-%m-%d %H:%M:%S') <> strftime(p.Seen, '%Y-%m-%d %H:%M:%S') OR lower(c.V) <> lower(p.V)"""
register("changed_timestamps", with_fixtures(SEEN_SQL, "prev_seen", "cur_seen"), _pair(diff.changed, "prev_seen", "cur_seen"))
COMPANY = _company_sql("{0}")
register("fuzzy_company", with_fixtures("+" + fuzzy_sql.companies("holders", COMPANY, K.COMPANY_SCORE, "out_rows") + "\nSELECT * FROM out_rows", "assets", "holders"), lambda s, d: resolve.overwrite_company(fixture(s, d, "holders"), fixture(s, d, "assets"), K.COMPANY_SCORE))
register("asset_fuzzy", with_fixtures("+" + fuzzy_sql.assets("holders", K.ASSET_SCORE, "out_rows") + "\nSELECT * FROM out_rows", "assets", "holders"), lambda s, d: resolve.match_assets(fixture(s, d, "holders"), fixture(s, d, "assets"), K.ASSET_SCORE))
register(
    "two_tier_lookup",
    with_fixtures(STANDARD.rpartition("\nSELECT")[0] + "\nSELECT ord, company_norm, matched_shortname AS short, matched_city AS city FROM m WHERE matched", "assets", "holders"),
    lambda s, d: resolve.standardise(fixture(s, d, "holders"), fixture(s, d, "assets")).where("matched").select("ord", "company_norm", F.col("matched_shortname").alias("short"), F.col("matched_city").alias("city")),
)
register("html_first_href", "SELECT page_id, CASE WHEN regexp_matches(html, '<a [^>]*href=\"') THEN trim(regexp_extract(html, '<a [^>]*href=\"([^\"]*)\"', 1)) ELSE '' END AS href FROM pages", lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", F.when(F.col("html").rlike('<a [^>]*href="'), html_cell("html")).otherwise("").alias("href")))
#: Cells with a tooltip, both, entities, nested and unclosed tags, by customer; ~ stands for a double quote.
CELLS = """SELECT c_custkey AS ord, replace(CASE c_custkey % 9 WHEN 0 THEN '<span class=~has-tip top~ tabindex=~2~ title=~ ' || c_name || ' ~>t</span>' WHEN 1 THEN '<span class=~has-tip top~ tabindex=~2~ title=~tip~>t</span><a href=~ u' || CAST(c_custkey AS STRING) || ' ~>x</a>'
  WHEN 2 THEN '<p> ' || c_name || ' <b> b </b></p>' WHEN 3 THEN 'a &amp; b' WHEN 4 THEN '<i>open ' || c_mktsegment WHEN 5 THEN '<span class=~top has-tip~ tabindex=~2~ title=~no~>kept</span>' WHEN 6 THEN '<a name=~n~>no link</a> <br/> end ' WHEN 7 THEN '  plain ' || c_name || ' ' ELSE '' END, '~', chr(34)) AS cell FROM customer"""
FIXTURES["cells"] = CELLS
CELL_TEXT = r"""SELECT ord, CASE ord % 9 WHEN 0 THEN trim(regexp_extract(cell, 'title="([^"]*)"', 1)) WHEN 1 THEN 'u' || CAST(ord AS STRING) WHEN 2 THEN regexp_extract(cell, '<p> (.*) <b>', 1) || 'b' WHEN 3 THEN 'a & b' WHEN 4 THEN substr(cell, 4) WHEN 5 THEN 'kept' WHEN 6 THEN 'no linkend' WHEN 7 THEN trim(cell) ELSE '' END AS text FROM cells"""
register("html_text", with_fixtures(CELL_TEXT, "cells"), lambda s, d: fixture(s, d, "cells").select("ord", html_cell("cell").alias("text")))
#: Names with characters that compatibility form changes, and ones that it leaves and a comparison ignores.
FIXTURES["odd_names"] = """SELECT c_custkey AS ord, CASE c_custkey % 6 WHEN 0 THEN '\uff21\uff22 ' || c_name WHEN 1 THEN c_name || '\u00a0\u202fx' WHEN 2 THEN 'a\u200b\u2060' || c_name WHEN 3 THEN '  ' || c_name || ' \ufb01n\u00ad ' WHEN 4 THEN 'x\u2460 ' || c_mktsegment ELSE '\u3000' || c_name || '  y' END AS name FROM customer"""
ODD = "name"
for _char, _form in (("\uff21", "A"), ("\uff22", "B"), ("\u00a0", " "), ("\u202f", " "), ("\ufb01", "fi"), ("\u2460", "1"), ("\u3000", " "), ("\u200b", ""), ("\u2060", ""), ("\u00ad", "")):
    ODD = f"replace({ODD}, '{_char}', '{_form}')"
register("sanitize_names", with_fixtures(f"SELECT ord, regexp_replace(trim({ODD}), ' +', ' ', 'g') AS sanitized FROM odd_names", "odd_names"), lambda s, d: fixture(s, d, "odd_names").select("ord", T.tidy(_nfkc("name")).alias("sanitized")))
register("status_style", with_fixtures(f"SELECT s.*, {case_map(K.STATUS_STYLES, 's.status', 'NULL')} AS status_style FROM (SELECT {STATUS} AS status, ord FROM raw) s", "raw"), lambda s, d: with_status_style(fixture(s, d, "raw").select(D.status(F.col("cert_status")).alias("status"), "ord")))
#: The derived columns, each from the raw ones; SNAPSHOT_COLUMNS gives their order.
DESCRIPTION = f"CASE WHEN cert_scope = '' THEN 'Unknown' ELSE array_to_string(list_transform({PARTS.format('cert_scope')}, lambda x: {case_map(K.SCOPE_DESCRIPTIONS, 'x', chr(39) + 'No Mapping' + chr(39))}), ', ') END"
GROUPS = f"list_sort(list_distinct(list_filter(list_transform({PARTS.format('cert_scope')}, lambda x: {case_map(K.FACILITY_GROUP_OF, 'x', 'NULL')}), lambda g: g IS NOT NULL)))"
LINK = f"list_filter({PARTS.format('string_split(cert_map, ' + chr(39) + 'maps?q=' + chr(39) + ')[-1]')}, lambda x: x <> '')"
PLACE = "CASE WHEN contains(cert_map, 'maps?q=') AND len({link}) >= 2 THEN {link}[{i}] ELSE 'Unknown' END"
DERIVED = {
    "Status": STATUS,
    "Certificate_Type": TYPE,
    "Certificate_Class": case_map({v: k for k, v in K.CERTIFICATE_TYPES.items()}, TYPE, "'Unknown'"),
    "Company_Name": "company",
    "City": CAP.format("city"),
    "Country": "land",
    "Region": "CASE WHEN lastgeo.k IS NULL THEN 'Unknown' ELSE r END",
    "Sub_Region": "CASE WHEN lastgeo.k IS NULL THEN 'Unknown' ELSE s END",
    "Scope_Description": DESCRIPTION,
    "Facility_Grouping": f"CASE WHEN len({GROUPS}) = 0 THEN 'Unclassified' ELSE array_to_string({GROUPS}, ', ') END",
    "Processing_Unit_Type_Description": DESCRIPTION,
    "Latitude": PLACE.format(link=LINK, i=1),
    "Longitude": PLACE.format(link=LINK, i=2),
}
DERIVE = f"""+ owners AS ({OWNER}), lands AS (SELECT ord AS land_ord, {case_map(K.COUNTRY_OVERRIDES, 'country', 'country')} AS land FROM ({COUNTRY})),
lastgeo AS (SELECT "Country" AS k, max_by("Region", ord) AS r, max_by("Sub Region", ord) AS s FROM geo GROUP BY 1),
derived AS (SELECT raw.ord, {', '.join(CLEAN.format('(' + DERIVED.get(name, source) + ')') + f' AS "{name}"' for name, source in K.SNAPSHOT_COLUMNS.items() if name in DERIVED or source)}
  FROM raw JOIN owners ON owners.ord = raw.ord JOIN lands ON land_ord = raw.ord LEFT JOIN lastgeo ON land = lastgeo.k)"""
register("snapshot_derived", with_fixtures(DERIVE + "\nSELECT * FROM derived", "raw", "geo"), lambda s, d: derive(fixture(s, d, "raw"), fixture(s, d, "geo")))
WHOLE = DERIVE + "," + fuzzy_sql.companies("derived", COMPANY, K.COMPANY_SCORE, "resolved") + "," + fuzzy_sql.assets("resolved", K.ASSET_SCORE, "snapshot")
register("snapshot_full", with_fixtures(WHOLE + "\nSELECT * FROM snapshot", "raw", "geo", "assets"), lambda s, d: build_snapshot(fixture(s, d, "raw"), fixture(s, d, "geo"), fixture(s, d, "assets")))
