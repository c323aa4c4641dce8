"""Entity resolution against master data: geography, companies and assets."""

from __future__ import annotations

from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.similarity import Choices, TokenSets
from ..functions.text import asset_identifier, company_key, match_key, plain_key
from ..functions.udfs import process
from ..staging import stage

#: Choices that one task of a fuzzy comparison holds.
CHOICES = 50_000
#: Names that it compares with them, about.
NAMES = 50_000
#: Tasks of a fuzzy comparison at most; they may have several groups each.
TASKS = 10_000
#: Names that are worth the preparation of a block of token sets.
NAMES_FOR_SETS = 8000
#: A master table of at most so many keys, and bytes in them, is broadcast; a larger one is joined as Spark sees fit.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its rows, counted now, are few and short."""
    rows, size = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def _has(df: DataFrame, *columns: str) -> None:
    for c in columns:
        if c not in df.columns:
            raise KeyError(f"column {c!r} is missing")


def with_regions(df: DataFrame, geo: DataFrame, country: str = "Country", region: str = K.GEO_REGION, sub_region: str = K.GEO_SUB_REGION) -> DataFrame:
    """Adds Region and Sub_Region from geo's columns of the names given: of repeated countries the last by ord counts; Unknown for a country that isn't there."""
    last = geo.groupBy(F.col(f"`{K.GEO_COUNTRY}`").alias("__country")).agg(F.max_by(F.struct(F.col(f"`{region}`").alias("r"), F.col(f"`{sub_region}`").alias("s")), "ord").alias("__geo"))
    joined = df.join(_small(last), F.col(country) == F.col("__country"), "left")
    found = F.col("__country").isNotNull()
    return joined.withColumns({"Region": F.when(found, F.col("__geo.r")).otherwise("Unknown"), "Sub_Region": F.when(found, F.col("__geo.s")).otherwise("Unknown")}).drop("__country", "__geo")


def company_choices(assets: DataFrame) -> DataFrame:
    """choice, short, pos: the keys of all full names, then of all short names; a key's short name is its last row's."""
    _has(assets, K.ASSET_COMPANY, K.ASSET_SHORT)
    full, short = F.col(f"`{K.ASSET_COMPANY}`"), F.col(f"`{K.ASSET_SHORT}`")
    one = assets.select(company_key(full).alias("choice"), short.alias("short"), (F.col("ord") * 2).alias("seq"), F.lit(0).alias("tier"), "ord")
    two = assets.select(company_key(short).alias("choice"), short.alias("short"), (F.col("ord") * 2 + 1).alias("seq"), F.lit(1).alias("tier"), "ord")
    return one.unionByName(two).where("choice <> ''").groupBy("choice").agg(F.max_by("short", "seq").alias("short"), F.min(F.struct("tier", "ord")).alias("pos"))


def _against(names: DataFrame, choices: DataFrame, compare, schema: str, fewest: int = 1) -> DataFrame:
    """What compare(names, choices), on tables, says of every part of the names (column key, staged) and every block of the choices (column choice).

    Each name goes to each block once, and each choice to each part once: both are dealt out by hashes, and neither passes the driver.
    A part has fewest names or more, about, as every part prepares its blocks anew.
    """
    spark = names.sparkSession
    blocks = max(1, -(-choices.count() // CHOICES))
    n = names.count()
    parts = max(1, min(-(-4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks), -(-n // fewest)), -(-n // NAMES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = names.select("key", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"), every(blocks).alias("block"))
    right = choices.select("*", F.pmod(F.xxhash64("choice"), F.lit(blocks)).cast("int").alias("block"), every(parts).alias("part"))
    # as many tasks as groups: by their bytes, which are few, Spark would put many together
    left, right = (x.repartition(min(parts * blocks, TASKS), "part", "block").groupBy("part", "block") for x in (left, right))
    return left.cogroup(right).applyInArrow(compare, schema)


def _best(least: int, names: pa.Table, choices: pa.Table) -> pa.Table:
    """key, choice, score, tier, ord of the first choice of the best ratio."""
    choices = choices.sort_by([("tier", "ascending"), ("ord", "ascending")])
    given, columns = Choices([process(c) for c in choices["choice"].to_pylist()]), [[], [], []]
    for key in names["key"].to_pylist() if choices.num_rows else ():
        if found := given.best(process(key), least):
            for column, value in zip(columns, (key, *found), strict=True):
                column.append(value)
    at = pa.array(columns[1], pa.int64())
    return pa.table([pa.array(columns[0], pa.string()), choices["choice"].take(at), pa.array(columns[2], pa.int32()), choices["tier"].take(at), choices["ord"].take(at)], names=["key", "choice", "score", "tier", "ord"])


def _near(least: int, names: pa.Table, choices: pa.Table) -> pa.Table:
    """key of the names with a choice whose token set ratio reaches least."""
    given = TokenSets([process(c) for c in choices["choice"].to_pylist()])
    return pa.table([pa.array([k for k in names["key"].to_pylist() if given.near(process(k), least)], pa.string())], names=["key"])


def best_companies(names: DataFrame, choices: DataFrame, least: int) -> DataFrame:
    """key, choice, score: for each distinct key the first choice of the best ratio, where that reaches least."""
    told = choices.select("choice", "pos.tier", "pos.ord")
    found = _against(stage(names, "names"), told, partial(_best, least), "key string, choice string, score int, tier int, ord long")
    first = F.max_by(F.struct("choice", "score"), F.struct("score", -F.col("tier"), -F.col("ord")))
    return found.groupBy("key").agg(first.alias("m")).select("key", "m.choice", "m.score")


def overwrite_company(df: DataFrame, assets: DataFrame, score_threshold: int = 70) -> DataFrame:
    """Company_Name replaced by the short name of the most similar company in assets, where its ratio reaches the threshold."""
    _has(df, "Company_Name")
    choices = company_choices(assets)
    keyed = df.withColumn("__key", company_key(F.col("Company_Name")))
    best = best_companies(keyed.select(F.col("__key").alias("key")).distinct(), choices, score_threshold)
    short = best.join(choices.select("choice", "short"), "choice").where("short is not null").select(F.col("key").alias("__match"), F.col("short").alias("__short"))
    joined = keyed.join(short, F.col("__key") == F.col("__match"), "left")
    return joined.withColumn("Company_Name", F.coalesce("__short", "Company_Name")).select(*(f"`{c}`" for c in df.columns))


def exact_assets(df: DataFrame, assets: DataFrame, strict_punct: bool = False) -> DataFrame:
    """Adds Asset_Identifier, __norm (its normalised form) and __exact (the same, where assets hold it, else null)."""
    _has(df, "Company_Name", "City")
    _has(assets, K.ASSET_ID)
    raw = F.col(f"`{K.ASSET_ID}`").cast("string")
    exact = assets.where(raw.isNotNull()).select(match_key(raw, strict_punct).alias("__exact")).distinct()
    told = df.withColumn("Asset_Identifier", asset_identifier(F.col("Company_Name"), F.col("City")))
    return told.withColumn("__norm", match_key(F.col("Asset_Identifier"), strict_punct)).join(_small(exact), F.col("__norm") == F.col("__exact"), "left")


def match_assets(df: DataFrame, assets: DataFrame, fuzzy_threshold: int = 80, strict_punct: bool = False) -> DataFrame:
    """Adds Asset_Identifier, and Match_Found: 1 where assets hold it exactly once normalised, or by a token set ratio that reaches the threshold."""
    told, raw = exact_assets(df, assets, strict_punct), F.col(f"`{K.ASSET_ID}`").cast("string")
    known = assets.where(raw.isNotNull())
    told = stage(told, "identified")  # read twice: the names without an exact match, and the rows that get the result
    missed = told.where("__exact is null and __norm <> ''").select(F.col("Asset_Identifier").alias("key")).distinct()
    found = _against(stage(missed, "names"), known.select(raw.alias("choice")).distinct(), partial(_near, fuzzy_threshold), "key string", NAMES_FOR_SETS)
    told = told.join(found.distinct().withColumnRenamed("key", "__id"), F.col("Asset_Identifier") == F.col("__id"), "left")
    flag = F.col("__exact").isNotNull() | F.col("__id").isNotNull()
    return told.withColumn("Match_Found", flag.cast("int")).select(*(f"`{c}`" for c in df.columns if c not in ("Asset_Identifier", "Match_Found")), "Asset_Identifier", "Match_Found")


def standardise(df: DataFrame, assets: DataFrame) -> DataFrame:
    """Company and city from assets by exact key, full names before short ones, the first row by ord of either."""
    _has(df, "Company_Name", "City")
    _has(assets, K.ASSET_COMPANY, K.ASSET_SHORT, K.ASSET_CITY)
    told = F.struct(F.col(f"`{K.ASSET_SHORT}`").alias("short"), F.col(f"`{K.ASSET_CITY}`").alias("city"))

    def tier(column: str, name: str) -> DataFrame:
        return _small(assets.groupBy(plain_key(F.col(f"`{column}`")).alias(f"__{name}_key")).agg(F.min_by(told, "ord").alias(f"__{name}")))

    rows = df.withColumn("company_norm", plain_key(F.col("Company_Name")))
    rows = rows.join(tier(K.ASSET_COMPANY, "full"), F.col("company_norm") == F.col("__full_key"), "left").join(tier(K.ASSET_SHORT, "short"), F.col("company_norm") == F.col("__short_key"), "left")
    by_full, by_short = F.col("__full_key").isNotNull(), F.col("__short_key").isNotNull()
    pick = lambda f: F.when(by_full, F.col(f"__full.{f}")).when(by_short, F.col(f"__short.{f}"))
    rows = rows.withColumns({"matched": by_full | by_short, "matched_shortname": pick("short"), "matched_city": pick("city")}).drop("__full", "__short", "__full_key", "__short_key")
    rows = rows.withColumns({"Company_Name": F.when(F.col("matched"), F.col("matched_shortname")).otherwise(F.col("Company_Name")), "City": F.when(F.col("matched"), F.col("matched_city")).otherwise(F.col("City"))})
    missing = lambda c: F.coalesce(F.col(c), F.lit("nan"))
    return rows.withColumn("asset_location", F.concat(missing("Company_Name"), F.lit(" "), missing("City")))


def with_match_style(df: DataFrame) -> DataFrame:
    """Adds match_style to standardised rows: the colour of a matched row's asset_location, null for others."""
    return df.withColumn("match_style", F.when(F.col("matched"), F.lit(K.MATCH_STYLE)))
