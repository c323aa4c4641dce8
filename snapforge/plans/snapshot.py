"""The snapshot of thirty columns from raw rows, and the run that compares it with the last one."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import derive as D
from ..functions.text import capitalize, clean_cell
from ..operators import diff, resolve
from ..sources import sheets


def derive(raw: DataFrame, geo: DataFrame) -> DataFrame:
    """ord and the derived columns, before companies and assets are matched."""
    o = D.owner(F.col("cert_owner"))
    rows = raw.withColumn("__owner", o)
    rows = rows.withColumns({
        "Company_Name": F.col("__owner.company"),
        "City": capitalize(F.col("__owner.city")),
        "Country": D.country_override(D.country(F.col("__owner.country"))),
        "Scope_Description": D.scope_description(F.col("cert_scope")),
        "Processing_Unit_Type_Description": D.scope_description(F.col("cert_scope")),
        "Facility_Grouping": D.facility_grouping(F.col("cert_scope")),
        "Certificate_Type": D.certificate_type(F.col("cert_number")),
        "Status": D.status(F.col("cert_status")),
        "Latitude": D.coordinate(F.col("cert_map"), 0),
        "Longitude": D.coordinate(F.col("cert_map"), 1),
    }).drop("__owner")
    rows = rows.withColumn("Certificate_Class", D.certificate_class(F.col("Certificate_Type")))
    rows = resolve.with_regions(rows, geo)
    return rows.select("ord", *(clean_cell(F.col(source or name)).alias(name) for name, source in K.SNAPSHOT_COLUMNS.items() if name not in ("Asset_Identifier", "Match_Found")))


def provenance(df: DataFrame) -> DataFrame:
    """df with each derived column's origin in its metadata, for whoever presents it."""
    kinds = {c: "source-derived" for c in K.SOURCE_DERIVED} | {c: "business-derived" for c in K.BUSINESS_DERIVED}
    return df.select(*(F.col(f"`{c}`").alias(c, metadata={"provenance": kinds[c]}) if c in kinds else F.col(f"`{c}`") for c in df.columns))


def with_status_style(df: DataFrame) -> DataFrame:
    """Adds status_style: the colour of the first column's status, null for others."""
    return df.withColumn("status_style", D.lookup(K.STATUS_STYLES, F.trim(F.coalesce(F.col(f"`{[c for c in df.columns if c != 'ord'][0]}`"), F.lit("")))))


def build_snapshot(raw: DataFrame, geo: DataFrame, assets: DataFrame, company_score: int = K.COMPANY_SCORE, asset_score: int = K.ASSET_SCORE) -> DataFrame:
    """ord and the snapshot's thirty columns in order."""
    rows = resolve.overwrite_company(derive(raw, geo), assets, company_score)
    rows = resolve.match_assets(rows, assets, asset_score)
    return provenance(rows.select("ord", *(f"`{c}`" for c in K.SNAPSHOT_COLUMNS)))


def run(spark: SparkSession, raw: DataFrame, geo: DataFrame, assets: DataFrame, base: str, state: str, at: datetime, ignore_cols=("Map", "Company_Name", "City")) -> dict:
    """Write the snapshot, compare it with the last one, write the reports, then the state; a dict of paths."""
    out = {"snapshot": sheets.write_snapshot(build_snapshot(raw, geo, assets), base, at)}
    previous = sheets.load_state(spark, state).get("prev_file_name")
    if previous:
        now = sheets.load_sheet(spark, out["snapshot"])
        then = sheets.load_sheet(spark, previous) if sheets.exists(spark, previous) else None
        reports = {"added": diff.added(then, now), "removed": diff.removed(then, now), "changed": diff.changed(then, now, ignore_cols=list(ignore_cols))}
        out |= {name: sheets.append_report(df, out["snapshot"], name) for name, df in reports.items()}
    sheets.save_state(spark, state, out["snapshot"])
    return out
