"""Comparison, resolution, sources and the stream, on hand-made tables."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapforge.functions import constants as K
from snapforge.operators import diff, resolve
from snapforge.plans.snapshot import build_snapshot, run
from snapforge.sources import pages, sheets
from snapforge.streaming.incremental import watch

PREV = [("A", "x"), ("B", "y"), ("B", "y2"), ("C", "Foo, Budapest, Hungary"), ("E", "e"), ("", "b1")]
CUR = [("A", "X "), ("B", "z"), ("C", "Foo"), ("D", "n"), ("D", "n2"), ("", "b2")]


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord long, Certificate_ID string, V string")


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def snaps(spark):
    return table(spark, PREV), table(spark, CUR)


def test_added_removed(snaps):
    prev, cur = snaps
    assert values(diff.added(prev, cur), "Certificate_ID", "V") == [("D", "n"), ("D", "n2")]
    assert values(diff.removed(prev, cur), "Certificate_ID", "V") == [("E", "e")]
    assert values(diff.added(cur, prev), "Certificate_ID", "V") == values(diff.removed(prev, cur), "Certificate_ID", "V")
    assert diff.added(None, cur).isEmpty() and diff.removed(None, cur).isEmpty() and diff.changed(None, cur).isEmpty()


def test_changed(snaps):
    prev, cur = snaps
    assert values(diff.changed(prev, cur), "Certificate_ID", "V", "Value_Changed") == [("", "b2", "V"), ("B", "z", "V"), ("C", "Foo", "V")]
    assert values(diff.changed(prev, cur, case_insensitive=False), "Certificate_ID", "V") == [("", "b2"), ("A", "X "), ("B", "z")]
    assert diff.changed(cur, cur).isEmpty()
    with pytest.raises(ValueError):
        diff.changed(prev, cur, ignore_cols=["V"])
    plan = diff.changed(prev, cur)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and plan.count("ArrowEvalPython") <= 2


def test_padded_id_is_one_key_for_added_and_two_for_changed(spark):
    a, b = table(spark, [(" A", "x")]), table(spark, [("A", "y")])
    assert diff.added(a, b).isEmpty() and diff.changed(a, b).isEmpty()


def test_id_column():
    assert diff.find_id_column(["x", "Certificate ID"]) == "Certificate ID" and diff.find_id_column(["a", "Certificate_Valid"]) == "Certificate_Valid"
    with pytest.raises(KeyError):
        diff.find_id_column(["a"])


def test_post_filter(spark):
    report = spark.createDataFrame([("Company_Name, City",), ("Company_Name,  City",), ("City",), (None,)], "Value_Changed string")
    assert diff.without_change(report).count() == 3 and diff.without_change(report, loose_space=True).count() == 2


def masters(spark):
    geo = spark.createDataFrame([("X", "r1", "s1", 0), ("X", "r2", "s2", 1)], f"`{K.GEO_COUNTRY}` string, `{K.GEO_REGION}` string, `{K.GEO_SUB_REGION}` string, ord long")
    assets = spark.createDataFrame(
        [("Acme Corp", "AC", "Lyon", "AC Lyon", 0), ("Acme Corp", "AC2", "Rome", "AC2 Rome", 1), ("P1", "Acme", "Lyon", "P1 Lyon Phase 2", 2), ("Acme", "S2", "Rome", None, 3)],
        f"`{K.ASSET_COMPANY}` string, `{K.ASSET_SHORT}` string, `{K.ASSET_CITY}` string, `{K.ASSET_ID}` string, ord long",
    )
    return geo, assets


def test_lookups(spark):
    geo, assets = masters(spark)
    rows = spark.createDataFrame([("ACME corp", "c", "X"), ("acme", "c", "Y"), ("zzzz", "c", None)], "Company_Name string, City string, Country string")
    assert [tuple(r) for r in resolve.with_regions(rows, geo).orderBy("Company_Name").select("Region", "Sub_Region").collect()] == [("r2", "s2"), ("Unknown", "Unknown"), ("Unknown", "Unknown")]
    assert values(resolve.standardise(rows, assets).where("matched"), "Company_Name", "City", "asset_location") == [("AC", "Lyon", "AC Lyon"), ("S2", "Rome", "S2 Rome")]
    assert values(resolve.overwrite_company(rows, assets, 51), "Company_Name") == [("AC2",), ("S2",), ("zzzz",)]
    found = resolve.match_assets(spark.createDataFrame([("ac", "LYON"), ("P1", "Lyon"), ("q", "q"), ("", "")], "Company_Name string, City string"), assets)
    assert values(found, "Asset_Identifier", "Match_Found") == [("", 0), ("P1 Lyon", 1), ("ac LYON", 1), ("q q", 0)]
    with pytest.raises(KeyError):
        resolve.match_assets(rows.drop("City"), assets)


def test_blocks_of_choices_agree(spark, monkeypatch):
    _, assets = masters(spark)
    rows = spark.createDataFrame([("ACME corp", "c"), ("p1", "c")], "Company_Name string, City string")
    whole = values(resolve.overwrite_company(rows, assets, 51), "Company_Name")
    monkeypatch.setattr(resolve, "CHOICES", 1)
    assert values(resolve.overwrite_company(rows, assets, 51), "Company_Name") == whole


def test_run(spark, tmp_path):
    geo, assets = masters(spark)
    raw = lambda n: spark.createDataFrame([(i, *("x" if c == "cert_in_put" and i == n else f"EU-ISCC-{i}" if c == "cert_number" else "Acme, lyon, x" if c == "cert_owner" else "" for c in K.RAW_COLUMNS)) for i in range(n)], "ord long, " + ", ".join(f"{c} string" for c in K.RAW_COLUMNS))
    snap = build_snapshot(raw(2), geo, assets)
    assert snap.columns == ["ord", *K.SNAPSHOT_COLUMNS] and snap.schema["City"].metadata == {"provenance": "source-derived"}
    base, state = str(tmp_path / "out"), str(tmp_path / "state.json")
    first = run(spark, raw(2), geo, assets, base, state, datetime(2026, 1, 1))
    second = run(spark, raw(3), geo, assets, base, state, datetime(2026, 1, 2))
    assert list(first) == ["snapshot"] and spark.read.parquet(second["added"]).count() == 1 and spark.read.parquet(second["removed"]).isEmpty() and spark.read.parquet(second["changed"]).isEmpty()
    assert sheets.load_state(spark, state) == {"prev_file_name": second["snapshot"]} and sheets.load_state(spark, str(tmp_path / "none")) == {}
    with pytest.raises(FileNotFoundError):
        sheets.load_sheet(spark, str(tmp_path / "none"))


def test_pages(spark, tmp_path):
    for i, rows in enumerate(([["a"] * 16, ["b", None] + ['<a href="h">x</a>'] * 14], [["c"] * 16])):
        (tmp_path / f"{i}.json").write_text(json.dumps({"data": rows, "recordsTotal": "3"}))
    got = pages.raw_rows(pages.saved_pages(spark, str(tmp_path))).orderBy("ord").collect()
    assert [r["ord"] for r in got] == [0, 1, 2] and got[1]["cert_number"] == "" and got[1]["cert_audit"] == "h"
    (tmp_path / "1.json").unlink()
    with pytest.raises(ValueError):
        pages.saved_pages(spark, str(tmp_path))
    assert pages.find_nonce('<input id="wdtNonceFrontendEdit_2" value="n1">') == "n1" and len(pages.form(0, 5, "n")) == 9 + 6 * 16
    with pytest.raises(ValueError):
        pages.find_nonce("<p>")


def test_stream(spark, tmp_path, snaps):
    source = str(tmp_path / "in")
    for i, snap in enumerate(snaps):
        snap.coalesce(1).write.mode("append").parquet(source)
        watch(spark, source, snap.schema, str(tmp_path / "state"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/batch=1/added")).count() == 2 and spark.read.parquet(str(tmp_path / "out/batch=1/changed")).where(F.col("Certificate_ID") == "C").count() == 1
