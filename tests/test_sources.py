"""The registry source against a local server, page order, reports' order and targets, state that survives a crash, and a batch run twice."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs

import pytest

from snapforge import staging
from snapforge.functions import constants as K
from snapforge.operators import diff
from snapforge.sources import pages, sheets
from snapforge.streaming.incremental import watch


class Registry(BaseHTTPRequestHandler):
    rows, short, asked = 23, False, []

    def log_message(self, *_):
        pass

    def _reply(self, body: bytes):
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def do_GET(self):
        self._reply(b'<html><input id="wdtNonceFrontendEdit_2" value="n-1"></html>')

    def do_POST(self):
        sent = {k: v[0] for k, v in parse_qs(self.rfile.read(int(self.headers["Content-Length"])).decode()).items()}
        start, length = int(sent["start"]), int(sent["length"])
        type(self).asked.append((start, length, sent["wdtNonce"], self.headers["X-Requested-With"], time.time()))
        data = [[f"c{i}"] * len(K.RAW_COLUMNS) for i in range(start, min(start + length, self.rows))]
        self._reply(json.dumps({"data": data[:-1] if self.short and length > 1 else data, "recordsTotal": str(self.rows)}).encode())


@pytest.fixture
def server():
    made = ThreadingHTTPServer(("127.0.0.1", 0), Registry)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    Registry.rows, Registry.short, Registry.asked = 23, False, []
    yield f"http://127.0.0.1:{made.server_port}/"
    made.shutdown()


def test_registry(spark, server):
    spark.dataSource.register(pages.RegistrySource)
    read = lambda **options: spark.read.format("registry").options(endpoint=server, page=server, page_size="10", **options).load()
    got = read().orderBy("ord").collect()
    assert [r["ord"] for r in got] == list(range(23)) and got[22]["cells"] == ["c22"] * len(K.RAW_COLUMNS)
    assert {a[0] for a in Registry.asked if a[1] == 10} == {0, 10, 20} and {a[2:4] for a in Registry.asked} == {("n-1", "XMLHttpRequest")}
    Registry.asked.clear()
    assert read(delay="0.6", nonce="n-2").count() == 23
    at = {a[0]: a[4] for a in Registry.asked if a[1] == 10}
    assert at[10] - at[0] > 0.2 and at[20] - at[10] > 0.2  # not all at once
    Registry.short = True
    with pytest.raises(Exception, match="incomplete"):
        read().collect()
    Registry.short, Registry.rows = False, 0
    assert read().count() == 0


def test_a_total_that_grows_while_paging_is_no_loss(spark, server):
    spark.dataSource.register(pages.RegistrySource)
    df = spark.read.format("registry").options(endpoint=server, nonce="n", page_size="10").load()
    assert df.count() == 23
    Registry.rows = 25
    assert df.count() in (23, 25)


def test_pages_follow_their_numbers(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.json").write_text(json.dumps({"data": [[f"r{i}"]], "recordsTotal": "14"}))
    (tmp_path / "12.json").write_text(json.dumps([{"data": [["r12"]], "recordsTotal": "14"}, {"data": [["r13"]], "recordsTotal": "14"}]))
    got = pages.saved_pages(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r["ord"], r["cells"][0]) for r in got] == [(i, f"r{i}") for i in range(14)]


def test_reports_are_written_in_their_order_and_never_over_their_source(spark, tmp_path):
    rows = spark.createDataFrame([(3, "B", "x"), (1, "C", "y"), (2, "A", "z")], "ord long, Certificate_ID string, V string").repartition(3)
    path = str(tmp_path / "r")
    sheets.write_report(rows, path)
    assert [r["ord"] for r in spark.read.parquet(path).collect()] == [1, 2, 3]
    changed = rows.selectExpr("*", "'Company_Name, City' AS Value_Changed").unionByName(rows.selectExpr("ord", "Certificate_ID", "V", "'V' AS Value_Changed"))
    sheets.write_report(changed, str(tmp_path / "c"))
    assert [r["Certificate_ID"] for r in spark.read.parquet(str(tmp_path / "c")).collect()] == ["A", "A", "B", "B", "C", "C"]
    sheets.write_filtered(str(tmp_path / "c"), str(tmp_path / "f"), spark)
    assert spark.read.parquet(str(tmp_path / "f")).count() == 3
    for target in (str(tmp_path / "c"), f"file:{tmp_path}/c/"):
        with pytest.raises(ValueError, match="read by"):
            sheets.write_filtered(str(tmp_path / "c"), target, spark)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 6
    assets = spark.createDataFrame([("acme", "AC", "Lyon", 0)], f"`{K.ASSET_COMPANY}` string, `{K.ASSET_SHORT}` string, `{K.ASSET_CITY}` string, ord long")
    spark.createDataFrame([(0, "ACME", "x")], "ord long, Company_Name string, City string").write.parquet(str(tmp_path / "s"))
    sheets.write_standardised(str(tmp_path / "s"), str(tmp_path / "std"), assets)
    assert spark.read.parquet(str(tmp_path / "std")).first()["asset_location"] == "AC Lyon"


def test_state_survives_a_write_cut_short(spark, tmp_path):
    path = str(tmp_path / "state")
    for name in ("a", "b", "c"):
        sheets.save_state(spark, path, name)
    assert sheets.load_state(spark, path)["prev_file_name"] == "c"
    (tmp_path / "state" / "9.json").write_text('{"prev_file')
    assert sheets.load_state(spark, path)["prev_file_name"] == "c"
    sheets.save_state(spark, path, "d")
    assert sheets.load_state(spark, path)["prev_file_name"] == "d"


def test_a_batch_run_again_makes_the_same_reports(spark, tmp_path, monkeypatch):
    source, schema = str(tmp_path / "in"), "ord long, Certificate_ID string, V string"
    state, out, check = (str(tmp_path / n) for n in ("state", "out", "check"))
    go = lambda: watch(spark, source, schema, state, out, check).awaitTermination()
    spark.createDataFrame([(0, "A", "x"), (1, "B", "y")], schema).coalesce(1).write.mode("append").parquet(source)
    go()
    spark.createDataFrame([(0, "B", "z"), (1, "C", "y")], schema).coalesce(1).write.mode("append").parquet(source)
    saved = sheets.save_state

    def crash(*args, **more):
        saved(*args, **more)
        raise RuntimeError("crash before the commit")

    monkeypatch.setattr(sheets, "save_state", crash)
    with pytest.raises(Exception, match="crash before the commit"):
        go()
    monkeypatch.setattr(sheets, "save_state", saved)
    go()
    told = lambda name: sorted(r["Certificate_ID"] for r in spark.read.parquet(f"{out}/batch=1/{name}").collect())
    assert (told("added"), told("removed"), told("changed")) == (["C"], ["A"], ["B"]) and sheets.load_state(spark, state)["batch"] == 1


def test_staged_tables_go_with_their_application(spark):
    df = staging.stage(spark.range(5).toDF("id"), "some")
    assert df.count() == 5 and df.inputFiles()[0].startswith("file:") and spark.sparkContext.applicationId in df.inputFiles()[0]
    staging.unstage(df)
    assert not sheets.exists(spark, df.inputFiles()[0])


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

        class _jsc:
            sc = staticmethod(lambda: type("J", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})())

        getConf = staticmethod(lambda: type("C", (), {"get": lambda self, k, d: d})())

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(type("S", (), {"sparkContext": Context})())


def test_lookup_queries_are_registered():
    from snapforge.plans import queries

    assert {"blank_ids", "two_tier_lookup", "html_text", "snapshot_full", "asset_fuzzy", "fuzzy_company"} <= set(queries.ORACLE_SQL) and diff.ORD == "ord"
