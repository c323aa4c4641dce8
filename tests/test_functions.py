"""Golden rows of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from snapforge.functions import derive as D
from snapforge.functions import text as T
from snapforge.functions import udfs as U


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (T.clean_cell, '  A B\t"C"\r\nD&nbsp;E​F\x0bG ', "A B C D EFG"),
        (T.clean_cell, None, ""),
        (T.clean_cell, "&nb​sp;x", "&nbsp;x"),
        (T.company_key, "Acme Holdings Ltd.", "acme holdings"),
        (T.company_key, "Agri Company GmbH", "ri mpany"),
        (T.company_key, "Corn Corp Inc", "corn rp"),
        (T.match_key, " A.B, C ", "a.b, c"),
        (lambda c: T.match_key(c, strict_punct=True), "A.B,  (C)", "a b c"),
        (T.plain_key, "O'Neil \"X\" Co", "oneilxco"),
        (T.plain_key, None, "nan"),
        (T.capitalize, "new YORK", "New york"),
        (D.country, "Republic of", "Republic of"),
        (D.country, "REPUBLIC OF", "Republic Of"),
        (lambda c: D.country_override(D.country(c)), "Republic of", "South Korea"),
        (lambda c: D.country_override(D.country(c)), "Côte d'Ivoire", "Côte D'ivoire"),
        (lambda c: D.country_override(D.country(c)), "HONG KONG", "China"),
        (D.facility_grouping, "TR, BP,TR", "LCF Trading liquid biofuels assets, Trading Companies"),
        (D.facility_grouping, "EL", "Unclassified"),
        (D.facility_grouping, "", "Unclassified"),
        (D.facility_grouping, None, ""),
        (D.scope_description, "TR,XX,TR", "Trader, No Mapping, Trader"),
        (D.scope_description, "", "Unknown"),
        (D.status, "1", "Valid"),
        (D.status, " 5 ", "Expired"),
        (D.status, "99", "Unknown"),
        (D.status, "1.0", ""),
        (D.status, "", ""),
        (D.status, "99999999999", "Unknown"),
        (D.certificate_type, "EU-ISCC-Cert-X1", "Mandated"),
        (D.certificate_type, "CORSIA-ISCC-1", "Aviation"),
        (D.certificate_type, "DE-B-BLE-BM-1", "Legacy"),
        (D.certificate_type, "foo", "Undefined"),
        (lambda c: D.certificate_class(D.certificate_type(c)), "EU-ISCC-Cert-X1", "EU ISCC"),
        (lambda c: D.certificate_class(D.certificate_type(c)), "DE-B-BLE-BM-1", "DE B BLE BM"),
        (lambda c: D.certificate_class(D.certificate_type(c)), "", "Unknown"),
        (lambda c: D.coordinate(c, 1), "https://m/maps?q=1.5, 2.5", "2.5"),
        (lambda c: D.coordinate(c, 0), "u maps?q=1,2 maps?q=3,4", "3"),
        (lambda c: D.coordinate(c, 0), "maps?q=,,3", "Unknown"),
        (lambda c: D.coordinate(c, 0), None, "Unknown"),
        (lambda c: T.asset_identifier(c, F.lit(None)), "Acme", "Acme"),
        (lambda c: T.comparable(U.compatibility_form(c)), "Foo,  Budapest, Hungary", "foo, budapest, hungary"),
        (lambda c: T.comparable(U.compatibility_form(c), case_insensitive=False), "Foo,  Budapest, Hungary", "Foo"),
        (lambda c: T.comparable(U.compatibility_form(c), rules=[(r"(\w+) inc", r"\1")]), "Acme Inc", "acme"),
    ],
)
def test_golden(spark, f, given, want):
    assert one(spark, f, given) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [("Acme, Lyon, France", ("Acme", "Lyon", "France")), ("Acme, Inc., Lyon, France", ("Acme", "Inc.", "France")), ("Acme, Lyon", ("Acme", "Lyon", "")), ("Acme", ("Acme", "", "")), ("", ("", "", "")), (None, ("", "", ""))],
)
def test_owner(spark, given, want):
    assert tuple(one(spark, D.owner, given)) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ('<a href=" http://x/y.pdf ">z</a>', "http://x/y.pdf"),
        ('<span class="has-tip top" tabindex="2" title=" Tip ">t</span>', "Tip"),
        ('<span class="has-tip top" tabindex="2" title="T">t</span><a href="h">z</a>', "h"),
        ("<p> a <b> b </b></p>", "ab"),
        ("a &amp; b", "a & b"),
        (None, ""),
    ],
)
def test_html(given, want):
    assert U.cell_text(given) == want


def test_similarity():
    assert U.ratio("abcd", "abce") == 75 and U.ratio("acme", "acme corp") == 62 and U.ratio("", "") == 100
    assert U.token_set_ratio("acme lyon", "lyon acme phase 2") == 100 and U.token_set_ratio("", "x") == 0
    assert U.best_ratio("acme", [("x", "x"), ("acme a", "acme a"), ("acme b", "acme b")], 51) == ("acme a", 80)
    assert U.best_ratio("", [("x", "x")], 51) == (None, 0)
