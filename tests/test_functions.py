import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire import functions as q


def values(spark, ddl, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, ddl).select(*columns).collect()]


def test_cyymmdd(spark):
    cases = {
        1250315: dt.date(2025, 3, 15), 780301: dt.date(1978, 3, 1), 450730: dt.date(1945, 7, 30),
        991231: dt.date(1999, 12, 31), 1000101: dt.date(2000, 1, 1), 101: dt.date(1900, 1, 1),
        1240229: dt.date(2024, 2, 29), 1230229: None, 229: None, 1000229: dt.date(2000, 2, 29),
        1251301: None, 1250431: None, 1250400: None, 0: None, -780301: None, 99999999: None, None: None,
    }
    got = values(spark, "n int", [(n,) for n in cases], "n", q.cyymmdd_to_date("n").alias("d"))
    assert dict(got) == cases


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)), min_size=1, max_size=40))
def test_cyymmdd_round_trip(spark, days):
    frame = spark.createDataFrame([(d,) for d in days], "d date").select("d", q.date_to_cyymmdd("d").alias("n"))
    for row in frame.select("d", "n", q.cyymmdd_to_date("n").alias("back")).collect():
        assert row["back"] == row["d"]
        assert row["n"] == int(row["d"].strftime("%Y%m%d")) - 19000000


def plain_isbn13(text):
    text = (text or "").strip(" ")
    if len(text) != 13 or not all(c in "0123456789" for c in text):
        return False
    return sum(int(d) * (1, 3)[i % 2] for i, d in enumerate(text)) % 10 == 0


def test_isbn13(spark):
    cases = [
        "9782246831471", "9782080287410", "9782702183694", "9782221267639", "9782246826118", "9782253237341",
        "9782070368228", "9782246834519", "9782246819523", "9782070000000", "9782070000005", " 9782246831471 ",
        "978224683147", "978224683147X", "97822468314711", "978 246831471", "+782246831471", "-782246831471",
        "0000000000000", "0000000000001", "978224683147.", "", None,
    ]
    got = values(spark, "i string", [(c,) for c in cases], "i", q.isbn13_valid("i").alias("v"))
    assert got == [(c, plain_isbn13(c)) for c in cases]
    assert [c for c, valid in got[:10] if not valid] == ["9782070000000"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text("0123456789 X-", min_size=10, max_size=15), min_size=1, max_size=60))
def test_isbn13_any_text(spark, texts):
    for text, valid in values(spark, "i string", [(t,) for t in texts], "i", q.isbn13_valid("i").alias("v")):
        assert valid == plain_isbn13(text), text


def test_isbn_shape_counts_null_as_bad(spark):
    got = values(spark, "i string", [("9782070000000",), ("9772070000000",), (None,)], q.isbn13_has_shape("i").alias("v"))
    assert got == [(True,), (False,), (False,)]


def test_isbn10(spark):
    cases = {
        "080442957X": "9780804429573", "0-8044-2957-x": "9780804429573", "0306406152": "9780306406157",
        "0306406153": None, "X306406152": None, "030640615": None, None: None,
    }
    got = values(spark, "i string", [(c,) for c in cases], "i", q.isbn10_to_13("i").alias("v"))
    assert dict(got) == cases
    both = [("978-0-306-40615-7",), ("0306406152",), ("nonsense",)]
    assert values(spark, "i string", both, q.normalise_isbn("i").alias("v")) == [
        ("9780306406157",), ("9780306406157",), (None,)]


def test_codes(spark):
    frame = [("V", "GFT", "AC"), ("R", "POC", "RS"), ("A", "NUM", "PI"), ("?", None, None)]
    got = values(
        spark, "m string, f string, s string", frame,
        q.movement_label("m").alias("a"), q.format_label("f").alias("b"), q.status_label("s").alias("c"),
    )
    assert got == [
        ("Vente", "Grand format", "Actif"), ("Retour", "Poche", "Autre"),
        ("Avoir", "Numérique", "Pilonné"), ("Inconnu", "Autre", "Autre"),
    ]


def test_price_band_edges(spark):
    prices = ["9.99", "10.00", "19.99", "20.00", "29.99", "30.00", None]
    got = values(spark, "p decimal(9,2)", [(p and Decimal(p),) for p in prices], q.price_band("p").alias("b"))
    assert [b for (b,) in got] == ["< 10 €", "10-20 €", "10-20 €", "20-30 €", "20-30 €", "≥ 30 €", None]


def test_names_flags_and_stock(spark):
    names = [("Gabo", "Gabriel", "G"), ("   ", "Anna", "G"), (None, None, "G")]
    got = values(spark, "p string, f string, l string", names, q.display_name("p", "f", "l").alias("n"))
    assert got == [("Gabo",), ("Anna G",), ("G",)]
    got = values(spark, "a int, r int, t int", [(5, 2, None), (None, None, None)], q.stock_total("a", "r", "t").alias("s"))
    assert got == [(7,), (0,)]


def test_text(spark):
    got = values(spark, "t string", [("a\x00b\nc\x1f é ",)], q.strip_controls("t").alias("s"), q.trim_fixed("t").alias("u"))
    assert got == [("abc é ", "a\x00b\nc\x1f é")]
    frame = spark.createDataFrame([("é", None), (None, "à"), ("e", "a"), (None, None)], "a string, b string")
    assert frame.filter(q.contains_any(["a", "b"], ("é", "à"))).count() == 2


@pytest.mark.parametrize("source, expected", [
    (("CHAR", 13, 0), "STRING"), (("decimal", 9, 2), "DECIMAL(9,2)"), (("NUMERIC", 7, 0), "DECIMAL(7,0)"),
    (("TIME", 0, 0), "STRING"), (("BLOB", 0, 0), "BINARY"), (("REAL", 0, 0), "FLOAT"), (("ROWID", 0, 0), "STRING"),
])
def test_type_names(source, expected):
    assert q.spark_type_name(*source) == expected


def test_bad_casts_are_null(spark):
    got = values(
        spark, "a string", [("12.345",), ("x",), ("99999999",), ("2024-02-30",)],
        q.typed("a", "decimal(5,2)").alias("d"), q.typed("a", "int").alias("i"), q.iso_date(F.col("a")).alias("t"),
    )
    assert got == [(Decimal("12.35"), None, None), (None, None, None), (None, 99999999, None), (None, None, None)]
