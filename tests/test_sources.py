import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire.model import TABLES, table
from quire.operators.clean import to_raw
from quire.session import scratch_folder
from quire.sources import (
    high_water_mark, jdbc_options, overwrite_partitioned, read_delimited, read_parquet, read_products, read_typed,
    rows_since, slice_counts, slice_predicates, write_delimited, write_json,
)
from quire.sources.sinks import overwrite, overwrite_sorted
from quire.sources.xml import product_identifiers

SCHEMA = "k int, t string, a decimal(9,2)"


def test_model_has_thirteen_tables_with_keys():
    assert len(TABLES) == 13 and sum(len(t.fields) for t in TABLES.values()) == 89
    assert [f.dataType.simpleString() for f in table("VENTEP").schema][:5] == ["bigint", "string", "int", "int", "decimal(11,2)"]
    assert all(set(t.keys) <= {f.name for f in t.fields} for t in TABLES.values())


def test_delimited_round_trip(spark):
    rows = [(1, "a|b", Decimal("1.50")), (2, 'say "x"', None), (3, "", Decimal("-2.00")), (4, None, None), (5, " padded  ", None), (6, "é", None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for encoding in ("UTF-8", "ISO-8859-1"):
        path = scratch_folder(spark, "csv")
        write_delimited(frame, path, encoding)
        back = read_delimited(spark, path, frame.schema, encoding)
        # The format has one way to write nothing: an empty text comes back as NULL.
        assert sorted(tuple(r) for r in back.collect()) == sorted((k, t or None, a) for k, t, a in rows)


def test_delimited_bad_lines(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('k|t|a\n1|"x|y"|2.00\n2|short\nq|z|1.00\n', encoding="utf-8")
    schema = spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_delimited(spark, str(tmp_path), schema).collect()
    kept = read_delimited(spark, str(tmp_path), schema, keep_corrupt=True).collect()
    assert [r["_corrupt_record"] for r in kept] == [None, "2|short", "q|z|1.00"] and kept[0]["t"] == "x|y"
    assert read_delimited(spark, str(tmp_path)).schema.simpleString() == "struct<k:string,t:string,a:string>"


def test_typed_parquet_and_schema_merge(spark):
    path = scratch_folder(spark, "evolving")
    spark.createDataFrame([(1, "a")], "k int, t string").write.parquet(f"{path}/part=1")
    spark.createDataFrame([(2, "b", "new")], "k int, t string, extra string").write.parquet(f"{path}/part=2")
    merged = read_parquet(spark, path, merge_schema=True)
    assert {(r["k"], r["extra"], r["part"]) for r in merged.collect()} == {(1, None, 1), (2, "new", 2)}
    target = scratch_folder(spark, "replaced")
    overwrite(spark.createDataFrame([(1,)], "a int"), target)
    overwrite(spark.createDataFrame([("x", 2)], "b string, c int"), target)
    assert read_parquet(spark, target).columns == ["b", "c"]


def test_raw_keeps_padding_and_turns_bad_amounts_to_null(spark):
    declared = table("collections")
    frame = spark.createDataFrame([("FOLIO     ", "Folio", "GALLMRD", "oops", "A")], "CLCODE string, CLNOM string, CLEDIT string, CLDTCR string, CLSTAT string")
    raw = to_raw(frame, declared)
    assert raw.dtypes == [("CLCODE", "string"), ("CLNOM", "string"), ("CLEDIT", "string"), ("CLDTCR", "int"), ("CLSTAT", "string")]
    assert raw.first()["CLCODE"] == "FOLIO     " and raw.first()["CLDTCR"] is None
    path = scratch_folder(spark, "typed")
    overwrite(raw, path)
    assert read_typed(spark, path, declared).count() == 1


def test_incremental(spark):
    path = scratch_folder(spark, "source")
    days = spark.range(100).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10).cast("int")).alias("d"))
    overwrite(days, path)
    source = read_parquet(spark, path)
    mark = high_water_mark(source.filter("id < 55"), "d")
    assert mark == dt.date(2024, 1, 6)
    again, later = rows_since(source, "d", mark), rows_since(source, "d", mark, strict=True)
    assert (again.count(), later.count()) == (50, 40)
    assert "GreaterThanOrEqual(d,2024-01-06)" in again._jdf.queryExecution().executedPlan().toString()
    assert rows_since(source, "d", high_water_mark(source.limit(0), "d")).count() == 100


def test_slices(spark):
    frame = spark.createDataFrame([(2020,), (2020,), (2021,), (None,), (1999,)], "y int")
    parts = [frame.filter(p).count() for p in slice_predicates("y", [2020, 2021])]
    assert parts == [2, 1, 2] and sum(r["row_count"] for r in slice_counts(frame, "y").collect()) == 5
    assert slice_predicates("e", ["L'EDI"])[0] == "e = 'L''EDI'"


def test_partitioned_write(spark):
    path = scratch_folder(spark, "years")
    frame = spark.range(1000).select("id", (F.lit(2020) + F.col("id") % 3).alias("y"))
    overwrite_partitioned(frame, path, "y")
    back = read_parquet(spark, path)
    assert back.count() == 1000 and {r["y"] for r in back.select("y").distinct().collect()} == {2020, 2021, 2022}
    assert "PartitionFilters: [isnotnull(y" in back.filter("y = 2021")._jdf.queryExecution().executedPlan().toString()


def test_sorted_full_load(spark):
    path = scratch_folder(spark, "sorted")
    overwrite_sorted(spark.range(1000).orderBy(F.rand(1)), path, "id")
    files = spark.read.parquet(path).groupBy("_metadata.file_path").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert all(x["b"] < y["a"] for x, y in zip(files, files[1:]))


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "drv", table="L.T")["dbtable"] == "L.T"
    assert jdbc_options("jdbc:x", query="SELECT A FROM T WHERE D >= 1")["query"].startswith("SELECT A")
    sliced = jdbc_options("jdbc:x", query="SELECT A FROM T", partition_column="A", bounds=(1, 100), partitions=4)
    assert sliced["dbtable"] == "(SELECT A FROM T) sliced" and sliced["numPartitions"] == "4" and sliced["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="T", query="Q")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="T", partition_column="A", partitions=4)


def test_xml_products(spark, tmp_path):
    product = """<Product><RecordReference>{ref}</RecordReference>
      <ProductIdentifier><ProductIDType>02</ProductIDType><IDValue>{ten}</IDValue></ProductIdentifier>
      <ProductIdentifier><ProductIDType>15</ProductIDType><IDValue>{thirteen}</IDValue></ProductIdentifier>
      <DescriptiveDetail><TitleDetail><TitleElement><TitleText>L'été</TitleText></TitleElement></TitleDetail></DescriptiveDetail>
    </Product>"""
    body = product.format(ref="007", ten="0306406152", thirteen="9780306406157") + product.format(ref="8", ten="", thirteen="9782070368228")
    (tmp_path / "a.xml").write_text(f"<ONIXMessage>{body}</ONIXMessage>", encoding="utf-8")
    got = {r["reference"]: r for r in product_identifiers(read_products(spark, str(tmp_path))).collect()}
    assert got["007"]["isbn10"] == "0306406152" and got["007"]["titre"] == "L'été" and got["8"]["isbn13"] == "9782070368228"


def test_json_report(spark):
    path = scratch_folder(spark, "report")
    write_json(spark.createDataFrame([("isbn", "PASS")], "check string, status string"), path)
    assert [tuple(r) for r in spark.read.json(path).select("check", "status").collect()] == [("isbn", "PASS")]


def test_written_products_are_dealt_over_files(spark, tmp_path, monkeypatch):
    from quire.sources import xml

    monkeypatch.setattr(xml, "FILE_PRODUCTS", 100)
    rows = spark.range(1050).select(F.col("id").cast("string").alias("RecordReference"))
    xml.write_products(rows.coalesce(1), str(tmp_path / "products"))
    read = xml.read_products(spark, str(tmp_path / "products"))
    assert len(read.inputFiles()) >= 11
    assert sorted(int(r.RecordReference) for r in read.collect()) == list(range(1050))
