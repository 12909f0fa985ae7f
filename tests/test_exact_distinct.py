from quire.operators.profile import exact_distinct


def test_each_column_is_counted_alone(spark):
    rows = spark.createDataFrame([(1, "a", None), (1, "b", float("nan")), (2, None, 1.5), (None, "a", 1.5)], "n int, t string, d double")
    counts = exact_distinct(rows)
    assert {r.column_name: r.exact for r in counts.collect()} == {"n": 2, "t": 2, "d": 2}
    # No row is copied once for every column.
    assert "Expand" not in counts._jdf.queryExecution().optimizedPlan().toString()
