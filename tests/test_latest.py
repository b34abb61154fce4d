"""Latest value per key and lookups."""

from pyspark.sql import functions as F

from ordertide.operators import latest as lt


def test_all_one_missing_and_tombstone(spark):
    df = spark.createDataFrame(
        [("a", "v1", False, 1, 1), ("a", "v2", False, 2, 2), ("b", "w", False, 1, 3),
         ("c", "x", False, 1, 4), ("c", None, True, 2, 5)],
        "key string, value string, value_null boolean, ts long, seq long")
    table = lt.latest(df, tombstone="value_null")
    assert {(r.key, r.value) for r in lt.scan(table).collect()} == {("a", "v2"), ("b", "w")}
    req = spark.createDataFrame([("a",), ("zz",)], "key string")
    got = {r.key: (r.found, r.value) for r in lt.lookup(req, table).collect()}
    assert got == {"a": (True, "v2"), "zz": (False, None)}


def test_tie_break_by_seq(spark):
    df = spark.createDataFrame([("a", "first", 5, 1), ("a", "second", 5, 2)], "key string, value string, ts long, seq long")
    assert lt.latest(df).first().value == "second"
    assert lt.latest(df.withColumn("seq", -F.col("seq"))).first().value == "first"
