"""Pages by their first and last key: ties, nulls, ends."""

from pyspark.sql import functions as F

from txnlens.operators.position import page


def test_pages_cover_the_table_once(spark):
    df = spark.range(53).select("id", F.when(F.col("id") % 10 != 3, (F.col("id") * 7) % 5.0).alias("Time"), F.lit("wide").alias("w"))
    want = [r["id"] for r in df.orderBy("Time", "id").collect()]
    got = [[r["id"] for r in page(df, at, 20).collect()] for at in (0, 20, 40, 60)]
    assert got == [want[:20], want[20:40], want[40:], []]
    tied = [[r["Time"] for r in page(df, at, 20, ["Time"]).collect()] for at in (0, 20, 40)]  # one key, many rows
    assert sum(tied, []) == [r["Time"] for r in df.orderBy("Time").collect()]
