"""The sink of whole batches: failed at each point, all of a batch or nothing."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from txnlens.sources import commits

ROW = StructType([StructField("k", LongType()), StructField("s", StringType())])


def batch(spark, lo, hi):
    return spark.range(lo, hi, 1, 4).select(F.col("id").alias("k"), F.concat(F.lit("é\n"), F.col("id").cast("string")).alias("s"))


def rows(spark, root, table):
    return sorted((r["batch_id"], r["k"], r["s"]) for r in commits.read_committed(spark, root, table, ROW).collect())


def expected(batch_id, lo, hi):
    return [(batch_id, k, f"é\n{k}") for k in range(lo, hi)]


def failing(point):
    """A sink that fails at a point of the batch; local, so that it is
    sent to the workers by value."""
    from txnlens.sources.commits import BatchWriter, CommitSink

    class Fails(BatchWriter):
        def write(self, batches):
            if point == "before a task":
                raise RuntimeError(point)
            done = super().write(batches)
            if point == "after a task" and any(n for _, _, n in done.names):
                raise RuntimeError(point)
            return done

        def commit(self, messages):
            if point == "before the commit":
                raise RuntimeError(point)
            super().commit(messages)
            raise RuntimeError(point)

        def abort(self, messages):
            if point == "before the commit":
                return  # a crash: nobody cleans up
            if point != "after the commit":
                super().abort(messages)

    class FailingSink(CommitSink):
        @classmethod
        def name(cls):
            return "txnlens_commits_failing"

        def writer(self, schema, overwrite):
            return Fails(self.options)

    return FailingSink


@pytest.mark.parametrize("point", ["before a task", "after a task", "before the commit", "after the commit"])
def test_a_failed_batch_is_whole_or_absent(spark, tmp_root, point):
    root = f"{tmp_root}/sink"
    commits.write_batch({"a": batch(spark, 0, 10), "b": batch(spark, 0, 3)}, root, 0)
    tables = {"a": batch(spark, 10, 30), "b": batch(spark, 10, 11)}
    with pytest.raises(Exception, match=point):
        commits.write_batch(tables, root, 1, failing(point))
    whole = point == "after the commit"
    a, b = expected(0, 0, 10), expected(0, 0, 3)
    assert rows(spark, root, "a") == a + (expected(1, 10, 30) if whole else [])
    assert rows(spark, root, "b") == b + (expected(1, 10, 11) if whole else [])
    for _ in range(2):  # the replay, and one more
        commits.write_batch(tables, root, 1)
        assert rows(spark, root, "a") == a + expected(1, 10, 30)
        assert rows(spark, root, "b") == b + expected(1, 10, 11)


def test_empty_batches_and_absent_sinks(spark, tmp_root):
    assert rows(spark, f"{tmp_root}/none", "a") == []
    commits.write_batch({"a": batch(spark, 0, 0)}, f"{tmp_root}/e", 4)
    assert rows(spark, f"{tmp_root}/e", "a") == [] and os.listdir(f"{tmp_root}/e/commits") == [f"{4:020d}.json"]


def test_stream_sink_restarts_without_loss(spark, tmp_root):
    commits.register_sink(spark)
    for n, (lo, hi) in enumerate([(0, 20), (20, 25)]):
        batch(spark, lo, hi).coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
        s = commits.payload(spark.readStream.schema(ROW).parquet(f"{tmp_root}/in"), "a")
        s.writeStream.format(commits.FORMAT).option("checkpointLocation", f"{tmp_root}/c").trigger(availableNow=True).start(f"{tmp_root}/s").awaitTermination()
        assert rows(spark, f"{tmp_root}/s", "a") == sorted(expected(0, 0, 20) + (expected(1, 20, 25) if n else []))
