"""Totals of one key keep one state partition; the session's setting comes back."""

from types import SimpleNamespace

from txnlens.streaming.totals import PROVIDER, SHUFFLE, start_totals


def test_partitions_hold_for_the_query_alone(spark):
    seen, before = {}, spark.conf.get(SHUFFLE)

    class Writer:
        def __getattr__(self, name):
            return lambda *a: self

        def start(self):
            seen.update({n: spark.conf.get(n) for n in (SHUFFLE, PROVIDER)})
            return "started"
    totals = SimpleNamespace(sparkSession=spark, writeStream=Writer())
    assert start_totals(totals, "out", "checkpoint", partitions=1) == "started"
    assert seen[SHUFFLE] == "1" and seen[PROVIDER].endswith("RocksDBStateStoreProvider") and spark.conf.get(SHUFFLE) == before
