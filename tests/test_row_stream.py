"""Streams by row number, totals as state, and the graph across micro-batches:
each equals the batch query, also after a failure and a restart."""

import pytest
from pyspark.sql import functions as F

from txnlens.functions.columns import hour_of_day
from txnlens.operators import graph
from txnlens.operators.features import engineer_features, feature_columns, fit_feature_scaler
from txnlens.operators.graph_model import graph_features
from txnlens.operators.position import row_batches
from txnlens.plans import q_monitor, q_streaming
from txnlens.sources.rowstream import RowStreamReader, append_rows, index_rows, row_stream, run_to_end
from txnlens.sources.tables import txn
from txnlens.streaming.graph_tail import GraphTail, edges_sink, features_sink, flush
from txnlens.streaming.scoring import read_monitoring, score_batch, score_row_batches
from txnlens.streaming.totals import RunningTotals, read_totals, running_totals, start_totals, write_epochs

from .conftest import SF001


class Stop(Exception):
    pass


@pytest.fixture(scope="module")
def rows(spark):
    """The events in another order and cut, with a time that many rows share."""
    t = txn(spark, SF001).withColumn("Time", F.when(F.col("id") % 3 == 0, F.lit(5e5)).otherwise(F.col("Time")))
    return t.orderBy(F.sha2(F.col("id").cast("string"), 256)).repartition(7).cache()


def run(stream, process, checkpoint):
    run_to_end(stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).start())


def collected(into):
    def process(df, batch_id):
        into[batch_id] = sorted(df.select("pos", "id").collect())
    return process


def expected(rows, size, most=None):
    out = {}
    for r in row_batches(rows, size, max_batches=most).select("batch_id", "pos", "id").collect():
        out.setdefault(r["batch_id"], []).append((r["pos"], r["id"]))
    return {b: sorted(x) for b, x in out.items()}


@pytest.mark.parametrize("size,most", [(300, None), (250, 3), (5000, None)])
def test_batches_are_those_of_row_batches(spark, rows, tmp_root, size, most):
    got = {}
    run(row_stream(spark, index_rows(rows), size, most), collected(got), tmp_root)
    assert got == expected(rows, size, most)
    assert [len(x) for _, x in sorted(got.items())] == ([300, 300, 300, 100] if size == 300 else [250] * 3 if most else [1000])


def test_restart_repeats_the_failed_batch_and_loses_nothing(spark, rows, tmp_root):
    index, got, fail = index_rows(rows), {}, [1]

    def process(df, batch_id):
        if batch_id in fail:
            raise Stop
        collected(got)(df, batch_id)
    with pytest.raises(Exception):
        run(row_stream(spark, index, 300), process, tmp_root)
    assert sorted(got) == [0]
    fail.clear()
    run(row_stream(spark, index, 300), process, tmp_root)
    assert got == expected(rows, 300)
    run(row_stream(spark, index, 300), lambda df, i: got.update({i: "again"}), tmp_root)
    assert got == expected(rows, 300)
    # later rows come after all others, and batches stay aligned
    more = rows.withColumn("id", F.col("id") + 100_000).limit(450)
    run(row_stream(spark, append_rows(index, more), 300), collected(got), tmp_root)
    assert [len(x) for _, x in sorted(got.items())] == [300, 300, 300, 100, 200, 250]
    assert [p for b in sorted(got) for p, _ in got[b]] == list(range(1450)) and {i for p, i in got[5]} <= {r["id"] for r in more.collect()}


def test_pieces_cover_files_and_row_groups(spark, rows, monkeypatch):
    """Any range of rows is read once, whatever files, row groups and tasks it spans."""
    from txnlens.sources import rowstream

    spark.conf.set("parquet.block.size", "4096")
    try:
        index = index_rows(rows)
    finally:
        spark.conf.unset("parquet.block.size")
    monkeypatch.setattr(rowstream, "TASK_ROWS", 70)
    monkeypatch.setattr(rowstream, "ARROW_ROWS", 33)
    import json

    schema = rowstream.StructType([*index.schema.fields]).add("pos", "long")
    reader = RowStreamReader({"files": json.dumps(index.files), "rows_per_batch": "100"}, schema)
    order = [r["id"] for r in rows.orderBy("Time", "id").collect()]
    for lo, hi in ((0, 1), (0, 1000), (137, 741), (999, 1000), (500, 500)):
        pieces = reader.partitions({"row": lo}, {"row": hi})
        got = [x for p in pieces for b in reader.read(p) for x in zip(b.column("pos").to_pylist(), b.column("id").to_pylist())]
        assert got == [(i, order[i]) for i in range(lo, hi)] and all(p.hi - p.lo <= 70 for p in pieces)


def test_empty_table(spark, rows, tmp_root):
    """At most a batch without rows, of which the sinks and the state write nothing."""
    import os

    got, index = {}, index_rows(rows.where("false"))
    run(row_stream(spark, index, 10), collected(got), f"{tmp_root}/a")
    assert [x for b in got.values() for x in b] == []
    run(row_stream(spark, index, 10), score_batch(None, f"{tmp_root}/sink", q_streaming.rule_scorer), f"{tmp_root}/b")
    assert not os.path.exists(f"{tmp_root}/sink")
    run(row_stream(spark, index, 10), edges_sink(GraphTail(f"{tmp_root}/state", hops=0), f"{tmp_root}/edges"), f"{tmp_root}/c")
    assert spark.read.schema("src long, dst long").parquet(f"{tmp_root}/edges").count() == 0


# ---- totals as state

def scored(spark, index, size, every):
    return running_totals(row_stream(spark, index, size).withColumn("batch_id", F.floor(F.col("pos") / every)))


def plain(df):
    return sorted(map(tuple, df.select("batch_id", "transactions_processed", "fraud_detected", "total_processed", "total_fraud_detected").collect()))


@pytest.mark.parametrize("fail_after_write", [False, True])
def test_totals_survive_a_failure(spark, tmp_root, fail_after_write):
    """Micro-batches of 230 rows end inside batches of 100; the second one
    fails before or after its rows are written, and is run again."""
    index = index_rows(q_monitor.scored_txn(spark, SF001))
    write, broken = write_epochs(f"{tmp_root}/out"), [True]

    def sink(df, epoch):
        if fail_after_write or epoch != 1 or not broken:
            write(df, epoch)
        if epoch == 1 and broken:
            raise Stop
    with pytest.raises(Exception):
        run_to_end(start_totals(scored(spark, index, 230, 100), "", f"{tmp_root}/ckpt", sink))
    broken.clear()
    run_to_end(start_totals(scored(spark, index, 230, 100), "", f"{tmp_root}/ckpt", sink))
    assert plain(read_totals(spark, f"{tmp_root}/out")) == plain(q_monitor.batch_running_totals(spark, SF001))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "unset").find("RocksDB") < 0


def test_totals_by_key(spark, rows, tmp_root):
    index = index_rows(rows.withColumn("prediction", F.col("Class")))
    stream = row_stream(spark, index, 400).withColumns({"batch_id": F.floor(F.col("pos") / 100), "side": (F.col("id") % 2)})
    run_to_end(start_totals(running_totals(stream, key="side"), f"{tmp_root}/out", f"{tmp_root}/ckpt"))
    got = read_totals(spark, f"{tmp_root}/out")
    last = {r["key"]: r["total_processed"] for r in got.groupBy("key").agg(F.max("total_processed").alias("total_processed")).collect()}
    want = {str(r["side"]): r["n"] for r in rows.groupBy((F.col("id") % 2).alias("side")).agg(F.count("*").alias("n")).collect()}
    assert last == want and got.agg(F.sum("fraud_detected")).first()[0] == rows.agg(F.sum("Class")).first()[0]


def test_a_closed_batch_is_refused():
    import pandas as pd

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, v):
            self.held = v

    class Handle:
        def getValueState(self, name, schema):
            return Value()
    p = RunningTotals()
    p.init(Handle())

    def feed(*counts):
        return [tuple(r) for f in p.handleInputRows(("k",), iter([pd.DataFrame(counts, columns=["batch_id", "processed", "detected"])]), None)
                for r in f.itertuples(index=False)]
    assert feed((0, 5, 1), (1, 2, 0), (0, 5, 1)) == [("k", 0, 10, 2, 10, 2), ("k", 1, 2, 0, 12, 2)]
    assert feed((1, 8, 3), (3, 1, 1)) == [("k", 1, 10, 3, 20, 5), ("k", 3, 1, 1, 21, 6)]
    with pytest.raises(ValueError):
        feed((2, 1, 0))


# ---- the graph across micro-batches

def hops_of_all(rows, hops):
    nodes, edges = graph.similarity_graph(rows.withColumn("Hour", hour_of_day("Time")), ["Amount", "Hour"])
    h = graph.propagate(nodes, edges, ["Amount", "Hour"], hops=hops)
    return {r["id"]: (round(r["Amount"], 6), round(r["Hour"], 6)) for r in h.collect()}


@pytest.mark.parametrize("size", [15, 400])
def test_edges_over_batch_ends(spark, tmp_root, size):
    """Batches shorter than the band, and long ones; each edge once."""
    t = txn(spark, SF001).limit(70 if size < 19 else 1000).cache()
    tail = GraphTail(f"{tmp_root}/state", hops=0)
    run(row_stream(spark, index_rows(t), size), edges_sink(tail, f"{tmp_root}/out"), f"{tmp_root}/ckpt")
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_root}/out").select("src", "dst").collect()))
    assert got == sorted(map(tuple, graph.banded_edges(t).collect())) and got


@pytest.mark.parametrize("size,hops", [(330, 3), (90, 1)])
def test_features_over_batch_ends(spark, tmp_root, size, hops):
    t = txn(spark, SF001).limit(250 if hops == 1 else 700).withColumn("Hour", hour_of_day("Time")).cache()
    tail, out = GraphTail(f"{tmp_root}/state", ["Amount", "Hour"], hops=hops), f"{tmp_root}/out"
    process, failed = features_sink(tail, out), []

    def once_broken(df, batch_id):
        process(df, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            raise Stop  # after its rows and its state were written
    index = index_rows(t)
    with pytest.raises(Exception):
        run(row_stream(spark, index, size).drop("pos"), once_broken, f"{tmp_root}/ckpt")
    stream = row_stream(spark, index, size).drop("pos")
    run(stream, once_broken, f"{tmp_root}/ckpt")
    for _ in range(2):  # a repeated flush gives the same
        flush(spark, tail, process, stream.schema)
    got = [(r["id"], (round(r["Amount"], 6), round(r["Hour"], 6))) for r in spark.read.schema("id long, Amount double, Hour double").parquet(out).collect()]
    want = hops_of_all(t, hops)
    assert len(got) == len(want) and dict(got) == want
    state = [spark.read.parquet(f"{tmp_root}/state/tail-{i}").count() for i in range(2)]
    assert max(state) <= 2 * tail.reach


def test_serving_features_equal_training(spark, tmp_root):
    """What the scorer's graph model reads in a stream is what it was trained on."""
    t = txn(spark, SF001).limit(500).cache()
    scaler = fit_feature_scaler(t)
    f = engineer_features(t, scaler, keep=["id", "Time", "Amount"])
    cols = [c for c in feature_columns(f)]
    tail, out = GraphTail(f"{tmp_root}/state", cols, hops=3), f"{tmp_root}/out"
    process = features_sink(tail, out)
    stream = row_stream(spark, index_rows(t), 210).drop("pos")
    served = lambda df, i, last=False: process(engineer_features(df, scaler, keep=["id", "Time", "Amount"]), i, last)
    run(stream, served, f"{tmp_root}/ckpt")
    flush(spark, tail, served, stream.schema)
    got = {r["id"]: [round(r[c], 6) for c in cols] for r in spark.read.parquet(f"{out}/epoch=*").collect()}
    assert got == {r["id"]: [round(r[c], 6) for c in cols] for r in graph_features(f, cols).collect()}


# ---- tables stored as folders

@pytest.mark.parametrize("name", ["stream_rule_stats", "stream_rule_alerts", "stream_batch_stats", "stream_alert_cases"])
def test_file_streams_read_folders(spark, tmp_root, name):
    """The same rows from one file and from many part files."""
    spark.read.parquet(f"{SF001}/events.parquet").repartition(5).write.parquet(f"{tmp_root}/sf/events.parquet")
    one, many = ([[round(x, 6) if isinstance(x, float) else x for x in r] for r in getattr(q_streaming, name)(spark, sf).collect()]
                 for sf in (SF001, f"{tmp_root}/sf"))
    assert sorted(one) == sorted(many) and one


def test_batches_admitted_at_once_sink_as_batches_of_their_own(spark, rows, tmp_root):
    """Seven batches a micro-batch: fewer micro-batches, the same alerts,
    statistics and cases of each batch; a replay changes nothing."""
    index, frames = index_rows(rows), []
    run(row_stream(spark, index, 30), score_batch(None, f"{tmp_root}/one", q_streaming.rule_scorer), f"{tmp_root}/c1")
    many = score_row_batches(f"{tmp_root}/many", q_streaming.rule_scorer, 30)

    def twice(df, n):
        frames.append(df.count())
        many(df, n)
        many(df, n)
    run(row_stream(spark, index, 30, batches_at_once=7), twice, f"{tmp_root}/c2")
    assert frames == [min(210, index.rows - lo) for lo in range(0, index.rows, 210)]

    def found(root):
        alerts, stats, cases = read_monitoring(spark, root)
        keys = ("transaction_id", "amount", "prediction", "confidence", "iso_score")
        return (sorted(map(tuple, alerts.select(*keys).collect())), sorted(map(tuple, cases.collect())),
                sorted(map(tuple, stats.select("batch_id", "transactions_processed", "fraud_detected", "fraud_rate", "total_processed", "total_fraud_detected").collect())))
    assert found(f"{tmp_root}/one") == found(f"{tmp_root}/many")


# ---- micro-batches that grow

def test_growing_admission():
    """1, 2, 4 batches and so on, up to batches_at_once; the offset alone decides it."""
    import json

    from txnlens.schemas import EVENTS

    def ends(at=0, **more):
        reader, out = RowStreamReader({"files": json.dumps([["f", 1000]]), "rows_per_batch": "30", "batches_at_once": "7", **more}, EVENTS), []
        reader.partitions({"row": at}, {"row": at})
        while (n := reader.latestOffset()["row"]) > at:
            out.append(n)
            reader.partitions({"row": at}, {"row": n})
            at = n
        return out
    assert ends(growing="true") == [30, 90, 210, 420, 630, 840, 1000]
    assert ends(at=90, growing="true") == [210, 420, 630, 840, 1000]  # after a restart too
    assert ends() == [210, 420, 630, 840, 1000]


@pytest.mark.parametrize("hops", [0, 3])
def test_graph_streams_take_few_micro_batches(spark, monkeypatch, hops):
    """The edges and features of 50 batches, found in micro-batches of 1, 2, 4 and then 8 of them."""
    monkeypatch.setattr(q_streaming, "GRAPH_ROWS", 20)
    monkeypatch.setattr(q_streaming, "BATCHES_AT_ONCE", 8)
    name, seen = ("features_sink" if hops else "edges_sink"), []
    whole = getattr(q_streaming, name)

    def counted(tail, path):
        process = whole(tail, path)
        return lambda df, i, **last: (seen.append(df.count()), process(df, i, **last))[1]
    monkeypatch.setattr(q_streaming, name, counted)
    t = txn(spark, SF001)
    if hops:
        got = {r["id"]: (r["Amount_h"], r["Hour_h"]) for r in q_streaming.stream_graph_features(spark, SF001).collect()}
        want = hops_of_all(t, hops)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=2e-5) for k in got)
    else:
        got = sorted(map(tuple, q_streaming.stream_band_edges(spark, SF001).collect()))
        assert got == sorted(map(tuple, graph.banded_edges(t).collect()))
    assert seen == [20, 40, 80] + [160] * 5 + [60] + [0] * bool(hops)


def test_keyed_totals_take_few_micro_batches(spark, monkeypatch):
    """22 and a half batches of 45 rows, which end inside totals of 10 rows."""
    import os

    for name, n in (("TOTALS_ADMITTED", 45), ("TOTALS_ROWS", 10), ("BATCHES_AT_ONCE", 5)):
        monkeypatch.setattr(q_streaming, name, n)
    paths = []
    monkeypatch.setattr(q_streaming, "start_totals", lambda totals, path, *a, **k: paths.append(path) or start_totals(totals, path, *a, **k))
    got = plain(q_streaming.stream_keyed_totals(spark, SF001))
    rows = q_streaming.rule_scorer(row_batches(txn(spark, SF001), 10)).groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("prediction").alias("d")).orderBy("batch_id").collect()
    want, n, d = [], 0, 0
    for r in rows:
        n, d = n + r["n"], d + r["d"]
        want.append((r["batch_id"], r["n"], r["d"], n, d))
    assert got == want
    epochs = [x for x in os.listdir(paths[0].removeprefix("file:")) if x.startswith("epoch=")]
    assert len(epochs) == 7  # that end at rows 45, 135, 315, 540, 765, 990 and 1000
