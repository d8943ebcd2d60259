"""Session helpers: a tuned local session for tests/bench and a checkpoint
directory that is always the shared one the cluster names."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def get_spark(app: str = "txnlens", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE, UTC and Arrow on and the web UI off.

    On a cluster ``master`` stays ``None`` and the submit settings win; the
    number of shuffle partitions should then follow the input size
    (roughly input bytes / 128 MB), which AQE coalesces further at runtime.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("TXNLENS_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster's ``spark.checkpoint.dir`` is used as it is. Only a local
    session without one gets a fresh folder under the temp dir (tests,
    bench); on a cluster a missing setting is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="txnlens-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session. Python stages
    import it there, whatever folder or host their worker runs in."""
    sc = spark.sparkContext
    if getattr(sc, "_txnlens_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="txnlens-ship-"), "txnlens.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(home)))
    sc.addPyFile(path)  # the driver serves it; nobody else reads its folder
    sc._txnlens_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for written tables."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df, name: str, partition_by: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: cuts the lineage (iterations, stamps that must not change)
    and survives executor loss, at the cost of one columnar write. With
    ``partition_by`` each value of that column is a folder of its own."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if partition_by:
        df.write.partitionBy(partition_by).parquet(path)
        return spark.read.schema(df.schema).parquet(path)  # an empty table has no folder to infer it from
    df.write.parquet(path)
    return spark.read.parquet(path)
