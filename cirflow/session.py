"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cirflow") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    ``master``/``shuffle_partitions`` are only applied when given; on a
    cluster the launcher's settings win.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset in local mode (tests)
    create a private one. On a cluster a missing setting is an error."""
    d = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not d:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cirflow-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once a session, so that they can
    import it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_cirflow_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="cirflow-")), "cirflow-src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._cirflow_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "cirflow", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df, name: str):
    """Write ``df`` once to the shared folder and read it back: later plans
    start from files that every executor can read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
