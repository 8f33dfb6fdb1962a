"""Session helpers shared by tests, the bench and the driver entry point.

Operators never create a session; they take DataFrames. These helpers only
build a local session for tests/bench and resolve the shared folder that
iterative and streaming operators write to.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kestrel", extra: dict | None = None) -> SparkSession:
    """A local-mode session configured the way a cluster job would be.

    AQE is on (runtime coalescing, skew-join splitting, runtime broadcast
    conversion by measured size), the UI is off, time zone is pinned to UTC.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Read from the session (``spark.checkpoint.dir`` or an explicit
    ``setCheckpointDir``). Only a local-mode session (one process)
    with nothing configured gets a fresh temporary folder, as tests do; a
    cluster session, local-cluster included, without a configured shared
    folder is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) that every executor can reach")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables;
    an open ``table_scope`` records it."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextlib.contextmanager
def table_scope(spark: SparkSession):
    """Removes, at its end or after an error, every table that operators wrote
    to the shared folder while it was open (innermost scope first), through
    Hadoop's file system, so in any store. Results are read from those tables:
    collect or write them before the scope ends."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.remove(paths)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            folder.getFileSystem(conf).delete(folder, True)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back: lineage is cut, the plan runs exactly once (an eager
    ``checkpoint()`` of an uncached plan computes it twice), and the result
    survives lost executors. Later plans get exact file-size statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df, name: str, **metrics):
    """``materialize`` that also returns the row count, observed during the
    write job itself (``Observation``), so no second job counts the rows.

    Extra aggregate ``metrics`` (name=Column) are observed in the same job;
    then the result is (df, rows, {name: value}).
    """
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")   # unique per call
    extra = [c.alias(k) for k, c in metrics.items()]
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra).write.option(
        "compression", "zstd").parquet(path)
    got = obs.get
    out = spark.read.schema(df.schema).parquet(path)
    if metrics:
        return out, int(got["rows"]), {k: got[k] for k in metrics}
    return out, int(got["rows"])
