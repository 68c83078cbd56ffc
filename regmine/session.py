"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so that second arithmetic on timestamps
# never meets a DST jump, ANSI so that bad casts fail loudly unless a try_*
# function is used on purpose, AQE for runtime coalescing and skew splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # With parallelism-first coalescing the post-shuffle target is
    # min(advisory 64 MB, shuffle bytes / default parallelism), floored by this
    # minimum: large shuffles are unaffected, small ones keep every core busy
    # for the CPU-heavy per-row stages that follow.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "regmine",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (about 128-256 MB per shuffle partition); AQE coalesces from there.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and "arrow" not in k:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on an existing session
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only read it.  A fresh local folder is created
    only when the session runs in local mode and nothing is configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/ABFS) so that lineage cuts survive executor loss")
        configured = tempfile.mkdtemp(prefix="regmine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ensure_utc(spark: SparkSession) -> None:
    """Day arithmetic on parsed timestamps is defined on wall-clock time; with
    a DST zone as session time zone a difference could gain or lose an hour.
    The operators therefore require (and set) a UTC session time zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_WRITTEN: list[str] = []


def scratch(spark: SparkSession, tag: str = "table") -> str:
    """A new path in the shared checkpoint folder, removed by ``release``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/regmine-{tag}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialize(df):
    """Cut lineage by writing ``df`` once, as Parquet, to the shared checkpoint
    folder (survives executor loss) and reading it back.  Used for the
    compressed tables and intermediate results that later passes re-read."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_with(df, **totals):
    """``materialize`` that also returns totals (name = aggregate column over
    the written columns) of the written rows as a dict: observed on the writing
    pass itself, so the rows are not read again.  Where the optimizer finds the
    input empty it drops the observation with it; the totals then come from the
    (empty) written table."""
    from pyspark.sql import Observation
    spark, seen = df.sparkSession, Observation()
    exprs = [c.alias(name) for name, c in totals.items()]
    out = materialize(df.observe(seen, *exprs))
    # observations arrive by the listener bus
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(600_000)
    return out, seen.get if seen._jo.future().isCompleted() else out.agg(*exprs).first().asDict()


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a path that ``scratch`` gave."""
    if path in _WRITTEN:
        _WRITTEN.remove(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True))


def release(spark: SparkSession) -> int:
    """Remove what ``materialize`` and ``scratch`` have written; call it when
    no result that reads them is needed any more."""
    return sum(remove(spark, path) for path in list(_WRITTEN))
