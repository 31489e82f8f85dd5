"""Session set-up and the one place that decides where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "furrow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it. Only a session whose executors are its own
    process may be without one; it gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    # Spark takes this setting only when a session starts, so the folder is remembered here.
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="furrow-")
    return _OWN[application]


_RUN: ContextVar[str | None] = ContextVar("furrow_run", default=None)


@contextmanager
def run_folder(spark: SparkSession):
    """Tables settled inside go to a folder of their own, which goes with the run: results that outlive it must
    have been written elsewhere. Threads started inside need the context copied to them."""
    path = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` once and go on from the written table, under the session's compression unless one is named.

    Used where several consumers read one expensive result. The table survives
    lost executors, keeps column pruning for each consumer, and cuts the lineage.
    """
    path = f"{_RUN.get() or shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def evenly(df: DataFrame) -> DataFrame:
    """Rows dealt out by the bytes they hold: Spark merges and splits the parts of this exchange to its advisory size,
    and to no fewer than the cores while parts are above its least size. For rows with long work ahead that come in
    few or uneven parts."""
    return df.hint("rebalance")
