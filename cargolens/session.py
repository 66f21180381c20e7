"""Spark session and shared-storage helpers.

Every operator in this package is a lazy DataFrame transformation; the
session only pins the settings the operators rely on:

* UTC session time zone (local dates are derived explicitly with
  ``from_utc_timestamp``; nothing depends on the host zone);
* ANSI mode stays on, so parsing always goes through ``try_*`` functions;
* adaptive execution with skew-join splitting and partition coalescing,
  so a tenant holding a third of all rows is split at run time;
* no Spark UI (no port opened by this library).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package expects.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "cargolens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with this package's settings.

    ``master`` is only set when given (tests and the benchmark run
    ``local[N]``); on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", "16g")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session created elsewhere."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and snapshot tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is
    unset in a local run (tests) a private scratch folder is created;
    a cluster without the setting is an error.
    """
    cfg = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — no SparkContext handle (Spark Connect)
        sc = None
    if not cfg and sc is not None:
        cfg = sc.getConf().get("spark.checkpoint.dir", None)
    if not cfg:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        cfg = tempfile.mkdtemp(prefix="cargolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", cfg)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(cfg)
    return cfg


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of each query run inside go when it is done; otherwise
    they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back, so
    that several tables derived from it share one evaluation."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with dropping_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
