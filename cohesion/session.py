"""SparkSession settings the engine expects (used by tests, bench and queries).

On a cluster the session comes from spark-submit; ``get_session`` only fills
in settings that are unset. The checkpoint directory is read from
``spark.checkpoint.dir`` and only set (to a local scratch folder) when unset,
as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName("cohesion")
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("COHESION_DRIVER_MEMORY", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Unset, it is an error on a cluster; in local mode, where one
    machine does all, it becomes a scratch folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir is unset on {master}: set it to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="cohesion-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (e.g. Spark Connect)
        pass
    return d


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder's path under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cohesion-{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: a lost executor costs a re-read, two readers share one run."""
    spark = df.sparkSession
    path = shared_folder(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def telling_case(spark: SparkSession, names: Iterable[str]) -> Iterator[None]:
    """While plans are built here, names that differ only by case are different columns, if ``names`` hold any such."""
    names, key = list(names), "spark.sql.caseSensitive"
    if len({n.lower() for n in names}) == len(set(names)):
        yield
        return
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
