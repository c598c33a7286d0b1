"""Session defaults and the shared folder used for written stages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
_scopes: list[str] = []


def build_session(cores: str | int = "*", app: str = "tastemill", **conf) -> SparkSession:
    """A local session with the settings the jobs expect; a cluster supplies its own."""
    conf.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tastemill-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session that others made without that setting gets a temporary folder.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="tastemill-")
    return _local_dir


def stage_path(spark: SparkSession, label: str) -> str:
    return "/".join([shared_dir(spark), "tastemill", *_scopes, f"{label}-{uuid.uuid4().hex}"])


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Stages written inside are removed at the end, so write or collect the result before that."""
    name = f"scope-{uuid.uuid4().hex}"
    top = "/".join([shared_dir(spark), "tastemill", *_scopes, name])
    _scopes.append(name)
    try:
        yield
    finally:
        _scopes.remove(name)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def write_stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of loops, fixes partition tags that must not be
    recomputed, and survives the loss of executors.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_checkpoints(spark: SparkSession) -> None:
    """Point ML estimators that checkpoint (ALS) at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/tastemill/rdd")
