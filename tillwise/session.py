"""Session settings the library relies on."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; every one may be overridden by the caller.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators assume on a session that exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "tillwise", cores: int | str = "*", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """Folder every executor can reach, as named by the cluster."""
    return spark.conf.get("spark.checkpoint.dir", None)


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's shared one.

    Only a session on a single machine, as in tests, gets a folder of its own where none is set.
    """
    folder = shared_dir(spark)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_dir()


@functools.cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="tillwise-")


def cut_lineage(spark: SparkSession, df, folder: str | None = None, **options: str):
    """A written table in the shared folder (or one below it) instead of the plan so far; ``options`` are the writer's."""
    path = f"{folder or work_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
