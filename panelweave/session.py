"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: let the runtime split oversized partitions, also where
    # the split costs an extra shuffle further up the plan.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def session(app: str = "panelweave", master: str | None = None, **extra) -> SparkSession:
    """Session with the settings above; ``extra`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings that may change at run time to a session made elsewhere."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.adaptive.") or key == "spark.sql.session.timeZone":
            spark.conf.set(key, value)
    return spark


def is_local_path(path: str) -> bool:
    """Whether a path names no store, or the local file system."""
    return "://" not in path and not path.partition(":")[0].isalpha() or path.startswith("file:")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the setting is absent, a folder beside the session's tables. On a
    cluster that has to be a store all executors reach; a warehouse on a local
    path, which is the default, fails with a message.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and is_local_path(warehouse):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder: the warehouse {warehouse} is a local path")
        root = warehouse.rstrip("/") + "/_scratch"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def run_dir(spark: SparkSession) -> str:
    """The application's own folder below the shared one; holds all its scratch tables."""
    return f"{checkpoint_root(spark).rstrip('/')}/panelweave-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the run's folder for a table written and read back."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the run's folder; call it when the results that read from it are stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df):
    """Write a table to the shared folder and read it back.

    The copy survives the loss of an executor, is pruned by column when read
    several times, and gives the planner its true size.
    """
    path = scratch_dir(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
