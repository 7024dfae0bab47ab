"""Session set-up and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; the cluster's own settings win where set."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once per context, so that functions of it run anywhere."""
    context = spark.sparkContext
    if getattr(context, "_basketry_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="basketry-"), "basketry.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("basketry", os.path.relpath(path, here)))
    context.addPyFile(target)
    context._basketry_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine: on a cluster
    the executors could not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local[") or context.master == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: fixes the rows for every later use and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder beside the checkpoints, for files that a plan writes and reads back."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
