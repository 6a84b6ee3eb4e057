"""Session set-up and the one setting the library needs from the cluster."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  name: str = "windrow") -> SparkSession:
    """A single-machine session for tests and benchmarks.

    On a cluster use the session that ``spark-submit`` configures; nothing in the
    library sets a core count, a memory size or a shuffle width.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix=f"{name}-checkpoint-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where the setting is missing, a single-machine session gets a folder of its own, once; any
    other is refused, since its executors would not see each other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    held = context._jsc.sc().getCheckpointDir()
    if not folder and held.isDefined():
        folder = held.get()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="windrow-checkpoint-")
    if not held.isDefined():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint, so that lost executors cannot change it.

    Checkpoints go to :func:`shared_folder` and are removed by Spark once nothing refers to them,
    where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
