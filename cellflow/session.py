"""Session settings for scripts and tests; a cluster session may be used as it is."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: The folder this program made for itself, if any; it goes when the program ends.
_own: list[tempfile.TemporaryDirectory] = []


def session(master: str = "local[8]", partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName("cellflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording a call site for every Column costs more than building the plan does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and read again by all that follows."""
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one the cluster names, a new local one only if none."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        if not _own:  # the setting itself cannot be changed in a running session
            _own.append(tempfile.TemporaryDirectory(prefix="cellflow-", ignore_cleanup_errors=True))
        named = _own[0].name
    return named
