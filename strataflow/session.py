"""Session and folder helpers shared by tests, bench and registered queries."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from strataflow.storage import delete_on_exit, make_folder


def local_session(cores: str = "8", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("strataflow")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    session without it is an error, since no machine-local folder would do.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strataflow-"))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder, removed when the session ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    make_folder(spark, path)  # only an existing folder can be marked for removal
    delete_on_exit(spark, path)
    return path
