"""Session settings and the shared folder every job writes intermediate state to."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# What the library needs from a session; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even where that costs the next step its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bounds what one batch of long texts takes in a Python worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def local_session(cpus: int | str = "*", app: str = "marquee", **conf: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": "8",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Turns on what the operators count on in a session made elsewhere."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once per Spark context, so that functions that run in Python
    workers find it wherever the session was started."""
    context = spark.sparkContext
    if getattr(context, "_marquee_shipped", False):
        return
    root = pathlib.Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="marquee-code-"), "marquee.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    context._marquee_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen in local mode, where driver and
    executors are the same process; elsewhere the setting is required.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="marquee-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Writes the rows once to the shared folder and goes on from there: the plan becomes
    short, survives executor loss, and later steps read only the columns they need from a
    table whose size the optimizer knows."""
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
