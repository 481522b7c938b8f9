"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that can change at run time. The skew-join rule may add a shuffle so
# that a key holding a large share of a table is split over many tasks even when
# the join's output partitioning would have been reused.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "cartwise", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or get) a session with the settings the jobs expect."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else started."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A missing setting is an error: a machine-local path would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return configured.rstrip("/")


def ready(spark: SparkSession) -> SparkSession:
    """Give a local-mode session that has no checkpoint folder one of its own; for tests and trials."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwise-"))
    return spark


PART = "cartwise.scratch.part"


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, or of the part of it in use."""
    part = spark.conf.get(PART, "")
    return f"{shared_dir(spark)}/cartwise/{spark.sparkContext.applicationId}" + (f"/{part}" if part else "")


def use_part(spark: SparkSession, part: str) -> None:
    """Put intermediate tables below a part of their own from now on; ``""`` ends that."""
    spark.conf.set(PART, part)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path among this application's intermediate tables."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete this application's intermediate tables; tables derived from them must be written first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Lets Spark delete the shuffle files of a job when the job ends, instead of whenever the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and keeps column pruning and
    filter pushdown for the jobs that read the table several times. Nothing else
    can read the shuffles of the write, so their files go with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
