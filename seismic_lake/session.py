"""Session settings the jobs rely on."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    # Event ids, year partitions and day counts are all defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Rows go to Python by this many bytes: 10,000 long texts, or pairs of them, would be held by both sides at once.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (safe to call repeatedly)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, which import its functions by name.

    Not needed where it is installed on every machine or given with ``--py-files``. Spark serves the archive
    from the driver, so no shared folder is involved; once per session is enough.
    """
    root = Path(__file__).resolve().parent
    with tempfile.TemporaryDirectory() as folder:
        archive = shutil.make_archive(f"{folder}/{root.name}", "zip", root.parent, root.name)
        spark.sparkContext.addPyFile(archive)
    return spark


def local_session(cores: int | str = "*", name: str = "seismic_lake", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    parallel = 8 if cores == "*" else int(cores)
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.session.timeZone", "UTC")
        # Wide plans are built faster without a recorded call site per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="lake-")  # one machine only, as in tests
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, lost executors cost a re-read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# One shuffle partition for this much input, and bounds on the numbers of partitions and of scan
# tasks: the driver keeps a record per scan task and shuffle partition.
INPUT_PER_PARTITION = 128 << 20
MAX_PARTITIONS = 50_000
MAX_SCAN_TASKS = 100_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SCAN_BYTES = "spark.sql.files.maxPartitionBytes"


def _scan_bytes(spark: SparkSession) -> int:
    text = spark.conf.get(SCAN_BYTES)
    return int(text[:-1]) if text.endswith("b") else int(text) if text.isdigit() else 128 << 20


def size_for(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Size scans and shuffles of a session for its largest input; called once, before any job.

    Only raises the numbers Spark starts from; AQE merges partitions that turn out too small.
    """
    partitions = min(MAX_PARTITIONS, -(-input_bytes // INPUT_PER_PARTITION))
    if partitions > int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(partitions))
    if input_bytes // MAX_SCAN_TASKS > _scan_bytes(spark):
        spark.conf.set(SCAN_BYTES, str(input_bytes // MAX_SCAN_TASKS))
    return spark
