"""Session helpers shared by the entry points, the tests and the benchmark."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every operator relies on for right results.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that matter for speed; a cluster may override any of them.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without it every Column call looks up the Python line it came from.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = 8, memory: str = "8g", shuffle_partitions: int = 8, conf: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("keyflow")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in {**REQUIRED_CONF, **TUNING_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="keyflow-"))
    return context.getCheckpointDir()
