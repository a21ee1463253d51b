"""Session helpers: UTC clock, AQE, shared checkpoint folder.

Everything time-related in this package assumes the session time zone is UTC
(the reference stores UTC instants).  ``ensure_utc`` sets it on the session the
caller owns; it is a runtime SQL conf, so it is safe on a shared session.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Runtime confs this package relies on.  All are plain SQL confs, settable on a
# live session, and every one is a Spark default or a Spark-documented knob.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def ensure_utc(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            try:
                spark.conf.set(k, v)
            except Exception:  # pragma: no cover - conf locked by the cluster operator
                if k == "spark.sql.session.timeZone":
                    raise
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets this to a shared filesystem path; we only
    read it, and a cluster session without it is an error (a machine-local
    folder would split data over the nodes' disks).  In local mode (unit
    tests, local runs) a fresh folder under the system temp dir is registered.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="seisma-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is no such path; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    import uuid

    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "seisma") -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    driver_mem = os.environ.get("SEISMA_DRIVER_MEMORY", "8g")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_mem)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Per-call Python call-site capture for error messages costs several
        # driver<->JVM round trips per DataFrame API call; plans here are built
        # from hundreds of calls.  Static conf: only settable at session build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def checkpointed(df):
    """Reliable checkpoint into the shared checkpoint folder (never a local one).

    Survives executor loss (the data lives on the shared filesystem) and cuts
    the lineage, so a DataFrame consumed several times is computed once.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
