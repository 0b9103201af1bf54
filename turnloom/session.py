"""Session set-up for tests and benchmarks, and the shared scratch folder.

On a cluster the session comes from the deployment: nothing here overrides it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "turnloom") -> SparkSession:
    """A single-JVM session for tests and ``bench.py``."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session that names none gets a temporary folder; a cluster
    session without one is an error, because a machine-local folder would be lost
    with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="turnloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


_made: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/turnloom-{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete what this application has stored at fresh paths, and nothing else.

    Results that still read from there must have been written or collected before. Returns
    the number of paths deleted. Checkpoints are left to ``spark.cleaner``.
    """
    jvm, done = spark._jvm, 0
    conf = spark._jsc.hadoopConfiguration()
    for path in _made.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        done += bool(place.getFileSystem(conf).delete(place, True))
    return done
