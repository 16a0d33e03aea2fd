"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()

# Settings every job wants; all of them can be changed at run time.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    app_name: str = "tidecast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build a session, or reuse the running one, with the job settings.

    ``shuffle_partitions`` is the upper bound AQE coalesces from: on a cluster set it so
    that one partition of the largest shuffle stays near 128-256 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(JOB_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which need it to run Python functions of it.

    Spark's own file service carries the archive, so no folder needs to be shared.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidecast-package-")) / "tidecast_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate results that every executor can reach.

    It comes from ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, which goes when Python ends.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="tidecast-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive lost executors and later reads skip the work."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def task_slots(spark: SparkSession) -> int:
    """Partition count for Python model fits, where rows are few but each one is costly."""
    return max(
        2 * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
