"""Session set-up and the folder for lineage cuts."""

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("forecourt")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, for clusters that don't have it installed."""
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="forecourt-package-"), "forecourt")
    archive = shutil.make_archive(target, "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for lineage cuts and written tables.

    Only a local session that names none gets a temporary folder: on a cluster that would
    not be shared between machines.
    """
    context = spark.sparkContext
    configured = context.getConf().get(_CHECKPOINT_KEY) or spark.conf.get(_CHECKPOINT_KEY, None)
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a shared folder")
    return tempfile.mkdtemp(prefix="forecourt-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back, cutting lineage.

    Losing an executor afterwards costs nothing, as the rows are in files.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


_stored: list[tuple[SparkSession, str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back; the folder goes when Python ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _stored:
        atexit.register(lambda: [_remove(*x) for x in _stored])
    _stored.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table of :func:`stored` that no query will read again."""
    files = df.inputFiles()
    for spark, path in [x for x in _stored if files and os.path.basename(x[1]) in files[0]]:
        _remove(spark, path)
        _stored.remove((spark, path))


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # at exit there is nobody left to tell
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
