"""Session helpers: settings for own sessions, and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8, name: str = "touchline") -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets its own temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = context.getCheckpointDir()
        if folder is None:
            folder = tempfile.mkdtemp(prefix="touchline-", dir="/tmp")
            context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    context = spark.sparkContext
    context._touchline_folders = [*getattr(context, "_touchline_folders", []), path]
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage and fixes one version of rows that are read more than once; the table
    outlives the executors that wrote it.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession) -> int:
    """Delete the folders that this application has been given by ``new_folder`` so far, and say how many.

    For use between jobs: frames that read such a table cannot be computed any more.
    """
    context = spark.sparkContext
    folders, context._touchline_folders = getattr(context, "_touchline_folders", []), []
    jvm, settings = context._jvm, context._jsc.hadoopConfiguration()
    dropped = 0
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        dropped += path.getFileSystem(settings).delete(path, True)
    return dropped


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> None:
    """Have Spark give up fused code of a stage that the JVM would interpret row by row.

    HotSpot compiles no method of more than 8,000 bytes. Spark's limit is far above unless the session sets another, and
    a projection of many patterns goes beyond 8,000; it then runs as generated code in smaller methods.
    """
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, "8000")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark application.

    The Python jobs of the library need it on every executor. ``--py-files`` or an installed package
    does the same; a second copy does no harm.
    """
    context = spark.sparkContext
    if getattr(context, "_touchline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(package):  # runs from a shipped zip already
        return
    target = os.path.join(tempfile.mkdtemp(prefix="touchline-package-"), "touchline.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    context._touchline_shipped = True
