"""Session helpers: a tuned local session and the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
#: With this set to true, a JSON object that repeats a key keeps its last value.
KEEP_LAST_KEY = "spark.sql.variant.allowDuplicateKeys"
#: Folders of this process's applications.
_owned: set[str] = set()


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter's session is used."""
    builder = (
        SparkSession.builder.master(master)
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config(KEEP_LAST_KEY, "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Checkpoints must outlive executors, so the folder has to be on storage that all of
    them share.  Where the setting is missing, a folder that the caller gave to
    ``setCheckpointDir`` serves, and else one in the session's warehouse, which is shared
    as well.
    """
    folder = (
        spark.conf.get(CHECKPOINT_SETTING, None)
        or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    )
    return folder.rstrip("/")


def file_system(spark: SparkSession, folder: str):
    """The file system that holds a folder, and the folder as its path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def results_folder(spark: SparkSession) -> str:
    """The application's own folder below the checkpoint folder.

    The application owns what is written here: tables made from it can be used until the
    application ends, and the folder is removed with it.  ``drop_results`` removes it before.
    """
    folder = f"{checkpoint_folder(spark)}/millrace-{spark.sparkContext.applicationId}"
    if folder not in _owned:
        files, path = file_system(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _owned.add(folder)
    return folder


def drop_results(spark: SparkSession) -> None:
    """Remove what this application has stored so far; tables that read it are void then."""
    for folder in list(_owned):
        files, path = file_system(spark, folder)
        files.delete(path, True)
        _owned.discard(folder)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and continue from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the results folder and continue from the files.

    It is written when this is called.  Unlike a checkpoint the written copy is read by
    column, so later steps that need a few columns read only these.  The application owns
    it (``results_folder``).  ``codec`` compresses long texts other than the session does.
    """
    place = f"{results_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(place, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(place)
