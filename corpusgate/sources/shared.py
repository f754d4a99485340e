"""Tables kept between steps, in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, made known to the session's checkpoints.

    It is the cluster's ``spark.checkpoint.dir``; one of our own is set only
    where the session names none, as in tests on one machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="corpusgate-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage of ``df`` by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cuts the lineage of ``df`` by a parquet table in the shared folder, which columns and compression make smaller than a checkpoint.

    The table lies in the folder of the session's checkpoints under a name of
    one use. It must last as long as any frame that reads it; ``clear_written``
    removes all that this process wrote.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> int:
    """Removes the tables that ``written`` made in this process; for when the results that read them have been used. Returns their number."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    gone = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table that is read in fewer parts than there are cores, dealt out to all of them; a larger table stays as it is.

    For steps whose work per row is heavy beside its size, such as parsing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_WRITTEN: list[str] = []
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the session's Python workers, once for each application.

    So they find it wherever they start. A package that was itself sent as an
    archive is there already.
    """
    context = spark.sparkContext
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or not os.path.isdir(home):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="corpusgate-"), "corpusgate.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for base, folders, files in os.walk(home):
            folders[:] = sorted(f for f in folders if f != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(base, f), os.path.relpath(os.path.join(base, f), os.path.dirname(home)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
