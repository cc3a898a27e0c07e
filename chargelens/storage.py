"""Intermediate tables in the folder shared by all executors.

A table written here cuts lineage and survives the loss of any executor, and unlike a cached
frame it is columnar, so later passes read only the columns they use.
"""

import tempfile
import uuid


def shared_dir(spark):
    """The cluster's checkpoint folder; a temporary one only in local mode without a setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="chargelens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def job_dir(spark):
    """The folder of this application in the shared folder."""
    return f"{shared_dir(spark)}/chargelens/{spark.sparkContext.applicationId}"


def new_path(spark, kind="tables"):
    return f"{job_dir(spark)}/{kind}/{uuid.uuid4().hex}"


def clear(spark):
    """Remove what this application has written to the shared folder; frames made of it are gone then.

    For the end of a job, when its results are written elsewhere.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(job_dir(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)


def materialize(df):
    """Write `df` once and read it back; the frame that comes back has no upstream plan."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
