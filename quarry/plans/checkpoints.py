"""Lineage cuts for iterative jobs and for results that are read more than once."""

import tempfile
import uuid


def shared_folder(spark):
    """The folder the cluster names in `spark.checkpoint.dir`; only a local session
    without the setting gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="run-checkpoints-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut_lineage(df):
    """Write `df` to a table in the shared folder and read it back.

    A table is columnar and survives lost executors like a checkpoint does. It is
    preferred to `checkpoint()` in loops, because a checkpointed frame carries the
    optimizer's constraints of its plan along, and they double with every round.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage_and_shuffles(df):
    """As `cut_lineage`; the shuffle files of the job go with its end, not when the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO, None)
    conf.set(SHUFFLES_GO, "true")
    try:
        return cut_lineage(df)
    finally:
        conf.unset(SHUFFLES_GO) if before is None else conf.set(SHUFFLES_GO, before)


def drop_stored(table):
    """Delete the folder of a table from `cut_lineage` that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
