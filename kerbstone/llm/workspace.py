"""Shared-folder tables and bounded Arrow batches used by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows and bytes that an Arrow batch may hold on its way to a Python worker at most; texts may be long.
BATCH_ROWS, BATCH_BYTES = 1000, 64 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's bounds of an Arrow batch, so that a Python worker's memory does not depend on the table.

    Frames are lazy and read the bounds when they run, so the bounds stay; they are never raised.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a local master takes one of its own and a cluster raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = known.get() if known.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        root = tempfile.mkdtemp(prefix="kerbstone-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def unused(columns: list[str], *names: str) -> list[str]:
    """The ``names``, each with as many underscores before it as it takes to be none of the ``columns`` (in any case of letters)."""
    known, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in known:
            name = "_" + name
        known.add(name.lower())
        out.append(name)
    return out


def materialise(spark: SparkSession, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it again: lineage ends there, executors can be lost.

    The table goes when the application ends. An empty frame gives an empty table of the same schema.
    """
    path = f"{shared_root(spark)}/kerbstone/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the shared folder (never ``localCheckpoint``)."""
    shared_root(spark)
    return df.checkpoint(eager=True)
