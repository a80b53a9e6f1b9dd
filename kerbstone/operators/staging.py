"""Cutting lineage in the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def staged(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the folder that ``spark.checkpoint.dir`` names.

    Where none is set, a local master takes a folder of its own; a cluster, whose machines share none, raises.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kerbstone-"))
    return df.checkpoint()
