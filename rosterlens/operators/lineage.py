"""Cut the lineage of a table by writing it to the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut_lineage(table: DataFrame) -> DataFrame:
    """Write the table once and go on from the written copy.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder of its own.
    """
    spark = table.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="rosterlens-")
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(folder)
    return table.checkpoint()
