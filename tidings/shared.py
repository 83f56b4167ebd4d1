"""The shared folder of a job: where intermediate results survive the loss of an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints, else one below its warehouse.

    Both are reached by the driver and by every executor; a temporary folder of a machine is not.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    return (named or f"{spark.conf.get(WAREHOUSE_SETTING).rstrip('/')}/_shared").rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path not used before, below :func:`shared_folder`."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """A small ``df`` computed once and reread from a reliable checkpoint.

    Its rows are packed into as few files as their size asks for.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.hint("rebalance").checkpoint(eager=True)
