"""Helpers shared by the operators: scratch tables in the shared folder, Arrow batch size, table reads."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.session import checkpoint_root

#: Rows per Arrow batch.  A row is a whole document, so the default of 10,000 would hold hundreds of MB.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once (a smaller setting of the session stays) and let workers
    import this package from where the driver has it; a cluster may ship it with --py-files instead."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder named in ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/levain-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_field(df: DataFrame, id_col: str) -> str:
    """``id_col`` with its type, for a Python function's result schema."""
    return f"`{id_col}` {df.schema[id_col].dataType.simpleString()}"


def texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text (null: empty), so that no other column can clash."""
    return df.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
