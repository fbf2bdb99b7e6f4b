"""A stated query set against all rows, in blocks: what the vector searches share.

Vectors and queries are dealt to blocks of bounded size by a hash of their row's number.  A task gets one
block of queries and one block of vectors, so no side is ever whole in one place; the best of each
query in each block meet in a partitioned top-k.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levain.llm.common import prepare, written

#: Rows of a block of vectors and of a block of queries.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 1024


def valid(df: DataFrame, id_col: str, vec_col: str, *more: Column) -> DataFrame:
    """(vec_id, v, *more): rows with an id whose vector is not null and has only finite components, as doubles."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), *more)


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number of its own for each (``row``), stored, so that it stays the same however often they are read."""
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def apart(rows: DataFrame) -> DataFrame:
    """``rows`` with columns of its own, for a plan in which the table meets itself."""
    return rows.select(*(F.col(c).alias(c) for c in rows.columns))


def dealt(by: str, blocks: int, seed: int = 42) -> Column:
    """A block from 0 for each value of ``by``."""
    return F.pmod(F.xxhash64(by, F.lit(seed)), F.lit(blocks)).cast("int")


def search(vectors: DataFrame, queries: DataFrame, run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], score_type: str, k: int,
           vector_block: int = VECTOR_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the k best of what ``run(vectors, queries)`` returns
    as (query_row, query_id, vec_id, score) for each pair of blocks; higher scores first, ties to smaller vec_id.
    Both tables are ``numbered``; rows that share an id are rows like others, as vectors and as queries."""
    prepare(vectors.sparkSession)
    n, q = vectors.count(), queries.count()
    across, down = max(1, math.ceil(n / vector_block)), max(1, math.ceil(q / query_block))
    left = vectors.withColumn("vb", dealt("row", across)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    right = apart(queries).withColumn("qb", dealt("row", down, 1)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    nothing = pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
    found = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInPandas(
        lambda a, b: run(a, b) if len(a) and len(b) else nothing, f"query_row long, query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
