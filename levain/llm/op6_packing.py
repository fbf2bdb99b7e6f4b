"""Packing into optimal length buckets.

Method.  The histogram of lengths over all rows goes to a dynamic program that chooses at most ``buckets``
upper bounds so that padding every row to its bucket's bound wastes the fewest tokens.  Each bucket's rows
then form batches of as many rows as the token budget holds at the bucket's bound (one at least).

Histogram.  Every length has a bin of its own, so the bounds are optimal; there are at most as many bins as the longest text
has tokens, whatever the number of rows.

Batches.  A bucket is dealt by a hash of the id and the row's place in the stored table (so a hot id is spread) to shards of about SHARD_ROWS rows and SHARD_TOKENS padded tokens
at most; each shard numbers its rows and fills batches; only a shard's last batch can be short.  So no bucket is in one task.

Cases.  A null length counts as 0; a null or empty text has length 0.  A row longer than the budget
is a batch of its own.  Null ids and repeated rows are packed like others (ties among equal rows are
open, their rows being equal).  Columns with the result's names are replaced.  An empty table gives an empty
result.  Very long texts are whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levain.llm.common import prepare, written
from levain.llm.tokens import default_path, encoder

BUCKETS, BUDGET = 16, 65536
SHARD_ROWS, SHARD_TOKENS = 32768, 1 << 24
#: Runs that a worker's encoder keeps; fewer than elsewhere, as packing follows stages that hold caches of their own.
CACHE_RUNS = 200_000


def token_counts(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] | None = None, tokenizer_path: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``n_tokens``, the number of ids of the whole text."""
    prepare(docs.sparkSession)
    path = tokenizer_path or default_path()
    names = [c for c in (docs.columns if keep is None else keep) if c != "n_tokens"]
    own = text_col in names and docs.schema[text_col].dataType.simpleString() == "string"  # then the text travels once
    text = text_col if own else "__text"
    rows = docs.select(*names) if own else docs.select(*names, F.col(text_col).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, CACHE_RUNS)
        for x in batches:
            n = np.diff(enc.flat([t or "" for t in x.column(text).to_pylist()])[1])
            yield pa.record_batch([*(x.column(c) for c in names), pa.array(n, pa.int64())], [*names, "n_tokens"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return rows.mapInArrow(run, f"{fields}{', ' * bool(names)}n_tokens long")


def histogram(rows: DataFrame, length_col: str = "n_tokens") -> list[tuple[int, int]]:
    """(length, rows) of each length, rising."""
    n = F.coalesce(F.col(length_col).cast("long"), F.lit(0))
    found = rows.groupBy(n.alias("n")).agg(F.count("*").alias("rows"))
    return sorted((r["n"], r["rows"]) for r in found.collect())  # bounded by the longest text


def best_bounds(bins: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """The bounds, at most ``buckets``, with the fewest padded tokens: least sum of bound times rows.
    The best first bin of the last bucket rises with the last bin, so halving finds all in n log n steps."""
    if not bins:
        return []
    top, rows = np.array([b for b, _ in bins], "float64"), np.cumsum([0, *(n for _, n in bins)]).astype("float64")
    n = len(bins)
    cost, back = top * rows[1:], []
    for _ in range(1, min(buckets, n)):
        new, first = np.empty(n), np.zeros(n, int)
        lo, hi, a, b = (np.array([v]) for v in (0, n - 1, 0, n - 1))
        while len(lo):  # the middles of all open spans at once
            mid = (lo + hi) // 2
            size = np.minimum(mid, b) - a + 1
            span = np.repeat(np.arange(len(lo)), size)
            start = np.arange(len(span)) - np.repeat(size.cumsum() - size, size) + a[span]  # the last bucket holds the bins start..mid
            total = np.where(start > 0, cost[start - 1], 0) + top[mid][span] * (rows[mid + 1][span] - rows[start])
            least = np.minimum.reduceat(total, size.cumsum() - size)
            hit = np.flatnonzero(total == least[span])
            best = start[hit[np.unique(span[hit], return_index=True)[1]]]
            new[mid], first[mid] = least, best
            lo, hi, a, b = (np.concatenate(pair) for pair in ((lo, mid + 1), (mid - 1, hi), (a, best), (best, b)))
            lo, hi, a, b = (v[keep] for keep in [lo <= hi] for v in (lo, hi, a, b))
        cost = new
        back.append(first)
    bounds, at = [int(top[-1])], n - 1
    for first in reversed(back):
        at = first[at] - 1
        if at < 0:
            break
        bounds.append(int(top[at]))
    return bounds[::-1]


def pack(rows: DataFrame, id_col: str = "doc_id", length_col: str = "n_tokens", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``rows`` with ``bucket`` (from 0), ``padded`` (the bucket's bound), ``batch`` (a name) and ``batch_row`` (from 0).
    ``rows`` is read twice, so give a stored table."""
    bins = histogram(rows, length_col)
    bounds = best_bounds(bins, buckets) or [0]
    held = np.zeros(len(bounds), "int64")
    np.add.at(held, np.searchsorted(bounds, [b for b, _ in bins]), [n for _, n in bins])
    per_batch = [max(1, budget // max(1, b)) for b in bounds]
    shards = [max(1, math.ceil(max(n / SHARD_ROWS, n * b / SHARD_TOKENS))) for n, b in zip(held.tolist(), bounds, strict=True)]

    def of(values: list[int]) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("bucket") + 1)

    n = F.coalesce(F.col(length_col).cast("long"), F.lit(0))
    dealt = rows.drop("bucket", "padded", "batch", "batch_row").withColumn("bucket", F.size(F.filter(F.array(*(F.lit(b).cast("long") for b in bounds)), lambda b: b < n)))
    dealt = dealt.withColumn("padded", of(bounds).cast("long")).withColumn("__key", F.xxhash64(id_col, F.monotonically_increasing_id())).withColumn("__shard", F.pmod("__key", of(shards).cast("long")))
    order = Window.partitionBy("bucket", "__shard").orderBy("__key")
    dealt = dealt.withColumn("__n", F.row_number().over(order) - 1).withColumn("__size", of(per_batch))
    batch = F.concat_ws("-", "bucket", "__shard", F.floor(F.col("__n") / F.col("__size")))
    return dealt.withColumn("batch", batch).withColumn("batch_row", F.col("__n") % F.col("__size")).drop("__key", "__shard", "__n", "__size")


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``docs`` (its columns ``keep``, or all) with token counts and batches."""
    return pack(written(token_counts(docs, text_col, keep), "lengths"), id_col, "n_tokens", buckets, budget)
