"""Hard-negative mining by the threshold algorithm over per-dimension sorted lists.

For each anchor: its ``positives`` are the first rows of its own label by falling integer inner product,
and for each positive the hard negatives are the first rows of other labels whose score lies between ``low`` and
``high`` hundredths of the positive's score (a window).

Method.  Rows are dealt to blocks of bounded size.  A block keeps, for each dimension, its rows sorted by that
component.  An anchor reads every list from the end its own component's sign prefers (sorted access), all lists equally
deep; a row seen for the first time is scored whole with integers (random access).  The sum over
dimensions of anchor component times the component last read is a bound on the score of every row not seen
yet.  An anchor stops once that threshold is strictly below the k-th score of each of its windows (below a
window's lower end where it is not full), since then no unseen row can enter or tie.  The first of each
window in each block meet in a partitioned top-k.

Two passes: positives meet only blocks of their own label, then the windows meet all blocks.

Integers.  Components become floor(scale * x).  Scores are exact: sums within 53 bits are formed in double precision, else
in Python integers; a score beyond a 64-bit integer is given as the nearest one (windows use the exact score).

Cases.  Rows with a null id, null label, null vector or a null or non-finite component take no part.
Shorter vectors count as padded with zeros; an empty vector scores 0 with all.  Rows that share an id are rows like
others: only an anchor's own row is left out of its positives, and each row that is an anchor gets its own
result.  Ties go to smaller ids.  An anchor without positives, and a window without rows (always so for a
negative positive score), give no rows.  An empty table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levain.llm.blocks import QUERY_BLOCK, VECTOR_BLOCK, apart, dealt, numbered, valid
from levain.llm.common import prepare, written
from levain.llm.op3_one_bit import stack
from levain.llm.op9_exact_topk import _floor

#: Rows read from each list in the first step; every step doubles the depth.
FIRST_DEPTH = 16
FOUND = "anchor_row long, place int, vec_id long, score long, exact string"
NOTHING = pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")}, dtype="object")


class SortedLists:
    """The rows of a block with, for each dimension, their order by that component."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids, self.order = x, ids, np.argsort(x, axis=0, kind="stable")
        self.read = 0  # rows scored so far, over all searches

    def first(self, q: np.ndarray, windows: list[tuple[int | None, int | None]], k: int, may: np.ndarray) -> list[list[tuple[int, int]]]:
        """For each window (lower and upper end of the score, None for open), the first ``k`` (score, row) among the rows that ``may`` be taken."""
        n, dims = len(self.x), np.flatnonzero(q != 0)
        down = q[dims] > 0
        seen, kept = np.zeros(n, bool), [(np.empty(0, self.x.dtype), np.empty(0, int))] * len(windows)
        before, depth = 0, FIRST_DEPTH if len(dims) else n
        while before < n:
            depth = min(depth, n)
            fresh = np.zeros(n, bool)
            if len(dims):  # sorted access, signed: the largest components first for positive places, the smallest for negative ones
                fresh[self.order[n - depth:n - before, dims[down]]] = True
                fresh[self.order[before:depth, dims[~down]]] = True
            else:
                fresh[:] = True
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            self.read += len(new)
            score = self.x[new] @ q  # random access
            bound = sum(int(q[d]) * int(self.x[self.order[n - depth if up else depth - 1, d], d]) for d, up in zip(dims, down, strict=True))
            done = True
            for at, (low, high) in enumerate(windows):
                fits = may[new]
                if low is not None:
                    fits = fits & (score >= low)
                if high is not None:
                    fits = fits & (score <= high)
                s, r = np.concatenate([kept[at][0], score[fits]]), np.concatenate([kept[at][1], new[fits]])
                if len(s) > k:
                    least = -np.partition(-s, k - 1)[k - 1]
                    near = np.flatnonzero(s >= least)
                    near = near[np.lexsort((self.ids[r[near]], -s[near]))][:k]
                    s, r = s[near], r[near]
                kept[at] = s, r
                floor = int(s.min()) if len(s) >= k else low
                done = done and floor is not None and bound < floor
            if done or seen.all():
                break
            before, depth = depth, 2 * depth
        return [[(int(s), int(r)) for s, r in zip(*part, strict=True)] for part in kept]


def _exact(x: np.ndarray, q: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Both as they are where every inner product fits a double, else as Python integers."""
    if dims * max(1.0, np.abs(x).max(initial=0)) * max(1.0, np.abs(q).max(initial=0)) >= 2.0**53:
        return tuple(np.vectorize(int, otypes=[object])(a) for a in (x, q))
    return x, q


def best_in_block(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, dims: int, low: int, high: int) -> pd.DataFrame:
    """What each anchor finds in one block: rows of its own label, or, where the anchors come with positives, the rows of each window."""
    windows = "positives" in anchors.columns
    x, q = _exact(stack(rows["v"], dims), stack(anchors["v"], dims), dims)
    lists = SortedLists(x, rows["vec_id"].to_numpy("int64"))
    label, number = rows["label"].to_numpy(), rows["row"].to_numpy("int64")
    out = []
    for n, a in enumerate(anchors.itertuples()):
        if windows:
            wanted = [(p, -(-low * s // 100), high * s // 100) for p, s in ((int(p["rank"]), int(p["exact"])) for p in a.positives)]
            wanted = [w for w in wanted if w[1] <= w[2]]
            may = label != a.label
        else:
            wanted, may = [(0, None, None)], (label == a.label) & (number != a.row)
        found = lists.first(q[n], [w[1:] for w in wanted], k, may) if wanted and may.any() else []
        out += [(a.row, w[0], lists.ids[r], s) for w, part in zip(wanted, found, strict=False) for s, r in part]
    lim = np.iinfo("int64")
    return pd.DataFrame([(r, p, i, min(max(s, lim.min), lim.max), str(s)) for r, p, i, s in out], columns=list(NOTHING)) if out else NOTHING


def _meet(rows: DataFrame, anchors: DataFrame, keys: list[str], run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """``run`` on every block of rows and block of anchors with equal ``keys``."""
    return rows.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInPandas(lambda a, b: run(a, b) if len(a) and len(b) else NOTHING, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_row", "place").orderBy(F.col("exact").cast("double").desc(), F.col("exact").try_cast("decimal(38,0)").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(df: DataFrame, anchors: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: float = 256.0,
         id_col: str = "vec_id", vec_col: str = "embedding", row_block: int = VECTOR_BLOCK, anchor_block: int = QUERY_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` (a condition on ``vec_id``) picks."""
    prepare(df.sparkSession)
    rows = valid(df, id_col, vec_col, label.cast("long").alias("label")).filter("label IS NOT NULL")
    rows = numbered(rows.withColumn("v", F.transform("v", lambda x: _floor(x * scale))))
    size = rows.agg(F.max(F.size("v")), F.count("*"), F.count_if(anchors)).first()
    dims, across, down = size[0] or 1, max(1, math.ceil(size[1] / row_block)), max(1, math.ceil(size[2] / anchor_block))
    picked = apart(rows.filter(anchors))

    # positives: blocks within a label, as many as its rows need
    held = rows.groupBy("label").agg(F.ceil(F.count("*") / row_block).cast("int").alias("of_rows"), F.greatest(F.lit(1), F.ceil(F.count_if(anchors) / anchor_block)).cast("int").alias("of_anchors"))
    place = lambda of, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    left = rows.join(held, "label").withColumn("rb", place("of_rows", 2)).withColumn("ab", every("of_anchors")).drop("of_rows", "of_anchors")
    right = picked.join(held, "label").withColumn("ab", place("of_anchors", 3)).withColumn("rb", every("of_rows")).drop("of_rows", "of_anchors")
    near = _first(_meet(left, right, ["label", "rb", "ab"], lambda a, b: best_in_block(a, b, positives, dims, low, high)), positives)
    near = written(near.select(F.col("anchor_row").alias("row"), "rank", "vec_id", "score", "exact"), "positives")

    # negatives: every block of rows against every block of anchors
    of_anchor = near.groupBy("row").agg(F.collect_list(F.struct("rank", "exact")).alias("positives"))  # ``positives`` at most
    left = rows.withColumn("rb", dealt("row", across)).withColumn("ab", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    right = picked.join(of_anchor, "row").withColumn("ab", dealt("row", down, 1)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    found = _first(_meet(left, right, ["rb", "ab"], lambda a, b: best_in_block(a, b, negatives, dims, low, high)), negatives)

    pairs = near.select(F.col("row").alias("anchor_row"), F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = found.select("anchor_row", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = picked.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return found.join(pairs, ["anchor_row", "place"]).join(names, "anchor_row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
