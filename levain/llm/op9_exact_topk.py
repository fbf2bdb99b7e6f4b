"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are documents, their places terms and the integers there term weights.  A block (see
``blocks``) sorts its vectors by id and parts them into ranges of RANGE documents; each range keeps
its forward index (the weights of its documents) and the largest and smallest weight of each term.
For a query the sum over its terms of weight times that extreme is a bound on every score in the
range.  Each query takes its ranges by falling bound, first one, then two, four and so on; a range
is scored through its forward index, and a query stops when the next bound falls below its k-th score
so far.  (Equal bounds go on, as ties go to smaller ids.)

Scores are exact: sums that fit 53 bits are formed in double precision, else in Python integers;
a score beyond a 64-bit integer is given as the nearest one.

Cases.  Vectors that are null or hold null or non-finite components take no part, as queries
either; an empty vector has score 0 with all.  Shorter vectors count as padded with zeros.  Rows
that share an id are rows like others: each is a candidate of the others, and each that is a query gets its own k.
A query with fewer than k others gets all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levain.llm.blocks import numbered, search, valid
from levain.llm.op3_one_bit import stack

#: Documents in a range.
RANGE = 128


def _top(have_s: np.ndarray, have_i: np.ndarray, s: np.ndarray, i: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row of two lists, by falling score, then id."""
    s, i = np.concatenate([have_s, s], axis=1), np.concatenate([have_i, i], axis=1)
    if s.shape[1] > 4 * k:  # all that can be among the k best: those not below the k-th score
        least = -np.partition(-s, k - 1, axis=1)[:, k - 1:k]
        width = int((s >= least).sum(axis=1).max())
        near = np.argsort(-s, axis=1, kind="stable")[:, :width]
        s, i = np.take_along_axis(s, near, 1), np.take_along_axis(i, near, 1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def best_in_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, dims: int) -> pd.DataFrame:
    """The k highest scores of each query within one block."""
    ids, qids = vectors["vec_id"].to_numpy("int64"), queries["vec_id"].to_numpy("int64")
    order = np.argsort(ids, kind="stable")
    rows_, own = vectors["row"].to_numpy("int64")[order], queries["row"].to_numpy("int64")
    ids, x, q = ids[order], stack(vectors["v"], dims)[order], stack(queries["v"], dims)
    if dims * max(1.0, np.abs(x).max(initial=0)) * max(1.0, np.abs(q).max(initial=0)) >= 2.0**53:
        x, q = (np.vectorize(int, otypes=[object])(a) for a in (x, q))
    starts = np.arange(0, len(ids), RANGE)
    high, low = np.maximum.reduceat(x, starts), np.minimum.reduceat(x, starts)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    never = -np.inf if x.dtype != object else -float("inf")
    top_s, top_i = np.full((len(q), k), never, x.dtype), np.full((len(q), k), np.iinfo("int64").max)
    by_bound = np.argsort(-bounds, axis=1, kind="stable")
    at, width = 0, 1
    while at < len(starts):
        turn = by_bound[:, at:at + width]
        open_ = np.take_along_axis(bounds, turn, 1) >= top_s[:, -1:]
        rows, cols = np.nonzero(open_)
        if not len(rows):
            break  # bounds fall: none of the later ranges is open either
        ranges = turn[rows, cols]
        for r in np.unique(ranges):
            who = rows[ranges == r]
            part = slice(starts[r], starts[r] + RANGE)
            score = q[who] @ x[part].T
            score[own[who, None] == rows_[part]] = never
            beats = np.flatnonzero((score >= top_s[who, -1:]).any(axis=1))
            if len(beats):
                top_s[who[beats]], top_i[who[beats]] = _top(top_s[who[beats]], top_i[who[beats]], score[beats], np.broadcast_to(ids[part], (len(beats), len(ids[part]))), k)
        at, width = at + width, 2 * width
    found = top_s > never
    lim = np.iinfo("int64")
    score = [min(max(int(s), lim.min), lim.max) for s in top_s[found]] if x.dtype == object else top_s[found].astype("int64")
    of = np.nonzero(found)[0]
    return pd.DataFrame({"query_row": own[of], "query_id": qids[of], "vec_id": top_i[found], "score": np.array(score, "int64")})


def top(df: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products, over the integers floor(scale * x),
    of each row that ``queries`` (a condition on ``vec_id``) picks, with every other row."""
    rows = valid(df, id_col, vec_col)
    rows = numbered(rows.withColumn("v", F.transform("v", lambda x: _floor(x * scale))))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    return search(rows, rows.filter(queries), lambda a, b: best_in_block(a, b, k, dims), "long", k)


def _floor(x: Column) -> Column:
    """floor of a double as a double, also beyond 64-bit integers (where every double is whole)."""
    most = 1.7976931348623157e308
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(F.greatest(F.lit(-most), F.least(F.lit(most), x)))
