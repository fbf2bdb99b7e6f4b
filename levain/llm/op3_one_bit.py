"""Approximate nearest neighbours by randomly rotated one-bit codes.

Index.  A vector is scaled to length 1, padded with zeros to ``bits`` places (at least 512, a
multiple of 64, not below the vectors' own dimension) and turned by a fixed random rotation; the
code is the sign bit of each place, packed.  Two scalars go with it: the inner product c of the turned vector
with the unit vector that its bits stand for, and the vector's length.

Estimate.  With s the inner product of a turned query and the code's unit vector, s / c is an unbiased
estimate of the cosine; its error is within  EPSILON * sqrt((1 - c^2) / c^2 / (bits - 1))  except
with a probability that falls like exp(-EPSILON^2 / 2).

Search.  Every vector is coded and every code is scored for every query, block by block (see
``blocks``).  In a block the k best estimates are scored exactly; then every vector whose estimate plus error
bound reaches the k-th exact score is reranked on the original vectors in double precision.

Cases.  Vectors that are null, empty, zero, or hold null or non-finite components take no part,
as queries either.  Shorter vectors count as padded with zeros.  Rows that share an id are
rows like others.  Ties go to the smaller id.  A query with fewer than k others gets all.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levain.llm.blocks import numbered, search, valid

#: Code length at least, and the error bound in standard errors.
BITS, EPSILON, SEED = 512, 2.6, 20


@lru_cache(maxsize=2)
def rotation(dims: int, bits: int, seed: int = SEED) -> np.ndarray:
    """The first ``dims`` rows of a random rotation of ``bits`` places (the others meet only zeros)."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))
    return (q * np.sign(np.diag(r))).T.copy()


def stack(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for n, v in enumerate(rows):
        out[n, :len(v)] = v
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by the largest component first so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed codes and correction scalars c of the unit rows ``x``."""
    turned = x @ rotation(x.shape[1], bits)
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(bits)


def estimates(queries: np.ndarray, codes: np.ndarray, c: np.ndarray, bits: int) -> np.ndarray:
    """Estimated cosines of unit queries (rows) and coded vectors (columns)."""
    turned = (queries @ rotation(queries.shape[1], bits)).astype("float32")
    total = turned.sum(axis=1, keepdims=True)
    out = np.empty((len(queries), len(codes)), "float32")
    for at in range(0, len(codes), 1024):  # <turned, signs> = 2 <turned, bits> - sum
        out[:, at:at + 1024] = turned @ np.unpackbits(codes[at:at + 1024], axis=1, count=bits).T.astype("float32")
    return (2 * out - total) / (np.sqrt(bits) * c).astype("float32")


def error_bound(c: np.ndarray, bits: int, epsilon: float = EPSILON) -> np.ndarray:
    return epsilon * np.sqrt(np.maximum(0, 1 - c * c) / (c * c) / (bits - 1))


def nearest_in_block(vectors: pd.DataFrame, queries: pd.DataFrame, k: int, dims: int, bits: int, epsilon: float) -> pd.DataFrame:
    """The k nearest of each query within one block, by estimate, bound and exact rerank."""
    ids, qids = vectors["vec_id"].to_numpy("int64"), queries["vec_id"].to_numpy("int64")
    order = np.argsort(ids, kind="stable")  # ties in a stable sort then go to the smaller id
    rows, own = vectors["row"].to_numpy("int64")[order], queries["row"].to_numpy("int64")
    ids, x, q = ids[order], unit(stack(vectors["v"], dims))[order], unit(stack(queries["v"], dims))
    codes, c = encode(x, bits)
    bound, out = error_bound(c, bits, epsilon).astype("float32"), []
    for at in range(0, len(q), 128):
        high = estimates(q[at:at + 128], codes, c, bits)
        high[own[at:at + 128, None] == rows] = -np.inf
        for n, est in enumerate(high, at):
            first = np.argpartition(-est, min(k, len(est) - 1))[:k]
            first = first[est[first] > -np.inf]
            least = np.sort(x[first] @ q[n])[0] if len(first) >= k else -np.inf
            near = np.flatnonzero((est + bound >= least) & (est > -np.inf))
            score = (x[near] * q[n]).sum(axis=1)
            best = np.argsort(-score, kind="stable")[:k]
            out.append((np.full(len(best), own[n]), np.full(len(best), qids[n]), ids[near[best]], score[best]))
    return pd.DataFrame({name: np.concatenate(part) for name, part in zip(("query_row", "query_id", "vec_id", "score"), zip(*out, strict=True), strict=True)})


def nearest(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", bits: int = BITS, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest others, by cosine, of each row that ``queries`` (a condition on ``vec_id``) picks."""
    rows = numbered(valid(df, id_col, vec_col).filter(F.exists("v", lambda x: x != 0)))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 1
    places = max(bits, -(-dims // 64) * 64)
    return search(rows, rows.filter(queries), lambda a, b: nearest_in_block(a, b, k, dims, places, epsilon), "double", k)
