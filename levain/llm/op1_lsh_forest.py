"""N-gram Jaccard join by a MinHash LSH forest and exact verification.

A document's features are its shingles: every WORDS consecutive words (lower case, parted by white space);
a shorter text that has words has one shingle of all of them.  Two documents are linked if the
Jaccard similarity of their shingle sets is at least THRESHOLD.

Method.
1.  Copies (equal word sequences) meet by a 128-bit fingerprint; one representative goes on.
2.  A signature has TREES times DEPTH minima of random hash functions.  Each tree sorts the documents by
    its DEPTH values as a prefix trie; documents that share a prefix of the present length are
    candidates.
3.  The trie groups are joined to clusters (connected components, by ids only), so that a document's
    shingles travel once and not once a tree.  Clusters are cut into tiles of bounded documents
    and shingles; a task compares two tiles and computes every similarity exactly, from sets of 64-bit
    shingle hashes.
4.  The found links tell the recall: a pair of similarity s shares a prefix of length d in some tree with
    probability p = 1 - (1 - s^d)^TREES, so each found link stands for 1 / p links.  While found / estimated
    is under TARGET, the prefixes are shortened by one and the groups formed anew.
5.  Classes are the connected components of the links.

Only ids, fingerprints and signatures of all documents are shuffled; texts are read a second time
and give shingles only where a fixed-size Bloom filter of candidates says so (a false positive costs
a row in a join).  Groups of near copies of any size end in tiles: nothing lists their pairs.

Cases.  Null and empty texts, and those of white space only, have no shingles: no links, a class of
their own.  Rows with a null id are in classes but name none (class_id is the smallest non-null id; null if there
is none).  Repeated rows are copies of each other.  Other columns are not read.  Ties do not arise:
a class is named by its smallest id.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levain.llm.common import id_field, prepare, texts, written
from levain.llm.components import components

WORDS, THRESHOLD = 5, 0.8
TREES, DEPTH, TARGET = 20, 7, 0.995
#: A tile holds at most about so many documents and shingles.
TILE_DOCS, TILE_SHINGLES = 512, 2_000_000
#: Bits of the Bloom filter of candidates: 2**25 are 4 MB.
BLOOM_BITS = 25
_RNG = np.random.default_rng(1)
_XOR = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32)
_ODD = _RNG.integers(0, 2**32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)
_POLY = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 60_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def words(text: str) -> list[str]:
    return text.lower().split()


def key(found: list[str]) -> bytes:
    """The fingerprint of a word sequence."""
    return hashlib.blake2b(" ".join(found).encode(), digest_size=16).digest()


def shingles(batch: list[list[str]], n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit shingle hashes of each word list (none empty), one after the other, and where each starts."""
    size = np.array([len(w) for w in batch], "int64")
    flat = np.concatenate([np.fromiter(map(_HASHES.__getitem__, w), "uint64", len(w)) for w in batch])
    start = np.cumsum(size) - size
    with np.errstate(over="ignore"):
        h = flat * _POLY
        for k in range(1, n):
            h[:-k or None] += flat[k:]
            h = h * _POLY if k < n - 1 else h
        for short in np.flatnonzero(size < n):
            at, x = start[short], np.uint64(size[short])
            for w in flat[at:at + size[short]]:
                x = x * _POLY + w
            h[at] = x
        keep = np.ones(len(flat), bool)
        for k in range(1, n):
            keep[(start + size - k)[size >= k]] = False
        keep[start[size < n]] = True
        h = h[keep]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    count = np.maximum(size - n + 1, 1)
    return h, np.cumsum(count) - count


def signatures(h: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A row of TREES * DEPTH minima for each set of shingles."""
    low, out = (h >> np.uint64(32)).astype("uint32"), np.empty((len(start), len(_XOR)), "uint32")
    for k, (x, a) in enumerate(zip(_XOR, _ODD, strict=True)):
        out[:, k] = np.minimum.reduceat((low ^ x) * a, start)
    return out


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, sig) of each row; both null where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            each = [words(t) for t in x.column(1).to_pylist()]
            some = [w for w in each if w]
            sig = iter(signatures(*shingles(some)).view("int32") if some else ())
            yield pa.record_batch([x.column(0), pa.array([key(w) if w else None for w in each], pa.binary()), pa.array([next(sig) if w else None for w in each], pa.list_(pa.int32()))], ["id", "key", "sig"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, key binary, sig array<int>")


def _bit(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), "<u4").reshape(-1, 4) & np.uint32(2**BLOOM_BITS - 1)


def candidate_filter(nodes: DataFrame) -> np.ndarray:
    """The Bloom filter of the keys in ``nodes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            bit = np.unique(_bit(x.column(0).to_pylist()))
            yield pa.record_batch([pa.array((bit >> 5).astype("int64")), pa.array(np.int64(1) << (bit & 31).astype("int64"))], ["w", "b"])

    got = nodes.select("node").mapInArrow(run, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()  # at most 2**(BLOOM_BITS - 5) rows
    out = np.zeros(2 ** (BLOOM_BITS - 5), "<u4")
    out[got["w"].to_numpy("int64")] = got["b"].to_numpy("int64").astype("<u4")
    return out.view("uint8")


def features(docs: DataFrame, text_col: str, nodes: DataFrame) -> DataFrame:
    """(key, n, set): the sorted shingle set of each candidate, and of some others."""
    bloom = docs.sparkSession.sparkContext.broadcast(candidate_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            each = [w for w in map(words, x.column(0).to_pylist()) if w]
            keys = [key(w) for w in each]
            bit = _bit(keys)
            seen = ((bloom.value[bit >> 3] >> (bit & 7).astype("uint8")) & 1).all(axis=1)
            some = {k: w for k, w, s in zip(keys, each, seen, strict=True) if s}
            h, start = shingles(list(some.values())) if some else (np.empty(0, "uint64"), np.empty(0, "int64"))
            sets = [np.unique(s) for s in np.split(h, start[1:])] if some else []
            yield pa.record_batch([pa.array(list(some), pa.binary()), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "n", "set"])

    return texts(docs, text_col, text_col).select("__text").mapInArrow(run, "key binary, n int, set binary")


def overlaps(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of each of the first ``split`` sets with each other set."""
    which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, name, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    some = shared[name]
    col, row = place[name[some]], which[some]
    out, step = np.zeros((split, len(sets)), "float32"), 4096
    order = np.argsort(col, kind="stable")
    col, row = col[order], row[order]
    for at in range(0, int(shared.sum()), step):
        i, j = np.searchsorted(col, (at, at + step))
        dense = np.zeros((len(sets), step), "float32")
        dense[row[i:j], col[i:j] - at] = 1
        out += dense[:split] @ dense.T
    return out.astype("int64")


def compare(keys: list[bytes], blocks: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], pair: tuple[int, int], depth: int, num: int, den: int) -> list[tuple]:
    """Rows (key, label, links, found, estimated) of one pair of tiles; similarity at least num / den."""
    order = sorted(range(len(keys)), key=lambda n: (blocks[n], keys[n]))
    keys, copies, sets = [keys[n] for n in order], copies[order], [sets[n] for n in order]
    split = len(keys) if pair[0] == pair[1] else int((blocks == pair[0]).sum())
    if split == 0 or len(keys) < 2:
        return []
    both, size = overlaps(sets, split), np.array([len(s) for s in sets])
    union = size[:split, None] + size - both
    link = both * den >= union * num
    if pair[0] == pair[1]:
        np.fill_diagonal(link, False)
    else:
        link[:, :split] = False
    a, b = np.nonzero(link)
    if not len(a):
        return []
    p = 1 - (1 - (both[a, b] / union[a, b]) ** depth) ** TREES
    half = 0.5 if pair[0] == pair[1] else 1.0
    label = np.arange(len(keys))
    while True:  # the smallest member of each component of the tiles' links
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    links = np.zeros(len(keys), "int64")
    np.add.at(links, a, copies[b])
    if half == 1.0:
        np.add.at(links, b, copies[a])
    found, estimated = np.bincount(a, minlength=len(keys)) * half, np.bincount(a, 1 / p, len(keys)) * half
    return [(keys[n], keys[label[n]], int(links[n]), float(found[n]), float(estimated[n])) for n in np.flatnonzero(links)]


def tiles(docs: DataFrame, text_col: str, clusters: DataFrame, copies: DataFrame, depth: int, threshold: float) -> DataFrame:
    """(key, label, links, found, estimated) for each key that has links in a pair of tiles."""
    num, den = round(threshold * 10_000), 10_000
    sets = features(docs, text_col, clusters).groupBy("key").agg(F.first("n").alias("n"), F.first("set").alias("set"))
    rows = clusters.withColumnRenamed("node", "key").join(copies, "key").join(sets, "key")
    sized = clusters.withColumnRenamed("node", "key").join(sets.select("key", "n"), "key").groupBy("label").agg(F.count("*").alias("g"), F.sum("n").alias("t"))
    parts = sized.select("label", F.ceil(F.greatest(F.col("g") / TILE_DOCS, F.col("t") / TILE_SHINGLES)).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    dealt = rows.join(parts, "label").withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select(F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "key", "block", "copies", "set")
    dealt = dealt.repartition("unit").sortWithinPartitions("unit", "label", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []

        def done() -> pa.RecordBatch:
            out = compare([h[0] for h in held], np.array([h[1] for h in held]), np.array([h[2] for h in held]), [np.frombuffer(h[3], "uint64") for h in held], unit[1:], depth, num, den) if len(held) > 1 else []
            cols = list(zip(*out, strict=True)) or [()] * 5
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64(), pa.float64(), pa.float64()), strict=True)], ["key", "label", "links", "found", "estimated"])

        for x in batches:
            cols = [x.column(c).to_pylist() for c in ("label", "i", "j", "key", "block", "copies", "set")]
            for label, i, j, *rest in zip(*cols, strict=True):
                if (label, i, j) != unit:
                    if held:
                        yield done()
                    unit, held = (label, i, j), []
                held.append(rest)
        if held:
            yield done()

    return dealt.drop("unit").mapInArrow(run, "key binary, label binary, links long, found double, estimated double")


def candidates(nodes: DataFrame, depth: int) -> DataFrame:
    """(u, v): each node with the smallest node of every trie group of two or more that holds it."""
    prefix = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(t, F.slice("sig", t * DEPTH + 1, depth)))
    rows = nodes.select("key", F.explode(prefix).alias("prefix"))
    groups = rows.groupBy("prefix").agg(F.min("key").alias("v"), F.count("*").alias("n")).filter("n > 1").select("prefix", "v")
    return rows.join(groups, "prefix").select(F.col("key").alias("u"), "v").filter("u != v").distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """(id, class_id, copy_id, n_links): for each row the smallest id of its class and of its copies (texts of
    the same words), and the number of other rows whose similarity is at least ``threshold``."""
    prepare(docs.sparkSession)
    all_rows = written(signed(docs, id_col, text_col), "signed")
    rows = all_rows.filter("key is not null")
    nodes = written(rows.groupBy("key").agg(F.min("id").alias("copy_id"), F.count("*").alias("copies"), F.first("sig").alias("sig")), "nodes")
    for depth in range(DEPTH, 0, -1):
        clusters = written(components(candidates(nodes, depth)), "clusters")
        found = written(tiles(docs, text_col, clusters, nodes.select("key", "copies"), depth, threshold), "links")
        have, want = found.agg(F.coalesce(F.sum("found"), F.lit(0.0)), F.coalesce(F.sum("estimated"), F.lit(0.0))).first()
        if have >= target * want:
            break
    classes = components(found.select(F.col("key").alias("u"), F.col("label").alias("v"))).withColumnRenamed("node", "key")
    named = classes.join(nodes.select("key", "copy_id"), "key").groupBy("label").agg(F.min("copy_id").alias("class_id"))
    links = found.groupBy("key").agg(F.sum("links").alias("links")).join(classes, "key").join(named, "label").select("key", "links", "class_id")
    named = nodes.select("key", "copy_id", "copies").join(links, "key", "left")
    named = named.select("key", F.coalesce("class_id", "copy_id").alias("class_id"), "copy_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select("id", "key").join(named, "key").select(F.col("id").alias(id_col), "class_id", "copy_id", "n_links")
    alone = all_rows.filter("key is null").select(F.col("id").alias(id_col), F.col("id").alias("class_id"), F.col("id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near copies: exactly one row of each class stays, the one with the smallest id (a null
    id comes last), of several with it the one with the smallest text hash.  Rows without words have no copies and stay."""
    names = docs.columns
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    blank = text.rlike(r"(?U)^[\s\x1c-\x1f]*$")
    row = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), F.md5(text).alias("hash"))
    keyed = docs.filter(~blank).withColumn("__row", row)
    kept = join(keyed.select("__row", text_col), "__row", text_col, threshold).filter("__row = class_id").select("__row").distinct()
    order = F.xxhash64(*(f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()))
    one = keyed.groupBy("__row").agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in names)), order).alias("doc"))  # rows equal in id and text meet in part before the shuffle
    return one.join(kept, "__row", "left_semi").select("doc.*").unionByName(docs.filter(blank))
