"""Toxicity by the nearest labelled examples, with calibrated scores and evidence.

Terms.  A text's terms are its character n-grams within words: of each lower-case word with a blank before and behind, the
substrings of GRAM characters (a shorter word with its blanks is one term).  Inflections of a stem share terms.  The
vocabulary are at most TERMS terms that tell the labels apart: those whose chi-square over the examples is beyond chance
for as many terms as were tried (2 ln(tried / ALPHA), a bound on the quantile).

Examples.  At most SAMPLE distinct labelled texts of each class (the smallest text hashes, so no source, copy group or key is
preferred); copies with different labels share one example with their mean label.

Vectors.  (1 + ln tf) * idf, scaled to length 1; document frequencies are counted over all documents.

Index.  Examples are sorted by their heaviest term and parted into ranges of RANGE; each term has postings in
that order and its largest weight in each range (block maxima).  For a query the maxima times its weights bound every
cosine in a range.  Ranges are opened by falling bound, more each time, until the bound of every range left is below
the k-th cosine: the nearest are exact.

Score.  The NEIGHBOURS nearest examples with a cosine over 0 vote for their label with weight 1 / (NEAR + 1 - cosine), times
the number of labelled texts that an example stands for; the share of label 1 among all labelled rows votes with weight
PRIOR.  A text without a term gets the share of label 1 among examples without a term, smoothed alike.  ``evidence`` lists
the ids of the nearest examples and ``similarity`` the nearest's cosine.

Cases.  A null or empty text, or one without a letter, has no term.  Labels that are null or neither
0 nor 1 are ignored.  Null ids have no label but get a score.  Rows that share an id are rows like others, and repeated labels count as often as they
occur.  Without labelled rows every score is 0.  Ties among neighbours go to the smaller id.  Texts are read whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levain.llm.common import prepare, written

#: Bounds of what is fitted: labelled texts of each class, and terms.
SAMPLE, TERMS = 2048, 2048
GRAM, ALPHA = 5, 0.01
RANGE, NEIGHBOURS = 32, 16
NEAR, PRIOR = 0.1, 1.0
#: Query vectors whose result a worker keeps.
KEPT = 20_000
WORD = re.compile(r"[^\W\d_]+")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are not learned from: crc32 of the id as text, modulo 5, is 0 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def letters(text: str | None) -> str:
    """The lower-case words of ``text``, parted and enclosed by blanks; empty if there is none."""
    found = WORD.findall((text or "").lower())
    return f" {' '.join(found)} " if found else ""


def grams(text: str | None) -> set[str]:
    out = set()
    for word in set(letters(text).split()):
        w = f" {word} "
        out.update(w[i:i + GRAM] for i in range(max(1, len(w) - GRAM + 1)))
    return out


def term_counts(docs: DataFrame, terms: list[str], keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``terms`` (numbers of those found in the whole text, rising) and ``counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for n, term in enumerate(terms):
            automaton.add_word(term, n)
        if terms:
            automaton.make_automaton()
        for x in batches:
            ends, numbers, counts = [0], [], []
            for text in x.column("__text").to_pylist():
                found = sorted(Counter(n for _, n in automaton.iter(letters(text))).items()) if terms and text else []
                numbers += [n for n, _ in found]
                counts += [c for _, c in found]
                ends.append(len(numbers))
            at = pa.array(ends, pa.int32())
            yield pa.record_batch([*(x.column(c) for c in keep), pa.ListArray.from_arrays(at, pa.array(numbers, pa.int32())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int32()))], [*keep, "terms", "counts"])

    rows = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return rows.mapInArrow(run, f"{fields}terms array<int>, counts array<int>")


def examples(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[DataFrame, dict[int, int], tuple[int, int]]:
    """The sample (place, example, vote, text) of distinct texts, the number of distinct texts of each class, and (rows of label 1, labelled rows)."""
    prepare(docs.sparkSession)
    label = F.col(label_col).cast("double")
    given = labels.filter(F.col(id_col).isNotNull() & F.coalesce(label.isin(0.0, 1.0), F.lit(False))).select(F.col(id_col).alias("__id"), label.alias("vote"))
    given = given.filter(~held_out("__id")).groupBy("__id").agg(F.sum("vote").alias("ones"), F.count("*").alias("n"))
    places = docs.filter(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col).cast("string")).alias("place"))
    texts = written(places.join(given, "__id").groupBy("place").agg(F.min("__id").alias("example"), F.sum("ones").alias("ones"), F.sum("n").alias("n"), (F.sum("ones") / F.sum("n")).alias("vote"))
                    .withColumn("kind", (F.col("vote") >= 0.5).cast("int")), "labelled-texts")
    counted = {r["kind"]: r for r in texts.groupBy("kind").agg(F.count("*").alias("texts"), F.sum("ones").alias("ones"), F.sum("n").alias("n")).collect()}  # two rows
    # hashes are spread evenly: the first four shares of them surely hold the sample, and little else reaches the two tasks that rank it
    share = {k: min(1.0, 4 * sample / r["texts"]) for k, r in counted.items()}
    few = F.col("place").cast("double") <= F.when(F.col("kind") == 1, -2.0**63 + 2.0**64 * share.get(1, 1.0)).otherwise(-2.0**63 + 2.0**64 * share.get(0, 1.0))
    first = texts.filter(few).withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy("place"))).filter(F.col("rank") <= sample)
    first = first.select("place", "example", "vote", "kind")
    chosen = docs.filter(F.col(text_col).isNotNull()).select(F.xxhash64(F.col(text_col).cast("string")).alias("place"), F.col(text_col).cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(first), "place").groupBy("place", "example", "vote", "kind").agg(F.min("text").alias("text"))  # 2 * sample rows are broadcast
    totals = (int(sum(r["ones"] for r in counted.values())), int(sum(r["n"] for r in counted.values())))
    return written(chosen, "labelled-sample"), {k: r["texts"] for k, r in counted.items()}, totals


def vocabulary(sample: DataFrame, most: int = TERMS, alpha: float = ALPHA) -> list[str]:
    """The terms that tell the classes of ``sample`` apart, the most telling first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found: dict[str, list[int]] = {}
            for kind, text in zip(x.column("kind").to_pylist(), x.column("text").to_pylist(), strict=True):
                for g in grams(text):
                    found.setdefault(g, [0, 0])[kind] += 1
            yield pa.record_batch([pa.array(list(found), pa.string()), *(pa.array([n[k] for n in found.values()], pa.int64()) for k in (0, 1))], ["term", "clean", "toxic"])

    size = {r["kind"]: r["count"] for r in sample.groupBy("kind").count().collect()}
    if len(size) < 2:
        return []
    counts = written(sample.select("kind", "text").mapInArrow(run, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "term-counts")
    a, b, p, q = F.col("toxic").cast("double"), F.col("clean").cast("double"), float(size[1]), float(size[0])
    spread = (a + b) * (p + q - a - b) * p * q
    chi = F.when(spread > 0, (p + q) * F.pow(a * (q - b) - b * (p - a), F.lit(2.0)) / spread).otherwise(0.0)
    least = 2 * math.log(max(1, counts.count()) / alpha)
    return [r["term"] for r in counts.withColumn("chi", chi).filter(F.col("chi") >= least).orderBy(F.col("chi").desc(), "term").limit(most).select("term").collect()]


def document_frequencies(found: DataFrame, terms: int) -> np.ndarray:
    """The number of rows that have each term; every task counts its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(terms, "int64")
        for x in batches:
            mine += np.bincount(x.column(0).flatten().to_numpy(zero_copy_only=False), minlength=terms)
        at = np.flatnonzero(mine)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(mine[at], pa.int64())], ["t", "n"])

    df = np.zeros(terms)
    for t, n in found.select("terms").mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n")).collect():  # a row a term at most
        df[t] = n
    return df


@dataclass
class Index:
    """Labelled examples as a block-max inverted index, with what the vote needs."""

    terms: list[str]
    idf: np.ndarray
    ids: np.ndarray  # of the examples, in index order
    votes: np.ndarray
    stands_for: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]]  # of each term: examples, weights
    maxima: np.ndarray  # of each term and range
    prior: float
    without: float  # the score of a text without a term
    opened: int = field(default=0)  # ranges scored so far

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[terms]
        return w / np.sqrt((w * w).sum())

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """The examples with the ``k`` largest cosines over 0, and these, nearest first."""
        w = self.weigh(terms, counts)
        bounds = w @ self.maxima[terms]
        by_bound = np.argsort(-bounds, kind="stable")
        docs = np.concatenate([self.postings[t][0] for t in terms])
        score = np.concatenate([self.postings[t][1] * v for t, v in zip(terms, w, strict=True)])
        of, total = docs // RANGE, np.zeros(len(self.ids))
        at, width, least = 0, 2, 0.0
        while at < len(by_bound) and bounds[by_bound[at]] > 0 and bounds[by_bound[at]] >= least - 1e-12:
            turn = np.zeros(len(by_bound), bool)
            turn[by_bound[at:at + width]] = True
            turn &= (bounds > 0) & (bounds >= least - 1e-12)
            self.opened += int(turn.sum())
            part = turn[of]
            total += np.bincount(docs[part], score[part], len(total))
            if len(total) >= k:
                least = float(np.partition(total, len(total) - k)[len(total) - k])
            at, width = at + width, 2 * width
        found = np.flatnonzero(total > 0)
        found = found[total[found] >= least - 1e-9]
        near = found[np.lexsort((self.ids[found], -np.round(total[found], 9)))][:k]
        return near, np.minimum(1.0, total[near])

    def score(self, terms: np.ndarray, counts: np.ndarray, k: int = NEIGHBOURS) -> tuple[float, list[int], float]:
        """(score, ids of the nearest examples, cosine of the first) of a text with these terms."""
        near, cosine = self.nearest(terms, counts, k) if len(terms) else (np.empty(0, int), np.empty(0))
        if not len(near):
            return self.without, [], 0.0
        w = self.stands_for[near] / (NEAR + 1 - cosine)
        unit = w.sum() / len(near)
        score = ((w * self.votes[near]).sum() + PRIOR * unit * self.prior) / (w.sum() + PRIOR * unit)
        return float(min(1.0, max(0.0, score))), self.ids[near].tolist(), float(cosine[0])


def _build(rows: list[tuple], terms: list[str], idf: np.ndarray, texts: dict[int, int], prior: float) -> Index:
    """The index of (example, vote, kind, terms, counts)."""
    kinds = Counter(r[2] for r in rows)
    weight = {kind: texts[kind] / n for kind, n in kinds.items()}
    none = [(weight[kind], vote) for _, vote, kind, t, _ in rows if not t]
    mean = sum(w for w, _ in none) / len(none) if none else 1.0
    without = (sum(w * v for w, v in none) + PRIOR * mean * prior) / (sum(w for w, _ in none) + PRIOR * mean)
    index = Index(terms, idf, np.empty(0, "int64"), np.empty(0), np.empty(0), [], np.zeros((len(terms), 0), "float64"), prior, without)
    vectors = [(i, vote, weight[kind], np.array(t), index.weigh(np.array(t), np.array(c, float))) for i, vote, kind, t, c in rows if t]
    vectors.sort(key=lambda v: (int(v[3][np.argmax(v[4])]), -float(v[4].max()), v[0]))
    index.ids, index.votes, index.stands_for = (np.array([v[n] for v in vectors], t) for n, t in ((0, "int64"), (1, "float64"), (2, "float64")))
    index.maxima = np.zeros((len(terms), -(-len(vectors) // RANGE)))
    lists: list[tuple[list[int], list[float]]] = [([], []) for _ in terms]
    for n, (*_, t, w) in enumerate(vectors):
        np.maximum.at(index.maxima, (t, n // RANGE), w)
        for term, x in zip(t.tolist(), w.tolist(), strict=True):
            lists[term][0].append(n)
            lists[term][1].append(x)
    index.postings = [(np.array(d, "int32"), np.array(w, "float64")) for d, w in lists]
    return index


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_terms: int = TERMS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          keep: tuple[str, ...] = ("doc_id",)) -> tuple[Index, DataFrame]:
    """The index of the labelled rows of ``docs`` that are not held out, and all of ``docs`` as their columns ``keep`` with terms and counts."""
    some, texts, (ones, n) = examples(docs, labels, sample, id_col, text_col, label_col)
    terms = vocabulary(some, most_terms)
    found = written(term_counts(docs, terms, list(keep), text_col), "document-terms")
    df = document_frequencies(found, len(terms))
    idf = np.log((1 + found.count()) / (1 + df)) + 1
    rows = [tuple(r) for r in term_counts(some, terms, ["example", "vote", "kind"]).collect()]  # 2 * sample rows of at most most_terms numbers
    return _build(rows, terms, idf, texts, ones / n if n else 0.0), found


def judge(found: DataFrame, index: Index, k: int = NEIGHBOURS) -> DataFrame:
    """``found`` (rows with terms and counts) with ``score``, ``predicted``, ``evidence`` and ``similarity`` in their place."""
    keep = [c for c in found.columns if c not in ("terms", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        for x in batches:
            out = []
            for t, c in zip(x.column("terms").to_pylist(), x.column("counts").to_pylist(), strict=True):
                key = (*t, *c)
                if key not in known:
                    if len(known) >= KEPT:
                        known.clear()
                    known[key] = index.score(np.array(t, int), np.array(c, float), k)
                out.append(known[key])
            cols = list(zip(*out, strict=True)) or [()] * 3
            yield pa.record_batch([*(x.column(c) for c in keep), pa.array(cols[0], pa.float64()), pa.array([int(s >= 0.5) for s in cols[0]], pa.int32()),
                                   pa.array(cols[1], pa.list_(pa.int64())), pa.array(cols[2], pa.float64())], [*keep, "score", "predicted", "evidence", "similarity"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in found.select(*keep).schema)
    return found.mapInArrow(run, f"{fields}score double, predicted int, evidence array<bigint>, similarity double")


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence, similarity) of every row of ``docs``."""
    index, found = learn(docs, labels, **options)
    return judge(found, index).withColumn("held_out", held_out()).select("doc_id", "held_out", "score", "predicted", "evidence", "similarity")
