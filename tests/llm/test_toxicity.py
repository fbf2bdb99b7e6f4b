"""Toxicity: exact neighbours against every example, held-out accuracy, calibration, and edge cases."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from levain.llm import op11_toxicity as o11
from levain.llm.queries import QUERIES

DOCS = "doc_id long, text string, terms string, place string, kind string, vote string"
SF = "/root/testdata/sf0.01"


def tables(spark, docs, labels):
    return (spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in docs], DOCS),
            spark.createDataFrame([(i, 1, y, "t") for i, y in labels], "doc_id long, quality int, toxic int, text string"))


def made(n=400, seed=0, share=0.3):
    """Clean words with, in toxic texts, some inflected stems; ids from 1."""
    r, docs, labels = random.Random(seed), [], []
    for i in range(1, n + 1):
        bad = r.random() < share
        words = ["".join(r.choice("abdeghilmnorstu") for _ in range(r.randint(2, 9))) for _ in range(r.randint(3, 60))]
        for _ in range(r.randint(1, 3) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(["Krumfel", "zworpig"]) + r.choice(["", "a", "ish", "ung", "!"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def plain_terms(text, terms):
    """Counts of each term by trying each at each place."""
    s = o11.letters(text)
    found = {n: sum(s.startswith(t, i) for i in range(len(s))) for n, t in enumerate(terms)}
    return {n: c for n, c in found.items() if c}


def test_nearest_are_those_of_every_cosine(spark):
    docs, labels = made()
    index, found = o11.learn(*tables(spark, docs, labels), sample=100)
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert index.terms and 0 < len(index.ids) <= 200 and not held & set(index.ids.tolist())
    text = dict(docs)
    n, df = len(docs), Counter(t for x in text.values() for t in plain_terms(x, index.terms))
    idf = [math.log((1 + n) / (1 + df[t])) + 1 for t in range(len(index.terms))]
    assert np.allclose(index.idf, idf)

    def vector(x):
        v = {t: (1 + math.log(c)) * idf[t] for t, c in plain_terms(x, index.terms).items()}
        size = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / size for t, w in v.items()}

    stored = {int(i): vector(text[int(i)]) for i in index.ids}
    for r in found.collect():
        assert dict(zip(r["terms"], r["counts"])) == plain_terms(text[r["doc_id"]], index.terms)
        if r["terms"]:
            q = vector(text[r["doc_id"]])
            every = sorted(((-round(sum(w * v.get(t, 0) for t, w in q.items()), 9), i) for i, v in stored.items()))
            want = [(i, -s) for s, i in every if s < 0][:o11.NEIGHBOURS]
            near, cosine = index.nearest(np.array(r["terms"], int), np.array(r["counts"], float))
            assert [s for _, s in want] == pytest.approx(cosine.tolist(), abs=1e-8) and [i for i, _ in want] == index.ids[near].tolist()


def test_ranges_are_left_unopened():
    r = np.random.default_rng(0)
    rows = [(i, float(i % 2), i % 2, sorted({int(t) for t in (r.integers(0, 4, 3) + 4 * (i // 200))}), None) for i in range(2000)]
    rows = [(i, v, k, t, [1] * len(t)) for i, v, k, t, _ in rows]
    index = o11._build(rows, [str(n) for n in range(40)], np.ones(40), {0: 1000, 1: 1000}, 0.5)
    index.nearest(np.array([0, 1]), np.ones(2))
    assert 0 < index.opened < 0.2 * index.maxima.shape[1]


def test_held_out_texts_are_told_apart(spark):
    docs, labels = made(1500, 3)
    got = {r["doc_id"]: r for r in o11.scored(*tables(spark, docs, labels)).collect()}
    held = [(got[i], y) for i, y in labels if got[i]["held_out"]]
    assert {r["doc_id"] for r, _ in held} == {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == y for r, y in held) >= 0.97 * len(held)
    assert abs(sum(r["score"] for r, _ in held) - sum(y for _, y in held)) < 0.1 * len(held)
    toxic = [r for r, y in held if y and r["predicted"]]
    label = dict(labels)
    assert all(r["evidence"] and 0 < r["similarity"] <= 1 and sum(label[i] for i in r["evidence"]) * 2 >= len(r["evidence"]) for r in toxic)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = made(300, 4)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (sorted(map(tuple, o11.scored(*tables(spark, docs, x)).select("doc_id", "score").collect())) for x in (labels, flipped))
    assert a == b


def test_edges(spark):
    docs, labels = made(200, 5)
    more = [(None, "krumfelish thing"), (900, None), (901, ""), (902, " \n 12 ;"), (903, "zworpig " * 50_000), (904, "a" * 30_000), (1, "krumfel"), (1, "krumfel"), (905, "KRUMFELA")]
    given = [*labels, (1, 1), (1, None), (None, 1), (7000, 1), (901, 0), (902, 1), (903, 7)]
    rows = o11.scored(*tables(spark, [*docs, *more], given)).collect()
    assert len(rows) == 209 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    of = {r["doc_id"]: r for r in rows}
    assert of[900]["score"] == of[901]["score"] == of[902]["score"] == of[904]["score"] < 0.5 and of[900]["evidence"] == []
    assert of[903]["predicted"] == of[905]["predicted"] == 1 and of[None]["predicted"] == 1 and not of[None]["held_out"]
    assert o11.scored(*tables(spark, [], [])).count() == 0
    assert {r["score"] for r in o11.scored(*tables(spark, docs, [])).collect()} == {0.0}
    assert {r["predicted"] for r in o11.scored(*tables(spark, docs, [(i, 1) for i, _ in docs])).collect()} == {1}


def test_query_on_held_out_rows(spark):
    got = {r["doc_id"]: r for r in QUERIES["op11_toxicity_votes"](spark, SF).collect()}
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert got.keys() == docs.keys()
    held = [i for i in label if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == label[i] for i in held) >= 0.95 * len(held)
