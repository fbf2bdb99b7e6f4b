"""Language identification by compression with per-language dictionaries.

Method.  For each language the words of all its distinct labelled texts are counted, and those that hold the most
bytes of them make a raw-content zstandard dictionary.  A text is compressed with each dictionary; the language of the smallest size wins.
Texts are read as words: lower-case runs of letters, each run of equal words once, so that case,
punctuation, numbers and repeated words do not hide the letters.  The whole text counts, in frames
of FRAME bytes (else a long text is compressed against itself rather than the dictionary).
If the margin (second smallest size over smallest, less one) is narrow, the text is measured again with
the strongest match finder.  A margin below the threshold of the language found and the text's length rejects the text
(``accepted`` is false).

Thresholds.  A quarter of the hashes is kept out of the dictionaries.  The margins of all these texts, whole, are measured, 0 for those that
get another language, and counted by language and class of lengths (doublings of the bytes of words) in steps of STEP.
PART of the QUANTILE of a class is the threshold, so that clean texts stay; with under FEW margins that of the class in all
languages, then that of the class and its neighbours, then REJECT, or nothing under SHORT bytes.
A language with under LEAST texts for its dictionary keeps none out.

Cases.  A null text, or one without a letter: language ``und``, score 0, not accepted.  Ties go to
the language with more labelled rows, then by name.  Equal texts get equal answers; repeated rows
are kept.  With no labelled row every text is ``und``.  Other columns are not read.  Very long texts
are whole.  Labelled rows: non-null, non-empty language and text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levain.llm.common import id_field, prepare

UNKNOWN = "und"
#: Bytes of a dictionary.
DICTIONARY = 65536
FRAME, SHORT = 4096, 64
#: Margins under NARROW are measured again; those under REJECT reject where no threshold is known.
NARROW, REJECT = 0.02, 0.001
#: Margins that make a threshold, texts of a dictionary that come first.
FEW, LEAST = 20, 32
QUANTILE, PART = 0.05, 0.5
#: Margins are counted in steps of STEP, up to 1.
STEP = 1e-4
#: The first and the last class of lengths: under 2**5 and from 2**12 bytes.
CLASSES = (5, 13)
WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> bytes:
    """The lower-case words of ``text``, each run of equal words once, parted by blanks."""
    found = WORD.findall(text.lower())
    if found and not "".join(found).isalpha():  # numbers such as ½, ² and Ⅷ are no letters
        found = "".join(c if c.isalpha() else " " for c in " ".join(found)).split()
    return " ".join(w for w, _ in groupby(found)).encode()


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", sample_texts: int | None = None) -> Dictionaries:
    """A dictionary for each language, by falling number of labelled rows, from every distinct text
    (``sample_texts``, the bound of a sample there once was, has no effect)."""
    prepare(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).filter("length(lang) > 0 and length(text) > 0")
    counts = dict(rows.groupBy("lang").count().collect())  # a row a language
    rows = rows.filter(F.col("text").rlike(r"\p{L}")).withColumn("place", F.xxhash64("text"))
    tried = F.col("place") % 4 == 0
    taken = rows.filter(~tried).select("lang", "place").distinct().groupBy("lang").count().collect()  # a row a language
    tried = tried & F.col("lang").isin([x for x, n in taken if n >= LEAST])
    part = rows.filter(~tried).dropDuplicates(["lang", "place"]).select("lang", "text")
    found: dict[str, list[str]] = {x: [] for x in sorted(counts, key=lambda x: (-counts[x], x))}
    for lang, word, _ in most_bytes(word_counts(part)).collect():  # at most DICTIONARY bytes a language
        found[lang].append(word)
    known = Dictionaries({x: " ".join([*reversed(w), ""]).encode() for x, w in found.items() if w})  # the last are the nearest
    known.least = thresholds(rows.filter(tried).dropDuplicates(["lang", "place"]).select("lang", "text"), known)
    return known


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n): how often the words of the texts (lang, text) occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            seen: Counter = Counter()
            for lang, text in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                seen.update((lang, w) for w in words(text).decode().split())
            yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def most_bytes(counted: DataFrame) -> DataFrame:
    """The words of each language that hold the most bytes of its texts, up to DICTIONARY bytes with the blanks, in falling order;
    each task first finds its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[int, str, int]]] = defaultdict(list)

        def first(of: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
            of.sort(key=lambda r: (-r[0], r[1]))
            sizes = accumulate(len(w.encode()) + 1 for _, w, _ in of)
            return [r for r, size in zip(of, sizes, strict=True) if size <= DICTIONARY]

        for x in batches:
            for lang, word, n in zip(*(c.to_pylist() for c in x.columns), strict=True):
                held[lang].append((n * len(word.encode()), word, n))
                if len(held[lang]) >= 2 * DICTIONARY:
                    held[lang] = first(held[lang])
        out = [(lang, w, n) for lang, of in held.items() for _, w, n in first(of)]
        cols = list(zip(*out, strict=True)) or [()] * 3
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "word", "n"])

    kinds = "lang string, word string, n long"
    return counted.mapInArrow(run, kinds).repartition("lang").mapInArrow(run, kinds)


class Dictionaries(dict):
    """Dictionaries by language, with ``least``: the smallest margin that is accepted, by language and class of lengths."""

    least: dict[tuple[str, int], float] = {}


def length_class(n: int) -> int:
    return min(max(n.bit_length(), CLASSES[0]), CLASSES[1])


def thresholds(tried: DataFrame, known: dict[str, bytes]) -> dict[tuple[str, int], float]:
    """The threshold of each language and class of lengths, from the labelled texts (lang, text) that no dictionary has."""
    dictionaries = tuple(known.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            out = [(lang, *measured(raw, dictionaries)) for lang, t in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True) if (raw := words(t))]
            cols = list(zip(*((lang, length_class(n), int(min(margin, 1.0) / STEP) if lang == best else 0) for lang, best, margin, _, n in out), strict=True)) or [()] * 3
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], ["lang", "class", "step"])

    if len(known) < 2:
        return {}
    of: dict[tuple[str | None, int], Counter] = defaultdict(Counter)
    near: dict[tuple[str, int], Counter] = defaultdict(Counter)
    for lang, size, step, n in tried.mapInArrow(run, "lang string, class long, step long").groupBy("lang", "class", "step").count().collect():  # bounded by steps
        of[lang, size][step] += n
        of[None, size][step] += n
        for c in (size - 1, size, size + 1):
            near[lang, c][step] += n
    out = {}
    for lang in known:
        for c in range(CLASSES[0], CLASSES[1] + 1):
            steps = next((m for m in (of[lang, c], of[None, c], near[lang, c]) if m.total() >= FEW), None)
            if steps:
                place, inner = int(QUANTILE * steps.total()), sorted(steps)
                out[lang, c] = PART * STEP * next(x for x, upto in zip(inner, accumulate(steps[x] for x in inner), strict=True) if upto > place)
    return out


@lru_cache(maxsize=2)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]) -> tuple[list[str], list, list]:
    import zstandard as z

    def make(**how) -> list:
        how = z.ZstdCompressionParameters(write_content_size=False, write_checksum=False, write_dict_id=False, window_log=18, **how)
        out = []
        for _, raw in dictionaries:
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            out.append(z.ZstdCompressor(dict_data=d, compression_params=how))
        return out

    plain = make(strategy=z.STRATEGY_GREEDY, min_match=4, hash_log=16, chain_log=16, search_log=3)
    strong = make(strategy=z.STRATEGY_BTULTRA, min_match=3, hash_log=16, chain_log=16, search_log=6, target_length=64)
    return [x for x, _ in dictionaries], plain, strong


def measured(raw: bytes, dictionaries: tuple[tuple[str, bytes], ...]) -> tuple[str, float, float, int]:
    """(language, margin, score, bytes) of words."""
    langs, plain, strong = _compressors(dictionaries)
    frames = [raw[i:i + FRAME] for i in range(0, len(raw), FRAME)]

    def sizes(how: list) -> list[int]:
        return [sum(len(c.compress(f)) for f in frames) for c in how]

    got = sizes(plain)
    best, second = sorted(got)[:2]
    if second / best - 1 < NARROW:
        got = sizes(strong)
        best, second = sorted(got)[:2]
    return langs[got.index(best)], second / best - 1, min(1.0, 2 * (1 - best / second)), len(raw)


def judge(text: str | None, dictionaries: tuple[tuple[str, bytes], ...], least: dict[tuple[str, int], float] | None = None) -> tuple[str, float, bool]:
    """(language, score, accepted); the score is the part of the second smallest size that the smallest saves, doubled
    and at most 1, or 1 if there is only one language."""
    raw = words(text or "")
    if not raw or not dictionaries:
        return UNKNOWN, 0.0, False
    if len(dictionaries) == 1:
        return dictionaries[0][0], 1.0, True
    lang, margin, score, size = measured(raw, dictionaries)
    need = max(REJECT if size >= SHORT else 0.0, (least or {}).get((lang, length_class(size)), 0.0))
    return lang, score, margin >= need


def identify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) for each row, from its text alone."""
    prepare(docs.sparkSession)
    known, least = tuple(dictionaries.items()), getattr(dictionaries, "least", None)  # languages times DICTIONARY bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            got = [judge(t, known, least) for t in x.column(1).to_pylist()]
            cols = list(zip(*got, strict=True)) or [(), (), ()]
            yield pa.record_batch([x.column(0), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.bool_())], [id_col, "lang_pred", "score", "accepted"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, f"{id_field(docs, id_col)}, lang_pred string, score double, accepted boolean")


def keep_accepted(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is accepted, with all their columns; a null ``lang_col`` gets the language found."""
    prepare(docs.sparkSession)
    known, least, names = tuple(dictionaries.items()), getattr(dictionaries, "least", None), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            got = [judge(t, known, least) for t in x.column(names.index(text_col)).to_pylist()]
            cols = dict(zip(names, x.columns, strict=True))
            if lang_col in cols:
                cols[lang_col] = pa.array([g[0] if v is None else v for g, v in zip(got, cols[lang_col].to_pylist(), strict=True)], pa.string())
            yield pa.record_batch(list(cols.values()), names).filter(pa.array([g[2] for g in got], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32(id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
