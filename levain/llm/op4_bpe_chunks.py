"""BPE encoding and decoding with reuse of content-defined chunks.

Method.  A rolling hash over the bytes of a text cuts it into chunks, so equal passages give equal
chunks wherever they stand.  The *core* of a chunk is what lies between its first and last blank.
A core that occurs more than once in the corpus is encoded once; the ids are joined to all
documents that hold it.  The join between two chunks is repaired by encoding again what lies around
it: the rest of the left chunk after its last blank with the start of the right chunk up to its
first blank, and the window grows over whole chunks while it holds no blank.  The tokenizer encodes
runs between blanks on their own (see ``tokens``), so ids at the window's ends then agree exactly
with those of the whole text.

Jobs.  (1) Count core fingerprints (128 bits, no text moves); those that occur twice or more set
bits in a Bloom filter of fixed size.  (2) Documents without a core in the filter are encoded where
they are read.  (3) For the others the distinct cores are encoded once and joined in by
fingerprint.  A false positive of the filter only sends an unshared core along way (3); a filter
that is too small for the corpus costs shuffle, never results.

Cases.  A null or empty text has no ids.  Repeated rows and ids come back as often as they came.
Any id, null too, is passed on.  Other columns are not read.  Very long texts are whole: a chunk
has no upper bound.  An empty table gives an empty result.  Texts without a blank are one window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levain.llm.common import id_field, prepare, texts
from levain.llm.tokens import default_path, encoder

#: Chunks are MIN_CHUNK + 2**CUT_BITS bytes long on average; the rolling hash sees 32 bytes.
CUT_BITS, MIN_CHUNK, WINDOW = 10, 256, 32
#: The Bloom filter's size: 2**26 bits are 8 MB.
BLOOM_BITS = 26
GEAR = np.random.default_rng(4).integers(0, 2**32, 256, dtype=np.uint32)
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r")] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions in the bytes ``data`` where the rolling hash asks for a cut (before the position)."""
    h = GEAR[data]
    for step in (1, 2, 4, 8, 16):  # doubling: afterwards h covers the last 32 bytes
        h[step:] += h[:-step] << np.uint32(step)
    at = np.flatnonzero(h[:-1] >> np.uint32(32 - CUT_BITS) == 0) + 1
    return at[(data[at] & 0xC0) != 0x80]  # never inside a character


def chunked(batch: list[str]) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """For each text its bytes and the (start, end) of each chunk's core; a chunk without two blanks has none."""
    raw = [t.encode() for t in batch]
    data = np.frombuffer(b"".join(raw), np.uint8)
    marks = cuts(data) if len(data) > WINDOW else np.empty(0, np.int64)
    blank = np.flatnonzero(_BLANK[data]) if len(data) else np.empty(0, np.int64)
    start = 0
    for b in raw:
        end, last, bounds = start + len(b), start, []
        lo, hi = np.searchsorted(marks, (start + WINDOW, end))  # a window must not see the text before
        for p in marks[lo:hi].tolist():
            if p - last >= MIN_CHUNK:
                bounds.append((last, p))
                last = p
        bounds.append((last, end))
        first = np.searchsorted(blank, [x for x, _ in bounds])
        after = np.searchsorted(blank, [y for _, y in bounds])
        cores = [(int(blank[i]) - start, int(blank[j - 1]) - start) for i, j in zip(first, after, strict=True) if j - i >= 2 and blank[j - 1] - blank[i] > 1]
        yield b, cores
        start = end


def fingerprint(core: bytes) -> bytes:
    return hashlib.blake2b(core, digest_size=16).digest()


def _bits(prints: list[bytes], log2: int) -> np.ndarray:
    """Four bit numbers for each fingerprint."""
    words = np.frombuffer(b"".join(prints), "<u4").reshape(-1, 4)
    return words & np.uint32(2**log2 - 1)


def shared_filter(docs: DataFrame, text_col: str = "text", log2: int = BLOOM_BITS) -> np.ndarray:
    """The Bloom filter (bytes of 8 bits) of cores that occur at least twice."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = [fingerprint(b[i:j]) for b, cores in chunked(x.column(0).to_pylist()) for i, j in cores]
            yield pa.record_batch([pa.array(found, pa.binary())], ["p"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            bit = np.unique(_bits(x.column(0).to_pylist(), log2))
            yield pa.record_batch([pa.array((bit >> 5).astype("int64")), pa.array(np.int64(1) << (bit & 31).astype("int64"))], ["w", "b"])

    found = texts(docs, text_col, text_col).select("__text").mapInArrow(prints, "p binary").groupBy("p").count()
    parts = found.filter("count > 1").select("p").mapInArrow(words, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b"))
    got = parts.toPandas()  # at most 2**(log2 - 5) rows
    out = np.zeros(2 ** (log2 - 5), "<u4")
    out[got["w"].to_numpy("int64")] = got["b"].to_numpy("int64").astype("<u4")
    return out.view(np.uint8)


def _seen(prints: list[bytes], bloom: np.ndarray) -> np.ndarray:
    bit = _bits(prints, len(bloom).bit_length() + 2)
    return ((bloom[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).all(axis=1)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None,
           bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """(id, ids): for each row the ids of its whole text as little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    prepare(spark)
    path = tokenizer_path or default_path()
    bloom = spark.sparkContext.broadcast(shared_filter(docs, text_col, bloom_bits))
    rows = texts(docs, id_col, text_col)
    out = f"{id_field(docs, id_col)}, ids binary"

    def shared_cores(batch: list[str]) -> Iterator[tuple[bytes, list[tuple[int, int, bytes]]]]:
        each = list(chunked(batch))
        prints = [fingerprint(b[i:j]) for b, cores in each for i, j in cores]
        seen, k = _seen(prints, bloom.value), 0
        for b, cores in each:
            yield b, [(i, j, prints[n]) for n, (i, j) in enumerate(cores, k) if seen[n]]
            k += len(cores)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without a shared core: encoded here, in one go."""
        enc = encoder(path)
        for x in batches:
            whole = x.column(1).to_pylist()
            mine = [n for n, (_, shared) in enumerate(shared_cores(whole)) if not shared]
            yield pa.record_batch([x.column(0).take(pa.array(mine, pa.int32())), pa.array(enc.encode([whole[n] for n in mine]), pa.binary())], [id_col, "ids"])

    def shared_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = {p: b[i:j] for b, shared in shared_cores(x.column(1).to_pylist()) for i, j, p in shared}
            yield pa.record_batch([pa.array(found.keys(), pa.binary()), pa.array([c.decode() for c in found.values()], pa.string())], ["p", "core"])

    def core_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for x in batches:
            yield pa.record_batch([x.column(0), pa.array(enc.encode(x.column(1).to_pylist()), pa.binary())], ["p", "core_ids"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with shared cores: a row for each local stretch (repaired joins and unshared chunks)
        with its ids, and one for each shared core.  A stretch has a key that no core has."""
        enc = encoder(path)
        for x in batches:
            ids, row, name, seq, key, own = x.column(0).to_pylist(), [], [], [], [], []
            for n, (b, shared) in enumerate(shared_cores(x.column(1).to_pylist())):
                if not shared:
                    continue
                mark, at = hashlib.blake2b(b + repr(ids[n]).encode(), digest_size=16).digest(), 0
                for k, (i, j, p) in enumerate([*shared, (len(b), len(b), None)]):
                    own.append(b[at:i].decode())
                    key.append(hashlib.blake2b(mark + k.to_bytes(4, "little"), digest_size=16, person=b"stretch").digest())
                    seq.append(2 * k)
                    if p is not None:
                        own.append(None)
                        key.append(p)
                        seq.append(2 * k + 1)
                    at = j
                row += [n] * (2 * len(shared) + 1)
                name += [mark] * (2 * len(shared) + 1)
            local = iter(enc.encode([t for t in own if t is not None]))
            found = [None if t is None else next(local) for t in own]
            yield pa.record_batch([x.column(0).take(pa.array(row, pa.int32())), pa.array(name, pa.binary()), pa.array(seq, pa.int32()), pa.array(key, pa.binary()), pa.array(found, pa.binary())], [id_col, "name", "seq", "p", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            row, whole = [], []
            for n, found in enumerate(x.column(1).to_pylist()):
                found = sorted((f["seq"], f["ids"]) for f in found)
                times = sum(s == 0 for s, _ in found)  # equal rows share a name
                row += [n] * times
                whole += [b"".join(f for _, f in found[::times])] * times
            yield pa.record_batch([x.column(0).take(pa.array(row, pa.int32())), pa.array(whole, pa.binary())], [id_col, "ids"])

    once = rows.mapInArrow(shared_texts, "p binary, core string").groupBy("p").agg(F.first("core").alias("core"))
    split = rows.mapInArrow(pieces, f"{id_field(docs, id_col)}, name binary, seq int, p binary, ids binary")
    filled = split.join(once.mapInArrow(core_ids, "p binary, core_ids binary"), "p", "left")
    parts = filled.select(id_col, "name", F.struct("seq", F.coalesce("ids", "core_ids").alias("ids")).alias("part"))
    whole = parts.groupBy(id_col, "name").agg(F.collect_list("part").alias("parts")).select(id_col, "parts")
    return rows.mapInArrow(alone, out).unionByName(whole.mapInArrow(joined, out))


def decode(encoded: DataFrame, id_col: str = "doc_id", tokenizer_path: str | None = None) -> DataFrame:
    """(id, text): the text that the tokenizer's ``decode`` gives for each row's ``ids`` (null: empty)."""
    path = tokenizer_path or default_path()

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for x in batches:
            yield pa.record_batch([x.column(0), pa.array([enc.decode(i or b"") for i in x.column(1).to_pylist()], pa.string())], [id_col, "text"])

    return encoded.select(id_col, "ids").mapInArrow(back, f"{id_field(encoded, id_col)}, text string")


def digests(encoded: DataFrame, id_col: str = "doc_id", tokenizer_path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of what ``encode`` returns and of its decoded text."""
    path = tokenizer_path or default_path()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for x in batches:
            ids = x.column(1).to_pylist()
            yield pa.record_batch([
                x.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(enc.decode(i).encode()).hexdigest() for i in ids], pa.string()),
            ], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.select(id_col, "ids").mapInArrow(digest, f"{id_field(encoded, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
