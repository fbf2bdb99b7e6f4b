"""Exact, fast encoding with a ``tokenizers`` file whose pre-tokenizer drops white space.

Such a tokenizer (for example ``word_bpe_49k.json``) encodes every run between blanks on its own:
no normalizer step, split pattern or special token reaches across a blank.  So the ids of a text
are the ids of its runs in order, and a bounded cache of runs saves most of the work.  Only blank,
tab, newline and carriage return part runs; any other white space is left to the tokenizer.

Whether a tokenizer does so is tried out on loading; one that does not encodes whole texts.

The runs of many texts are told apart by Arrow, so that each different run is looked up once, not once for
each time it occurs.

Most runs are a Latin word with or without closing punctuation.  If the tokenizer marks
the ends of words, lowers case and parts letters from punctuation (both are tried out on loading), word and punctuation
are looked up on their own; what the cache lacks is encoded many
at a time, parted by blanks and without normalizing, and the ids are told apart at the marks.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Marks that close a word of letters.
CLOSING = ".,;:!?"
#: Letters of words that are parted from closing marks; not the capital I with dot.
LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c.lower().isalpha())
#: Runs that the normalizer must leave as they are, and texts whose ids depend on blanks unless these only part runs.
LATIN = "a the quickly \u00e4rger \u00e9t\u00e9 ni\u00f1o \u00ff\u00fe\u00b5\u00aa\u00ba\u00df word, end. what?! etc...; xxxxxxxxxxxxxxxxxxxxxxxx"
TRIED = ("a b", " a", "a ", "a  b", "one two, three.  Four\tfive\nsix\r\nseven 8 9", "  \n\n x\n\n  y", "the end .", "it 's", "\u00e4 b\u00df, \u65e5\u672c \u8a9e")


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str, cache_runs: int = 300_000) -> RunEncoder:
    """One encoder a worker process."""
    return RunEncoder(path, cache_runs)


def blanks(text: str) -> str:
    """``text`` with a blank for each character that parts runs."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")


def runs(text: str) -> list[str]:
    """The runs of ``text`` between blanks; consecutive blanks give empty runs."""
    return blanks(text).split(" ")


def _is_latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def gather(ids: np.ndarray, bounds: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` between ``bounds`` that are at ``places``, in order, and the bounds of these."""
    start = bounds[places]
    size = bounds[places + 1] - start
    upto = np.concatenate([[0], size.cumsum()])
    return ids[np.repeat(start - upto[:-1], size) + np.arange(upto[-1])], upto


class Arena:
    """The ids of runs, one after another, with each run's place; what was not used again goes when it holds more than ``size`` runs."""

    def __init__(self, size: int):
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids, self.ends, self.used = np.empty(1 << 20, "<u4"), np.zeros(self.size + 1, "int64"), np.zeros(self.size + 1, bool)

    def shrink(self) -> None:
        """Keep the runs that were used again since the last time; none if these are more than half of ``size``."""
        kept = list(compress(self.at, self.used.tolist()))
        ids, bounds = self.gather(np.flatnonzero(self.used))
        self.clear()
        if len(kept) <= self.size // 2:
            self.add(kept, ids, bounds[1:])

    def add(self, runs_: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Add runs whose ids lie in ``ids`` up to ``ends`` each."""
        n, start = len(self.at), int(self.ends[len(self.at)])
        if start + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:start], np.empty(2 * (start + len(ids)), "<u4")])
        if n + len(runs_) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(len(self.ends) + len(runs_), "int64")])
            self.used = np.concatenate([self.used, np.zeros(len(self.ends) - len(self.used), bool)])
        self.ids[start:start + len(ids)] = ids
        self.ends[n + 1:n + 1 + len(runs_)] = start + ends
        self.at.update(zip(runs_, range(n, n + len(runs_)), strict=True))

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs at ``places``, in order, and their bounds."""
        return gather(self.ids, self.ends, places)


class RunEncoder:
    def __init__(self, path: str, cache_runs: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache = Arena(2 * cache_runs)
        self.pattern = None
        self.bare = Tokenizer.from_file(path)  # for words that need no normalizing
        self.names: list[str] | None = None
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_run = self._parts_at_blanks()
        self.ends = self._word_ends() if self.by_run else None

    def _parts_at_blanks(self) -> bool:
        """Whether runs between blanks are encoded on their own, tried on texts whose blanks would matter otherwise."""
        return all(self._plain([t]) == [b"".join(self._plain(runs(t)))] for t in TRIED)

    def _word_ends(self) -> np.ndarray | None:
        """Whether each id ends a word; None if the tokenizer does not tell or treats words otherwise."""
        mark = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        if not mark or self._plain(["\u00c4Bc!!"]) != [b"".join(self._plain(["\u00e4bc", "!!"]))]:
            return None
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        split = [x for x in split.get("pretokenizers", [split]) if x.get("type") == "Split"]
        if len(split) == 1 and split[0].get("invert") and "Regex" in split[0]["pattern"]:
            self.pattern = regex.compile(split[0]["pattern"]["Regex"])  # what it finds are the pieces that end in a mark
        self.bare.normalizer = None
        self.bare.model._resize_cache(0)  # it gets each word once
        tried = LATIN.split()
        if [np.array(e.ids, "<u4").tobytes() for e in self.bare.encode_batch_fast(tried, add_special_tokens=False)] != self._plain(tried):
            return None
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for t, i in vocab.items() if t.endswith(mark)]] = True
        return ends

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _many(self, some: list[str], pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of many lower-case Latin runs from one call, and where each run's end, given the number of word ends in each; None where that does not fit."""
        joined = " ".join(some)
        if not _is_latin(joined) or joined != joined.lower():
            return None
        ids = np.array(self.bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        at, upto = np.flatnonzero(self.ends[ids]) + 1, pieces.cumsum()
        return (ids, at[upto - 1]) if len(at) == upto[-1] else None

    def _bulk(self, some: list[str], pieces: np.ndarray) -> list[str]:
        """Add ``some`` to the cache, many at a time; returns those that must go one by one."""
        rest = []
        for i in range(0, len(some), 500):
            part = some[i:i + 500]
            found = self._many(part, pieces[i:i + 500])
            if found is None:
                rest += part
            else:
                self.cache.add(part, *found)
        return rest

    def _add(self, missing: list[str]) -> None:
        """Put the ids of ``missing`` into the cache."""
        rest = missing
        if self.ends is not None:
            words = [w for w in missing if w.isalpha()]
            rest = [w for w in missing if not w.isalpha()]
            rest += self._bulk(words, np.ones(len(words), int))
            if self.pattern is not None:
                counted = np.array([len(self.pattern.findall(w)) if w.isprintable() else 0 for w in rest], int)  # not where other white space may be replaced
                rest = self._bulk([w for w, n in zip(rest, counted, strict=True) if n], counted[counted > 0]) + [w for w, n in zip(rest, counted, strict=True) if not n]
        for i in range(0, len(rest), 10_000):
            found = self._plain(rest[i:i + 10_000])
            self.cache.add(rest[i:i + 10_000], np.frombuffer(b"".join(found), "<u4"), np.cumsum([len(x) // 4 for x in found]))

    def _places(self, wanted: pa.LargeStringArray) -> np.ndarray:
        """Where the cache has each of ``wanted``, which differ and hold no blank; those that it lacks are added."""
        at = self.cache.at
        names = pc.binary_join(pa.ListArray.from_arrays([0, len(wanted)], wanted), pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        places = np.fromiter(map(at.get, names, repeat(-1)), "int64", len(names))
        unknown = places < 0
        self.cache.used[places[~unknown]] = True
        if missing := list(compress(names, unknown.tolist())):
            self._add(missing)
            places[unknown] = np.fromiter(map(at.__getitem__, missing), "int64", len(missing))
        return places

    def _different(self, some: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different runs, in order, and their bounds."""
        if self.ends is None:
            return self.cache.gather(self._places(some))
        stem, tail = pc.utf8_rtrim(some, CLOSING), pc.utf8_ltrim(some, LETTERS)  # closing marks after a word of letters are on their own
        fits = pc.equal(pc.add(pc.binary_length(stem), pc.binary_length(tail)), pc.binary_length(some))
        parts = pa.concat_arrays([pc.if_else(fits, stem, some), pc.if_else(fits, tail, pa.scalar("", pa.large_string()))]).dictionary_encode()
        places = self._places(parts.dictionary)[parts.indices.to_numpy()]
        ids, bounds = self.cache.gather(places.reshape(2, -1).T.ravel())
        return ids, bounds[::2]

    def _lower(self, text: str) -> str:
        """``text`` in lower case where that cannot matter: Latin-1 without the name of a special token."""
        if self.ends is None or not _is_latin(text):
            return text
        low = text.lower()
        return text if any(s in low for s in self.special) else low

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's begin and the last one's end."""
        if not self.by_run:
            found = self._plain(texts)
            return np.frombuffer(b"".join(found), "<u4"), np.cumsum([0, *(len(x) // 4 for x in found)])
        if len(self.cache.at) > self.cache.size:
            self.cache.shrink()
        parts = pc.split_pattern(pa.array([blanks(self._lower(t)) for t in texts], pa.large_string()), " ")
        found = parts.flatten().dictionary_encode()
        ids, bounds = gather(*self._different(found.dictionary), found.indices.to_numpy())
        return ids, bounds[parts.offsets.to_numpy()]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, at = self.flat(texts)
        raw, at = ids.tobytes(), (4 * at).tolist()
        return [raw[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: bytes) -> str:
        """What the tokenizer's ``decode(ids, skip_special_tokens=False)`` gives."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
        if self.names is None:  # without a decoder: the tokens, parted by blanks
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.names = [""] * (max(vocab.values()) + 1)
            for token, i in vocab.items():
                self.names[i] = token
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))
