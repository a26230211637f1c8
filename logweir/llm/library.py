"""Ids of a tokenizers file, with whole words looked up where the file allows it."""

from __future__ import annotations

import json
import os
import re
import string
from functools import lru_cache

import numpy as np

from logweir.llm.shingles import mix, span_words

# Fixed value: the word pattern of the public file for which words can be looked up.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words a Python worker remembers before it starts anew.
MEMORY = 800_000
#: Words that are encoded in one call.
JOINED = 1000
#: Bytes of a word that is compared as two numbers.
SHORT = 16
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# Marks that never take part in a contraction or, without letters, in a special token.
_MARKS = "".join(c for c in string.punctuation if c != "'")
# Characters of which each has one small form, whatever stands beside it.
_PLAIN = re.compile("[^\x00-\u012f\u0131-\u024f]")
# What keeps a text from being cut by its bytes alone: other characters than ASCII and Latin
# letters, a contraction, a special token.
_CUT = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]|'[sStTrRvVmMlLdD]|<\\|")
_BLANK, _LETTER, _DIGIT, _MARK = range(4)
_KIND = np.full(256, _LETTER, np.uint8)
_KIND[:128] = [
    _BLANK if 9 <= c <= 13 or c == 32 else _DIGIT if chr(c).isdigit() else _LETTER if chr(c).isalpha() else _MARK for c in range(128)
]


def _drops_blanks(config: dict) -> bool:
    """Whether no token crosses white space and none is made of it."""
    steps = (config.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    normal = {n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])}
    first = steps[0]
    return (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
        and first.get("pattern") == {"Regex": WORD_PATTERN} and normal <= {"NFC", "Replace", "Lowercase"}
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in config["added_tokens"])
    )


class _Table:
    """Ids of words: short ones by a hash, told by all their bytes; longer ones by the words themselves."""

    def __init__(self):
        self.hash, self.low, self.high = (np.zeros(0, np.uint64) for _ in range(3))
        self.size, self.entry = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.begin, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.long: dict[bytes, int] = {}

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hash, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == hashes[inside]
        return np.flatnonzero(~known)

    def find(self, hashes: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray | None:
        """Entries of short words; none if one is not known, or known as another word."""
        at = np.searchsorted(self.hash, hashes)
        if len(at) and (at[-1] >= len(self.hash) or (self.hash[at] != hashes).any()):
            return None
        same = (self.low[at] == low).all() and (self.high[at] == high).all() and (self.size[at] == size).all()
        return self.entry[at] if same else None

    def store(self, ids: list[bytes]) -> np.ndarray:
        """The new entries of words with these ids."""
        times = np.array([len(i) // 4 for i in ids], np.int64)
        entries = len(self.begin) + np.arange(len(ids))
        self.begin = np.r_[self.begin, len(self.ids) + np.cumsum(times) - times]
        self.times = np.r_[self.times, times]
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), "<u4")])
        return entries

    def add(self, hashes, low, high, size, ids: list[bytes]) -> None:
        entry = self.store(ids)
        order = np.argsort(np.concatenate([self.hash, hashes]), kind="stable")
        for name, more in (("hash", hashes), ("low", low), ("high", high), ("size", size), ("entry", entry)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])


class WordIds:
    """Little-endian 32-bit ids of texts, as the library gives them.

    Where the file's words end at white space at the latest and white space gives no token,
    a text is cut at ASCII blanks and each cut is encoded by the library once. Small
    letters are made first where that is sure to be what the library does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tool = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self._by_word = _drops_blanks(json.load(f))
        self._known: dict[str, bytes] = {"": b""}
        self._table = _Table()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._tool.encode_batch(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Words of letters only, many in a call: blanks part them, and each is one word of the file."""
        out = {}
        for start in range(0, len(words), JOINED):
            part = words[start : start + JOINED]
            found = self._tool.encode(" ".join(part), add_special_tokens=False)
            of, ids = np.array(found.word_ids), np.array(found.ids, "<u4").tobytes()
            cuts = (4 * np.searchsorted(of, np.arange(len(part) + 1))).tolist()
            if of[-1] != len(part) - 1:  # a word that the file sees otherwise
                out.update(zip(part, self._library(part), strict=True))
            else:
                out.update((w, ids[a:b]) for w, a, b in zip(part, cuts, cuts[1:], strict=False))
        return out

    def _learn(self, missing: set[str]) -> None:
        known = self._known
        if len(known) + len(missing) > MEMORY:
            known.clear()
            known[""] = b""
        missing = missing - known.keys()
        # a word with marks behind it is the word's ids and the marks' ids
        ends = {w: (s, w[len(s) :]) for w in missing if (s := w.rstrip(_MARKS)) != w and s.isalpha() and not _PLAIN.search(s)}
        missing = (missing - ends.keys()).union(*ends.values()) - known.keys()
        letters = [w for w in missing if w.isalpha() and not _PLAIN.search(w)]
        known.update(self._words(letters))
        others = list(missing.difference(letters))
        known.update(zip(others, self._library(others), strict=True))
        known.update((w, known[a] + known[b]) for w, (a, b) in ends.items())

    def _ids_of(self, words: list[str]) -> list[bytes]:
        letters = [w for w in words if w.isalpha()]
        ids = self._words(letters)
        others = [w for w in words if w not in ids]
        ids.update(zip(others, self._library(others), strict=True))
        return [ids[w] for w in words]

    def _by_bytes(self, texts: list[str]) -> list[bytes]:
        """Texts of ASCII and Latin letters: runs of letters, digits one by one, runs of marks.

        Equal runs of the batch are looked up once. Runs of up to SHORT bytes are found by a
        hash and compared by all their bytes, longer ones are keys themselves.
        """
        encoded = [t.lower().encode() for t in texts]
        joined = b" ".join(encoded) + b" " * (SHORT + 8)
        data = np.frombuffer(joined, np.uint8)
        kind = _KIND[data]
        starts = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)])
        ends = np.r_[starts[1:], len(data)]
        word = kind[starts] != _BLANK
        starts, ends = starts[word], ends[word]
        sizes, entry = ends - starts, np.zeros(len(starts), np.int64)
        if len(self._table.begin) > MEMORY:
            self._table = _Table()
        table, short = self._table, np.flatnonzero(sizes <= SHORT)
        long = np.flatnonzero(sizes > SHORT)
        if len(long):
            runs = [joined[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
            new = list(dict.fromkeys(r for r in runs if r not in table.long))
            table.long.update(zip(new, table.store(self._ids_of([r.decode() for r in new])).tolist(), strict=True))
            entry[long] = [table.long[r] for r in runs]
        at, size = starts[short], sizes[short]
        low, high = span_words(data, at, size), span_words(data, at + 8, size - 8)
        hashes = mix(mix(low + _SPREAD) + high + size.astype(np.uint64))
        distinct, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        if (low != low[first[same]]).any() or (high != high[first[same]]).any() or (size != size[first[same]]).any():
            return self._by_words(texts)
        found = table.find(distinct, low[first], high[first], size[first])
        if found is None:
            new = table.missing(distinct)
            of = first[new]
            words = [joined[a : a + n].decode() for a, n in zip(at[of].tolist(), size[of].tolist(), strict=True)]
            table.add(distinct[new], low[of], high[of], size[of], self._ids_of(words))
            found = table.find(distinct, low[first], high[first], size[first])
            if found is None:
                return self._by_words(texts)
        entry[short] = found[same]
        begin, times = table.begin[entry], table.times[entry]
        done = np.cumsum(times)
        total = int(done[-1]) if len(done) else 0
        out = table.ids[np.repeat(begin - (done - times), times) + np.arange(total)].tobytes()
        doc_ends = np.cumsum([len(e) + 1 for e in encoded])
        words_until = np.searchsorted(starts, doc_ends)
        cuts = [0, *(4 * np.r_[0, done][words_until]).tolist()]
        return [out[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self._by_word:
            return self._library(texts)
        # ASCII without an apostrophe or a special token needs no closer look
        plain = [t.isascii() and "'" not in t and "<|" not in t or not _CUT.search(t) for t in texts]
        bytewise = iter(self._by_bytes([t for t, p in zip(texts, plain, strict=True) if p]))
        others = iter(self._by_words([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(bytewise if p else others) for p in plain]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Any texts, cut at ASCII blanks."""
        small = [t if _PLAIN.search(t) else t.lower() for t in texts]
        cut = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in small]
        met = set().union(*cut)
        missing = met - self._known.keys()
        if missing:
            if len(self._known) + len(missing) > MEMORY:
                missing = met  # of the batch at hand nothing may be forgotten
            self._learn(missing)
        return [b"".join(map(self._known.__getitem__, words)) for words in cut]


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    """One per Python worker, so that what it has met lasts from task to task."""
    return WordIds(path)
