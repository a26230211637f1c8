"""Word shingles as 64-bit numbers, for many texts at a time."""

from __future__ import annotations

import numpy as np

_GOLD = np.uint64(0x9E3779B97F4A7C15)
# Masks that leave so many bytes of a little-endian number.
_LEFT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Characters that one pass takes at most, but for a single longer text.
PASS_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_words(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number, of which `left` bytes count and the others are 0.

    `data` holds eight bytes more than the places reach.
    """
    found = np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(np.uint64).ravel()
    return found & _LEFT[np.clip(left, 0, 8)]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span of bytes that does not depend on where it stands.

    Each eight bytes are spread together with their place in the span before they are added.
    """
    data, sizes = np.r_[data, np.zeros(8, np.uint8)], ends - starts
    total = mix(span_words(data, starts, sizes) + _GOLD)
    longer = np.flatnonzero(sizes > 8)
    if len(longer):
        more = (sizes[longer] - 1) >> 3  # numbers behind the first
        first = np.cumsum(more) - more
        nth = np.arange(int(more.sum())) - np.repeat(first, more) + 1
        found = span_words(data, np.repeat(starts[longer], more) + 8 * nth, np.repeat(sizes[longer], more) - 8 * nth)
        keys = mix((nth.astype(np.uint64) + np.uint64(1)) * _GOLD)
        total[longer] += np.add.reduceat(mix(found ^ keys), first)
    return mix(total + sizes.astype(np.uint64))


def _pass_shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, shingle) of one pass, in order, repeats included."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(encoded) + b" ", np.uint8)
    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.r_[True, blank].view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    doc_ends = np.cumsum([len(e) + 1 for e in encoded])
    word = span_hashes(data, starts, ends)
    doc = np.searchsorted(doc_ends, starts, side="right")
    n = len(word)
    joined = np.zeros(max(n - words + 1, 0), np.uint64)
    for k in range(words):
        joined = mix(joined * _GOLD + word[k : k + len(joined)])
    inside = doc[: len(joined)] == doc[words - 1 : words - 1 + len(joined)] if len(joined) else np.zeros(0, bool)
    doc_of, found = doc[: len(joined)][inside], joined[inside]
    # documents with fewer words: the whole sequence
    per_doc = np.bincount(doc, minlength=len(texts))
    short = np.flatnonzero((per_doc > 0) & (per_doc < words))
    if len(short):
        first = np.searchsorted(doc, short)
        whole = np.zeros(len(short), np.uint64)
        for k in range(words - 1):
            more = per_doc[short] > k
            whole[more] = mix(whole[more] * _GOLD + word[first[more] + k])
        whole = mix(whole + per_doc[short].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        doc_of, found = np.r_[doc_of, short], np.r_[found, whole]
        order = np.argsort(doc_of, kind="stable")
        doc_of, found = doc_of[order], found[order]
    return doc_of, found


def passes(texts: list[str]):
    """Runs of texts of at most PASS_BYTES characters, but for single longer ones."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > PASS_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def all_shingles(texts: list[str], words: int):
    """The shingles of each pass, with repeats."""
    for part in passes(texts):
        yield _pass_shingles(part, words)[1]


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The set of each text: sorted distinct 64-bit numbers.

    Words are runs of bytes other than blank and 0x09 to 0x0D after lower-casing A-Z. A text of
    fewer words has its whole sequence as the one shingle, one without words the empty set.
    """
    out = []
    for part in passes(texts):
        doc, found = _pass_shingles(part, words)
        ends = np.searchsorted(doc, np.arange(len(part) + 1))
        out += [np.unique(found[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out
