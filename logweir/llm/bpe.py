"""Byte-level BPE by dynamic programming over prefixes.

The encoding of every byte prefix ends in exactly one token, so one number per byte holds the
encodings of all prefixes. A prefix's last token is the one whose neighbour before it, the
last token of the prefix it leaves, would not merge with it differently: two tokens may stand
side by side if merging their joined bytes gives these two again. Bytes can be appended
without touching what is there, and after an edit only the prefixes up to where the old
last tokens return are computed again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from logweir.llm.tables import id_and_text

#: Entries of each of a worker's memories (pairs, pieces, words), and as many older ones.
MEMORY = 300_000
#: Characters of a piece or word that is remembered.
LONG = 64
# Fixed value: the pattern for which texts may be cut before blanks.
COMMON = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BLANK_BEFORE_SPACE = re.compile(r"\s ")


class _Memory(dict):
    """Results by key, bounded: what was not asked for since the last half is forgotten."""

    def __init__(self, make, bound: int = MEMORY):
        super().__init__()
        self._make, self._bound, self._older = make, bound, {}

    def __missing__(self, key):
        made = self._older.get(key)
        if made is None:
            made = self._make(key)
        if len(self) >= self._bound:
            self._older = dict(self)
            self.clear()
        self[key] = made
        return made


class Vocabulary:
    """Tokens with ranks: the rank is the id and the order of merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks), default=1)
        # sizes of the tokens that end in the same three bytes, or fewer, the longest first
        ends: dict[bytes, set[int]] = {}
        for token in ranks:
            ends.setdefault(token[-3:], set()).add(len(token))
        self.sizes = {
            end: sorted({*sizes, *(n for n in (1, 2) if end[-n:] in ranks)}, reverse=True) for end, sizes in ends.items()
        }
        # whether two tokens may stand side by side, by left * number of tokens + right
        self.pairs: dict[int, bool] = {}
        # whether merging a token's bytes gives the token: 1 yes, 2 no, 0 not known yet
        self.whole = bytearray(len(self.tokens))
        self._halves: dict[int, tuple[int, int] | None] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a file of lines: base64 token, blank, rank."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def merged(self, data: bytes, parts_left: int = 1) -> list[int]:
        """The encoding by merging the lowest rank first: the definition, for a few bytes."""
        parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
        while len(parts) > parts_left:
            pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(pairs)
            if best == 1 << 60:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens that a token is last merged from; None for one that is never made."""
        known = self._halves.get(token, 0)
        if known == 0:
            data = self.tokens[token]
            if len(data) == 1:
                known = (token, token)
            else:
                parts = self.merged(data, 2)
                known = (parts[0], parts[1]) if len(parts) == 2 and self.merged(data) == [token] else None
            self._halves[token] = known
        return known

    def is_whole(self, token: int) -> bool:
        if not self.whole[token]:
            self.whole[token] = 2 if self.halves(token) is None else 1
        return self.whole[token] == 1

    def follows(self, pair: int) -> bool:
        """Whether no merge crosses the border of two tokens.

        Undoing the later of the two tokens' last merges, again and again, passes through all
        pairs of parts that met at the border, each until a known rank: a merge of the two
        below that rank would have come first. Of equal ranks the left merge comes first.
        """
        known = self.pairs.get(pair)
        if known is not None:
            return known
        left, right = divmod(pair, len(self.tokens))
        tokens, ranks, before, known = self.tokens, self.ranks, 1 << 60, None
        while known is None:
            if ranks.get(tokens[left] + tokens[right], 1 << 60) < before:
                known = False
            elif len(tokens[left]) == 1 and len(tokens[right]) == 1:
                known = True
            elif len(tokens[right]) == 1 or (len(tokens[left]) > 1 and left > right):
                left, before = self.halves(left)[1], left
            else:
                right, before = self.halves(right)[0], right + 1
        if len(self.pairs) >= MEMORY:
            self.pairs.clear()
        self.pairs[pair] = known
        return known


class PrefixEncoding:
    """Bytes with the last token of each of their prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = bytearray()
        self.last: list[int] = []
        self.append(data)

    def _extend(self, data: bytes, stop: int) -> None:
        """Finds the last token of each prefix up to `stop` that has none yet."""
        v, last = self.vocabulary, self.last
        sizes, ranks, whole, pairs, n = v.sizes, v.ranks, v.whole, v.pairs, len(v.tokens)
        for end in range(len(last) + 1, stop + 1):
            for size in sizes.get(data[end - 3 if end > 3 else 0 : end]) or (2, 1):
                begin = end - size
                if begin < 0:
                    continue
                token = ranks.get(data[begin:end])
                if token is None or not (whole[token] == 1 or v.is_whole(token)):
                    continue
                if begin:
                    pair = last[begin - 1] * n + token
                    fits = pairs.get(pair)
                    if not (v.follows(pair) if fits is None else fits):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("the vocabulary does not cover all bytes")

    def append(self, data: bytes) -> None:
        """Adds bytes at the end; the encodings of all earlier prefixes stay as they are."""
        self.data += data
        self._extend(bytes(self.data), len(self.data))

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Puts `data` in place of bytes start to stop; returns how many prefixes were redone.

        A last token depends on the bytes of the longest token and on the last tokens of that
        many prefixes before it: once as many in a row have come out as before, so do all.
        """
        v, after = self.vocabulary, self.last[stop:]
        self.data[start:stop] = data
        whole, same = bytes(self.data), 0
        self.last = self.last[:start]
        edit_end = start + len(data)
        for end in range(start + 1, len(whole) + 1):
            self._extend(whole, end)
            if end > edit_end:
                same = same + 1 if self.last[-1] == after[end - edit_end - 1] else 0
                if same >= v.longest:
                    self.last += after[end - edit_end :]
                    return end - start
        return len(whole) - start

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first `end` bytes, of all by default."""
        at, out = len(self.data) if end is None else end, []
        while at > 0:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


class TextEncoder:
    """Whole texts: each match of the pattern is encoded by itself.

    A match of the common pattern never goes from a character that is not white space on to
    white space, so text may be cut before any blank that follows such a character: what such a
    cut gives, about a word, is looked up. With another pattern its matches alone are.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self._pattern, self._cuts = regex.compile(pattern), pattern == COMMON
        self._pieces = _Memory(self._piece)
        self._after_blank = _Memory(self._word)
        # the last token of byte prefixes, whatever piece they have been met in
        self._prefixes = _Memory(self._last_token)

    def _last_token(self, prefix: bytes) -> int:
        """The last token of a prefix that is not known yet, from those of shorter ones."""
        v, known, end = self.vocabulary, self._prefixes, len(prefix)
        for size in v.sizes.get(prefix[-3:]) or (2, 1):
            begin = end - size
            if begin < 0:
                continue
            token = v.ranks.get(prefix[begin:])
            if token is None or not (v.whole[token] == 1 or v.is_whole(token)):
                continue
            if begin == 0 or v.follows(known[prefix[:begin]] * len(v.tokens) + token):
                return token
        raise ValueError("the vocabulary does not cover all bytes")

    def _piece(self, piece: str) -> tuple[int, ...]:
        data, tokens = piece.encode(), self.vocabulary.tokens
        known = self.vocabulary.ranks.get(data)  # as the library: a piece that is a token is that token
        if known is not None:
            return (known,)
        if len(data) > 4 * LONG:
            return tuple(PrefixEncoding(self.vocabulary, data).ids())
        out, end = [], len(data)
        while end:
            out.append(self._prefixes[data[:end]])
            end -= len(tokens[out[-1]])
        return tuple(out[::-1])

    def _matches(self, text: str):
        pieces = self._pieces
        return chain.from_iterable([pieces[p] if len(p) <= LONG else self._piece(p) for p in self._pattern.findall(text)])

    def _word(self, word: str) -> tuple[int, ...]:
        """A blank and a word; letters, and marks behind them, need no pattern."""
        letters = word.rstrip(".,;:!?")
        if letters.isalpha():
            ids = self._pieces[" " + letters]
            return ids if letters == word else ids + self._pieces[word[len(letters) :]]
        return tuple(self._matches(" " + word))

    def encode(self, text: str) -> list[int]:
        if not self._cuts or _BLANK_BEFORE_SPACE.search(text):
            return list(self._matches(text))
        head, *words = text.split(" ")
        if max(map(len, words), default=0) > LONG:
            return list(self._matches(text))
        return [*self._matches(head), *chain.from_iterable(map(self._after_blank.__getitem__, words))]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> TextEncoder:
    """One per Python worker, so that its memories last from task to task."""
    return TextEncoder(Vocabulary.read(path), pattern)


def _encoded(path: str, pattern: str, summary: bool, texts_at_once: int = 512):
    def run(batches):
        tool = encoder(path, pattern)
        names = list(map(str, range(len(tool.vocabulary.tokens))))
        for whole in batches:
            for at in range(0, whole.num_rows, texts_at_once):
                batch, rows = whole.slice(at, texts_at_once), []
                for text in batch.column("text"):
                    ids = tool.encode(text.as_py())
                    data = tool.decode(ids)
                    if summary:
                        joined = ",".join(map(names.__getitem__, ids)).encode()
                        rows.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(data).hexdigest()))
                    else:
                        rows.append((ids, data))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.string(), pa.string()) if summary else (pa.list_(pa.int32()), pa.binary())
                fields = ("n_tokens", "ids_sha256", "decoded_sha256") if summary else ("ids", "decoded")
                yield pa.record_batch(
                    [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", *fields]
                )

    return run


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded), a row per row of `docs`: the ids, and the bytes they decode to.

    `vocabulary` is a rank file readable on every executor. Each match of `pattern` is encoded
    by itself; there are no special tokens. A null text is empty and has no ids; null ids and
    repeated rows keep their rows; an empty table gives none; other columns are not read.
    """
    return id_and_text(docs).mapInArrow(_encoded(vocabulary, pattern, False), "doc_id long, ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """As encode_texts, with (doc_id, n_tokens, ids_sha256, decoded_sha256) in place of both."""
    return id_and_text(docs).mapInArrow(
        _encoded(vocabulary, pattern, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
