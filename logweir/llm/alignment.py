"""Alignment of two tokenizers: groups between common token ends, and which ids end together.

A group of one token of each kind with the same bytes is told by an array from A's ids to B's
and counted in a vector of A's length. Only ids that end together otherwise are counted as pairs
in a shuffle.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import run_folder, ship, written

#: Characters that are encoded at a time, but for a single longer text.
AT_ONCE = 1 << 19
#: Words whose ids a Python worker remembers before it starts anew.
MEMORY = 500_000
# Fixed value: how a byte-level file cuts texts, here for Latin letters only.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
# What that pattern is not taken for: characters beyond Latin ones, and those in it whose class libraries may see otherwise.
_BEYOND = re.compile("[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")


def byte_level_bytes(token: str) -> bytes:
    """What a byte-level token stands for: each of its characters is a byte.

    Printable bytes are written as themselves, the others as the characters from 256 on, in order.
    """
    return bytes(map(_byte_of().__getitem__, token))


def _cuts_at_words(config: dict) -> bool:
    """Whether the file cuts a text by the common byte-level pattern, and does nothing else to it."""
    steps = {k: config.get(k) for k in ("normalizer", "pre_tokenizer")}
    cut = steps["pre_tokenizer"] or {}
    return steps["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b and b != 173)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    """What a piece stands for: <0xHH> is a byte, U+2581 a space."""
    if re.fullmatch("<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Alignment:
    """Two tokenizers with the bytes of their tokens, and which of B's ids have the bytes of A's."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(byte_level)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as f:
            config = json.load(f)
        special = {t["id"] for t in config["added_tokens"]}
        self.a = [b""] * self._a.get_vocab_size()
        for token, i in self._a.get_vocab().items():
            self.a[i] = token.encode() if i in special else byte_level_bytes(token)
        self.b = [piece_bytes(self._b.id_to_piece(i)) for i in range(self._b.get_piece_size())]
        self._sizes = [np.array([len(t) for t in tokens], np.int64) for tokens in (self.a, self.b)]
        # of pieces with the same bytes the last: bytes stand before the pieces made of letters
        of = {t: i for i, t in enumerate(self.b)}
        self.identity = np.array([of.get(t, -1) for t in self.a], np.int64)
        self._written = self._ids_as_text()
        self._by_word = _cuts_at_words(config)
        self._known: dict[str, bytes] = {}

    def _ids_as_text(self) -> np.ndarray:
        """Ids with the mark behind them: `,` inside a group, `|` and `;` at its ends."""
        marked = [f"{i}{m}".encode() for n, end in ((len(self.a), "|"), (len(self.b), ";")) for i in range(n) for m in (",", end)]
        return np.array(marked).view(np.uint8).reshape(len(marked), -1)

    def _library(self, texts: list[str]) -> list[bytes]:
        """A's ids of texts that are given back byte for byte; else nothing."""
        found = [e.ids for e in self._a.encode_batch_fast(texts, add_special_tokens=False)]
        return [
            np.array(ids, np.uint32).tobytes() if b"".join(map(self.a.__getitem__, ids)) == t.encode("utf-8", "surrogatepass") else b""
            for t, ids in zip(texts, found, strict=True)
        ]

    def _ids_a(self, texts: list[str]) -> list[bytes]:
        """A's ids of texts as 32-bit numbers, of Latin letters word by word from what was met before."""
        plain = [self._by_word and not _BEYOND.search(t) for t in texts]
        cut = [_WORDS.findall(t) for t, p in zip(texts, plain, strict=True) if p]
        met = set().union(*cut)
        if len(self._known) + len(met) > MEMORY:
            self._known.clear()
        new = list(met - self._known.keys())
        self._known.update(zip(new, self._library(new), strict=True))
        words = (b"".join(map(self._known.__getitem__, w)) for w in cut)
        others = iter(self._library([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(words) if p else next(others) for p in plain]

    def __call__(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, digest, A's ids of equal groups, pairs of the others) of each text.

        A pair is a * |B| + b. A text without bytes, or whose tokens do not give back its bytes
        behind a space, has no tokens.
        """
        out, full = [(0, 0, 0, "", b"", np.zeros(0, np.int64))] * len(texts), [i for i, t in enumerate(texts) if t]
        ids_a, ids_b = self._ids_a([" " + texts[i] for i in full]), self._b.encode([texts[i] for i in full], num_threads=1)
        kept = [
            k for k, i in enumerate(full)
            if ids_a[k] and b"".join(map(self.b.__getitem__, ids_b[k])) == b" " + texts[i].encode("utf-8", "surrogatepass")
        ]
        if not kept:
            return out
        n_a, n_b = np.array([len(ids_a[k]) // 4 for k in kept]), np.array([len(ids_b[k]) for k in kept])
        a = np.frombuffer(b"".join(ids_a[k] for k in kept), np.uint32).astype(np.int64)
        b = np.fromiter(chain.from_iterable(ids_b[k] for k in kept), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self._sizes[0][a]), np.cumsum(self._sizes[1][b])
        met = np.zeros(int(ends_a[-1]) + 1, np.uint8)
        met[ends_a] += 1
        met[ends_b] += 2
        last_a, last_b = met[ends_a] == 3, met[ends_b] == 3
        to_a, to_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1  # tokens up to the end of each group
        size_a, size_b = np.diff(np.r_[0, to_a]), np.diff(np.r_[0, to_b])
        end_a, end_b = a[to_a - 1], b[to_b - 1]
        equal = (size_a == 1) & (size_b == 1) & (self.identity[end_a] == end_b)
        # A's tokens of a group, then B's
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(to_b - size_b, size_a)] = 2 * a + last_a
        codes[np.arange(len(b)) + np.repeat(to_a, size_b)] = 2 * (len(self.a) + b) + last_b
        shown = self._written[codes]
        there = shown > 0
        text = shown[there].tobytes()
        text_ends = np.cumsum(there.sum(1))[np.cumsum(n_a + n_b) - 1].tolist()
        group_ends = np.searchsorted(to_a, np.cumsum(n_a)) + 1
        narrow = np.min_scalar_type(len(self.a))
        pairs, start, at = end_a * len(self.b) + end_b, 0, 0
        for k, (i, n, m, stop, to) in enumerate(zip([full[k] for k in kept], n_a.tolist(), n_b.tolist(), text_ends, group_ends.tolist(), strict=True)):
            same = equal[at:to]
            out[i] = (n, m, to - at, hashlib.sha256(text[start : stop - 1]).hexdigest(), end_a[at:to][same].astype(narrow).tobytes(), pairs[at:to][~same])
            start, at = stop, to
        return out

    def ids_of(self, stored: bytes) -> np.ndarray:
        return np.frombuffer(stored, np.min_scalar_type(len(self.a)))


@lru_cache(maxsize=2)
def alignment(byte_level: str, pieces: str) -> Alignment:
    """One per Python worker."""
    return Alignment(byte_level, pieces)


def _in_parts(texts: list[str]):
    part, held = [], 0
    for text in texts:
        if part and held + len(text) > AT_ONCE:
            yield part
            part, held = [], 0
        part.append(text)
        held += len(text)
    if part:
        yield part


_ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("groups_sha256", pa.string()), ("equal", pa.binary()), ("pairs", pa.list_(pa.int64())),
    ]
)


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, equal, pairs): each text's groups, before any count."""
    ship(docs.sparkSession)

    def run(batches):
        tool = alignment(byte_level, pieces)
        for batch in batches:
            at = 0
            for part in _in_parts(batch.column("text").to_pylist()):
                columns = [pa.array(c, t) for c, t in zip(zip(*tool(part), strict=True), _ALIGNED.types[1:], strict=True)]
                yield pa.record_batch([batch.column("doc_id").slice(at, len(part)), *columns], schema=_ALIGNED)
                at += len(part)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, equal binary, pairs array<long>"
    )


def _equal_counts(rows: DataFrame, byte_level: str, pieces: str) -> np.ndarray:
    """How often each of A's ids makes a group with its equal: a vector per task, added up."""

    def run(batches):
        tool = alignment(byte_level, pieces)
        total = np.zeros(len(tool.a), np.int64)
        for batch in batches:
            total += np.bincount(tool.ids_of(b"".join(batch.column("equal").to_pylist())), minlength=len(total))
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["a", "n"])

    found = rows.select("equal").mapInArrow(run, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    out = np.zeros(len(alignment(byte_level, pieces).a), np.int64)
    for a, n in found.collect():  # a row per id of the vocabulary at most
        out[a] = n
    return out


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per row of `docs`.

    A is a byte-level file of tokenizers and encodes a space and the text, B a model of
    sentencepiece that puts the space there itself; both can be read on every executor. Tokens
    of A and B that end at the same byte are linked; every token has bytes, so a group has one
    link, between its last tokens. A link's count is how many links of the whole table have its
    ids; it is best if no other id of A has more with its id of B.

    Null, empty and not exactly rebuilt texts have no tokens, zeros, and '' as their digest.
    Null ids and repeated rows keep their rows and count once per row; an empty table gives
    none; other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    folder = run_folder(spark)
    tool = alignment(byte_level, pieces)
    rows = written(aligned(docs, byte_level, pieces).withColumn("row", F.monotonically_increasing_id()), f"{folder}/aligned")
    equal = _equal_counts(rows, byte_level, pieces)
    each = rows.select("row", F.explode("pairs").alias("pair"))
    counts = written(each.groupBy("pair").agg(F.count("*").alias("n")), f"{folder}/counts")
    # the highest count of each id of B, from both kinds of links: a row per id at most
    highest = np.zeros(len(tool.b), np.int64)
    there = np.flatnonzero(equal)
    np.maximum.at(highest, tool.identity[there], equal[there])
    for b, n in counts.groupBy((F.col("pair") % len(tool.b)).alias("b")).agg(F.max("n")).collect():
        highest[b] = max(highest[b], n)
    best_of = spark.createDataFrame(pa.table({"b": np.arange(len(highest)), "highest": highest}).to_pandas())
    ranked = counts.join(F.broadcast(best_of), F.col("pair") % len(tool.b) == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("highest")).cast("long").alias("best")
    )
    per_text = each.groupBy("row", "pair").agg(F.count("*").alias("times"))
    others = per_text.join(ranked, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("other_sum"), F.sum(F.col("times") * F.col("best")).alias("other_best")
    )
    sent = spark.sparkContext.broadcast((equal, (equal > 0) & (equal == highest[tool.identity])))  # two vectors of the vocabulary

    def run(batches):
        local = alignment(byte_level, pieces)
        for batch in batches:
            found = [local.ids_of(x) for x in batch.column("equal").to_pylist()]
            sums = [pa.array([int(of[ids].sum()) for ids in found], pa.int64()) for of in sent.value]
            yield pa.record_batch([*(batch.column(c) for c in _KEPT), *sums], [*_KEPT, "equal_sum", "equal_best"])

    own = rows.select(*_KEPT, "equal").mapInArrow(
        run, "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, equal_sum long, equal_best long"
    )
    none = F.lit(0).cast("long")
    return own.join(others, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("equal_best") + F.coalesce("other_best", none)).alias("n_best"),
        (F.col("equal_sum") + F.coalesce("other_sum", none)).alias("count_sum"), "groups_sha256",
    )


_KEPT = ("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
