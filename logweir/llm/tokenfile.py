"""Token ids in files: canonical Huffman codes of limited length, in independent blocks.

A folder holds `code` (token, its code length, from counts over all documents) and `blocks`.
A block holds whole documents in ascending order: their ids and lengths, the codes of all their
tokens without gaps, and the bit offset of every 128th token. Codes are canonical, so lengths
alone give them; a table of all numbers of `LIMIT` bits decodes them, from each offset on its
own.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.llm.library import word_ids
from logweir.llm.tables import id_and_text, run_folder, ship, written

#: Longest code in bits; a vocabulary of more than 2 ** LIMIT tokens raises.
LIMIT = 20
CHECKPOINT = 128
BLOCK_TOKENS = 1 << 18

_IDS = "doc_id long, n_tokens long, ids binary"
_BLOCK = "part int, before long, n_tokens long, doc_ids binary, null_ids binary, doc_tokens binary, bits binary, offsets binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most `limit` bits, by package-merge.

    A token of count 0 gets none; a single token gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("too many tokens for codes of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    coins = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(limit):
        merged = np.concatenate([coins, packages])
        sort = np.argsort(merged, kind="stable")
        levels.append(sort < len(coins))  # which of this level, by weight, are coins
        merged = merged[sort]
        packages = merged[0 : len(merged) - 1 : 2] + merged[1::2]
    take, depth = 2 * len(coins) - 2, np.zeros(len(coins), np.int64)
    for level in reversed(levels):
        coins_taken = int(level[:take].sum())
        depth[:coins_taken] += 1
        take = 2 * (min(take, len(level)) - coins_taken)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each token: by length, then by token, counting up."""
    codes, code, size = np.zeros(len(lengths), np.uint64), 0, 0
    for token in sorted(np.flatnonzero(lengths).tolist(), key=lambda t: (lengths[t], t)):
        code <<= int(lengths[token]) - size
        size = int(lengths[token])
        codes[token] = code
        code += 1
    return codes


@lru_cache(maxsize=2)
def _codes(lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    array = np.frombuffer(lengths, np.uint8)
    return canonical_codes(array) << (np.uint64(64) - np.maximum(array, 1).astype(np.uint64)), array.astype(np.int64)


@lru_cache(maxsize=2)
def _table(lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each number of LIMIT bits: the token whose code it begins with, and its length."""
    array = np.frombuffer(lengths, np.uint8)
    tokens = np.flatnonzero(array)
    tokens = tokens[np.argsort(array[tokens], kind="stable")]
    times = 1 << (LIMIT - array[tokens].astype(np.int64))
    symbol, size = np.zeros(1 << LIMIT, np.uint32), np.ones(1 << LIMIT, np.uint8)
    filled = np.repeat(tokens, times)
    symbol[: len(filled)], size[: len(filled)] = filled, np.repeat(array[tokens], times)
    return symbol, size


def pack_bits(ids: np.ndarray, lengths: bytes) -> tuple[bytes, bytes]:
    """(bits, offsets) of ids: codes one after the other, and where each 128th begins."""
    codes, sizes = _codes(lengths)
    size, code = sizes[ids], codes[ids]  # a code stands at the upper end of its 64 bits
    ends = np.cumsum(size)
    at = ends - size
    words = np.zeros((int(ends[-1]) >> 6) + 2, np.uint64)
    word, bit = at >> 6, (at & 63).astype(np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    words[word[first]] = np.bitwise_or.reduceat(code >> bit, first)
    over = np.flatnonzero(ends - (word << 6) > 64)  # the last code of a word may go on in the next
    words[word[over] + 1] |= code[over] << (np.uint64(64) - bit[over])
    data = words.astype(">u8").tobytes()[: (int(ends[-1]) + 7) // 8]
    return data, at[::CHECKPOINT].astype("<u8").tobytes()


def unpack_bits(bits: bytes, offsets: bytes, n: int, lengths: bytes) -> np.ndarray:
    """The n ids back: all stretches between two offsets are decoded side by side."""
    symbol, size = _table(lengths)
    raw = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
    window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
    at = np.frombuffer(offsets, "<u8").astype(np.int64)
    out = np.zeros((CHECKPOINT, len(at)), np.uint32)
    last = len(window) - 1
    for step in range(CHECKPOINT):
        peek = (window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)) >> np.uint32(32 - LIMIT)
        out[step] = symbol[peek]
        at = at + size[peek]
    return out.T.ravel()[:n]


def _id_kind(path: str, end_id: int) -> str:
    """Two bytes per id, while ids wait to be coded, where the vocabulary allows it."""
    from tokenizers import Tokenizer

    return "<u2" if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def _tokenize(path: str, end_id: int, kind: str, texts_at_once: int = 1024):
    end = np.array([end_id], kind).tobytes()

    def run(batches):
        tool = word_ids(path)
        for whole in batches:
            for at in range(0, whole.num_rows, texts_at_once):
                batch = whole.slice(at, texts_at_once)
                ids = [np.frombuffer(data, "<u4").astype(kind).tobytes() + end for data in tool(batch.column("text").to_pylist())]
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array([len(d) // len(end) for d in ids], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "n_tokens", "ids"],
                )

    return run


def _count(kind: str):
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                data = b"".join(batch.column("ids").slice(start, 512).to_pylist())
                met = np.bincount(np.frombuffer(data, kind))
                if len(met) > len(total):
                    total = np.pad(total, (0, len(met) - len(total)))
                total[: len(met)] += met
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int64)), pa.array(total[used])], ["token", "n"])

    return run


def _encode(lengths: bytes, block_tokens: int, kind: str):
    width = np.dtype(kind).itemsize

    def run(batches):
        part, before, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            doc_ids, data = zip(*held, strict=True)
            ids = np.frombuffer(b"".join(data), kind)
            bits, offsets = pack_bits(ids, lengths)
            values = (
                part, before, len(ids), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                np.array([d is None for d in doc_ids], np.uint8).tobytes(),
                np.array([len(d) // width for d in data], "<i8").tobytes(), bits, offsets,
            )
            kinds = (pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5)
            names = ["part", "before", "n_tokens", "doc_ids", "null_ids", "doc_tokens", "bits", "offsets"]
            return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                held.append((doc_id, data.as_py()))
                size += len(held[-1][1]) // width
                if size >= block_tokens:
                    yield block()
                    before, held, size = before + size, [], 0
        if held:
            yield block()

    return run


def write_token_file(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encodes every document and `end_id`, and stores the ids in `folder` by ascending doc_id.

    Documents are encoded once and kept, zstd-packed, in `folder`/ids until the blocks are
    written; what the driver gets is one count per token of the vocabulary.
    """
    spark = docs.sparkSession
    kind = _id_kind(tokenizer, end_id)
    encoded = id_and_text(docs).mapInArrow(_tokenize(tokenizer, end_id, kind), _IDS)
    encoded.write.option("compression", "zstd").parquet(f"{folder}/ids")
    encoded = spark.read.schema(_IDS).parquet(f"{folder}/ids")
    met = encoded.select("ids").mapInArrow(_count(kind), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.token for r in met), default=-1) + 1, np.int64)
    for r in met:
        counts[r.token] = r.n
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths).tolist()
    spark.createDataFrame([(t, int(lengths[t])) for t in used], "token long, bits int").coalesce(1).write.parquet(f"{folder}/code")
    order = F.asc_nulls_last("doc_id")
    (
        encoded.repartitionByRange(order).sortWithinPartitions(order, "n_tokens", "ids")
        .mapInArrow(_encode(lengths.tobytes(), block_tokens, kind), _BLOCK)
        .write.parquet(f"{folder}/blocks")
    )


def _decode(lengths: bytes):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                sizes = np.frombuffer(r["doc_tokens"], "<i8")
                ids = unpack_bits(r["bits"], r["offsets"], r["n_tokens"], lengths).astype("<u4")
                ends = np.cumsum(sizes)
                nulls = np.frombuffer(r["null_ids"], np.uint8).astype(bool)
                yield pa.record_batch(
                    [
                        pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=nulls), pa.array(ends - sizes + r["base"]), pa.array(sizes),
                        pa.array([ids[e - s : e].tobytes() for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return run


def read_token_file(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ids as little-endian 32-bit numbers.

    `start` counts the ids of all documents before, from the sums that each task of the writer
    stored with its blocks.
    """
    ship(spark)
    code = spark.read.schema("token long, bits int").parquet(f"{folder}/code").collect()  # the vocabulary's size at most
    lengths = np.zeros(max((r.token for r in code), default=-1) + 1, np.uint8)
    for r in code:
        lengths[r.token] = r.bits
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    # a row per task of the writer
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("part_base")
    )
    parts = written(parts, f"{folder}/parts-{uuid.uuid4().hex}")
    placed = blocks.join(parts, "part").withColumn("base", F.col("part_base") + F.col("before"))
    return placed.mapInArrow(
        _decode(lengths.tobytes()), "doc_id long, start long, n_tokens long, ids binary"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Writes the ids of `docs` and gives what read_token_file reads back, a row per row.

    A null or empty text is its end id alone; null ids come last; rows repeated with one id
    stand in the order of their lengths and ids; an empty table gives no rows; other columns
    are not read.
    """
    folder = folder or run_folder(docs.sparkSession)
    write_token_file(docs, tokenizer, folder, end_id)
    return read_token_file(docs.sparkSession, folder)
