"""Spelling variants: words one letter apart, led to the much more frequent form.

Near words are found on a bit-sliced index: for each position and letter a row of bits over the
words. Sets of words that agree with a prefix without error, or with one, move on by one letter
with a few operations on whole rows of bits, for many words at a time.

Of two words one letter apart, cut in half after the shorter one's length, either the first
halves or the second halves are equal. Words therefore meet in blocks of an equal half, and
blocks of very many words are cut into pieces that meet pairwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import id_and_text, run_folder, ship, written

# Fixed value: the letters of a word once A-Z are small.
LETTERS = "[a-zÀ-ÿ]"
#: Words of a block that meet in one piece, and words of small blocks that share an index.
PIECE = 2048
#: Rows of a task that searches.
ROWS_PER_TASK = 60_000
#: Positions whose rows of bits are held at a time.
SLICE = 64


def counted_words(docs: DataFrame, min_length: int = 6, min_count: int = 5, damaged_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters of the whole texts, A-Z made small, that are long and frequent enough.

    With `damaged_every`, a run loses one letter where that number divides the crc32 of
    `<doc_id>:<run>`, the one at the crc32 modulo the run's length; it is judged as it is then.
    A null text has no words, a null doc_id is written as nothing.
    """
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # shorter runs have no match of this, and longer ones are taken whole
    found = F.explode(F.regexp_extract_all(small, F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0)))
    words = id_and_text(docs).select("doc_id", found.alias("word"))
    if damaged_every:
        key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
        words = words.withColumn("h", F.crc32(key.cast("binary")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        without = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        words = words.withColumn("word", F.when(F.col("h") % damaged_every == 0, without).otherwise(F.col("word")))
        words = words.filter(F.char_length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _halves(words: DataFrame, min_length: int) -> DataFrame:
    """(side, shorter, half, word, n): each word in its blocks.

    A word meets those of its length and one more (it is the shorter one), and those of one
    less (they are): two lengths, each with a first and a second half.
    """
    size, shorter = F.char_length("word"), F.col("shorter")
    cut = F.floor(shorter / 2).cast("int")
    lengths = F.explode(F.filter(F.array(size, size - 1), lambda n: n >= min_length)).alias("shorter")
    rows = words.select("word", "n", lengths)
    both = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), cut).alias("half")),
        F.struct(F.lit(1).alias("side"), F.substring("word", size - shorter + cut + 1, shorter).alias("half")),
    )
    return rows.select("word", "n", "shorter", F.inline(both))


def _pieces(blocks: DataFrame, piece: int, folder: str) -> DataFrame:
    """Adds (query, member, role): the pieces in which a word asks (1), is asked about (2), or both (3)."""
    keys = ["side", "shorter", "half"]
    sizes = blocks.groupBy(*keys).agg(F.count("*").alias("size")).filter("size > 1")
    sizes = written(sizes, f"{folder}/sizes")
    rows = blocks.join(sizes, keys).withColumn("cuts", F.ceil(F.col("size") / piece).cast("int"))
    own = F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int")
    asks = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda j: F.struct(own.alias("query"), j.alias("member"), F.lit(1).alias("role")))
    asked = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda j: F.struct(j.alias("query"), own.alias("member"), F.lit(2).alias("role")))
    one = F.array(F.struct(F.lit(0).alias("query"), F.lit(0).alias("member"), F.lit(3).alias("role")))
    places = F.when(F.col("cuts") == 1, one).otherwise(F.concat(asks, asked))
    return rows.select(*keys, "word", "n", F.inline(places))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(words, longest): letters as numbers from 1, 0 behind the end; and the lengths."""
    sizes = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    _, number = np.unique(flat, return_inverse=True)
    out = np.zeros((len(words), int(sizes.max())), np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = number + 1
    return out, sizes


def _rows_of_bits(chosen: np.ndarray) -> np.ndarray:
    """Bits of the last axis as 64-bit numbers."""
    packed = np.packbits(chosen, axis=-1, bitorder="little")
    room = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, room)])).view(np.uint64)


class _Index:
    """For each position and letter the members with it, as bits; a slice of positions at a time."""

    def __init__(self, codes: np.ndarray):
        self._codes, self._letters = codes, np.arange(int(codes.max()) + 1)
        self._from, self._rows = -1, None

    def at(self, position: int) -> np.ndarray:
        """(letters, bits) of a position; beyond the longest member no letter has one."""
        if self._rows is None or not self._from <= position < self._from + SLICE:
            self._from = max(position - 1, 0)
            part = self._codes[:, self._from : self._from + SLICE]
            self._rows = _rows_of_bits(part.T[:, None, :] == self._letters[None, :, None])
            self._rows[:, 0] = 0
        k = position - self._from
        return self._rows[k] if k < len(self._rows) else np.zeros_like(self._rows[0]) if len(self._rows) else np.zeros((len(self._letters), -(-len(self._codes) // 64)), np.uint64)


def near_words(codes: np.ndarray, sizes: np.ndarray, asks: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(asking word, near word): pairs exactly one inserted, deleted or replaced letter apart.

    Four sets move along the letters of an asking word: members that agree so far, those with
    one letter replaced, with one letter more, with one letter less.
    """
    order = np.flatnonzero(asks)
    order = order[np.argsort(-sizes[order], kind="stable")]
    members = np.flatnonzero(asked)
    if not len(order) or not len(members):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index, longest = _Index(codes[members]), int(sizes[order[0]])
    everyone = np.broadcast_to(_rows_of_bits(np.ones(len(members), bool)), (len(order), -(-len(members) // 64)))
    same, more = everyone.copy(), everyone.copy()
    other, less = np.zeros_like(same), np.zeros_like(same)
    behind = None
    here = index.at(0)
    for i in range(longest):
        k = int(np.searchsorted(-sizes[order], -i, side="left"))  # asking words longer than i
        letter = codes[order[:k], i]
        ahead = index.at(i + 1).copy()
        agree = here[letter]
        less[:k] = same[:k] if behind is None else (less[:k] & behind[letter]) | same[:k]
        other[:k] = (other[:k] & agree) | (same[:k] & ~agree)
        same[:k] &= agree
        more[:k] = (more[:k] & ahead[letter]) | same[:k]
        behind, here = here, ahead
    lengths, place = np.unique(sizes, return_inverse=True)
    of_length = _rows_of_bits(np.vstack([place[members][None, :] == np.arange(len(lengths))[:, None], np.zeros((1, len(members)), bool)]))

    def with_length(n):
        at = np.minimum(np.searchsorted(lengths, n), len(lengths) - 1)
        return of_length[np.where(lengths[at] == n, at, len(lengths))]

    own = sizes[order]
    found = (other & with_length(own)) | (more & with_length(own + 1)) | (less & with_length(own - 1))
    hit = np.flatnonzero(found.any(1))
    bits = np.unpackbits(found[hit].view(np.uint8), axis=1, bitorder="little")
    row, column = np.nonzero(bits)
    return order[hit[row]], members[column]


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])


def _search(blocks: list, sides: list[int], shorter: list[int], words: list[str], counts: list[int], roles: list[int]):
    """Of each asking word: its near words in the piece, and the most frequent of them."""
    codes, sizes = _codes(words)
    roles = np.array(roles)
    asking, near = near_words(codes, sizes, roles & 1 > 0, roles & 2 > 0)
    block, sides, shorter, counts = np.array(blocks), np.array(sides), np.array(shorter), np.array(counts)
    heads: dict[str, int] = {}
    head = np.array([heads.setdefault(w[: s // 2], len(heads)) for w, s in zip(words, shorter.tolist(), strict=True)])
    # one block, whose length is the shorter word's; pairs with both halves equal count on the first side
    keep = (block[asking] == block[near]) & (np.minimum(sizes[asking], sizes[near]) == shorter[asking])
    keep &= (sides[asking] == 0) | (head[asking] != head[near])
    asking, near = asking[keep], near[keep]
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -counts[near], asking))
    asking, near = asking[order], near[order]
    first = np.flatnonzero(np.r_[True, asking[1:] != asking[:-1]]) if len(asking) else np.zeros(0, np.int64)
    of, best = asking[first].tolist(), near[first].tolist()
    return pa.record_batch(
        [
            pa.array([words[i] for i in of], pa.string()), pa.array(np.diff(np.r_[first, len(asking)]), pa.int64()),
            pa.array(counts[best], pa.int64()), pa.array([words[i] for i in best], pa.string()),
        ],
        schema=_FOUND,
    )


def _search_all(batches):
    """Blocks come one after the other; small ones share an index until it is full."""
    held = [[] for _ in range(6)]
    last, number = None, -1
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("side", "shorter", "half", "query", "member", "word", "n", "role")]
        for side, shorter, half, query, member, word, n, role in zip(*columns, strict=True):
            key = (side, shorter, half, query, member)
            if key != last:
                # long words, of which few fit in, are not put beside others
                if held[0] and (len(held[0]) >= PIECE or len(held[0]) * max(len(word), len(held[3][-1])) > PIECE * SLICE):
                    yield _search(*held)
                    held = [[] for _ in range(6)]
                last, number = key, number + 1
            for column, value in zip(held, (number, side, shorter, word, n, role), strict=True):
                column.append(value)
    if held[0]:
        yield _search(*held)


def near_counts(words: DataFrame, min_length: int = 6, piece: int = PIECE) -> DataFrame:
    """(word, n_near, near_n, near) of the words that have near ones: how many, and the most frequent.

    `words` are distinct, of at least `min_length` >= 2 letters. What leaves a task is one row
    per word and piece, not the pairs.
    """
    spark, keys = words.sparkSession, ["side", "shorter", "half", "query", "member"]
    folder = run_folder(spark)
    rows = written(_pieces(_halves(words, min_length), piece, folder), f"{folder}/pieces")
    tasks = max(rows.count() // ROWS_PER_TASK + 1, spark.sparkContext.defaultParallelism)
    dealt = rows.repartition(tasks, *keys).sortWithinPartitions(*keys)
    found = dealt.mapInArrow(_search_all, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near")
    )


def spelling_groups(words: DataFrame, ratio: int = 5, min_length: int = 6, piece: int = PIECE) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row per row of `words` (word, n).

    The form is the near word of largest n, of equal ones the first in code-point order, if its
    n is at least `ratio` >= 2 times the word's; else null. The root follows forms to the last.
    Forms grow by the ratio, so a chain is no longer than the logarithm of the largest n, and
    each round doubles how far a word looks. No words give no rows.
    """
    spark = words.sparkSession
    ship(spark)
    folder = run_folder(spark)
    words = written(words.select("word", F.col("n").cast("long").alias("n")), f"{folder}/words")
    near = near_counts(words, min_length, piece)
    much = F.col("near_n") >= ratio * F.col("n")
    out = words.join(near, "word", "left").select(
        "word", F.when(much, F.col("near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(much, F.col("near_n")).alias("form_n"),
    )
    out = written(out, f"{folder}/forms")
    # only words with a form move
    moves = out.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach, chain = 1, 1
    largest = out.agg(F.max("n")).first()[0] or 1
    while ratio**chain <= largest:
        chain += 1
    while reach < chain:
        far = moves.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        moves = written(moves.join(far, "root", "left").select("word", F.coalesce("farther", "root").alias("root")), f"{folder}/roots-{reach}")
        reach *= 2
    return out.join(moves, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
