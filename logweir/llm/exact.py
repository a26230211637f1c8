"""Exact duplicates by a cuckoo filter over content digests.

Each bucket of digests has a filter and the stored keys behind it. A filter hit is checked
against the stored keys, so a false positive never joins two texts; a full filter is built
again, twice as large, from the stored keys. Live digests can be added and taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.llm.tables import free_name, id_and_text

SLOTS = 4
KICKS = 64
#: Hex digits of a digest that name its bucket: 65,536 buckets.
BUCKET_DIGITS = 4


class CuckooIndex:
    """Digest (bytes) -> value, found through a cuckoo filter of 16-bit fingerprints."""

    def __init__(self, capacity: int = 8):
        self._size, self._turn, self.false_hits = 0, -1, 0
        self._build(capacity, [])

    def __len__(self) -> int:
        return self._size

    def _build(self, capacity: int, entries) -> None:
        n = 1
        while n * SLOTS < capacity:
            n *= 2
        self._mask, self._turn = n - 1, self._turn + 1  # each build reads other bytes of the keys
        self._filter = [[] for _ in range(n)]  # fingerprints
        self._stored = {}  # the content: full key and value, in the bucket of its fingerprint
        self._size = 0
        for key, value in entries:
            self.put(key, value)

    def _place(self, key: bytes) -> tuple[int, int]:
        at = 8 * self._turn % max(len(key) - 7, 1)
        return int.from_bytes(key[at : at + 2], "big"), int.from_bytes(key[at + 2 : at + 8], "big") & self._mask

    def _other(self, mark: int, row: int) -> int:
        return (row ^ (mark * 0x5BD1E995)) & self._mask

    def _hit(self, key: bytes) -> bool:
        mark, row = self._place(key)
        return mark in self._filter[row] or mark in self._filter[self._other(mark, row)]

    def get(self, key: bytes):
        """The value of a live key, else None: a filter hit is verified on the stored key."""
        if not self._hit(key):
            return None
        bucket = self._stored.get(self._place(key)[0], {})
        if key not in bucket:
            self.false_hits += 1
            return None
        return bucket[key]

    def put(self, key: bytes, value) -> None:
        mark, row = self._place(key)
        bucket = self._stored.setdefault(mark, {})
        if key in bucket:
            bucket[key] = value
            return
        bucket[key] = value
        self._size += 1
        if not self._insert(mark, row):
            self._build(SLOTS * 2 * (self._mask + 1), list(self.items()))

    def _insert(self, mark: int, row: int) -> bool:
        for at in (row, self._other(mark, row)):
            if len(self._filter[at]) < SLOTS:
                self._filter[at].append(mark)
                return True
        for kick in range(KICKS):
            kept = self._filter[row]
            mark, kept[kick % SLOTS] = kept[kick % SLOTS], mark
            row = self._other(mark, row)
            if len(self._filter[row]) < SLOTS:
                self._filter[row].append(mark)
                return True
        return False

    def take_out(self, key: bytes) -> bool:
        """Ends a live key; one fingerprint goes with it."""
        mark, row = self._place(key)
        bucket = self._stored.get(mark, {})
        if key not in bucket:
            return False
        del bucket[key]
        if not bucket:
            del self._stored[mark]
        at = self._filter[row]
        if mark not in at:
            at = self._filter[self._other(mark, row)]
        at.remove(mark)
        self._size -= 1
        return True

    def items(self):
        for bucket in self._stored.values():
            yield from bucket.items()


_GROUPS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("n", pa.int64()), ("live", pa.bool_())])


def _largest(a, b):
    return b if a is None else a if b is None else max(a, b)


def _flushed(index: CuckooIndex) -> pa.RecordBatch:
    rows = [(key, *value) for key, value in index.items()]
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _GROUPS, strict=True)], _GROUPS)


def _merge_events(batches: Iterator[pa.RecordBatch], bound: int | None) -> Iterator[pa.RecordBatch]:
    """Adds up events (digest, id, count; `live` false ends the digest) through the index.

    Without a bound the rows come in order of their buckets and each bucket is one index. With
    a bound (the pass before the shuffle) the index is handed on whenever it holds so many keys.
    """
    index, bucket = CuckooIndex(), None
    for batch in batches:
        for key, keep, n, live in zip(*(batch.column(c).to_pylist() for c in _GROUPS.names), strict=True):
            if bound is None and key[: BUCKET_DIGITS // 2] != bucket:
                if len(index):
                    yield _flushed(index)
                index, bucket = CuckooIndex(), key[: BUCKET_DIGITS // 2]
            if not live:
                index.take_out(key)
                continue
            known = index.get(key)
            index.put(key, (keep, n, True) if known is None else (_largest(known[0], keep), known[1] + n, True))
            if bound is not None and len(index) >= bound:
                yield _flushed(index)
                index = CuckooIndex()
    if len(index):
        yield _flushed(index)


def digest_groups(digests: DataFrame, map_keys: int = 100_000) -> DataFrame:
    """One row per live digest: (digest, keep_id, n, live) from events of the same columns.

    Repeats are merged by an index in each input task first, so a text that a third of all rows
    hold sends one row per task, then by the index of the digest's bucket. A row whose `live`
    is false must stand after what it ends: give it in a later call with the earlier result.
    """
    kind = "digest binary, keep_id long, n long, live boolean"
    once = digests.mapInArrow(lambda b: _merge_events(b, map_keys), kind)
    return (
        once.repartition("digest")
        .sortWithinPartitions(F.substring(F.hex("digest"), 1, BUCKET_DIGITS), F.desc("live"))
        .mapInArrow(lambda b: _merge_events(b, None), kind)
    )


def live_after(index: DataFrame, added: DataFrame, ended: DataFrame) -> DataFrame:
    """The index (a result of digest_groups) after a batch of additions and deletions.

    `added` has the columns of the index, `ended` those digests that leave. An ended digest
    that is not live changes nothing.
    """
    gone = ended.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("live"))
    return (
        index.unionByName(added).unionByName(gone.dropDuplicates(["digest"]))
        .repartition("digest")
        .sortWithinPartitions(F.substring(F.hex("digest"), 1, BUCKET_DIGITS), F.desc("live"))
        .mapInArrow(lambda b: _merge_events(b, None), "digest binary, keep_id long, n long, live boolean")
    )


def text_digests(docs: DataFrame) -> DataFrame:
    """(digest, keep_id, n, live) of each document: the events that digest_groups reads."""
    return id_and_text(docs).select(
        F.unhex(F.sha2("text", 256)).alias("digest"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("live")
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row per row of `docs`.

    Texts are equal when they are identical; null counts as empty. The largest doc_id of equal
    texts stays, a null id only where all are null. Of rows repeated with that doc_id and text
    one is `kept`. An empty table gives no rows; other columns of `docs` are not read. Texts
    are compared by their SHA-256, verified in full; no text is shuffled.
    """
    own = text_digests(docs).select("digest", F.col("keep_id").alias("doc_id"))
    groups = digest_groups(text_digests(docs)).select("digest", "keep_id", F.col("n").alias("group_size"))
    numbered = own.withColumn("copy", F.row_number().over(W.partitionBy("doc_id", "digest").orderBy(F.lit(1))))
    return numbered.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _row_key(doc_id, digest):
    return F.concat_ws(":", F.hex(digest), F.coalesce(doc_id.cast("string"), F.lit("null")))


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    key = free_name(docs, "row_key")
    kept = exact_duplicates(docs).filter("kept").select(_row_key(F.col("doc_id"), F.unhex("text_sha256")).alias(key))
    digest = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    met = docs.withColumn(key, _row_key(docs["doc_id"].cast("long"), digest)).join(kept.hint("shuffle_hash"), key, "left_semi")
    nth = free_name(docs, "nth")
    numbered = met.withColumn(nth, F.row_number().over(W.partitionBy(key).orderBy(key)))
    return numbered.filter(F.col(nth) == 1).select(*docs.columns)
