"""Passages that an earlier document holds, found in sorted suffixes.

A passage is a string of 50 bytes. Every passage has an anchor, the 24 bytes in it with the
least hash, so equal passages have equal anchors at equal places; about one position in 14 is
an anchor. The work runs over blocks of whole documents:

1. each block sends the distinct hashes of its anchors, and learns which of them other
   documents have too;
2. it sorts the suffixes that begin at those anchors, puts equal ones together, and sends them
   as front-coded runs, with the bytes to the left of the anchor that passages may reach;
3. the runs of a bucket of anchors are merged by a loser tree that uses the prefixes known from
   the coding; the merged order with its common prefixes, and the order of the left sides, tell
   for each passage of each suffix the least document that holds it;
4. each block takes back those documents and marks the bytes of its own later ones.

An anchor that very many suffixes begin with is sent as single passages, which have buckets of
their own, so neither a frequent line nor its many surroundings meet in one task.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.merge import common_prefixes, front_code, front_decode, merge_runs
from logweir.llm.shingles import mix
from logweir.llm.tables import free_name, id_and_text, run_folder, ship, written

PASSAGE, ANCHOR = 50, 24
REACH = PASSAGE - ANCHOR  # the farthest a passage begins before its anchor
BLOCK_BYTES = 2 << 20
#: Text per bucket of anchors.
BUCKET_BYTES = 4 << 20
#: Suffixes of one anchor from which its passages go apart.
FREQUENT = 4096
_NO_DOC = np.iinfo(np.int64).max
_SEGMENT = 1 << 17


def _packed(*arrays: np.ndarray) -> bytes:
    sizes = np.array([a.nbytes for a in arrays], np.int64)
    return zstandard.ZstdCompressor(3).compress(b"".join([sizes.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)]))


def _unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    at = np.cumsum(np.r_[8 * len(kinds), sizes])
    return [np.frombuffer(raw[a:b], k) for a, b, k in zip(at[:-1], at[1:], kinds, strict=True)]


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes from each position on, for all but the last ones."""
    n = len(data) - ANCHOR + 1
    w = data.astype(np.uint64)
    for size in (1, 2, 4):
        w = w[:-size] | w[size:] << np.uint64(8 * size)  # as many bytes again
    w = w * np.uint64(0x9E3779B97F4A7C15)
    return mix((w[:n] ^ (w[8 : n + 8] >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95) + (w[8 : n + 8] ^ w[16 : n + 16] << np.uint64(17) ^ w[16 : n + 16] >> np.uint64(31)))


def _owners(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the anchor, its hash) of the passage from each position on."""
    h = _anchor_hashes(data)
    # the least of REACH + 1 hashes by their upper 40 bits, the first of equal ones
    least = h >> np.uint64(24) << np.uint64(24) | np.arange(len(h), dtype=np.uint64)
    for step in (1, 2, 4, 8):
        least = np.minimum(least[:-step], least[step:])
    rest = REACH + 1 - 16
    least = np.minimum(least[:-rest], least[rest:])
    place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    # least hashes are small ones: spread again, or the first buckets get most anchors
    return place, mix(h[place])


def _stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, first and last passage, hash, document) of each anchor, a segment at a time.

    An anchor's passages are one stretch of positions; passages across documents are none.
    """
    found = []
    for start in range(0, len(data) - PASSAGE + 1, _SEGMENT):
        own, value = _owners(data[start : start + _SEGMENT + PASSAGE - 1])
        at = np.arange(start, start + len(own))
        doc = np.searchsorted(ends, at, side="right")
        whole = np.flatnonzero(ends[doc] - at >= PASSAGE)
        if not len(whole):
            continue
        own, at = own[whole] + start, at[whole]
        new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (np.diff(at) != 1)])
        last = at[np.r_[new[1:], len(at)] - 1]
        part = [own[new], at[new], last, value[whole][new], doc[whole][new]]
        if found and found[-1][0][-1] == part[0][0] and found[-1][2][-1] + 1 == part[1][0]:
            found[-1][2][-1] = part[2][0]  # a stretch goes on in the next segment
            part = [p[1:] for p in part]
        if len(part[0]):
            found.append(part)
    if not found:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


class _Block:
    """Documents one after the other, and the anchors of their passages."""

    def __init__(self, row: dict):
        self.ids, self.sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        self.text = zstandard.ZstdDecompressor().decompress(row["packed"])
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(self.text, np.uint8)
        self.at, self.first, self.last, self.hash, doc = _stretches(self.data, self.ends)
        self.doc = self.ids[doc]
        self.order = np.argsort(self.hash, kind="stable")
        sorted_hash = self.hash[self.order]
        self.starts = np.flatnonzero(np.r_[True, sorted_hash[1:] != sorted_hash[:-1]]) if len(self.hash) else np.zeros(0, np.int64)
        self.distinct = sorted_hash[self.starts]

    def cuts(self, keys: np.ndarray, buckets: int) -> np.ndarray:
        return np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))

    def counted(self) -> np.ndarray:
        """Per distinct hash how many suffixes (127 at most), and 128 if in several documents."""
        times = np.diff(np.r_[self.starts, len(self.order)])
        doc = self.doc[self.order]
        several = np.maximum.reduceat(doc, self.starts) != np.minimum.reduceat(doc, self.starts)
        return (np.minimum(times, 127) | several * 128).astype(np.uint8)

    def records(self, told: np.ndarray, buckets: int) -> _Records:
        """The suffixes to send, from what is told per distinct hash: 1 shared, 2 frequent too."""
        per_anchor = np.zeros(len(self.hash), np.uint8)
        per_anchor[self.order] = np.repeat(told, np.diff(np.r_[self.starts, len(self.order)]))
        usual, often = np.flatnonzero(per_anchor == 1), np.flatnonzero(per_anchor == 2)
        times = (self.last - self.first + 1)[often]
        single = np.repeat(self.first[often], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = np.r_[self.at[usual], single]
        low = np.r_[(self.at - self.last)[usual], np.zeros(len(single), np.int64)]
        high = np.r_[(self.at - self.first)[usual], np.zeros(len(single), np.int64)]
        doc = np.r_[self.doc[usual], np.repeat(self.doc[often], times)]
        padded = np.r_[np.zeros(REACH, np.uint8), self.data, np.zeros(PASSAGE, np.uint8)]
        suffix = np.lib.stride_tricks.sliding_window_view(padded[REACH:], PASSAGE)[at]
        left = np.lib.stride_tricks.sliding_window_view(padded, REACH)[at][:, ::-1].copy()
        suffix[np.arange(PASSAGE) >= PASSAGE - low[:, None]] = 0
        left[np.arange(REACH) >= high[:, None]] = 0
        return _Records(at, low, high, doc, suffix, left, np.r_[self.hash[usual], _row_hash(suffix[len(usual) :])], buckets)


def _row_hash(rows: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8)))).view(np.uint64)
    out = np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return out


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


class _Records:
    """Suffixes of a block, equal ones together, sorted within their buckets."""

    def __init__(self, at, low, high, doc, suffix, left, key, buckets):
        rows = np.concatenate([suffix, left, low[:, None].astype(np.uint8) + 1, high[:, None].astype(np.uint8) + 1], axis=1)
        order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable") if len(rows) else np.zeros(0, np.int64)
        bucket = _bucket(key, buckets)
        order = order[np.argsort(bucket[order], kind="stable")]
        rows, bucket = rows[order], bucket[order]
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (rows[1:] != rows[:-1]).any(1)] if len(rows) else np.zeros(0, bool)
        self.starts = np.flatnonzero(new)
        self.members, self.at, self.doc = order, at, doc
        self.first_of = self.starts
        first = order[self.starts]
        self.low, self.high, self.suffix, self.left = low[first], high[first], suffix[first], left[first]
        self.cuts = np.searchsorted(bucket[self.starts], np.arange(buckets + 1))
        if len(order):
            self.least = np.minimum.reduceat(doc[order], self.starts)
            self.most = np.maximum.reduceat(doc[order], self.starts)

    def run(self, bucket: int) -> bytes | None:
        """The front-coded run of a bucket."""
        a, b = self.cuts[bucket], self.cuts[bucket + 1]
        if a == b:
            return None
        shared, sizes = common_prefixes(self.suffix[a:b]), PASSAGE - self.low[a:b]
        shared = np.minimum(shared, sizes)
        left = self.left[a:b][np.arange(REACH) < self.high[a:b, None]]
        return _packed(
            front_code(self.suffix[a:b], shared, sizes), shared.astype(np.uint8), left,
            self.low[a:b].astype(np.uint8), self.high[a:b].astype(np.uint8), self.least[a:b], self.most[a:b],
        )


def _blocks(text_at: int, block_bytes: int):
    """Rows to blocks: their other columns as an Arrow stream, ids, sizes and the joined text."""

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            text = batch.column(text_at).fill_null("").cast(pa.binary())
            size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
            start = 0
            while start < batch.num_rows:
                stop = start + max(1, int(np.searchsorted(np.cumsum(size[start:]), block_bytes, side="right")))
                piece = batch.slice(start, stop - start)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema.remove(text_at)) as writer:
                    writer.write_batch(pa.record_batch([c for i, c in enumerate(piece.columns) if i != text_at], schema=piece.schema.remove(text_at)))
                ids = piece.column(0).cast(pa.int64()).fill_null(_NO_DOC).to_numpy()
                packed = zstandard.ZstdCompressor(3).compress(b"".join(text.slice(start, stop - start).to_pylist()))
                yield pa.record_batch(
                    [
                        pa.array([part << 32 | nth]), pa.array([int(size[start:stop].sum())]), pa.array([ids.tobytes()], pa.binary()),
                        pa.array([size[start:stop].tobytes()], pa.binary()), pa.array([packed], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                    ],
                    ["block", "n_bytes", "ids", "sizes", "packed", "rest"],
                )
                start, nth = stop, nth + 1

    return run


_BLOCK = "block long, n_bytes long, ids binary, sizes binary, packed binary, rest binary"
_PART = "bucket int, block long, data binary"


def _part(bucket, block, data) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(v, k) for v, k in zip((bucket, block, data), kinds, strict=True)], ["bucket", "block", "data"])


def _each(batches):
    """Row after row: a row is a block, of which one at a time is unpacked."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _send_hashes(buckets: int):
    def run(batches):
        for row in _each(batches):
            block = _Block(row)
            if not len(block.distinct):
                continue
            counted, cuts = block.counted(), block.cuts(block.distinct, buckets)
            used = np.flatnonzero(np.diff(cuts)).tolist()
            data = [_packed(np.diff(block.distinct[cuts[b] : cuts[b + 1]], prepend=np.uint64(0)), counted[cuts[b] : cuts[b + 1]]) for b in used]
            yield _part(used, [row["block"]] * len(used), data)

    return run


def _by_bucket(batches):
    """(bucket, blocks, data) of rows sorted by bucket."""
    key, blocks, data = None, [], []
    for batch in batches:
        for bucket, block, item in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "data")), strict=True):
            if bucket != key and blocks:
                yield key, blocks, data
                blocks, data = [], []
            key = bucket
            blocks.append(block)
            data.append(item)
    if blocks:
        yield key, blocks, data


def _tell_shared(frequent: int):
    """For each hash of each block: 0 if one document has it, 1 if several, 2 if very many suffixes."""

    def run(batches):
        for bucket, blocks, data in _by_bucket(batches):
            parts = [_unpacked(d, np.uint64, np.uint8) for d in data]
            sizes = [len(p[1]) for p in parts]
            hashes, counted = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(hashes, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0])
            n_blocks = np.diff(np.r_[starts, len(order)])
            several = (n_blocks > 1) | (np.maximum.reduceat(counted[order], starts) >= 128)
            often = np.add.reduceat((counted[order] & 127).astype(np.int64), starts) >= frequent
            told = np.zeros(len(order), np.uint8)
            told[order] = np.repeat(several * (1 + often), n_blocks).astype(np.uint8)
            cut = np.cumsum([0, *sizes])
            yield _part([bucket] * len(blocks), blocks, [_packed(told[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)])

    return run


def _told(parts) -> np.ndarray:
    """What all buckets told a block, in the order of its hashes."""
    found = [_unpacked(p["data"], np.uint8)[0] for p in sorted(parts or [], key=lambda p: p["bucket"])]
    return np.concatenate(found) if found else np.zeros(0, np.uint8)


def _send_runs(buckets: int):
    def run(batches):
        for row in _each(batches):
            told = _told(row["told"])
            if not told.any():
                continue
            records = _Block(row).records(told, buckets)
            runs = [(b, data) for b in np.flatnonzero(np.diff(records.cuts)).tolist() if (data := records.run(b))]
            yield _part([b for b, _ in runs], [row["block"]] * len(runs), [d for _, d in runs])

    return run


def _least_documents(shared: np.ndarray, left: np.ndarray, low, high, least) -> np.ndarray:
    """(record, l): the least document of the passage that begins l bytes before the anchor.

    The records are in the order of their suffixes, `shared` long prefixes alike. Two passages
    are equal if their suffixes share PASSAGE - l bytes and their left sides l bytes.
    """
    n = len(shared)
    words = np.ascontiguousarray(np.pad(left, ((0, 0), (0, -REACH % 8)))).view(">u8")
    order = np.lexsort(words.T[::-1])
    left_shared = common_prefixes(left[order])
    out = np.full((n, REACH + 1), _NO_DOC)
    for far in range(REACH + 1):
        own = np.flatnonzero((low <= far) & (high >= far))
        if not len(own):
            continue
        left_class = np.empty(n, np.int64)
        left_class[order] = np.cumsum(left_shared < far)
        key = (np.cumsum(shared < PASSAGE - far) * (n + 1) + left_class)[own]
        by_key = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(key[by_key]) != 0])
        smallest = np.minimum.reduceat(least[own[by_key]], starts)
        out[own[by_key], far] = np.repeat(smallest, np.diff(np.r_[starts, len(own)]))
    return out


def _merge(batches):
    """Runs of a bucket to (record, first and last l, document) for each block."""
    for bucket, blocks, data in _by_bucket(batches):
        runs, parts = [], []
        for item in data:
            tails, shared, left, low, high, least, most = _unpacked(item, np.uint8, np.uint8, np.uint8, np.uint8, np.uint8, np.int64, np.int64)
            rows = front_decode(tails, shared, PASSAGE - low.astype(np.int64), PASSAGE).tobytes()
            runs.append([int.from_bytes(rows[i : i + PASSAGE]) for i in range(0, len(rows), PASSAGE)])
            sides = np.zeros((len(low), REACH), np.uint8)
            sides[np.arange(REACH) < high[:, None]] = left
            parts.append((shared, sides, low, high, least, most))
        from_run, shared = merge_runs(runs, [p[0].tolist() for p in parts], PASSAGE)
        sizes = [len(r) for r in runs]
        run = np.array(from_run, np.int64)
        # a run's records come out in their own order
        place = np.empty(len(run), np.int64)
        by_run = np.argsort(run, kind="stable")
        place[by_run] = np.arange(len(run))
        _, left, low, high, least, most = (np.concatenate(c)[place] for c in zip(*parts, strict=True))
        found = _least_documents(np.array(shared), left, low, high, least)
        useful = (found < most[:, None])[by_run]
        found = found[by_run]  # now in the order of blocks and their records
        opens = useful & np.c_[np.ones(len(found), bool), ~useful[:, :-1] | (found[:, 1:] != found[:, :-1])]
        closes = useful & np.c_[~useful[:, 1:] | (found[:, 1:] != found[:, :-1]), np.ones(len(found), bool)]
        record, begin = np.nonzero(opens)
        stop = np.nonzero(closes)[1]
        cut = np.searchsorted(record, np.cumsum([0, *sizes]))
        answers = [
            (block, _packed((record[a:b] - base).astype(np.int64), begin[a:b].astype(np.uint8), stop[a:b].astype(np.uint8), found[record[a:b], begin[a:b]]))
            for block, base, a, b in zip(blocks, np.cumsum([0, *sizes[:-1]]).tolist(), cut[:-1], cut[1:], strict=True)
            if b > a
        ]
        if answers:
            yield _part([bucket] * len(answers), [a for a, _ in answers], [d for _, d in answers])


def _removed(row: dict, buckets: int) -> tuple[_Block | None, bytes, np.ndarray, np.ndarray]:
    """(text, document sizes, mask of removed bytes) of a block."""
    sizes = np.frombuffer(row["sizes"], np.int64)
    if not row["answers"]:
        text = zstandard.ZstdDecompressor().decompress(row["packed"])
        return text, sizes, np.zeros(len(text), bool)
    block = _Block(row)
    records = block.records(_told(row["told"]), buckets)
    depth = np.zeros(len(block.data) + 1, np.int32)
    bounds = np.r_[records.starts, len(records.members)]
    for part in row["answers"]:
        record, near, far, doc = _unpacked(part["data"], np.int64, np.uint8, np.uint8, np.int64)
        record = record + records.cuts[part["bucket"]]
        times = bounds[record + 1] - bounds[record]
        which = np.repeat(np.arange(len(record)), times)
        member = records.members[np.repeat(bounds[record], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        later = doc[which] < records.doc[member]
        at, which = records.at[member][later], which[later]
        np.add.at(depth, at - far[which], 1)
        np.subtract.at(depth, at - near[which] + PASSAGE, 1)
    return block.text, sizes, np.cumsum(depth[:-1], dtype=np.int32) > 0


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))


def _spans(gone: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.r_[False, gone, False].view(np.int8))).tolist()
    return [{"start": a, "length": b - a} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _whole_characters(text: bytes, gone: np.ndarray) -> np.ndarray:
    """A character goes with any of its bytes."""
    data = np.frombuffer(text, np.uint8)
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(starts):
        return gone
    hit = np.logical_or.reduceat(gone, starts)
    return np.repeat(hit, np.diff(np.r_[starts, len(data)]))


def _result(buckets: int, text_name: str | None, schema: pa.Schema | None, count_at: int | None):
    """Blocks with their answers to rows: a report, or the rows with their texts changed."""

    def run(batches):
        for row in _each(batches):
            text, sizes, gone = _removed(row, buckets)
            rest = pa.ipc.open_stream(row["rest"]).read_next_batch()
            ends = np.cumsum(sizes).tolist()
            spans, kept = [], []
            for a, b in zip([0, *ends[:-1]], ends, strict=True):
                mask, own = gone[a:b], text[a:b]
                if schema is not None and mask.any():
                    mask = _whole_characters(own, mask)
                spans.append(_spans(mask))
                kept.append(np.frombuffer(own, np.uint8)[~mask].tobytes() if spans[-1] else own)
            if schema is None:
                yield pa.record_batch(
                    [rest.column(0), pa.array(sizes), pa.array(spans, _SPANS), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "removed", "kept"]
                )
                continue
            columns = {n: rest.column(i) for i, n in enumerate(rest.schema.names)}
            texts = [k.decode() for k in kept]
            columns[text_name] = pa.array(texts, pa.string())
            stays = pa.array([bool(k) or not s for k, s in zip(kept, spans, strict=True)])
            if count_at is not None:
                name = schema.names[count_at]
                changed = pa.array([bool(s) for s in spans])
                columns[name] = pc.if_else(changed, pa.array([len(t) for t in texts]).cast(schema.field(count_at).type), columns[name])
            yield pa.record_batch([columns[n] for n in schema.names], schema.names).filter(stays)

    return run


def _stored_blocks(docs: DataFrame, text_at: int, folder: str, block_bytes: int) -> DataFrame:
    """The blocks as a bucketed table, so that what they are told joins them without moving them."""
    spark = docs.sparkSession
    name, parts = f"llm_blocks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.mapInArrow(_blocks(text_at, block_bytes), _BLOCK).write.option("path", f"{folder}/blocks").option("compression", "none").bucketBy(parts, "block").saveAsTable(name)
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are the folder's
    return blocks


def _searched(docs: DataFrame, text_at: int, frequent: int, block_bytes: int) -> tuple[DataFrame, int]:
    """Blocks with what they were told and answered, and the number of buckets."""
    spark = docs.sparkSession
    ship(spark)
    folder = run_folder(spark)
    blocks = _stored_blocks(docs, text_at, folder, block_bytes)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))

    def dealt(parts: DataFrame) -> DataFrame:
        return parts.repartition("bucket").sortWithinPartitions("bucket", "block")

    def gathered(parts: DataFrame, name: str) -> DataFrame:
        return parts.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(name))

    def stored(parts: DataFrame, name: str) -> DataFrame:
        return written(parts, f"{folder}/{name}")

    told = stored(dealt(blocks.mapInArrow(_send_hashes(buckets), _PART)).mapInArrow(_tell_shared(frequent), _PART), "told")
    with_told = blocks.join(gathered(told, "told"), "block", "left")
    runs = with_told.select("block", "ids", "sizes", "packed", "told").mapInArrow(_send_runs(buckets), _PART)
    answers = stored(dealt(runs).mapInArrow(_merge, _PART), "answers")
    return with_told.join(gathered(answers, "answers"), "block", "left"), buckets


def repeated_passages(docs: DataFrame, frequent: int = FREQUENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_bytes, removed, kept), a row per row of `docs`.

    Removed is each byte of the UTF-8 text that is covered by a string of 50 bytes which also
    begins in a document with a smaller doc_id; strings are judged on the input and never cross
    documents. `removed` holds the maximal spans, `kept` the other bytes. A null text is empty.
    A null doc_id ranks last; rows that share a doc_id, or are repeated, take nothing from each
    other. An empty table gives no rows; other columns of `docs` are not read. `frequent` and
    `block_bytes` change how the work is dealt, never the rows.
    """
    found, buckets = _searched(id_and_text(docs), 1, frequent, block_bytes)
    return found.mapInArrow(
        _result(buckets, None, None, None),
        "doc_id long, n_bytes long, removed array<struct<start: long, length: long>>, kept binary",
    )


def without_repeated_passages(docs: DataFrame, count_col: str | None = None) -> DataFrame:
    """The rows of `docs` with repeated passages taken out of their texts.

    A character goes with any of its bytes, so that texts stay valid. Rows of which nothing is
    left leave; rows that lose nothing stay as they are, null texts as empty ones. `count_col`,
    if given, is set to the number of characters where a text has changed.
    """
    first = docs.select("doc_id", *[c for c in docs.columns if c != "doc_id"])
    found, buckets = _searched(first, first.columns.index("text"), FREQUENT, BLOCK_BYTES)
    fields = first.schema
    arrow = pa.schema([pa.field(f.name, _arrow_type(f.dataType)) for f in fields])
    at = first.columns.index(count_col) if count_col else None
    return found.mapInArrow(_result(buckets, "text", arrow, at), fields).select(*docs.columns)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
