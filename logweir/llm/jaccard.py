"""Documents joined by the Jaccard similarity of their word shingles, exactly.

Several orders of all shingles are fixed: rare ones first, as a sketch of fixed size counts
them, then by a hash that differs from order to order. Similar sets share one of their first
shingles, a tenth or so of the set, under each order. The first order finds the candidates;
within a bucket of candidates a pair is verified only if it shares a prefix shingle under
every order, which is one AND of bit rows per order.

Copies (equal sets) are one node. The members of a prefix shingle's group do not meet in pairs
but at the group's least document, its pivot, so a group of n costs n rows. The more documents,
the more of them share a prefix shingle by chance. So a set also has a row of about as many bits
as shingles, each of which turns a bit over: sets differ in as many shingles as their rows in bits,
or more. Texts go only to buckets where the bits leave their set a partner. A bucket that is
too large for one task is first compared with its pivot alone, in slices: members similar to
it are linked by that; of these only such as can reach a member that is not, by the triangle
inequality of the Jaccard distance, go on with the others to blocks that meet block by block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.components import components
from logweir.llm.shingles import PASS_BYTES, all_shingles, mix, shingle_sets
from logweir.llm.tables import id_and_text, remove, run_folder, written

#: Counters of the sketch, whatever the input. Short shingles, of which many repeat by chance,
#: need more to be told apart; the order they give never changes the result.
SKETCH = 1 << 24
ORDERS = 3
#: What one task holds of a bucket at most: members, and shingles (or one member).
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 1_000_000
#: Members of a bucket whose rows of bits one task holds at most, or twice as many of two blocks.
BITS_MEMBERS = 8192
#: Rows of bits that are compared in one step.
ROWS_AT_ONCE = 128
_CHUNK = 1 << 14
_SEEDS = [np.uint64(0xD1B54A32D192ED03 * (r + 1) & (1 << 64) - 1) for r in range(ORDERS)]


def prefix_size(n: int, percent: int) -> int:
    """How many first shingles of n can be all that similar sets share: n - ceil(t n) + 1."""
    return n - (percent * n + 99) // 100 + 1


def prefix(found: np.ndarray, order: int, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set: by class, then by the order's hash."""
    size = prefix_size(len(found), percent)
    if size >= len(found):
        return found
    rank, key = classes[(found & np.uint64(len(classes) - 1)).astype(np.int64)], mix(found ^ _SEEDS[order])
    upto = np.cumsum(np.bincount(rank))
    last = int(np.searchsorted(upto, size))
    sure = found[rank < last]
    tied = np.flatnonzero(rank == last)
    need = size - len(sure)
    if need < len(tied):
        tied = tied[np.argpartition(key[tied], need - 1)[:need]]
    return np.concatenate([sure, found[tied]])


def rarity_classes(docs: DataFrame, words: int, counters: int = SKETCH) -> np.ndarray:
    """For each counter of the sketch the binary logarithm of its count: a byte each.

    A task's counts end at 65,535, which tells a frequent shingle as well as more would.
    """

    def count(batches):
        total = np.zeros(counters, np.uint16)
        for batch in _slices(batches, "text"):
            for found in all_shingles(batch.column("text").to_pylist(), words):
                place, times = np.unique((found & np.uint64(counters - 1)).astype(np.uint32), return_counts=True)
                total[place] = np.minimum(total[place] + times, 65_535)
        pack = zstandard.ZstdCompressor(1)
        chunks = range(0, counters, _CHUNK)
        yield pa.record_batch(
            [pa.array([c // _CHUNK for c in chunks], pa.int32()), pa.array([pack.compress(total[c : c + _CHUNK].tobytes()) for c in chunks], pa.binary())],
            ["chunk", "counts"],
        )

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(unpack.decompress(data), np.uint16).astype(np.int64)
        classes = [np.frexp(s.astype(np.float64))[1].astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(classes, pa.binary())], ["chunk", "classes"])

    counted = docs.select("text").mapInArrow(count, "chunk int, counts binary")
    rows = counted.repartition("chunk").mapInArrow(add, "chunk int, classes binary").collect()
    out = np.zeros(counters, np.uint8)
    for r in rows:
        out[r.chunk * _CHUNK : (r.chunk + 1) * _CHUNK] = np.frombuffer(r.classes, np.uint8)
    return out


def _slices(batches, column: str, most: int = PASS_BYTES):
    """The batches in slices that hold about so many bytes of a column, or a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        # a slice ends with the row by which it is full
        part = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def set_bits(found: np.ndarray, percent: int) -> bytes:
    """A row of bits, each the parity of the shingles that fall on it.

    A power of two of them, eight times the shingles that two similar sets of half the size
    can differ in, or more: sets without common shingles then differ in far more bits.
    """
    size = max(64, 1 << (-(-8 * len(found) * (100 - percent) // (100 + percent)) - 1).bit_length())
    place = (found >> np.uint64(32) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: list[bytes]) -> tuple[np.ndarray, dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Words per row; by width all rows of that width or more, folded to it; and their places there."""
    words = np.array([len(b) // 8 for b in bits])
    flat, starts = np.frombuffer(b"".join(bits), np.uint64), np.cumsum(words) - words
    tables, places, width = {}, {}, int(words.max())
    wider, at = np.zeros(0, np.int64), np.zeros((0, width), np.uint64)
    while width >= words.min():
        own = np.flatnonzero(words == width)
        tables[width] = np.concatenate([at, flat[starts[own][:, None] + np.arange(width)]])
        wider = np.concatenate([wider, own])
        places[width] = np.zeros(len(bits), np.int64)
        places[width][wider] = np.arange(len(wider))
        width //= 2
        at = tables[2 * width][:, :width] ^ tables[2 * width][:, width:] if width else at
    return words, tables, places


def alike(group: np.ndarray, n: np.ndarray, member: np.ndarray, side: np.ndarray, two: np.ndarray, bits: list[bytes], percent: int) -> np.ndarray:
    """Whether a row has another one in its group to which sizes and bits allow it to be similar.

    The rows are in the order of groups and sizes. In a group of two blocks only rows of unlike
    sides are compared. Of rows that have a partner it need not be known which others they have.
    """
    kept = np.zeros(len(n), bool)
    if not len(n):
        return kept
    words, tables, places = _folded(bits)
    ends = np.searchsorted(group, group, side="right")
    i, step = np.arange(len(n)), 0
    while len(i):
        step += 1
        i = i[i + step < ends[i]]
        i = i[100 * n[i] >= percent * n[i + step]]  # nor will larger ones fit
        if not step % 32:
            left = np.r_[0, np.cumsum(~kept)]
            i = i[~kept[i] | (left[ends[i]] > left[i + step])]
        j = i + step
        ask = ~(kept[i] & kept[j]) & (member[i] != member[j]) & (~two[i] | (side[i] != side[j]))
        a, b = i[ask], j[ask]
        width = np.minimum(words[a], words[b])
        for w in tables:
            of = np.flatnonzero(width == w)
            if len(of):
                x, y = a[of], b[of]
                differ = np.bitwise_count(tables[w][places[w][x]] ^ tables[w][places[w][y]]).sum(1, dtype=np.int64)
                fits = (100 + percent) * differ <= (100 - percent) * (n[x] + n[y])
                kept[x[fits]] = kept[y[fits]] = True
    return kept


def _to_alike(percent: int):
    """Rows of whole buckets or of two blocks, sorted by size, to (pivot, member, n) of those with a partner."""

    def found(rows: pa.Table, new: np.ndarray) -> pa.RecordBatch:
        n, member, side, a, b = (rows.column(c).to_numpy() for c in ("n", "member", "side", "block_a", "block_b"))
        kept = pa.array(alike(np.cumsum(new), n, member, side, a != b, rows.column("bits").to_pylist(), percent))
        return rows.select(["pivot", "member", "n"]).filter(kept).combine_chunks()

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            keys = np.stack([rows.column(c).to_numpy() for c in ("pivot", "block_a", "block_b")])
            new = np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(0)] if rows.num_rows else np.zeros(0, bool)
            last = int(np.flatnonzero(new)[-1]) if rows.num_rows else 0  # its group may go on
            if last:
                yield from found(rows.slice(0, last), new[:last]).to_batches()
            held = rows.slice(last)
        if held is not None and held.num_rows:
            yield from found(held, np.r_[True, np.zeros(held.num_rows - 1, bool)]).to_batches()

    return run


def _sets_table(words: int, percent: int, classes):
    def run(batches):
        for batch in _slices(batches, "text"):
            rows = []
            for found in shingle_sets(batch.column("text").to_pylist(), words):
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                first = prefix(found, 0, classes.value, percent).view(np.int64) if len(found) else np.zeros(0, np.int64)
                rows.append((len(found), digest, first, set_bits(found, percent)))
            n, digest, first, bits = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(first, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["doc_id", "n", "digest", "prefix", "bits"],
            )

    return run


def _packed(batches):
    pack = zstandard.ZstdCompressor(3)
    for batch in _slices(batches, "text"):
        texts = [pack.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "packed"])


def _shared_columns(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Each set as numbers of the shingles that two sets or more hold, and how many those are."""
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1, dtype=np.int32) - 1
    out, at = [], 0
    for s in sets:
        own = place[at : at + len(s)]
        out.append(number[own[times[own] > 1]])
        at += len(s)
    return out, int((times > 1).sum())


def _bit_rows(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits per set, over the shingles that two sets or more hold."""
    columns, n = _shared_columns(sets)
    bits = np.zeros((len(sets), n // 64 + 1), np.uint64)
    for row, own in zip(bits, columns, strict=True):
        np.bitwise_or.at(row, own >> 6, np.uint64(1) << (own & 63).astype(np.uint64))
    return bits


def links_within(ids: list, sets: list[np.ndarray], percent: int, classes: np.ndarray, label: np.ndarray, side: np.ndarray | None = None) -> list[tuple]:
    """Enough links among the sets to connect what is linked: those that join two labels.

    Members of one label are known to be connected. With `side`, only members of unlike sides
    are compared.
    """
    n = np.array([len(s) for s in sets])
    label, links = label.copy(), []
    if len(sets) < 2:
        return links
    firsts = [_bit_rows([prefix(s, r, classes, percent) for s in sets]) for r in range(ORDERS)]
    columns = held = None
    for i in range(len(sets) - 1):
        others = np.arange(i + 1, len(sets))
        fits = (label[others] != label[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))
        if side is not None:
            fits &= side[others] != side[i]
        others = others[fits]
        for bits in firsts:
            if len(others):
                parts = [others[k : k + ROWS_AT_ONCE] for k in range(0, len(others), ROWS_AT_ONCE)]
                others = np.concatenate([part[(bits[part] & bits[i]).any(1)] for part in parts])
        if not len(others):
            continue
        if columns is None:
            columns, n_columns = _shared_columns(sets)
            held = np.zeros(n_columns, bool)
        held[columns[i]] = True
        common = np.array([np.count_nonzero(held[columns[j]]) for j in others.tolist()])
        held[columns[i]] = False
        for j in others[100 * common >= percent * (n[others] + n[i] - common)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                links.append((ids[i], ids[j]))
    return links


def _groups(batches, keys: list[str], names: list[str]):
    """(key, rows) of batches that are sorted by the keys."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in (*keys, *names)), strict=True):
            if row[: len(keys)] != key:
                if held:
                    yield key, held
                key, held = row[: len(keys)], []
            held.append(row[len(keys) :])
    if held:
        yield key, held


def _texts(rows) -> list[str]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(r).decode("utf-8", "surrogatepass") for r in rows]


def _pairs(links: list[tuple]) -> pa.RecordBatch:
    a, b = zip(*links, strict=True)
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _verify(words: int, percent: int, classes):
    """Blocks of a bucket to links. Rows: bucket, block, side, member, whether linked to the pivot."""

    def run(batches):
        for _, rows in _groups(batches, ["pivot", "block_a", "block_b"], ["side", "member", "linked", "packed"]):
            side, ids, linked, packed = zip(*rows, strict=True)
            label = np.arange(len(ids))
            label[np.array(linked)] = -1
            sides = np.array(side)
            two = (sides != sides[0]).any()
            links = links_within(list(ids), shingle_sets(_texts(packed), words), percent, classes.value, label, sides if two else None)
            if links:
                yield _pairs(links)

    return run


def _to_pivot(words: int, percent: int):
    """Slices of a large bucket, the pivot first in each, to distances from the pivot."""

    def run(batches):
        key, pivot = None, None
        for batch in _slices(batches, "packed", PASS_BYTES // 4):
            columns = [batch.column(c).to_pylist() for c in ("pivot", "slice", "first", "member")]
            found = shingle_sets(_texts(batch.column("packed").to_pylist()), words)
            rows = []
            for p, piece, first, member, own in zip(*columns, found, strict=True):
                if (p, piece) != key:
                    key, pivot = (p, piece), own
                common = len(np.intersect1d(own, pivot, assume_unique=True))
                union = len(own) + len(pivot) - common
                rows.append((p, first, member, 1 - common / union, 100 * common >= percent * union, len(own)))
            p, first, member, distance, linked, n = zip(*rows, strict=True) if rows else ((),) * 6
            yield pa.record_batch(
                [
                    pa.array(p, pa.int64()), pa.array(first, pa.int64()), pa.array(member, pa.int64()), pa.array(distance, pa.float64()),
                    pa.array(linked, pa.bool_()), pa.array(n, pa.int64()), batch.column("packed"),
                ],
                ["pivot", "first", "member", "distance", "linked", "n", "packed"],
            )

    return run


def _blocks(members: DataFrame, *names: str) -> DataFrame:
    """Members (pivot, member, blocks, and the columns named) once per block pair that they are part of."""
    block = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    other = members.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(
        "pivot", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), F.col("own").alias("side"),
        "member", *names,
    )


def _n_blocks(members, shingles):
    return F.greatest(F.lit(1), F.ceil(members / BLOCK_MEMBERS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def near_links(docs: DataFrame, sets: DataFrame, first: DataFrame, words: int, percent: int, classes, folder: str) -> DataFrame:
    """(a, b): links between representatives of equal sets, enough to connect what is linked.

    `first` holds the representative of each set as (digest, first_id). What a frequent key is
    joined with is stored before, so that Spark can split the key's partition. Tables of the
    folder go when they have been read, `sets` too.
    """
    nodes = sets.join(first.withColumnRenamed("first_id", "doc_id"), ["digest", "doc_id"], "left_semi")
    tokens = nodes.select("doc_id", F.explode("prefix").alias("token"))
    groups = tokens.groupBy("token").agg(F.min("doc_id").alias("pivot"), F.max("doc_id").alias("top")).filter("top > pivot").select("token", "pivot")
    groups = written(groups, f"{folder}/groups")
    met = written(tokens.join(groups, "token").select("pivot", F.col("doc_id").alias("member")).distinct(), f"{folder}/met")
    met = met.join(sets.select(F.col("doc_id").alias("member"), "n").distinct(), "member")
    met = written(_with_partners(met, percent), f"{folder}/partners")
    met = written(_with_alike(met, sets, percent), f"{folder}/alike")
    remove(docs.sparkSession, folder, "sets", "groups", "met", "partners")
    sizes = met.groupBy("pivot").agg(F.min("member").alias("first"), F.count("*").alias("members"), F.sum("n").alias("shingles"))
    sizes = written(
        sizes.select("pivot", "first", _n_blocks(F.col("members"), F.col("shingles")).alias("blocks")), f"{folder}/sizes"
    )

    def placed(buckets: DataFrame) -> DataFrame:
        texts = id_and_text(docs).mapInArrow(_packed, "doc_id long, packed binary").withColumnRenamed("doc_id", "member")
        return texts.join(met.join(buckets, "pivot").hint("shuffle_hash"), "member").select("pivot", "first", "member", "blocks", "packed")

    keys = ["pivot", "block_a", "block_b"]
    check = _verify(words, percent, classes)
    small = _blocks(placed(sizes.filter("blocks = 1")).withColumn("linked", F.lit(False)), "linked", "packed")
    links = small.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(check, "a long, b long")
    if sizes.filter("blocks > 1").isEmpty():
        return links

    # from here on the first member is the pivot of its bucket
    large = placed(sizes.filter("blocks > 1"))
    pivots = large.filter("first = member").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    others = large.filter("first <> member").withColumn("slice", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
    slices = pivots.unionByName(others).repartition("pivot", "slice").sortWithinPartitions("pivot", "slice", F.col("member") != F.col("first"), "member")
    told = slices.select("pivot", "slice", "first", "member", "packed").mapInArrow(
        _to_pivot(words, percent), "pivot long, first long, member long, distance double, linked boolean, n long, packed binary"
    )
    told = written(told, f"{folder}/told")
    by_pivot = told.filter("linked AND first <> member").select(F.col("first").alias("a"), F.col("member").alias("b"))
    least = told.filter("NOT linked").groupBy("pivot").agg(F.min("distance").alias("least"))
    reach = 1 - percent / 100 + 1e-9
    rest = told.filter("first <> member").join(least, "pivot").filter((~F.col("linked")) | (F.col("distance") >= F.col("least") - reach))
    rest = rest.select("pivot", "member", "linked", "n", "packed")
    again = rest.groupBy("pivot").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    again = again.select("pivot", _n_blocks(F.col("members"), F.col("shingles")).alias("blocks"))
    more = _blocks(rest.join(again, "pivot"), "linked", "packed").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(check, "a long, b long")
    return links.union(by_pivot).union(more)


def _with_partners(met: DataFrame, percent: int) -> DataFrame:
    """Members of a bucket that has another one of a size that similarity allows.

    Sizes fall into classes so wide that similar sets are in one class or in two next to each
    other; a member alone in its own class and those beside it has no partner.
    """
    classed = met.withColumn("class", F.floor(F.log("n") / float(np.log(100 / min(percent, 99)))))
    counts = classed.groupBy("pivot", "class").agg(F.count("*").alias("c"))
    near = counts.select("pivot", F.explode(F.array(*[F.col("class") + d for d in (-1, 0, 1)])).alias("class"), "c")
    near = near.groupBy("pivot", "class").agg(F.sum("c").alias("near")).filter("near > 1")
    return classed.join(near.select("pivot", "class"), ["pivot", "class"], "left_semi").drop("class")


def _with_alike(met: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members of a bucket that has another one to which their rows of bits allow them to be similar."""
    bits = sets.select(F.col("doc_id").alias("member"), "n", "bits").distinct()
    sizes = met.groupBy("pivot").agg(F.ceil(F.count("*") / BITS_MEMBERS).cast("int").alias("blocks"))
    rows = _blocks(met.join(sizes, "pivot").join(bits, ["member", "n"]), "n", "bits")
    keys = ["pivot", "block_a", "block_b"]
    found = rows.repartition(*keys).sortWithinPartitions(*keys, "n").mapInArrow(_to_alike(percent), "pivot long, member long, n long")
    return found.distinct()  # a member of several blocks


def similar_documents(docs: DataFrame, words: int = 5, percent: int = 80, counters: int = SKETCH) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per row of `docs`.

    A document's set holds its distinct shingles of `words` words, of a shorter one its whole
    sequence. Documents link where 100 * intersection >= percent * union; `component_id` is
    the least doc_id that links reach. A null text or one without words has the empty set and
    links with nothing. Rows that repeat a doc_id with other words are one document, linked
    with itself. A null doc_id finds its copies and their component but is nobody's link. An
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = run_folder(spark)
    rows = id_and_text(docs)
    classes = spark.sparkContext.broadcast(rarity_classes(rows, words, counters))  # a byte per counter
    sets = written(
        rows.mapInArrow(_sets_table(words, percent, classes), "doc_id long, n long, digest binary, prefix array<long>, bits binary"),
        f"{folder}/sets",
    )
    plain = sets.select("doc_id", "n", "digest")
    full = plain.filter("n > 0")
    first = written(full.groupBy("digest").agg(F.min("doc_id").alias("first_id")), f"{folder}/first")
    known = written(
        full.join(first, "digest").select("doc_id", "n", "first_id").union(plain.filter("n = 0").select("doc_id", "n", "doc_id")),
        f"{folder}/known",
    )
    twice = known.groupBy("doc_id").agg(F.min("first_id").alias("a"), F.max("first_id").alias("z")).filter("a < z").select("doc_id", "a")
    same_id = known.join(twice, "doc_id").filter("n > 0").select("a", F.col("first_id").alias("b"))
    links = near_links(docs, sets, first, words, percent, classes, folder).union(same_id)
    roots = components(links, folder).withColumnRenamed("a", "first_id")
    return known.join(roots, "first_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "first_id").alias("component_id")
    )


def without_similar_documents(docs: DataFrame, words: int = 5, percent: int = 80, counters: int = SKETCH) -> DataFrame:
    """The rows of `docs` whose doc_id is the least of its component; null ids stay."""
    found = similar_documents(docs, words, percent, counters)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone.hint("shuffle_hash"), docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
