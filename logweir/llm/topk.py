"""Exact inner-product search over norm-sorted blocks.

Vectors are dealt into blocks by descending length. Each is rotated by the singular vectors
of all candidates, so that the first coordinates hold most of a product; what the rest can add
is bounded by Cauchy-Schwarz, and a product is finished only where that bound reaches the
query's k-th score so far. A first pass over the longest vectors gives every query such a
score; the second meets all other blocks, or none that its lengths rule out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.llm.tables import run_folder, ship, written

#: Sums of products of doubles below this are whole numbers without rounding.
EXACT = 2.0**53
_BLOCK = "dim int, block long, top_norm double, ids binary, vectors binary"
_HITS = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, dim, v, norm), v = floor(scale * x).

    Rows whose id or vector is null, or whose vector is empty or holds a null or a component
    that is not finite, leave.
    """
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # floor() of Spark gives a long; kept as a double, so that large components stay what they are
    whole = F.transform("x", lambda c: F.when(F.abs(c * scale) < 2.0**52, F.floor(c * scale).cast("double")).otherwise(c * scale))
    good = rows.filter(F.col("vec_id").isNotNull() & F.coalesce((F.size("x") > 0) & finite, F.lit(False)))
    sums = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    return good.select("vec_id", F.size("x").alias("dim"), whole.alias("v")).withColumn("norm", F.sqrt(sums))


def rotations(rows: DataFrame) -> dict[int, np.ndarray]:
    """Right singular vectors of all vectors of one dimension, by falling singular value.

    What comes to the driver are the sums of products, dim x dim numbers, whatever the rows.
    """

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            flat, ends = batch.column("v").flatten().to_numpy(), np.cumsum(dims)
            for dim in np.unique(dims):
                at = (ends[dims == dim] - dim)[:, None] + np.arange(dim)
                total[int(dim)] = total.get(int(dim), 0) + flat[at].T @ flat[at]
        for dim, m in total.items():
            i, j = np.indices(m.shape)
            yield pa.record_batch(
                [pa.array(np.full(m.size, dim, np.int32)), pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(m.ravel())],
                ["dim", "i", "j", "s"],
            )

    found = (
        rows.filter("norm < 1e12").select("dim", "v").mapInArrow(sums, "dim int, i int, j int, s double")
        .groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).collect()
    )
    out: dict[int, np.ndarray] = {}
    for r in found:
        out.setdefault(r.dim, np.zeros((r.dim, r.dim)))[r.i, r.j] = r.s
    return {dim: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy() for dim, m in out.items()}


def _blocks(size: int):
    """Rows, sorted by dimension and falling norm, as matrices of at most `size` rows."""

    def run(batches):
        part, nth = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block():
            nonlocal nth, held
            dim = held[0][1]
            out = [
                pa.array([dim], pa.int32()), pa.array([part << 32 | nth]), pa.array([max(h[3] for h in held)]),
                pa.array([np.array([h[0] for h in held], np.int64).tobytes()]), pa.array([np.array([h[2] for h in held]).tobytes()]),
            ]
            nth, held = nth + 1, []
            return pa.record_batch(out, ["dim", "block", "top_norm", "ids", "vectors"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dim", "v", "norm")), strict=True):
                if held and (len(held) >= size or held[0][1] != row[1]):
                    yield block()
                held.append(row)
        if held:
            yield block()

    return run


def _products(q: np.ndarray, c: np.ndarray, pairs) -> np.ndarray:
    """Whole-number products of the given pairs; those beyond a long take its end."""
    i, j = pairs
    top = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if top < EXACT:
        if len(i) > 0.1 * len(q) * len(c):
            return (q @ c.T)[i, j].astype(np.int64)
        return np.einsum("ij,ij->i", q[i], c[j]).astype(np.int64)
    whole = [[int(x) for x in row] for row in q], [[int(x) for x in row] for row in c]
    ends = -(2**63), 2**63 - 1
    return np.array(
        [min(max(sum(x * y for x, y in zip(whole[0][a], whole[1][b], strict=True)), ends[0]), ends[1]) for a, b in zip(i, j, strict=True)], np.int64
    )


def _best(k: int, query: np.ndarray, vec: np.ndarray, score: np.ndarray):
    """The k best of each query, ties to the smaller id."""
    order = np.lexsort((vec, -score.astype(object) if len(score) and score.min() == -(2**63) else -score, query))
    query, vec, score = query[order], vec[order], score[order]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    keep = rank < k
    return query[keep], vec[keep], score[keep], rank[keep]


def search_block(qid, q, cid, c, k: int, rotation=None, floor=None, head: int = 16, step: int = 512):
    """(index of query, vec_id, score) of the k best candidates of each query, itself apart.

    `floor` holds for each query a score that k candidates elsewhere already reach; lower ones
    are not looked for. The candidates are sorted by falling length.
    """
    floor = np.full(len(q), -(2**63), np.int64) if floor is None else floor.copy()
    found = [np.zeros(0, np.int64)] * 3
    with np.errstate(over="ignore", invalid="ignore"):
        qn, cn = np.sqrt((q * q).sum(1)), np.sqrt((c * c).sum(1))
        sure = rotation is not None and qn.max(initial=0) < 1e12 and cn.max(initial=0) < 1e12
        if sure:
            qr, cr = q @ rotation, c @ rotation
            q_rest, c_rest = (np.sqrt((m[:, head:] ** 2).sum(1)) for m in (qr, cr))
    for start in range(0, len(c), step):
        part = slice(start, start + step)
        if sure:
            slack = 1e-6 + 1e-9 * np.outer(qn, cn[part])
            live = np.flatnonzero(qn * cn[start] + slack[:, 0] >= floor)
            if not len(live):
                break  # the lengths only fall from here on
            bound = qr[live, :head] @ cr[part, :head].T + np.outer(q_rest[live], c_rest[part]) + slack[live]
            i, j = np.nonzero(bound >= floor[live, None])
            i = live[i]
        else:
            i, j = (a.ravel() for a in np.indices((len(q), len(c[part]))))
        other = qid[i] != cid[start + j]
        i, j = i[other], j[other]
        score = _products(q, c[part], (i, j))
        good = score >= floor[i]
        i, j, score = i[good], j[good], score[good]
        *found, rank = _best(k, np.r_[found[0], i], np.r_[found[1], cid[start + j]], np.r_[found[2], score])
        last = rank == k - 1
        floor[found[0][last]] = np.maximum(floor[found[0][last]], found[2][last])
    return (*found, floor)


def _matrix(ids: bytes, vectors: bytes, dim: int):
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors).reshape(-1, dim)


def _meet(k: int, rotation: dict, with_floor: bool):
    """Joined rows of a query block and a candidate block to scored pairs."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                qid, q = _matrix(row["q_ids"], row["q_vectors"], row["dim"])
                cid, c = _matrix(row["ids"], row["vectors"], row["dim"])
                floor = np.frombuffer(row["floor"], np.int64) if with_floor else None
                i, vec, score, floor = search_block(qid, q, cid, c, k, rotation.get(row["dim"]), floor)
                hits = [qid[i].tolist(), vec.tolist(), score.tolist()]
                if with_floor:
                    yield pa.record_batch([pa.array(h, pa.int64()) for h in hits], ["query_id", "vec_id", "score"])
                else:
                    yield pa.record_batch(
                        [
                            pa.array([row["q_block"]]), pa.array([floor.tobytes()]), pa.array([float(floor.min())]),
                            pa.array([[{"query_id": a, "vec_id": b, "score": s} for a, b, s in zip(*hits, strict=True)]], pa.list_(pa.struct([(n, pa.int64()) for n in ("query_id", "vec_id", "score")]))),
                        ],
                        ["q_block", "floor", "least", "hits"],
                    )

    return run


def top_inner_products(vectors: DataFrame, queries, k: int = 5, scale: float = 256.0, query_rows: int = 512, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query row, exactly.

    `queries` is a condition on vec_id. Scores are inner products of floor(scale * x), ties go
    to the smaller id; a query with fewer candidates of its dimension gets them all. Vectors
    null, empty or holding null or non-finite components take no part, nor do null ids; rows
    repeated with one id count as the row itself and are never its own hit, but each is a hit
    of other queries. A score beyond a long takes the end of its range. An empty table gives
    no rows; other columns are not read.

    The query set meets all rows in blocks: query blocks are copied to each of a number of
    slots that grows with the candidate blocks, so no task holds more than its blocks.
    """
    spark = vectors.sparkSession
    ship(spark)
    folder = run_folder(spark)
    rows = integer_vectors(vectors, scale)
    rotation = rotations(rows)

    def blocks(of: DataFrame, size: int, name: str) -> DataFrame:
        sorted_rows = of.repartitionByRange("dim", F.desc("norm"), "vec_id").sortWithinPartitions("dim", F.desc("norm"), "vec_id")
        return written(sorted_rows.mapInArrow(_blocks(size), _BLOCK), f"{folder}/{name}")

    candidates = blocks(rows, block_rows, "candidates")
    asked = blocks(rows.filter(queries), query_rows, "queries").withColumnsRenamed(
        {"block": "q_block", "top_norm": "q_norm", "ids": "q_ids", "vectors": "q_vectors"}
    )
    longest = candidates.groupBy("dim").agg(F.max_by("block", F.struct("top_norm", "block")).alias("block"))
    first = asked.join(candidates.join(longest, ["dim", "block"]), "dim")
    begun = written(
        first.select("dim", "q_block", "q_ids", "q_vectors", "ids", "vectors").mapInArrow(
            _meet(k, rotation, False), f"q_block long, floor binary, least double, hits array<struct<{_HITS}>>"
        ),
        f"{folder}/begun",
    )
    slots = max(8, -(-candidates.count() // 8))
    rest = candidates.join(longest, ["dim", "block"], "left_anti").withColumn("slot", F.pmod(F.hash("block"), F.lit(slots)))
    spread = asked.join(begun.select("q_block", "floor", "least"), "q_block").withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    )
    met = spread.join(rest, ["dim", "slot"]).filter("q_norm * top_norm * 1.000001 + 1 >= least")
    more = met.select("dim", "floor", "q_ids", "q_vectors", "ids", "vectors").mapInArrow(_meet(k, rotation, True), _HITS)
    hits = begun.select(F.inline("hits")).unionByName(more)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
