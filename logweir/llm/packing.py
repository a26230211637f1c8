"""Sequences of power-of-two length, none of which crosses a document.

A document of n ids is cut into pieces by the binary form of n: as many whole sequences as fit,
then one piece per binary digit of the rest. Pieces of equal length form a bucket; each is a
sequence by itself, so nothing is padded and no attention crosses documents.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.llm.library import word_ids
from logweir.llm.tables import id_and_text, run_folder, written

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, nth long"


def binary_pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: lengths are powers of two and only fall."""
    lengths = [longest] * (n // longest)
    rest = n % longest
    lengths += [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return list(zip(accumulate(lengths, initial=0), lengths, strict=False))


def _cut(path: str, end_id: int, longest: int, texts_at_once: int = 1024):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tool, part, met = word_ids(path), TaskContext.get().partitionId(), {}
        for whole in batches:
            for at in range(0, whole.num_rows, texts_at_once):
                batch, rows = whole.slice(at, texts_at_once), []
                ids = tool(batch.column("text").to_pylist())
                for doc_id, data in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                    data += end
                    n = len(data) // 4
                    for start, length in binary_pieces(n, longest):
                        nth = met[length] = met.get(length, -1) + 1
                        rows.append((doc_id, start, length, n, data[4 * start : 4 * (start + length)], part, nth))
                columns = list(zip(*rows, strict=True))
                kinds = (*[pa.int64()] * 4, pa.binary(), pa.int32(), pa.int64())
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "start", "length", "doc_tokens", "ids", "part", "nth"],
                )

    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, longest: int = 2048) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids), a row per piece.

    Ids are little-endian unsigned 32-bit numbers from the tokenizers file `tokenizer`, without
    added special tokens, and `end_id`; `longest` is a power of two. Buckets of longer pieces
    come first: sequence ids run from 0 through one bucket after the other without gaps. A null
    or empty text is its end id alone; null ids and repeated rows are documents of their own;
    an empty table gives no rows; other columns are not read.

    Pieces are stored once and numbered from their counts per task and bucket, so no task sees
    all of them.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest sequence must be a power of two")
    folder = run_folder(docs.sparkSession)
    pieces = id_and_text(docs).mapInArrow(_cut(tokenizer, end_id, longest), _PIECES)
    pieces.write.option("compression", "zstd").parquet(f"{folder}/pieces")
    pieces = docs.sparkSession.read.schema(_PIECES).parquet(f"{folder}/pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))  # a few rows per task
    order = W.orderBy(F.desc("length"), "part").rowsBetween(W.unboundedPreceding, -1)
    bases = written(
        counts.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).select("length", "part", "base"), f"{folder}/bases"
    )
    return pieces.join(bases, ["length", "part"]).select(
        "doc_id", "start", "length", "doc_tokens", (F.col("base") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "ids",
    )
