"""Token counts behind a cache of digests: only contents not seen before are encoded."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.tables import id_and_text, run_folder, written

CACHE = "tokenizer_version string, content_sha256 binary, n_tokens long"


@lru_cache(maxsize=4)
def _counter(path: str):
    """The library's own count of a list of texts, once per Python worker."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def tokenizer_version(path: str) -> str:
    """Names the vocabulary by its content, so that another file never shares its counts."""
    import hashlib

    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _encode(path: str, texts_at_once: int):
    def run(batches):
        count, seen = _counter(path), set()
        for batch in batches:
            digests = batch.column("content_sha256").to_pylist()
            # rows repeated with their id come to the same task
            once = [d not in seen and not seen.add(d) for d in digests]
            batch = batch.filter(pa.array(once, pa.bool_()))
            for start in range(0, batch.num_rows, texts_at_once):
                part = batch.slice(start, texts_at_once)
                yield pa.record_batch(
                    [part.column("content_sha256"), pa.array(count(part.column("text").to_pylist()), pa.int64())],
                    ["content_sha256", "n_tokens"],
                )

    return run


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts in the cache for one tokenizer; none where the folder is new."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    rows = spark.read.schema(CACHE).parquet(cache) if there else spark.createDataFrame([], CACHE)
    # two runs that met the same content may both have stored it, with the same count
    return rows.filter(F.col("tokenizer_version") == version).groupBy("content_sha256").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 4096, texts_at_once: int = 256) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row per row of `docs`; the cache grows.

    `tokenizer` is a .model file of sentencepiece or a .json file of tokenizers, readable on
    every executor; `cache` a folder of the shared store. Contents are normalised by reading
    null as empty and in no other way, since counts depend on every byte. Digests that the
    cache lacks are encoded once each and appended before the counts are joined. A null doc_id
    is kept as null, repeated rows each get a row, an empty table gives none; other columns of
    `docs` are not read.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    rows = id_and_text(docs).select(
        "doc_id", "text", F.unhex(F.sha2("text", 256)).alias("content_sha256"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    contents = rows.groupBy("content_sha256").agg(F.min("doc_id").alias("first_id"))
    missing = contents.join(stored_counts(spark, cache, version), "content_sha256", "left_anti")
    # one text of each missing digest; the digest, not the text, is what is grouped
    new = rows.join(
        missing.withColumnRenamed("content_sha256", "missing_sha256").hint("shuffle_hash"),
        F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("content_sha256") == F.col("missing_sha256")),
        "left_semi",
    ).select("content_sha256", "text")
    (
        new.mapInArrow(_encode(tokenizer, texts_at_once), "content_sha256 binary, n_tokens long")
        .select(F.lit(version).alias("tokenizer_version"), "content_sha256", "n_tokens")
        .write.mode("append").parquet(cache)
    )
    # stored, so that Spark can split the partition of a content that very many rows have
    counts = written(
        contents.select("content_sha256").join(stored_counts(spark, cache, version), "content_sha256"), f"{run_folder(spark)}/counts"
    )
    return rows.select("doc_id", "n_bytes", "content_sha256").join(counts, "content_sha256").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
