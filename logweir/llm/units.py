"""Repeated lines, sentences or paragraphs: every unit but the earliest of its kind is cut out."""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.tables import id_and_text, run_folder, written

#: What a unit is: patterns whose matches, one after the other, are the whole text.
LINE = r"[^\n]*\n|[^\n]+"
PARAGRAPH = r"(?s:.*?\n\n|.+)"
#: A line; in it each sentence that ends, with the blanks behind it, at 40 characters of the unit or later.
SENTENCE = r"[^\n]{40,}?(?:[.!?]+[ \t]+|[。！？]+[ \t]*)|[^\n]*\n|[^\n]+"


def _keyed(docs: DataFrame) -> DataFrame:
    # rows that share a doc_id but not the text are documents of their own
    return id_and_text(docs).withColumn("text_key", F.xxhash64("text"))


def normal_form(unit: bytes) -> list[bytes]:
    """The words of a unit in ASCII lower case, apart by ASCII white space."""
    return unit.lower().split()


def _digests(unit: str):
    def run(batches):
        found = re.compile(unit)
        for batch in batches:
            rows = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text")), strict=True):
                for nth, one in enumerate(found.findall(text)):
                    if words := normal_form(one.encode()):
                        rows.append((doc_id, key, nth, hashlib.md5(b" ".join(words)).digest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "text_key", "nth", "digest"])

    return run


def unit_digests(docs: DataFrame, unit: str = SENTENCE) -> DataFrame:
    """(doc_id, text_key, nth, digest) of each unit with a word."""
    return _keyed(docs).select("doc_id", "text_key", "text").mapInArrow(
        _digests(unit), "doc_id long, text_key long, nth int, digest binary"
    )


def repeated_units(docs: DataFrame, unit: str = SENTENCE) -> DataFrame:
    """(doc_id, text_key, nth) of the units that an earlier one repeats.

    Units rank by doc_id (null last), then by their place. What is grouped are digests, added
    up in each task first; those met more than once are stored, and join the units again from
    there, so that Spark can split the partition of a frequent one.
    """
    units = unit_digests(docs, unit)
    rank = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.col("text_key"), F.col("nth"))
    firsts = (
        units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
        .filter("n > 1").select("digest", "first")
    )
    firsts = written(firsts, f"{run_folder(docs.sparkSession)}/firsts")
    return units.join(firsts, "digest").filter(rank != F.col("first")).select("doc_id", "text_key", "nth")


def _cut(unit: str):
    def run(batches):
        found = re.compile(unit)
        for batch in batches:
            rows = []
            for doc_id, text, cut in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "cut")), strict=True):
                units = found.findall(text)
                gone, spans, kept, at = set(cut or ()), [], [], 0
                for nth, one in enumerate(units):
                    whole = one.encode()
                    if nth not in gone:
                        kept.append(one)
                    elif spans and spans[-1]["start"] + spans[-1]["length"] == at:
                        spans[-1]["length"] += len(whole)
                    else:
                        spans.append({"start": at, "length": len(whole)})
                    at += len(whole)
                rows.append((doc_id, at, len(units), len(gone), spans, "".join(kept)))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _CUT.types, strict=True)], schema=_CUT)

    return run


_CUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_units", pa.int64()), ("n_cut", pa.int64()),
        ("removed", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("kept_text", pa.string()),
    ]
)


def without_repeated_units(docs: DataFrame, unit: str = SENTENCE) -> DataFrame:
    """(doc_id, n_bytes, n_units, n_cut, removed, kept_text), a row per row of `docs`.

    A unit goes with the line end or blanks behind it; `removed` holds the byte spans in the
    original text, so every kept byte can be led back to its place. Units are equal when their
    words are, in ASCII lower case; every unit with a word counts, however short, those without
    stay. A null text is empty and has no unit; a null doc_id ranks last; rows repeated with
    doc_id and text are one document and get the same result. An empty table gives no rows;
    other columns of `docs` are not read.
    """
    cuts = (
        repeated_units(docs, unit).groupBy("doc_id", "text_key")
        .agg(F.collect_set("nth").alias("cut")).withColumnsRenamed({"doc_id": "cut_id", "text_key": "cut_key"})
    )
    rows = _keyed(docs)
    met = rows.join(
        cuts.hint("shuffle_hash"),
        (rows["text_key"] == cuts["cut_key"]) & rows["doc_id"].eqNullSafe(cuts["cut_id"]), "left",
    )
    return met.select("doc_id", "text", "cut").mapInArrow(
        _cut(unit),
        "doc_id long, n_bytes long, n_units long, n_cut long, "
        "removed array<struct<start: long, length: long>>, kept_text string",
    )
