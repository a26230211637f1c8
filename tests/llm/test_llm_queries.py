"""The registered queries over whole tables, and the pipeline against plain versions of its stages."""

import brute
import duckdb
import public_tokenizers
import pytest

import corpus_pipeline
from logweir.llm import language
from logweir.llm.queries import QUERIES, SQL
from logweir.llm.tables import table, written, run_folder

SF = "/root/testdata/sf0.001"


def _docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = db.sql(SQL[name])
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    assert names == sorted(expected.columns)
    order = ", ".join(f'"{n}"' for n in names)
    rows = [tuple(r) for r in got.select(*names).collect()]
    # by their text, since null and a string have no order
    assert sorted(rows, key=repr) == sorted(db.sql(f"SELECT {order} FROM ({SQL[name]})").fetchall(), key=repr)


def _expected(name):
    docs = _docs()
    if name == "op1_byte_bpe":
        return brute.bpe_rows(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    if name == "op4_ngram_jaccard":
        return brute.similar_rows(docs, 3, 90)
    if name == "op5_suffix_dedup":
        return [(d, n, sum(b - a for a, b in s), len(s), brute._sha(k)) for d, n, s, k in brute.passage_rows(docs)]
    if name == "op6_token_counts":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        return [(d, len(t.encode()), n := len(model.encode(t)), n > 4096) for d, t in docs]
    start, out = 0, []
    for d, ids in sorted(brute.library_ids(docs, public_tokenizers.path("word_bpe_49k.json"), 2)):
        out.append((d, start, len(ids), brute.crc(ids)))
        start += len(ids)
    return out


@pytest.mark.parametrize("name", ["op1_byte_bpe", "op4_ngram_jaccard", "op5_suffix_dedup", "op6_token_counts", "op9_token_file"])
def test_query_equals_the_plain_version(spark, name):
    assert sorted(tuple(r) for r in QUERIES[name](spark, SF).collect()) == sorted(_expected(name))


def _plain_passages(docs):
    out = []
    for (doc_id, text), (_, _, spans, _) in zip(docs, brute.passage_rows(docs), strict=True):
        data, gone = text.encode(), set()
        for a, b in spans:
            gone.update(range(a, b))
        at, kept = 0, []
        for c in text:
            size = len(c.encode())
            if not gone.intersection(range(at, at + size)):
                kept.append(c)
            at += size
        assert at == len(data)
        if kept or not spans:
            out.append((doc_id, "".join(kept)))
    return out


def test_pipeline_equals_its_plain_stages(spark):
    folder, docs = run_folder(spark), table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"{folder}/{name}")
        seen[name] = docs
    plain = _docs()
    model = language.learn_languages(table(spark, SF, "documents"))
    plain = [(d, t) for d, t in plain if t and any(c.isalpha() for c in t)]
    plain = [(d, t) for d, t in plain if model.predict(language.features([t]))[1][0] >= language.LEAST_SCORE]
    assert sorted((r.doc_id, r.text) for r in seen["language_id"].collect()) == sorted(plain)
    keep = {}
    for d, t in plain:
        keep[t] = max(d, keep.get(t, d))
    plain = sorted((d, t) for t, d in keep.items())
    assert sorted((r.doc_id, r.text) for r in seen["exact_dedup"].collect()) == plain
    least = {d for d, _, c in brute.similar_rows(plain, 5, 80) if d == c}
    plain = [(d, t) for d, t in plain if d in least]
    assert sorted((r.doc_id, r.text) for r in seen["near_dedup"].collect()) == plain
    plain = _plain_passages(plain)
    kept = seen["passage_dedup"]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(plain)
    assert all(r.n_chars == len(r.text) for r in kept.collect())
    for name in list(seen)[:-1]:
        assert seen[name].dtypes == table(spark, SF, "documents").dtypes
    expected = []
    for d, ids in brute.library_ids(plain, public_tokenizers.path("word_bpe_49k.json"), 1):
        start = 0
        for size in brute.piece_lengths(len(ids), 2048):
            expected.append((d, start, size, brute.crc(ids[start : start + size]), len(ids)))
            start += size
    assert sorted(tuple(r)[:5] for r in docs.collect()) == sorted(expected)
