"""The registered queries of the operators, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from logweir.llm import alignment, bpe, counts, exact, jaccard, language, packing, spelling, suffixes, tokenfile, topk, toxicity, units
from logweir.llm.tables import run_folder, table


def op1_byte_bpe(spark, sf_dir):
    return bpe.encode_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op2_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, longest=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_ngram_jaccard(spark, sf_dir):
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_suffix_dedup(spark, sf_dir):
    found = suffixes.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["length"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_token_counts(spark, sf_dir):
    return counts.token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("piece_bpe_32k.model"),
        cache=f"{run_folder(spark)}/counts",
    )


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.predict_languages(docs, language.learn_languages(docs))
    return found.select("doc_id", F.coalesce(language.held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_exact_top_k(spark, sf_dir):
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5, scale=256.0)


def op9_token_file(spark, sf_dir):
    read = tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_substring_dedup(spark, sf_dir):
    found = units.without_repeated_units(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_units", "n_cut",
        F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["length"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op11_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_spelling_variants(spark, sf_dir):
    words = spelling.counted_words(table(spark, sf_dir, "documents"), min_length=6, min_count=5, damaged_every=199)
    return spelling.spelling_groups(words, ratio=5, min_length=6)


def op13_tokenizer_alignment(spark, sf_dir):
    return alignment.align_tokenizers(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    q.__name__: q
    for q in (
        op1_byte_bpe, op2_exact_dedup, op3_packing, op4_ngram_jaccard, op5_suffix_dedup, op6_token_counts,
        op7_language_id, op8_exact_top_k, op9_token_file, op10_substring_dedup, op11_toxicity, op12_spelling_variants,
        op13_tokenizer_alignment, pipeline,
    )
}

SQL = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_exact_top_k": """
        WITH parts AS (
            SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM embeddings),
        whole AS (
            SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts
            WHERE vec_id NOT IN (SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x))),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0 GROUP BY ALL),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score FROM scored)
        SELECT * FROM ranked WHERE rank <= 5""",
    "op10_substring_dedup": r"""
        WITH found AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''),
                '[^\n]{40,}?(?:[.!?]+[ \t]+|[。！？]+[ \t]*)|[^\n]*\n|[^\n]+') AS l FROM documents),
        units AS (SELECT doc_id, unnest(range(len(l))) AS nth, unnest(l) AS unit FROM found),
        plain AS (
            SELECT *, trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[ \t\n\x0B\f\r]+', ' ', 'g'), ' ') AS p FROM units),
        ranked AS (SELECT *, p <> '' AND row_number() OVER (PARTITION BY p ORDER BY doc_id, nth) > 1 AS cut FROM plain),
        runs AS (
            SELECT *, cut AND NOT coalesce(lag(cut) OVER (PARTITION BY doc_id ORDER BY nth), false) AS opens FROM ranked),
        cuts AS (
            SELECT doc_id, count(*) AS n_units, count(*) FILTER (cut) AS n_cut, sum(strlen(unit)) FILTER (cut) AS n_removed,
                   count(*) FILTER (opens) AS n_spans, string_agg(unit, '' ORDER BY nth) FILTER (NOT cut) AS kept
            FROM runs GROUP BY doc_id)
        SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units,
               CAST(coalesce(n_cut, 0) AS BIGINT) AS n_cut, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN cuts USING (doc_id)""",
    "op12_spelling_variants": r"""
        WITH RECURSIVE bits AS (
            SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                                  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
            FROM (SELECT unnest(range(256)) AS i)),
        crc AS (SELECT list(c ORDER BY i) AS t FROM bits),
        runs AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
                   unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-zÀ-ÿ]{6,}')) AS run FROM documents),
        once AS (SELECT d, run, count(*) AS times FROM runs GROUP BY ALL),
        coded AS (
            SELECT run, times, flatten(list_transform(string_split(d || ':' || run, ''), lambda c:
                       CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
                            ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END)) AS codes FROM once),
        hashed AS (
            SELECT run, times, xor(list_reduce(list_prepend(4294967295, codes),
                       lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h FROM coded, crc),
        damaged AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                        ELSE run END AS word, times FROM hashed),
        words AS (
            SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
        -- one byte a letter, since levenshtein counts bytes
        narrow AS (
            SELECT *, translate(word, (SELECT string_agg(chr(CAST(192 + i AS INTEGER)), '' ORDER BY i) FROM range(64) r(i)),
                                (SELECT string_agg(chr(CAST(33 + i AS INTEGER)), '' ORDER BY i) FROM range(64) r(i))) AS b FROM words),
        near AS (
            SELECT x.word, y.word AS other, y.n AS other_n FROM narrow x JOIN narrow y
            ON strlen(y.b) BETWEEN strlen(x.b) - 1 AND strlen(x.b) + 1 AND levenshtein(x.b, y.b) = 1),
        best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS near_n,
                   arg_min(other, (-other_n, other)) AS near FROM near GROUP BY word),
        forms AS (
            SELECT word, CASE WHEN near_n >= 5 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
        paths AS (
            SELECT word, word AS root, form AS next FROM forms
            UNION ALL
            SELECT p.word, f.word, f.form FROM paths p JOIN forms f ON f.word = p.next)
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM paths WHERE next IS NULL) USING (word)""",
}
