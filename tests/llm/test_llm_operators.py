"""The operators on a table with nulls, empty and long texts, ties, repeated rows and odd columns."""

import hashlib
from collections import defaultdict

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from logweir.llm import bpe, counts, exact, jaccard, language, packing, suffixes, tokenfile, topk, units
from logweir.llm.tables import run_folder

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, n int, kept string, row_key string, "
    "start long, block string, removed string, prefix string, score string"
)


def _story(seed, n):
    rng = np.random.default_rng(seed)
    parts = "the of and tion er re nd wh ing ou sh ble at on".split()
    return " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(n))


def texts():
    base, passage = _story(1, 120), _story(2, 60)
    out = [
        (1, None), (2, ""), (3, " \n\t "), (4, "Hello world, it's 12 o'clock."), (5, "Hello world, it's 12 o'clock."), (7, "a"), (8, "a"), (9, "a b"),
        (10, base), (11, base + " tail"), (12, base.upper()), (13, base.replace("the", "THE", 1)), (14, _story(3, 40) + "\n" + passage + "\n" + _story(4, 30)),
        (15, passage + " " + _story(5, 50)), (16, "é" * 40 + "ü" * 40), (17, "x" + "é" * 40 + "ü" * 40), (18, "ab" * 400), (19, "ab" * 300),
        (20, "你好 世界 🙂 İstanbul\x1c\x85  <|endoftext|>"), (21, _story(6, 30_000)), (22, "same line of words\n" * 30), (23, "Same  line of words\nother line here now\n"),
        (24, "\n\n\n"), (25, "z" * 200_000),
    ]
    return out + [(30 + k, " ".join([*base.split()[: 110 + k % 3], f"w{k}"])) for k in range(12)]


def repeated():
    return [*texts(), (5, "Hello world, it's 12 o'clock."), (10, _story(1, 120))]


@pytest.fixture
def make(rows):
    def frame(pairs):
        return rows([(d, t, None, "s", None, "x", 1, "k", "r", 5, "b", "m", "p", "o") for d, t in pairs], SCHEMA).repartition(3)

    return frame


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _same(df, expected):
    assert _rows(df) == sorted(map(tuple, expected), key=repr)


OPERATORS = [
    lambda d: bpe.encode_digests(d, RANKS, public_tokenizers.PATTERN),
    exact.exact_duplicates,
    lambda d: packing.pack_documents(d, WORDS),
    lambda d: jaccard.similar_documents(d, 3, 90),
    suffixes.repeated_passages,
    lambda d: counts.token_counts(d, public_tokenizers.path("piece_bpe_32k.model"), f"{run_folder(d.sparkSession)}/c"),
    lambda d: language.predict_languages(d, language.learn_languages(d)),
    lambda d: tokenfile.round_trip(d, WORDS),
    units.without_repeated_units,
    exact.without_exact_duplicates,
    jaccard.without_similar_documents,
    suffixes.without_repeated_passages,
    lambda d: language.with_known_language(d, language.learn_languages(d)),
]


@pytest.mark.parametrize("operator", OPERATORS)
def test_an_empty_table_gives_no_rows(make, operator):
    assert operator(make([])).collect() == []


def test_bpe(make):
    pairs = [*repeated(), (None, "null id"), (None, None)]
    _same(bpe.encode_digests(make(pairs), RANKS, public_tokenizers.PATTERN), brute.bpe_rows(pairs, RANKS, public_tokenizers.PATTERN))
    full = bpe.encode_texts(make(pairs[:6]), RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in full) == [(d, (t or "").encode()) for d, t in pairs[:6]]


def test_exact_duplicates(make):
    pairs = [*repeated(), (None, "a"), (None, "only null"), (None, "only null")]
    groups = defaultdict(list)
    for d, t in pairs:
        groups[t or ""].append(d)
    keep = {t: max((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
    got = exact.exact_duplicates(make(pairs)).collect()
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert sorted((r.doc_id, r.keep_id, r.group_size, sha[r.text_sha256]) for r in got if r.doc_id is not None) == sorted(
        (d, keep[t or ""], len(groups[t or ""]), t or "") for d, t in pairs if d is not None
    )
    kept = [sha[r.text_sha256] for r in got if r.kept]
    assert sorted(kept) == sorted(groups)
    stays = exact.without_exact_duplicates(make(pairs))
    assert stays.columns == make(pairs).columns
    assert sorted((r.text or "") for r in stays.collect()) == sorted(groups)


def test_exact_index_takes_additions_and_deletions(make, spark):
    index = exact.digest_groups(exact.text_digests(make(texts())))
    more = exact.text_digests(make([(100, "a"), (101, "new")]))
    gone = exact.text_digests(make([(0, "a b"), (0, "not there")])).select("digest")
    live = {bytes(r.digest): (r.keep_id, r.n) for r in exact.live_after(index, more, gone).collect()}

    def at(text):
        return live.get(hashlib.sha256(text.encode()).digest())

    assert at("a") == (100, 3) and at("new") == (101, 1) and at("a b") is None and at("not there") is None
    assert len(live) == len({t or "" for _, t in texts()})


def test_packing(make):
    pairs = [*repeated(), (None, "null id")]
    expected = []
    for d, ids in brute.library_ids(pairs, WORDS, 1):
        start = 0
        for size in brute.piece_lengths(len(ids), 2048):
            expected.append((d, start, size, len(ids), brute.crc(ids[start : start + size])))
            start += size
    found = packing.pack_documents(make(pairs), WORDS, end_id=1, longest=2048)
    _same(found.select("doc_id", "start", "length", "doc_tokens", F.crc32("ids")), expected)
    got = sorted((r.sequence_id, r.length, r.offset) for r in found.collect())
    assert [s for s, _, _ in got] == list(range(len(got))) and {o for _, _, o in got} == {0}
    assert [n for _, n, _ in got] == sorted((n for _, n, _ in got), reverse=True)
    with pytest.raises(ValueError, match="power of two"):
        packing.pack_documents(make(pairs), WORDS, longest=1000)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_similar_documents(make, words, percent):
    _same(jaccard.similar_documents(make(repeated()), words, percent), brute.similar_rows(repeated(), words, percent))


def test_similar_documents_with_null_ids(make):
    got = _rows(jaccard.similar_documents(make([(4, "a b c d"), (None, "A b c d"), (None, "x y z"), (None, None)]), 3, 90))
    assert got == sorted([(4, 2, 4), (None, 2, 4), (None, 1, None), (None, 0, None)], key=repr)
    kept = jaccard.without_similar_documents(make([(4, "a b c d"), (5, "A b c d"), (None, "x")]))
    assert sorted(kept.select("doc_id").collect(), key=repr) == [(4,), (None,)]


def test_large_buckets_are_compared_in_blocks(make, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 3)
    rng = np.random.default_rng(0)
    base, pairs = _story(7, 90).split(), repeated()
    for k in range(40):
        own = list(base)
        for at in rng.integers(0, len(own), rng.integers(0, 4)):
            own[at] = f"q{rng.integers(0, 30)}"
        pairs.append((200 + k, " ".join(own)))
    _same(jaccard.similar_documents(make(pairs), 3, 90), brute.similar_rows(pairs, 3, 90))


@pytest.mark.parametrize(("frequent", "block"), [(4096, 1 << 22), (2, 400), (3, 5000)])
def test_repeated_passages(make, frequent, block):
    pairs = [*repeated(), (None, _story(1, 120)), (None, "short")]
    found = suffixes.repeated_passages(make(pairs), frequent, block)
    got = [(r.doc_id, r.n_bytes, [(s.start, s.start + s.length) for s in r.removed], bytes(r.kept)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute.passage_rows(pairs), key=repr)


def test_texts_without_repeated_passages_stay_valid(make):
    docs = make([*repeated(), (None, "short")]).withColumn("n_chars", F.length("text").cast("long"))
    stays = suffixes.without_repeated_passages(docs, count_col="n_chars")
    assert stays.dtypes == docs.dtypes
    got = {r.doc_id: r for r in stays.collect() if r.doc_id is not None}
    assert 12 in got and 11 in got and got[11].text.endswith(" tail") and got[11].n_chars == len(got[11].text) < 60
    assert got[17].text == "x" and got[2].text == "" and got[1].text == ""
    assert got[10].text == _story(1, 120)


def test_token_counts_and_their_cache(make, spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pairs = [*repeated(), (None, "null id"), (None, None)]
    expected = [(d, len((t or "").encode()), n := len(model.encode(t or "")), n > 20) for d, t in pairs]
    cache = f"{run_folder(spark)}/cache"
    _same(counts.token_counts(make(pairs), path, cache, limit=20), expected)
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in pairs})
    # a second table brings one new text: one more count is stored
    _same(counts.token_counts(make([*pairs, (99, "news")]), path, cache, limit=20), [*expected, (99, 4, len(model.encode("news")), False)])
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in pairs}) + 1
    json_counts = counts.token_counts(make(pairs), WORDS, cache, limit=20)
    assert {(r.doc_id, r.n_tokens) for r in json_counts.collect()} == {(d, len(ids) - 1) for d, ids in brute.library_ids(pairs, WORDS, 0)}


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame(
        [(None, None, "en", "s", 0), (None, "12 %% 3", "en", "s", 0), (9001, "", "de", "s", 0), (9002, "x" * 100_000, None, "s", 0)], docs.schema
    )
    docs = docs.unionByName(odd)
    model = language.learn_languages(docs)
    found = language.predict_languages(docs, model).withColumn("held", language.held_out(F.col("doc_id")))
    right = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held AND doc_id < 9000")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    assert found.filter("lang_pred = 'und' AND score = 0").count() == 3
    assert found.filter("score < 0 OR score > 1").count() == 0 and found.count() == docs.count()
    stays = language.with_known_language(docs, model, least_score=0.0)
    assert stays.columns == docs.columns and stays.count() == docs.count() - 3
    # the plain version: a text at a time, by the definition
    rows = docs.collect()
    with_letter = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
    told = [(r, *(x[0] for x in model.predict(language.features([r.text])))) for r in with_letter]
    for wanted, least in ((None, 0.5), (["en", "fr"], 0.5), (["de"], 0.99)):
        kept = [r for r, lang, score in told if score >= least and (wanted is None or lang in wanted)]
        stays = language.with_known_language(docs, model, wanted, least)
        _same(stays, [tuple(r) for r in kept])
        counts = language.language_counts(docs, model, wanted, least).collect()
        assert sum(r.n for r in counts if r.kept) == len(kept) and sum(r.n for r in counts) == len(rows)
    # neither lang nor source nor id is an input of a prediction
    blind = docs.select((F.col("doc_id") * 7 + 1).alias("doc_id"), "text")
    assert {(r.doc_id * 7 + 1, r.lang_pred) for r in found.collect() if r.doc_id is not None} == {
        (r.doc_id, r.lang_pred) for r in language.predict_languages(blind, model).collect() if r.doc_id is not None
    }


def test_without_usable_labels_the_text_alone_decides(make):
    docs = make([(1, "plain words"), (2, None), (3, "12 %% 3"), (4, ""), (None, "你好"), (5, "plain words")])
    model = language.learn_languages(docs)  # lang is null in all rows
    assert model is None
    stays = language.with_known_language(docs, model)
    assert stays.columns == docs.columns
    _same(stays.select("doc_id", "text"), [(1, "plain words"), (None, "你好"), (5, "plain words")])
    assert {(r.kept, r.n) for r in language.language_counts(docs, model).collect()} == {(True, 3), (False, 3)}


def test_texts_of_no_learned_language_go(spark):
    """By a model that has its 500 rows a language; from few rows it is less sure of what is strange."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.learn_languages(docs)
    other = ["Съешь же ещё этих мягких французских булок да выпей чаю.", "هذه جملة باللغة العربية", "Tämä on suomenkielinen lause jota käytetään testaamiseen."]
    strange = spark.createDataFrame([(n, t, None, "s", 0) for n, t in enumerate(other)], docs.schema)
    assert language.with_known_language(strange, model).isEmpty()
    assert language.with_known_language(docs, model).count() >= 0.995 * docs.filter(F.col("text").rlike(r"\p{L}")).count()


def test_top_inner_products(rows):
    rng = np.random.default_rng(8)
    vectors = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(60)]
    vectors += [(100, vectors[7][1]), (101, vectors[7][1]), (50, [1.0, 2.0]), (150, None), (200, [float("nan")] * 8), (250, [None] * 8), (300, []), (None, [0.5] * 8), (350, [float("inf")] * 8)]
    vectors += [(400, [1.0, 1.0, 1.0]), (401, [0.3, 0.4, -0.1])]
    df = rows([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<double>, rank string, score int")
    found = topk.top_inner_products(df, F.expr("vec_id % 50 = 0"), k=5, query_rows=3, block_rows=7)
    _same(found, brute.top_rows(vectors, 50, 5))
    assert topk.top_inner_products(df.limit(0), F.expr("vec_id % 50 = 0")).collect() == []


def test_token_file(make):
    pairs = [*texts(), (5, "a longer text than the other of this id, by some words"), (None, "null id")]
    start, expected = 0, []
    by_id = sorted(brute.library_ids(pairs, WORDS, 2), key=lambda x: (x[0] is None, x[0] or 0, len(x[1])))
    for d, ids in by_id:
        expected.append((d, start, len(ids), brute.crc(ids)))
        start += len(ids)
    found = tokenfile.round_trip(make(pairs), WORDS)
    _same(found.select("doc_id", "start", "n_tokens", F.crc32("ids")), expected)


def test_repeated_units(make):
    pairs = [*repeated(), (None, "same line of words\nnull line of words\n"), (10, "another text of ten\nsame line of words")]
    found = units.without_repeated_units(make(pairs))
    _same(found.select("doc_id", "n_units", "n_cut", "kept_text"), brute.unit_rows(pairs))
    for r in found.collect():
        text = next((t or "") for d, t in pairs if d == r.doc_id and len((t or "").encode()) == r.n_bytes).encode()
        spans = [(s.start, s.start + s.length) for s in r.removed]
        kept = b"".join(text[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(text)], strict=True))
        if r.doc_id != 10:
            assert kept.decode() == r.kept_text


LONG = "this sentence is certainly longer than forty letters"


@pytest.mark.parametrize("kind, unit", [("sentence", units.SENTENCE), ("line", units.LINE), ("paragraph", units.PARAGRAPH)])
def test_units_of_each_kind(make, kind, unit):
    shown = [
        "one\ntwo words\n", "ONE\n two  words \nthree", "https://example.org/a/very/long/address\n", "x https://example.org/a/very/long/address\nhttps://example.org/a/very/long/address",
        "没有空格的一行字，它很长，但是只有一个词。" * 3, "前面" + "没有空格的一行字，它很长，但是只有一个词。" * 3, f"{LONG}. Then {LONG}! And... {LONG}?No", f"Other {LONG}. Then {LONG}! {LONG}.\tEnd", f"{LONG}..!  \n\n\n{LONG}",
        "a. b. c. d.", "\n", " \t\n\n \n", "p one\n\np two\n\n\np one\n\n", f"p two\n\n{LONG}.", f"{LONG} 3.14 and v1.2 stays. {LONG}. ",
    ]
    pairs = [(k, t) for k, t in enumerate(shown)]
    found = units.without_repeated_units(make(pairs), unit)
    _same(found.select("doc_id", "n_units", "n_cut", "kept_text"), brute.unit_rows(pairs, kind))


def test_short_and_blank_free_lines_are_cut(make):
    pairs = [(1, "yes\nof course\n汉字没有空格\n"), (2, "new\nyes\nof course\n汉字没有空格\n")]
    assert {r.doc_id: r.kept_text for r in units.without_repeated_units(make(pairs)).collect()} == {1: pairs[0][1], 2: "new\n"}


def test_a_passage_inside_other_lines_is_cut(make):
    passage = " ".join(f"{LONG} number {k}." for k in range(8))
    pairs = [(1, f"Before it all. {passage} After it."), (2, f"Elsewhere, in another line, it says so. {passage} Then it goes on.")]
    kept = {r.doc_id: r.kept_text for r in units.without_repeated_units(make(pairs)).collect()}
    assert kept[1] == pairs[0][1] and len(kept[2]) < len(pairs[1][1]) - 0.8 * len(passage)  # its first sentence shares a unit with what stands before
