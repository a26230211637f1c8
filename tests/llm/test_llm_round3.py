"""Toxicity, spelling variants and tokenizer alignment against plain versions and planted cases."""

import random
import string
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_operators import SCHEMA, repeated, texts

from logweir.llm import alignment, spelling, toxicity
from logweir.llm.queries import QUERIES
from logweir.llm.tables import table

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def make(rows):
    def frame(pairs):
        return rows([(d, t, None, "s", None, "x", 1, "k", "r", 5, "b", "m", "p", "o") for d, t in pairs], SCHEMA).repartition(3)

    return frame


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# spelling


def _one_step(rnd, word):
    i, c = rnd.randrange(len(word)), rnd.choice("abcé")
    return rnd.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


@pytest.mark.parametrize("seed", range(30))
def test_near_words_equal_all_pairs(seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(2, 7))) for _ in range(rnd.randint(1, 120))}
    words = sorted(words | {"".join(rnd.choice(string.ascii_lowercase) for _ in range(rnd.randint(60, 140))) for _ in range(3)})
    words += sorted({_one_step(rnd, w) for w in words} - set(words))
    asks, asked = np.array([[rnd.random() < 0.7 for _ in words] for _ in range(2)])
    got = list(zip(*(x.tolist() for x in spelling.near_words(*spelling._codes(words), asks, asked)), strict=True))
    every = [(i, j) for i in range(len(words)) for j in range(len(words)) if asks[i] and asked[j] and brute._one_apart(words[i], words[j])]
    assert sorted(got) == every


def _vocabulary(seed, n):
    rnd = random.Random(seed)
    # many words share a half, so that blocks are cut into pieces
    words = {"inter" + "".join(rnd.choice("abé") for _ in range(rnd.randint(3, 8))) for _ in range(n)}
    words |= {"".join(rnd.choice("abé") for _ in range(rnd.randint(2, 7))) + "ation" for _ in range(n)}
    words |= {_one_step(rnd, w) for w in sorted(words)}
    return {w: rnd.choice([5, 6, 25, 30, 130, 700, 4000]) for w in sorted(words) if len(w) >= 6}


@pytest.mark.parametrize("piece", [16, 2048])
def test_spelling_groups_equal_all_pairs(spark, rows, piece):
    counts = _vocabulary(piece, 150)
    found = spelling.spelling_groups(rows(list(counts.items()), "word string, n long").repartition(3), piece=piece)
    assert _rows(found) == sorted(brute.spelling_rows(counts, 5), key=repr)


def test_roots_follow_a_chain(spark, rows):
    counts = {"abcdefgh"[: 6] + "x" * k: 5 * 5**k for k in range(6)}
    found = {r.word: r.root for r in spelling.spelling_groups(rows(list(counts.items()), "word string, n long")).collect()}
    assert set(found.values()) == {"abcdefxxxxx"}


def test_words_of_odd_texts(spark, make):
    docs = [
        (1, None), (2, ""), (None, "Straße straße STRASSE naïve"), (3, "naïve×naïve÷x über " * 9), (3, "naïve×naïve÷x über " * 9), (4, "z" * 50_000 + " letters1letters_letters"),
        *[(k, "letters Letters letterss lettres") for k in range(5, 1200)],
    ]
    for every in (None, 3):
        counts = brute.counted_words(docs, 6, 5, every)
        words = spelling.counted_words(make(docs), damaged_every=every)
        assert _rows(words) == sorted(counts.items(), key=repr)
        assert _rows(spelling.spelling_groups(words)) == sorted(brute.spelling_rows(counts, 5), key=repr)


def test_no_words(spark, make):
    words = spelling.counted_words(make([(1, "a b")]))
    assert spelling.spelling_groups(words).collect() == []
    assert spelling.spelling_groups(spelling.counted_words(make([]))).collect() == []


# alignment


def test_alignment_of_odd_texts(spark, make):
    docs = [*repeated(), (None, "null id"), (40, "</s> <|endoftext|> <s>"), (41, "▁mark"), (42, "ﬁ ½ é é"), (43, "  two  blanks \n"), (44, "­​")]
    got = alignment.align_tokenizers(make(docs), BYTES, PIECES)
    assert _rows(got) == sorted(brute.alignment_rows(docs, BYTES, PIECES), key=repr)


def test_alignment_of_empty_tables(spark, make):
    assert alignment.align_tokenizers(make([]), BYTES, PIECES).collect() == []
    assert _rows(alignment.align_tokenizers(make([(1, None), (1, "")]), BYTES, PIECES)) == [(1, 0, 0, 0, 0, 0, 0, "")] * 2


def test_alignment_query_equals_the_plain_version(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = QUERIES["op13_tokenizer_alignment"](spark, sf)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.alignment_rows(docs, BYTES, PIECES))


def test_equal_bytes_take_the_fast_path():
    tool = alignment.alignment(BYTES, PIECES)
    same = np.flatnonzero(tool.identity >= 0)
    assert len(same) > 10_000
    assert all(tool.a[i] == tool.b[tool.identity[i]] for i in same.tolist())
    ((_, _, n_groups, _, equal, pairs),) = tool(["the cat and the dog"])
    assert n_groups == len(tool.ids_of(equal)) + len(pairs) and len(pairs) == 0


# toxicity


def _prose(rnd, n, bad=()):
    parts = "the of and tion er re nd wh ing ou sh ble at on".split()
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 2))) for _ in range(n)]
    for w in bad:
        words.insert(rnd.randrange(len(words) + 1), w)
    return " ".join(words)


def _labelled(seed, n):
    rnd = random.Random(seed)
    bad = {"en": ["stinker", "dimwit", "rotter"], "fr": ["vilain", "goujat", "malotru"]}
    docs, labels = [], []
    for i in range(n):
        lang, toxic = rnd.choice(["en", "fr"]), int(rnd.random() < 0.3)
        text = ("" if lang == "en" else "été où ") + _prose(rnd, rnd.randint(5, 200), rnd.sample(bad[lang], 2) if toxic else ())
        docs.append((i, text, lang))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxic_texts_that_were_held_out_are_found(spark, rows):
    docs, labels = _labelled(1, 1500)
    docs += [(5000, None, None), (5001, "", "en"), (None, "stinker dimwit", None), (7, docs[7][1], docs[7][2]), (6000, "and the " * 40_000 + "rotter dimwit", "en")]
    d = rows([(*x, "s", 1.5, "p", True) for x in docs], "doc_id long, text string, lang string, source string, score double, predicted string, toxic boolean")
    model = toxicity.learn_toxicity(d, rows([*labels, (None, 1, 1), (3, None, None), (9999, 1, 1)], "doc_id long, quality int, toxic int"))
    got = toxicity.score_toxicity(d, model)
    assert got.columns == ["doc_id", "score", "predicted"]
    found = [tuple(r) for r in got.withColumn("h", toxicity.held_out(got.doc_id)).collect()]
    assert len(found) == len(docs) and all(0 <= s <= 1 and p == int(s >= 0.5) for _, s, p, _ in found)
    toxic = {i for i, _, t in labels if t}
    held = [(i in toxic, p) for i, _, p, h in found if h and i is not None and i < 1500]
    assert sum(t == p for t, p in held) > 0.95 * len(held)
    by_id = {i: (s, p) for i, s, p, _ in found}
    assert by_id[None][1] == 1 and by_id[6000][1] == 1
    assert by_id[5000] == by_id[5001] and by_id[5000][1] == 0


def test_other_columns_do_not_change_a_score(spark, rows):
    docs, labels = _labelled(2, 300)
    d = rows([(*x, "s") for x in docs], "doc_id long, text string, lang string, source string")
    model = toxicity.learn_toxicity(d, rows(labels, "doc_id long, quality int, toxic int"))
    other = rows([(i + 10**6, t, "xx", "y") for i, t, _ in docs], "doc_id long, text string, lang string, source string")
    one = {r.doc_id: r.score for r in toxicity.score_toxicity(d, model).collect()}
    assert {r.doc_id - 10**6: r.score for r in toxicity.score_toxicity(other, model).collect()} == one


@pytest.mark.parametrize("label", [None, 0, 1])
def test_without_two_labels(spark, rows, label):
    docs = rows([(i, f"text {i}", None) for i in range(20)], "doc_id long, text string, lang string")
    labels = rows([(i, label) for i in range(20) if label is not None], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, toxicity.learn_toxicity(docs, labels)).collect()
    assert len({r.score for r in got}) == 1 and {r.predicted for r in got} == {label or 0}
    empty = docs.limit(0)
    assert toxicity.score_toxicity(empty, toxicity.learn_toxicity(empty, labels)).collect() == []


def test_repeated_rows_are_sampled_once(spark, rows):
    docs = rows([(4, "same text", "en")] * 3000 + [(i, f"text {i}", "en") for i in range(10, 60)], "doc_id long, text string, lang string")
    labels = rows([(4, 1), (4, 0)] * 50 + [(i, 0) for i in range(10, 60)], "doc_id long, toxic int")
    chosen = toxicity._sampled(labels, docs, 20)
    found = sorted(tuple(r) for r in chosen.collect())
    assert len(found) == len({d for d, _, _ in found}) and sum(t == 0 for _, t, _ in found) == 20
    assert [t for d, t, _ in found if d == 4] == [1]


def test_every_labelled_row_is_learned_from(spark, rows):
    ids = [i for i in range(16_000) if zlib.crc32(str(i).encode()) % 5][:12_000]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long").orderBy(F.shiftrightunsigned(F.xxhash64("doc_id"), 33))
    ids = [r.doc_id for r in frame.collect()]
    # of the toxic rows, those with the last hashes hold a word of their own
    toxic = set(ids[::2])
    late = set([i for i in ids if i in toxic][-40:])
    texts = [(i, "good day" + " zyzzyva" * (i in late) + " rotter" * (i in toxic - late), "en") for i in ids]
    docs = rows([*texts, (10**6, "good day zyzzyva", "en"), (10**6 + 1, "good day", "en")], "doc_id long, text string, lang string")
    labels = rows([(i, int(i in toxic)) for i in ids] + [(i, 0) for i in range(20_000, 20_010)], "doc_id long, toxic int")
    # more rows a label than were once taken
    more = rows([(10**7 + i, "good day rotter", "en") for i in range(1500)], "doc_id long, text string, lang string")
    labels = labels.union(more.select("doc_id", F.lit(1)))
    model = toxicity.learn_toxicity(docs.union(more), labels)
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).filter(F.col("doc_id") >= 10**6).collect()}
    assert got == {10**6: 1, 10**6 + 1: 0}


def test_parts_learn_together(spark, rows, monkeypatch):
    docs, labels = _labelled(3, 1200)
    d = rows(docs, "doc_id long, text string, lang string")
    known = rows(labels, "doc_id long, quality int, toxic int")
    n_learned = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, *_ in labels)
    counts, added = [], toxicity._added
    monkeypatch.setattr(toxicity, "ROWS_PER_PART", 300)
    monkeypatch.setattr(toxicity, "_added", lambda vectors: counts.append(added(vectors)) or counts[-1])
    model = toxicity.learn_toxicity(d, known)
    assert sum(v[-1] for name, v in counts[0].items() if "lang" not in name) == n_learned
    assert sum(v.sum() for v in counts[-1].values()) == n_learned
    assert toxicity.learn_toxicity(d.repartition(7), known.repartition(3)) == model
    found = {r.doc_id: r.predicted for r in toxicity.score_toxicity(d, model).collect()}
    held = [(t, found[i]) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(t == p for t, p in held) > 0.95 * len(held)


def test_held_out_accuracy_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op11_toxicity"](spark, sf).filter("held_out")
    met = got.join(table(spark, sf, "labels"), "doc_id").select("toxic", "predicted").collect()
    caught = [r.predicted for r in met if r.toxic]
    clean = [r.predicted == 0 for r in met if not r.toxic]
    print(len(caught), np.mean(caught), np.mean(clean))
    assert len(caught) > 50 and np.mean(caught) > 0.75 and np.mean(clean) > 0.93


# earlier operators


def test_repeated_rows_teach_a_language_once(spark, rows, monkeypatch):
    from logweir.llm import language

    seen = []
    monkeypatch.setattr(language, "fit", lambda x, langs: seen.append(langs))
    docs = [(4, "wieder und wieder", "de")] * 3000 + [(k, f"encore {k}", "fr") for k in range(10, 400)] + [(k, f"label {k}", f"l{k}") for k in range(500, 600)]
    frame = rows(docs, "doc_id long, text string, lang string").repartition(3)
    language.learn_languages(frame, rows_per_language=10, languages=40)
    counts = {lang: seen[0].count(lang) for lang in set(seen[0])}
    assert counts["fr"] == 10 and max(counts.values()) == 10 and len(counts) == 40


def test_packing_query_equals_the_library(spark):
    import duckdb

    sf, path = "/root/testdata/sf0.001", public_tokenizers.path("word_bpe_49k.json")
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    expected = []
    for d, ids in brute.library_ids(docs, path, 1):
        start = 0
        for size in brute.piece_lengths(len(ids), 2048):
            expected.append((d, start, size, brute.crc(ids[start : start + size]), len(ids)))
            start += size
    got = [tuple(r) for r in QUERIES["op3_packing"](spark, sf).collect()]
    assert sorted(r[:5] for r in got) == sorted(expected)
    ends = {}
    for *_, length, _, _, sequence, offset in sorted(((r[0], r[1], r[2], r[3], r[4], r[5], r[6]) for r in got), key=lambda r: (r[5], r[6])):
        assert offset == ends.get(sequence, 0)
        ends[sequence] = offset + length
    assert max(ends.values()) <= 2048
