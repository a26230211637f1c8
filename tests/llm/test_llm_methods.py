"""The parts of the operators that need no session, against plain versions."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logweir.llm.bpe import PrefixEncoding, TextEncoder, Vocabulary
from logweir.llm.exact import CuckooIndex
from logweir.llm.jaccard import SKETCH, links_within, prefix, prefix_size
from logweir.llm.library import WordIds
from logweir.llm.merge import common_prefixes, front_code, front_decode, merge_runs
from logweir.llm.packing import binary_pieces
from logweir.llm.shingles import shingle_sets
from logweir.llm.suffixes import _bucket, _stretches
from logweir.llm.tokenfile import canonical_codes, code_lengths, pack_bits, unpack_bits
from logweir.llm.topk import search_block


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def texts(vocabulary):
    return TextEncoder(vocabulary, public_tokenizers.PATTERN)


ODD_TEXTS = [
    "", " ", "  ", " \n ", "a  b", "a   b", "a \n b", "a \nb\t c ", "it's we'll I'VE 12 345", "x\x1cy\x85z w", "İstanbul ΣΑΣ straße",
    "你好 世界 🙂🙃", "é è", "<|endoftext|> <|startoftext|>x", "....,,,;;;", "a" * 3000, " " * 500 + "x", "\n" * 100, "word. word, word; ﬁ ª º ²",
]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_the_library(texts, text):
    assert texts.encode(text) == _library().encode_ordinary(text)
    assert texts.decode(texts.encode(text)) == text.encode()


_made = []


def _library():
    import base64

    import tiktoken

    if not _made:
        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _made.append(tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _made[0]


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_bpe_of_odd_texts(texts, text):
    assert texts.encode(text) == _library().encode_ordinary(text)


def test_prefix_encoding_appends_and_edits(vocabulary):
    rng = random.Random(1)
    words = "the thereof nation ationality un re reread étude straße 123 aaaaaaa bababa".split()
    for _ in range(40):
        data = " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))).encode()
        cut = rng.randint(0, len(data))
        made = PrefixEncoding(vocabulary, data[:cut])
        made.append(data[cut:])
        assert made.last == PrefixEncoding(vocabulary, data).last
        assert made.ids() == vocabulary.merged(data)
        end = rng.randint(0, len(data))
        assert made.ids(end) == vocabulary.merged(data[:end])
        start, stop = sorted((rng.randint(0, len(data)), rng.randint(0, len(data))))
        put = rng.choice(words).encode()[: rng.randint(0, 5)]
        made.replace(start, stop, put)
        fresh = PrefixEncoding(vocabulary, data[:start] + put + data[stop:])
        assert (bytes(made.data), made.last) == (bytes(fresh.data), fresh.last)


def test_neighbours_are_those_that_merging_leaves(vocabulary):
    rng = random.Random(9)
    whole = [t for t in rng.sample(range(50_000), 4000) if vocabulary.is_whole(t)] + list(range(256))
    for _ in range(20_000):
        a, b = rng.choice(whole), rng.choice(whole)
        merged = vocabulary.merged(vocabulary.tokens[a] + vocabulary.tokens[b])
        assert vocabulary.follows(a * len(vocabulary.tokens) + b) == (merged == [a, b])


def test_an_edit_redoes_only_what_is_near(vocabulary):
    small = Vocabulary({bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257})
    made = PrefixEncoding(small, b"abcd" * 2000)
    assert made.replace(10, 11, b"x") < 50
    assert made.last == PrefixEncoding(small, bytes(made.data)).last


def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tool, plain = WordIds(path), Tokenizer.from_file(path)
    assert tool._by_word
    for some in (ODD_TEXTS, ODD_TEXTS[::-1]):
        got = [np.frombuffer(x, "<u4").tolist() for x in tool(some)]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in some]
    other = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(other)
    assert [np.frombuffer(x, "<u4").tolist() for x in WordIds(other)(ODD_TEXTS)] == [plain.encode(t, add_special_tokens=False).ids for t in ODD_TEXTS]


def test_cuckoo_index_is_a_dictionary():
    rng, index, plain = random.Random(2), CuckooIndex(4), {}
    keys = [rng.randbytes(32) for _ in range(3000)]
    keys += [keys[0][:2] + rng.randbytes(24) + keys[0][-6:] for _ in range(40)]  # one fingerprint, one row
    for _ in range(20000):
        key = rng.choice(keys)
        if rng.random() < 0.6:
            index.put(key, rng.random())
            plain[key] = index.get(key)
        else:
            assert index.take_out(key) == (key in plain)
            plain.pop(key, None)
        probe = rng.choice(keys)
        assert index.get(probe) == plain.get(probe)
    assert dict(index.items()) == plain and len(index) == len(plain)


@pytest.mark.parametrize("n", [0, 1, 2, 2047, 2048, 2049, 100_003])
def test_pieces_are_powers_of_two(n):
    pieces = binary_pieces(n, 2048)
    assert [p for _, p in pieces] == brute.piece_lengths(n, 2048)
    assert sum(p for _, p in pieces) == n


def test_shingles_as_defined():
    some = ["", " \t", "A b", "a B c", "a b c a b c", "é É\x85x y z", "x" * 100_000, "w " * 50_000, None or "one\x0btwo\x0cthree\rfour"]
    for words in (1, 3, 5):
        assert [len(s) for s in shingle_sets(some, words)] == [len(brute.shingle_set(t, words)) for t in some]
    a, b = shingle_sets(["The quick brown fox", "  the QUICK\nbrown\tfox "], 3)
    assert a.tolist() == b.tolist()


def test_similar_sets_share_prefixes_in_every_order():
    rng = np.random.default_rng(3)
    classes = rng.integers(0, 4, SKETCH).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        other = np.unique(np.r_[base[rng.random(len(base)) < 0.96], rng.integers(0, 2**63, int(rng.integers(0, 4)), dtype=np.uint64)])
        both = len(np.intersect1d(base, other))
        if 100 * both >= 90 * (len(base) + len(other) - both):
            for order in range(3):
                a, b = (prefix(s, order, classes, 90) for s in (base, other))
                assert len(a) == min(prefix_size(len(base), 90), len(base)) and len(np.intersect1d(a, b))


def test_links_within_connect_what_all_pairs_connect():
    rng = np.random.default_rng(4)
    classes = np.zeros(SKETCH, np.uint8)
    base = [np.unique(rng.integers(0, 2**63, 60, dtype=np.uint64)) for _ in range(6)]
    sets = []
    for k in range(120):
        b = base[k % 6]
        sets.append(np.unique(np.r_[b[rng.random(len(b)) < rng.choice([0.93, 0.97, 1])], rng.integers(0, 2**63, 2, dtype=np.uint64)]))
    for percent in (80, 90):
        links = links_within(list(range(len(sets))), sets, percent, classes, np.arange(len(sets)))
        root = list(range(len(sets)))

        def find(i, root=root):
            return i if root[i] == i else find(root[i])

        for a, b in links:
            both = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)
            root[find(a)] = find(b)
        for a in range(len(sets)):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b]))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    assert find(a) == find(b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=6), max_size=12), max_size=7))
def test_loser_tree_merges_front_coded_runs(runs):
    width, coded, shared_of = 6, [], []
    for run in runs:
        strings = sorted(s.encode() for s in run)
        rows = np.array([list(s.ljust(width, b"\0")) for s in strings], np.uint8).reshape(-1, width)
        sizes, shared = np.array([len(s) for s in strings], np.int64), common_prefixes(rows)
        again = front_decode(front_code(rows, np.minimum(shared, sizes), sizes), np.minimum(shared, sizes), sizes, width)
        assert (again == rows).all()
        coded.append([int.from_bytes(r.tobytes()) for r in rows])
        shared_of.append(shared.tolist())
    from_run, prefixes = merge_runs(coded, shared_of, width)
    at, merged = [0] * len(runs), []
    for r in from_run:
        merged.append(coded[r][at[r]])
        at[r] += 1
    assert merged == sorted(x for run in coded for x in run)
    rows = np.array([list(x.to_bytes(width)) for x in merged], np.uint8).reshape(-1, width)
    assert prefixes == common_prefixes(rows).tolist()


def _huffman_cost(counts):
    import heapq

    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    return cost


def test_code_lengths_are_optimal_and_limited():
    rng = np.random.default_rng(5)
    counts = rng.integers(1, 1000, 300)
    lengths = code_lengths(counts)
    assert (lengths * counts).sum() == _huffman_cost(counts.tolist())
    steep = np.array([1 << min(k, 55) for k in range(60)], np.int64)
    limited = code_lengths(steep, 8)
    assert limited.max() == 8 and sum(2.0**-limited.astype(float)) == 1
    assert code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0] and code_lengths(np.zeros(0, np.int64)).tolist() == []
    codes = canonical_codes(lengths)
    words = sorted(f"{int(c):0{n}b}" for c, n in zip(codes, lengths, strict=True))
    assert not any(b.startswith(a) for a, b in zip(words, words[1:], strict=False))


@pytest.mark.parametrize("n", [1, 127, 128, 129, 5000])
def test_bits_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 40_000)
    lengths = code_lengths(np.bincount(ids)).tobytes()
    bits, offsets = pack_bits(ids, lengths)
    assert unpack_bits(bits, offsets, n, lengths).tolist() == ids.tolist()


def test_search_block_finds_the_best_of_any_lengths():
    rng = np.random.default_rng(6)
    for scale in (1, 30, 3e7):
        c = np.floor(rng.normal(size=(700, 24)) * scale * rng.uniform(0.1, 3, (700, 1)))
        c = c[np.argsort(-(c * c).sum(1))]
        cid, qid = np.arange(700), np.arange(0, 700, 13)
        rotation = np.linalg.eigh(c.T @ c)[1][:, ::-1]
        i, vec, score, _ = search_block(qid, c[qid], cid, c, 5, rotation, step=64)
        expected = brute.top_rows([(int(a), r.tolist()) for a, r in zip(cid, c, strict=True)], 13, 5, 1.0)
        got = sorted(zip(qid[i].tolist(), (-score).tolist(), vec.tolist(), strict=True))
        assert [(q, v, -s) for q, s, v in got] == [(q, v, s) for q, _, v, s in expected]


def _doubled(n):
    """A word of a and b that sums of bytes times powers cannot tell from its complement."""
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return ["a" * 8 + word, "a" * 8 + word.translate(str.maketrans("ab", "ba"))]


@pytest.mark.parametrize("n", [1024, 2048, 1 << 15])
def test_unlike_words_have_unlike_shingles(n):
    one, other = shingle_sets(_doubled(n), 3)
    assert one.tolist() != other.tolist()


@pytest.mark.parametrize("at_once", [1, 2])
def test_unlike_words_have_their_own_ids(at_once):
    path, texts = public_tokenizers.path("word_bpe_49k.json"), [*_doubled(2048), "sixteen_letters__", "sixteenlettersabc", "sixteenlettersab"]
    ids = WordIds(path)
    got = [i for k in range(0, len(texts), at_once) for i in ids(texts[k : k + at_once])]
    assert got == [np.array(i[:-1], "<u4").tobytes() for _, i in brute.library_ids(enumerate(texts), path, 0)]


@pytest.mark.parametrize("pattern", [r"\S+|\s+", r"[^b]+|b+", r"(?s:.{1,7})"])
def test_another_pattern_is_taken_at_its_word(vocabulary, pattern):
    import regex
    import tiktoken

    tool = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})
    for text in ("the cat and the bobbed dog sat", "a b  c\nd e", "words. and, marks!"):
        assert "".join(regex.findall(pattern, text)) == text
        assert TextEncoder(vocabulary, pattern).encode(text) == tool.encode_ordinary(text)


def test_the_common_pattern_is_known():
    from logweir.llm import bpe

    assert public_tokenizers.PATTERN == bpe.COMMON


def test_anchors_are_dealt_evenly():
    data = np.random.default_rng(3).integers(97, 123, 200_000).astype(np.uint8)
    *_, value, _ = _stretches(data, np.array([len(data)]))
    per_bucket = np.bincount(_bucket(value, 64), minlength=64)
    assert per_bucket.max() < 2 * per_bucket.mean()
