"""The plain definitions that the operators are tested against: whole tables, no tricks."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def bpe_rows(docs, path, pattern):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tool = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = []
    for doc_id, text in docs:
        ids = tool.encode_ordinary(text or "")
        out.append((doc_id, len(ids), _sha(",".join(map(str, ids)).encode()), _sha(tool.decode_bytes(ids))))
    return out


def library_ids(docs, path, end_id):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(path)
    return [(doc_id, [*tool.encode(text or "", add_special_tokens=False).ids, end_id]) for doc_id, text in docs]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def piece_lengths(n: int, longest: int) -> list[int]:
    out = []
    while n:
        size = min(longest, 1 << (n.bit_length() - 1))
        out.append(size)
        n -= size
    return out


def shingle_set(text, words):
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))))
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def similar_rows(docs, words, percent):
    """(doc_id, set size, least doc_id reachable); every pair that shares a shingle is compared."""
    sets = [(doc_id, shingle_set(text, words)) for doc_id, text in docs]
    holders = {}
    for i, (_, s) in enumerate(sets):
        for shingle in s:
            holders.setdefault(shingle, []).append(i)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, s) in enumerate(sets):
        common = Counter(j for shingle in s for j in holders[shingle] if j < i)
        for j, both in common.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(doc_id, len(s), least[find(i)]) for i, (doc_id, s) in enumerate(sets)]


def passage_rows(docs, size=50):
    """(doc_id, bytes, removed spans, kept bytes); null ids rank last."""
    rank = [float("inf") if doc_id is None else doc_id for doc_id, _ in docs]
    data = [(text or "").encode() for _, text in docs]
    first = {}
    for r, d in zip(rank, data, strict=True):
        for p in range(len(d) - size + 1):
            s = d[p : p + size]
            if r < first.get(s, float("inf")):
                first[s] = r
    out = []
    for (doc_id, _), r, d in zip(docs, rank, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for p in range(len(d) - size + 1):
            if first.get(d[p : p + size], r) < r:
                gone[p : p + size] = True
        gone = gone[:-1]
        edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).tolist()
        out.append((doc_id, len(d), list(zip(edge[::2], edge[1::2], strict=True)), bytes(np.frombuffer(d, np.uint8)[~gone])))
    return out


def top_rows(vectors, every, k, scale=256.0):
    import math

    good = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in vectors
        if i is not None and v is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in good:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in good if c != q and len(w) == len(v))
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:k], 1)]
    return out


def units_of(text, kind):
    """The text cut into lines, into paragraphs, or into lines and sentences of 40 characters and more."""
    if kind == "paragraph":
        parts = text.split("\n\n")
        return [p + "\n\n" for p in parts[:-1]] + [p for p in parts[-1:] if p]
    out = [line for line in re.split(r"(?<=\n)", text) if line]
    if kind == "line":
        return out
    sentences = []
    for line in out:
        start = i = 0
        while i < len(line):
            stop = i
            if i - start >= 40 and line[i] in ".!?":
                while stop < len(line) and line[stop] in ".!?":
                    stop += 1
                if stop < len(line) and line[stop] not in " \t":
                    stop = i
            elif i - start >= 40 and line[i] in "。！？":
                while stop < len(line) and line[stop] in "。！？":
                    stop += 1
            elif i - start >= 40 and line[i] == "\n":
                break
            if stop > i and stop < len(line) or stop > i and line[i] in "。！？":
                while stop < len(line) and line[stop] in " \t":
                    stop += 1
                sentences.append(line[start:stop])
                start = i = stop
            else:
                i += 1
        if start < len(line):
            sentences.append(line[start:])
    return sentences


def unit_rows(docs, kind="sentence"):
    """(doc_id, units, cut units, kept text)."""
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, cut = {}, {}
    ranked = sorted(
        ((float("inf") if d is None else d, t or "", n) for d, t in docs for n in range(len(units_of(t or "", kind)))),
        key=lambda x: (x[0], x[2]),
    )
    for doc_id, text, n in ranked:
        plain = re.sub(r"[ \t\n\x0b\f\r]+", " ", units_of(text, kind)[n].translate(small)).strip(" ")
        if plain and seen.setdefault(plain, (doc_id, text, n)) != (doc_id, text, n):
            cut.setdefault((doc_id, text), set()).add(n)
    out = []
    for d, t in docs:
        gone, whole = cut.get((float("inf") if d is None else d, t or ""), set()), units_of(t or "", kind)
        out.append((d, len(whole), len(gone), "".join(w for n, w in enumerate(whole) if n not in gone)))
    return out


def _one_apart(a, b):
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def counted_words(docs, min_length, min_count, damaged_every=None):
    import zlib

    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(small)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damaged_every and h % damaged_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def spelling_rows(counts, ratio):
    forms, out = {}, []
    near = {w: [v for v in counts if _one_apart(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return out


def alignment_rows(docs, byte_level, pieces):
    """(doc_id, n_a, n_b, groups, links, best, counts, digest) from the libraries' own ids."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a_tool, b_tool = Tokenizer.from_file(byte_level), sentencepiece.SentencePieceProcessor(model_file=pieces)
    a_tool.encode_special_tokens = True
    # the library's decoder loses bytes that are no character alone, so bytes are led back by its alphabet
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain}
    chars.update((chr(256 + k), b) for k, b in enumerate(b for b in range(256) if b not in plain))
    assert ByteLevel().decode(["Ġa"]) == " a"
    counts, found = Counter(), []
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        ids_a = a_tool.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b_tool.encode(text or "")
        bytes_a = [bytes(chars[c] for c in a_tool.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            p = b_tool.id_to_piece(i)
            bytes_b.append(bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode())
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            found.append((doc_id, [], [], [], ""))
            continue
        at_a = dict(zip(np.cumsum([len(x) for x in bytes_a]).tolist(), range(len(ids_a)), strict=True))
        at_b = dict(zip(np.cumsum([len(x) for x in bytes_b]).tolist(), range(len(ids_b)), strict=True))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(at_a.keys() & at_b.keys()):
            x, y = at_a[end] + 1, at_b[end] + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            links.append((ids_a[x - 1], ids_b[y - 1]))
            i, j = x, y
        counts.update(links)
        found.append((doc_id, ids_a, ids_b, links, _sha(";".join(groups).encode())))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (d, len(a), len(b), len(x), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), digest)
        for d, a, b, x, digest in found
    ]
