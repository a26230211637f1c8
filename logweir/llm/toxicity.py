"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling.

A text is the sequence of its words, each a row of an embedding table by its hash. Filters slide
over one, two and three words; of each filter the largest answer over the whole text counts.
The pooled answers go through one linear layer. Where a score becomes a 1 is set for each
language apart; a text's language is told from its words alone, as the learned rows show them.

All labelled rows are learned from, whole. They are dealt into parts by a hash of the id. Counts
are added up over the parts; in a round of learning every part goes over its own rows from the
common weights, and the weights move by the mean of the parts' moves. What is added up has the
size of a network, whatever the input, and is added on the executors.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, fields
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.llm.shingles import passes, span_hashes
from logweir.llm.tables import run_folder, ship, written
from logweir.session import shared_folder

#: Rows of the embedding table.
BUCKETS = 1 << 15
#: Numbers in an embedding, words under a filter, filters of each width.
DIMENSIONS, WIDTHS, FILTERS = 12, (1, 2, 3), 8
#: Rows and words of a part, about: what a task goes over at a time.
ROWS_PER_PART, WORDS_PER_PART = 8192, 4_000_000
#: Folds of the learned rows, each scored by the network that has learned from the others, to set the thresholds.
FOLDS = 3
#: A clean text that is marked counts as much as so many toxic ones that are not.
CLEAN_WEIGHT = 2
#: Rows of a language and label below which its threshold leans on that of all languages.
LEAN = 10
#: Languages with a threshold of their own: the most frequent ones of the learned rows.
LANGUAGES = 64
#: Learned texts with a word below which its embedding stays 0; texts added to each word's counts.
LEAST_TEXTS, SMOOTH = 3, 2.0
ROUNDS, STEP, AT_ONCE = 6, 0.01, 64
#: Share of the words that a round of learning does not see.
DROPPED = 0.2
#: Margins are counted in steps of 1 / STEPS, from -FARTHEST on.
STEPS, FARTHEST = 256, 32
#: Pieces in which a network's moves are added up.
PIECES = 16

# Letters and digits make words, in UTF-8 every byte of a character beyond ASCII too.
_WORD = np.array([chr(c).isalnum() or c >= 128 for c in range(256)])


def word_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word, words of each text), in lower case."""
    encoded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(encoded) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(np.r_[False, _WORD[data]].view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    text_ends = np.cumsum([len(e) + 1 for e in encoded])
    per_text = np.diff(np.searchsorted(starts, np.r_[0, text_ends]))
    return (span_hashes(data, starts, ends) >> np.uint64(64 - 15)).astype(np.int32), per_text


def _pooled(taps: list[np.ndarray], bias: np.ndarray, words: np.ndarray, per_text: np.ndarray, want_place=False):
    """(texts, filters): the largest answer of each filter, and where it was given.

    `taps` has for each width the answers of every word at every place under the filter. A text
    with fewer words than a filter is wide is filled up with the last row, which answers 0.
    """
    n_texts, blank = len(per_text), len(taps[0]) - 1
    room = np.maximum(per_text, 1) + max(WIDTHS) - 1
    begins = np.cumsum(room) - room
    wide = np.full(int(room.sum()), blank, np.int32)
    wide[np.repeat(begins - np.r_[0, np.cumsum(per_text)[:-1]], per_text) + np.arange(len(words))] = words
    last = begins + np.maximum(per_text, 1)
    inside = np.ones(len(wide), bool)
    inside[(last[:, None] + np.arange(max(WIDTHS) - 1)).ravel()] = False
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, begins)
    out, places, done = np.empty((n_texts, FILTERS * len(WIDTHS)), np.float32), [], 0
    for k, width in enumerate(WIDTHS):
        of = taps[k]
        answers = of[wide[at], :FILTERS].copy()
        for tap in range(1, width):
            answers += of[wide[at + tap], tap * FILTERS : (tap + 1) * FILTERS]
        best = np.maximum.reduceat(answers, first, axis=0)
        out[:, done : done + FILTERS] = best
        if want_place:
            owner = np.repeat(np.arange(n_texts), np.diff(np.r_[first, len(at)]))
            rows, columns = np.nonzero(answers == best[owner])
            # of equal answers the first
            _, keep = np.unique(owner[rows].astype(np.int64) * FILTERS + columns, return_index=True)
            places.append(at[rows[keep]].reshape(n_texts, FILTERS))
        done += FILTERS
    return np.maximum(out + bias, 0), places, wide


@dataclass
class Network:
    embedding: np.ndarray  # (BUCKETS + 1, DIMENSIONS), the last row stays 0
    filters: np.ndarray  # (sum of WIDTHS, DIMENSIONS, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    constant: np.ndarray  # one number

    def taps(self) -> list[np.ndarray]:
        out, at = [], 0
        for width in WIDTHS:
            out.append(np.concatenate([self.embedding @ self.filters[at + t] for t in range(width)], axis=1))
            at += width
        return out

    def margins(self, taps, words, per_text) -> np.ndarray:
        return _pooled(taps, self.bias, words, per_text)[0] @ self.weights + self.constant[0]


@dataclass
class ToxicityModel:
    """Networks whose margins are averaged, and what tells languages and their thresholds."""

    networks: list[Network]
    languages: np.ndarray  # (BUCKETS, languages): log shares of words
    thresholds: np.ndarray  # of each language, and of texts without one

    def language_of(self, words, per_text) -> np.ndarray:
        """The column of each text's language; one more where nothing tells it."""
        n = self.languages.shape[1]
        if not n:
            return np.zeros(len(per_text), np.int64)
        ends = np.cumsum(per_text)
        total = np.zeros((len(per_text), n))
        filled = np.flatnonzero(per_text)
        if len(filled):
            # a column at a time, so that a long text needs no table of its words by languages
            for c in range(n):
                total[filled, c] = np.add.reduceat(self.languages[words, c], (ends - per_text)[filled])
        return np.where(per_text > 0, total.argmax(1), n)

    def dump(self) -> bytes:
        out = io.BytesIO()
        parts = {f"{k}_{f.name}": getattr(n, f.name) for k, n in enumerate(self.networks) for f in fields(n)}
        np.savez(out, languages=self.languages, thresholds=self.thresholds, **parts)
        return out.getvalue()

    @classmethod
    def load(cls, dumped: bytes) -> ToxicityModel:
        with np.load(io.BytesIO(dumped)) as f:
            n = sum(name.endswith("_constant") for name in f.files)
            networks = [Network(*(f[f"{k}_{field.name}"] for field in fields(Network))) for k in range(n)]
            return cls(networks, f["languages"], f["thresholds"])


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.model, self._taps = model, [n.taps() for n in model.networks]

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = []
        for part in passes(texts):
            words, per_text = word_buckets(part)
            margin = np.mean([n.margins(t, words, per_text) for n, t in zip(self.model.networks, self._taps, strict=True)], axis=0)
            margin = np.clip(margin - self.model.thresholds[self.model.language_of(words, per_text)], -30, 30)
            out.append(1 / (1 + np.exp(-margin)))
        return np.concatenate(out).astype(float) if out else np.zeros(0)


@lru_cache(maxsize=2)
def _scorer(dumped: bytes) -> Scorer:
    return Scorer(ToxicityModel.load(dumped))


def _log_odds(one: np.ndarray, none: np.ndarray, share: float) -> np.ndarray:
    """How much likelier a text with the word is a 1, less its standard error, from the texts with it of each label."""
    a, b = one + SMOOTH * share, none + SMOOTH * (1 - share)
    odds, error = np.log(a / b) - np.log(share / (1 - share)), np.sqrt(1 / a + 1 / b)
    return np.sign(odds) * np.maximum(np.abs(odds) - error, 0)


def _best_threshold(nones: np.ndarray, ones: np.ndarray) -> float:
    """The cut with the largest share of ones found, less CLEAN_WEIGHT times the share of others marked.

    From counts of margins of both labels. Of equal cuts the one in the middle of the widest gap.
    """
    met = np.flatnonzero(nones + ones)
    m = (met + 0.5) / STEPS - FARTHEST
    # cutting before place i: the ones from i on and the others before it are right
    right = 1 - np.r_[0, np.cumsum(ones[met])] / ones.sum() + CLEAN_WEIGHT * np.r_[0, np.cumsum(nones[met])] / nones.sum()
    edges = np.r_[m[0] - 2, m, m[-1] + 2]
    gap = np.diff(edges)
    best = max(range(len(right)), key=lambda i: (round(float(right[i]), 12), gap[i]))
    return float((edges[best] + edges[best + 1]) / 2)


def _gradients(model: Network, words, per_text, labels, weight):
    """Of filters, bias, weights and constant, then the words met and their embeddings' gradients."""
    # only the rows of these words are filtered; the last row fills up
    seen = np.zeros(BUCKETS + 1, bool)
    seen[words] = seen[BUCKETS] = True
    rows = np.flatnonzero(seen)
    taps = Network(model.embedding[rows], model.filters, model.bias, model.weights, model.constant).taps()
    pooled, places, wide = _pooled(taps, model.bias, (np.cumsum(seen) - 1)[words], per_text, want_place=True)
    margin = pooled @ model.weights + model.constant[0]
    of_margin = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) * weight).astype(np.float32)
    of_pooled = of_margin[:, None] * model.weights * (pooled > 0)
    of_filters = np.zeros_like(model.filters)
    met, of_words, at = [], [], 0
    for k, width in enumerate(WIDTHS):
        own = of_pooled[:, k * FILTERS : (k + 1) * FILTERS]
        for tap in range(width):
            under = rows[wide[places[k] + tap]]
            of_filters[at] = np.einsum("tf,tfd->df", own, model.embedding[under])
            met.append(under.ravel())
            of_words.append((own[:, :, None] * model.filters[at].T).reshape(-1, DIMENSIONS))
            at += 1
    met, back = np.unique(np.concatenate(met), return_inverse=True)
    summed = np.zeros((len(met), DIMENSIONS), np.float32)
    np.add.at(summed, back, np.concatenate(of_words))
    return of_filters, of_pooled.sum(0), pooled.T @ of_margin, of_margin.sum(keepdims=True), met, summed


def _step(gradient, mean, square, clock) -> np.ndarray:
    """Moves by the gradient's mean over its spread; the two moments are kept up in place."""
    mean *= 0.9
    mean += 0.1 * gradient
    square *= 0.99
    square += 0.01 * gradient * gradient
    return STEP * (mean / (1 - 0.9**clock)) / (np.sqrt(square / (1 - 0.99**clock)) + 1e-6)


def _cut(words, per_text, rows):
    ends = np.cumsum(per_text)
    return np.concatenate([words[ends[r] - per_text[r] : ends[r]] for r in rows]), per_text[rows]


def _start(one: np.ndarray, none: np.ndarray, share: float) -> tuple[Network, np.ndarray]:
    """A network before it learns, and which words are too rare to have an embedding."""
    rng = np.random.default_rng(0)
    n_filters = FILTERS * len(WIDTHS)
    embedding = rng.normal(0, 0.1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    filters = rng.normal(0, 0.3, (sum(WIDTHS), DIMENSIONS, FILTERS)).astype(np.float32)
    bias, weights = np.zeros(n_filters, np.float32), rng.normal(0, 0.1, n_filters).astype(np.float32)
    # words start from their log odds, read by one filter of each width
    embedding[:BUCKETS, 0] = np.clip(_log_odds(one, none, share), -4, 4) / 2
    rare = np.append(one + none < LEAST_TEXTS, True)
    embedding[rare] = 0
    at = 0
    for k, width in enumerate(WIDTHS):
        filters[at, 0, 0], weights[k * FILTERS] = 1, 1
        at += width
    return Network(embedding, filters, bias, weights, np.zeros(1, np.float32)), rare


def _blank(side: float) -> Network:
    """Every text gets the margin `side`."""
    sizes = ((BUCKETS + 1, DIMENSIONS), (sum(WIDTHS), DIMENSIONS, FILTERS), FILTERS * len(WIDTHS), FILTERS * len(WIDTHS))
    return Network(*(np.zeros(n, np.float32) for n in sizes), np.full(1, side, np.float32))


def _gone_over(model: Network, rare, words, per_text, labels, balance, learn, rng) -> np.ndarray:
    """The moves of a network by one round over the rows `learn`, weighted, and their weights.

    An embedding's weight is how often it was met; of all else it is the number of rows.
    """
    after = Network(*(getattr(model, f.name).copy() for f in fields(Network)))
    dense = [after.filters, after.bias, after.weights, after.constant]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (*dense, after.embedding)]
    times = np.zeros(BUCKETS + 1, np.float32)
    order, clock = rng.permutation(learn), 0
    for start in range(0, len(order), AT_ONCE):
        rows = order[start : start + AT_ONCE]
        seen_words, sizes = _cut(words, per_text, rows)
        seen_words = np.where(rng.random(len(seen_words)) < DROPPED, BUCKETS, seen_words)
        *grads, met, of_met = _gradients(after, seen_words, sizes, labels[rows], balance[labels[rows]] / len(rows))
        clock += 1
        for p, g, moments in zip(dense, grads, state, strict=False):
            p -= _step(g, *moments, clock)
        # of the embeddings only the rows that were met
        mean, square = (m[met] for m in state[-1])
        after.embedding[met] -= _step(of_met, mean, square, clock) * ~rare[met][:, None]
        state[-1][0][met], state[-1][1][met] = mean, square
        times[met] += 1
    moves = (after.embedding - model.embedding) * times[:, None]
    others = [(getattr(after, f) - getattr(model, f)).ravel() * len(learn) for f in _DENSE]
    return np.concatenate([moves.ravel(), times, *others, [len(learn)]]).astype(np.float32)


_DENSE = ("filters", "bias", "weights", "constant")


def _moved(model: Network, moves: np.ndarray) -> Network:
    """The network behind the mean of all parts' moves."""
    at = (BUCKETS + 1) * DIMENSIONS
    times = moves[at : at + BUCKETS + 1]
    embedding = model.embedding + moves[:at].reshape(-1, DIMENSIONS) / np.maximum(times, 1)[:, None]
    at += BUCKETS + 1
    out = {"embedding": embedding}
    for name in _DENSE:
        old = getattr(model, name)
        out[name] = old + (moves[at : at + old.size] / moves[-1]).reshape(old.shape)
        at += old.size
    return Network(**{name: value.astype(np.float32) for name, value in out.items()})


def held_out(doc_id):
    """Whether a document is kept out of learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): labelled documents that are not held out, a row per doc_id."""
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def _place():
    return F.shiftrightunsigned(F.xxhash64("doc_id"), 33)


def _sampled(labels: DataFrame, docs: DataFrame, rows_per_label: int) -> DataFrame:
    """(doc_id, toxic, nth): of the labelled documents so many of each label, in the order of a hash."""
    known = _known(labels).join(docs.select(docs["doc_id"].cast("long").alias("doc_id")), "doc_id", "left_semi")
    sizes = dict(known.groupBy("toxic").count().collect())  # two rows at most
    # a bound on the hash lets about twice the rows through that are ranked then
    bound = F.lit(0)
    for label, n in sizes.items():
        bound = F.when(F.col("toxic") == label, F.lit(int(min(1.0, 2 * rows_per_label / n) * (1 << 31)))).otherwise(bound)
    order = W.partitionBy("toxic").orderBy("place", "doc_id")
    ranked = known.withColumn("place", _place()).filter(F.col("place") < bound).withColumn("nth", F.row_number().over(order))
    return ranked.filter(F.col("nth") <= rows_per_label).select("doc_id", "toxic", "nth")


_LEARNED = "doc_id long, toxic int, lang string, n_words long, words binary"
_PART = "part int, toxic binary, langs array<string>, sizes binary, words binary"
_VECTOR = "name string, part int, vector binary"


def _as_words(batches):
    for batch in batches:
        found = [word_buckets([text])[0].astype(np.uint16) for text in batch.column("text").to_pylist()]
        sizes, words = pa.array([len(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())
        kept = [batch.column(c) for c in ("doc_id", "toxic", "lang")]
        yield pa.record_batch([*kept, sizes, words], ["doc_id", "toxic", "lang", "n_words", "words"])


def _as_parts(batches):
    """Rows sorted by part to a row per part."""
    names = ("toxic", "lang", "n_words", "words")

    def whole(part, toxic, langs, sizes, words):
        columns = [[part], [np.array(toxic, np.int8).tobytes()], [langs], [np.array(sizes, np.int64).tobytes()], [b"".join(words)]]
        kinds = (pa.int32(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "toxic", "langs", "sizes", "words"])

    key, held = None, [[], [], [], []]
    for batch in batches:
        for part, *row in zip(*(batch.column(c).to_pylist() for c in ("part", *names)), strict=True):
            if part != key and held[0]:
                yield whole(key, *held)
                held = [[], [], [], []]
            key = part
            for column, value in zip(held, row, strict=True):
                column.append(value)
    if held[0]:
        yield whole(key, *held)


@dataclass
class _Part:
    """Learned rows, their words one after the other; a label's rows go into the folds in turn."""

    nth: int
    words: np.ndarray
    per_text: np.ndarray
    labels: np.ndarray
    langs: list
    fold: np.ndarray

    @classmethod
    def each(cls, batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                labels = np.frombuffer(row["toxic"], np.int8).astype(np.int64)
                fold = np.zeros(len(labels), np.int64)
                for label in (0, 1):
                    rows = np.flatnonzero(labels == label)
                    fold[rows] = (np.arange(len(rows)) + row["part"]) % FOLDS
                words = np.frombuffer(row["words"], np.uint16).astype(np.int32)
                yield cls(row["part"], words, np.frombuffer(row["sizes"], np.int64), labels, row["langs"], fold)


def _vectors(part: int, named: dict[str, np.ndarray]) -> pa.RecordBatch:
    packed = [zstandard.ZstdCompressor(1).compress(v.astype(np.float32).tobytes()) for v in named.values()]
    columns = [pa.array(named, pa.string()), pa.array([part] * len(named), pa.int32()), pa.array(packed, pa.binary())]
    return pa.record_batch(columns, ["name", "part", "vector"])


def _add(batches):
    key, total = None, None
    for batch in batches:
        for name, packed in zip(*(batch.column(c).to_pylist() for c in ("name", "vector")), strict=True):
            vector = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.float32)
            if name != key:
                if key is not None:
                    yield pa.record_batch([pa.array([key]), pa.array([total.tobytes()], pa.binary())], ["name", "vector"])
                key, total = name, np.zeros(len(vector))
            total += vector
    if key is not None:
        yield pa.record_batch([pa.array([key]), pa.array([total.tobytes()], pa.binary())], ["name", "vector"])


def _added(vectors: DataFrame) -> dict[str, np.ndarray]:
    """Vectors of a name added up over all parts, always in the same order; a few megabytes come to the driver."""
    dealt = vectors.repartition("name").sortWithinPartitions("name", "part")
    return {r.name: np.frombuffer(r.vector) for r in dealt.mapInArrow(_add, "name string, vector binary").collect()}


def _counted(names: list[str]):
    """Texts of each fold and label, those with each word, and the words of each language."""

    def run(batches):
        for part in _Part.each(batches):
            text = np.repeat(np.arange(len(part.per_text)), part.per_text)
            pairs = np.unique(text * BUCKETS + part.words)
            text_of, bucket = pairs // BUCKETS, pairs % BUCKETS
            out = {}
            for k in range(FOLDS):
                for label in (0, 1):
                    own = (part.fold == k) & (part.labels == label)
                    out[f"{k} {label}"] = np.append(np.bincount(bucket[own[text_of]], minlength=BUCKETS), own.sum())
            lang_of = {lang: n for n, lang in enumerate(names)}
            owner = np.repeat(np.array([lang_of.get(lang, -1) for lang in part.langs], np.int64), part.per_text)
            for n in np.unique(owner[owner >= 0]).tolist():
                out[f"lang {n}"] = np.bincount(part.words[owner == n], minlength=BUCKETS)
            yield _vectors(part.nth, out)

    return run


def _round(sent, nth: int):
    """One round of every network over the rows of each part."""

    def run(batches):
        for part in _Part.each(batches):
            for k, (model, rare, balance) in sent.value.items():
                learn = np.flatnonzero(part.fold != k)
                if not len(learn):
                    continue
                rng = np.random.default_rng([nth, part.nth])
                moves = _gone_over(model, rare, part.words, part.per_text, part.labels, balance, learn, rng)
                yield _vectors(part.nth, {f"{k} {n:02}": m for n, m in enumerate(np.array_split(moves, PIECES))})

    return run


def _counted_margins(sent):
    """Margins that each fold's rows get from the network that has not seen them, by language and label."""

    def run(batches):
        networks, languages = sent.value
        model, taps = ToxicityModel([], languages, np.zeros(0)), {k: n.taps() for k, n in networks.items()}
        for part in _Part.each(batches):
            step = np.full(len(part.labels), -1)
            for k, network in networks.items():
                rows = np.flatnonzero(part.fold == k)
                # a few texts at a time, as they are scored
                for a in range(0, len(rows), AT_ONCE):
                    few = rows[a : a + AT_ONCE]
                    margin = network.margins(taps[k], *_cut(part.words, part.per_text, few))
                    step[few] = np.clip((margin + FARTHEST) * STEPS, 0, 2 * FARTHEST * STEPS - 1).astype(np.int64)
            language, out = model.language_of(part.words, part.per_text), {}
            for n in np.unique(language).tolist():
                for label in (0, 1):
                    own = step[(language == n) & (part.labels == label) & (step >= 0)]
                    out[f"{n} {label}"] = np.bincount(own, minlength=2 * FARTHEST * STEPS)
            yield _vectors(part.nth, out)

    return run


def _parts(learned: DataFrame, n_rows: int, n_words: int) -> DataFrame:
    """The learned rows as a row per part, in the order of a hash, stored so that a part is a task."""
    n = max(1, -(-n_rows // ROWS_PER_PART), -(-n_words // WORDS_PER_PART))
    dealt = learned.withColumn("place", _place()).withColumn("part", (F.col("place") % n).cast("int"))
    dealt = dealt.repartitionById(n, "part").sortWithinPartitions("part", "place", "doc_id")
    shared_folder(learned.sparkSession)
    return dealt.select("part", "toxic", "lang", "n_words", "words").mapInArrow(_as_parts, _PART).checkpoint()


def _shares(sums: dict[str, np.ndarray], n_languages: int) -> np.ndarray:
    shares = np.zeros((BUCKETS, n_languages), np.float32)
    for n in range(n_languages):
        counts = sums.get(f"lang {n}", np.zeros(BUCKETS)) + 0.1
        shares[:, n] = np.log(counts / counts.sum())
    return shares


def _thresholds(counts: dict[str, np.ndarray], n_languages: int) -> np.ndarray:
    """Of each language, and of texts without one; with few rows of a label it leans on that of all."""
    of = np.zeros((n_languages + 1, 2, 2 * FARTHEST * STEPS))
    for name, found in counts.items():
        language, label = map(int, name.split())
        # without languages every text counts as of the first column
        of[language, label] += found
    nones, ones = of.sum(0)
    of_all = _best_threshold(nones, ones) if nones.any() and ones.any() else 0.0
    out = np.full(n_languages + 1, of_all)
    for n in range(n_languages):
        fewest = of[n].sum(1).min()
        if fewest:
            share = fewest / (fewest + LEAN)
            out[n] = share * _best_threshold(*of[n]) + (1 - share) * of_all
    return out


def learn_toxicity(docs: DataFrame, labels: DataFrame, rows_per_label: int | None = None) -> bytes:
    """A model of `labels.toxic`, from all whole texts that have a label.

    Rows count that are not held out, have a label of 0 or 1 and a document; with
    `rows_per_label`, a bound that only a caller sets, so many of each label in the order of a
    hash of the id. Of several labels of a doc_id the largest counts, of several texts the least.

    Each of FOLDS networks learns from all rows but its fold; the margins that folds get from the
    network that has not seen them set the thresholds. With fewer than FOLDS rows of a label,
    every text gets one score, on the likelier label's side; without labels a low one. What the
    driver holds are networks and counts by word, a few megabytes at any size of the input.
    """
    spark = docs.sparkSession
    ship(spark)
    known = _known(labels) if rows_per_label is None else _sampled(labels, docs, rows_per_label).drop("nth")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), docs["lang"].cast("string").alias("lang")
    )
    rows = rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    met = rows.join(known, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("d"))
    found = met.select("doc_id", "toxic", "d.lang", "d.text").mapInArrow(_as_words, _LEARNED)
    learned = written(found, f"{run_folder(spark)}/learned")
    sizes = learned.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("n_words").alias("words")).collect()  # two rows at most
    n_rows, of_label = sum(r.n for r in sizes), {r.toxic: r.n for r in sizes}
    frequent = learned.filter("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    names = sorted(r.lang for r in frequent.collect())
    if min(of_label.get(0, 0), of_label.get(1, 0)) < FOLDS:
        side = 2.0 if n_rows and 2 * of_label.get(1, 0) >= n_rows else -2.0
        return ToxicityModel([_blank(side)], np.zeros((BUCKETS, 0), np.float32), np.zeros(1)).dump()

    parts = _parts(learned, n_rows, sum(r.words for r in sizes))
    sums = _added(parts.mapInArrow(_counted(names), _VECTOR))
    shares = _shares(sums, len(names))
    learning = {}
    for k in range(FOLDS):
        none, one = (sum(sums[f"{j} {label}"] for j in range(FOLDS) if j != k) for label in (0, 1))
        if none[-1] and one[-1]:  # a network needs rows of both labels
            share = one[-1] / (one[-1] + none[-1])
            balance = (one[-1] + none[-1]) / (2 * np.array([none[-1], one[-1]]))
            learning[k] = (*_start(one[:-1], none[:-1], share), balance)
    for nth in range(ROUNDS):
        sent = spark.sparkContext.broadcast(learning)  # a few megabytes, whatever the input
        sums = _added(parts.mapInArrow(_round(sent, nth), _VECTOR))
        sent.unpersist()
        for k, (model, rare, balance) in learning.items():
            learning[k] = _moved(model, np.concatenate([sums[f"{k} {n:02}"] for n in range(PIECES)])), rare, balance
    networks = {k: model for k, (model, _, _) in learning.items()}
    counts = _added(parts.mapInArrow(_counted_margins(spark.sparkContext.broadcast((networks, shares))), _VECTOR))
    return ToxicityModel(list(networks.values()), shares, _thresholds(counts, len(names))).dump()


def score_toxicity(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, score, predicted), a row per row of `docs`.

    Scores depend on the text alone, whole and of any length; a null text is empty and has a
    score too. Null ids and repeated rows keep their rows, an empty table gives none; other
    columns of `docs` are not read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few megabytes, whatever the input

    def run(batches):
        for batch in batches:
            score = _scorer(sent.value)(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())],
                ["doc_id", "score", "predicted"],
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")
