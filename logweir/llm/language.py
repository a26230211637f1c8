"""Language by hierarchical discrimination: first the family, then the language within it.

Features are square roots of the shares of hashed character 1- to 3-grams of the whole text.
One linear support vector machine per family tells it from all others; within a family one per
pair of languages votes.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.llm.tables import ship

UNKNOWN = "und"
BUCKETS = 4096
#: Labelled rows per language that a model is fitted on, the same at every size of the input.
ROWS_PER_LANGUAGE = 500
#: Languages that a model tells at most: the most frequent labels, of equal ones the first by name.
LANGUAGES = 32
#: From this score on a prediction counts: the language is likelier than all others together.
LEAST_SCORE = 0.5
# Families of ISO 639-1 codes. A language not named here is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
_LETTER = re.compile(r"[^\W\d_]")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def features(texts: list[str]) -> np.ndarray:
    """(texts, BUCKETS + 1): rows of length one and a constant; no letters give zeros."""
    text = "\n".join(t.lower() for t in texts) + "\n"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t.lower()) + 1 for t in texts])
    doc = np.repeat(np.arange(len(texts)), sizes)
    letter = _letters()[codes]
    keep = letter | np.r_[True, letter[:-1]]  # one blank between words
    codes, doc = np.where(letter, codes, 32)[keep].astype(np.uint64), doc[keep]
    out = np.zeros((len(texts), BUCKETS + 1), np.float32)
    gram, flat = np.zeros(len(codes), np.uint64), []
    for n in range(3):
        size = max(len(codes) - n, 0)
        gram = gram[:size] * np.uint64(0x10FFFF + 2) + codes[n:] + np.uint64(1)
        place = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 12)
        inside = (doc[:size] == doc[n:]) & (gram != 33 if n == 0 else True)
        flat.append((doc[:size] * BUCKETS + place.astype(np.int64))[inside])
    counts = np.bincount(np.concatenate(flat), minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    out[:, :BUCKETS] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    out[:, BUCKETS] = 1
    return out


def linear_svm(x: np.ndarray, positive: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a squared-hinge support vector machine, by dual coordinate descent."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weights, alpha, soft = np.zeros(x.shape[1], np.float32), np.zeros(len(x)), 0.5 / cost
    squares = (x * x).sum(1) + soft
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            new = max(alpha[i] - (y[i] * (weights @ x[i]) - 1 + soft * alpha[i]) / squares[i], 0.0)
            if new != alpha[i]:
                weights += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return weights


@dataclass
class LanguageModel:
    """Families, the languages of each, and the weights: a column per machine."""

    families: list[tuple[str, ...]]
    pairs: list[tuple[int, int, int]]  # family, first and second language in it
    weights: np.ndarray  # families first, then pairs

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each row, and a score from 0 to 1."""
        margin = x @ self.weights
        n = len(self.families)
        share = np.exp(4 * (margin[:, :n] - margin[:, :n].max(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        family = margin[:, :n].argmax(1)
        languages, score = [""] * len(x), share[np.arange(len(x)), family]
        for f, names in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            votes, sure = np.zeros((len(rows), len(names))), np.ones((len(rows), len(names)))
            for column, (of, a, b) in enumerate(self.pairs, n):
                if of != f:
                    continue
                p = 1 / (1 + np.exp(-4 * margin[rows, column]))
                votes[:, a] += (p >= 0.5) + 1e-6 * p
                votes[:, b] += (p < 0.5) + 1e-6 * (1 - p)
                sure[:, a] *= p
                sure[:, b] *= 1 - p
            best = votes.argmax(1)
            for row, name in zip(rows.tolist(), best.tolist(), strict=True):
                languages[row] = names[name]
            score[rows] *= sure[np.arange(len(rows)), best]
        return languages, np.clip(score, 0, 1).astype(float)


def fit(x: np.ndarray, languages: list[str]) -> LanguageModel | None:
    known = sorted(set(languages))
    if not known:
        return None
    family_of = {lang: name for name, langs in FAMILIES.items() for lang in langs}
    names = sorted({family_of.get(lang, lang) for lang in known})
    families = [tuple(lang for lang in known if family_of.get(lang, lang) == name) for name in names]
    labels = np.array(languages)
    machines = [linear_svm(x, np.isin(labels, f)) for f in families]
    pairs = []
    for f, langs in enumerate(families):
        for a, b in combinations(range(len(langs)), 2):
            rows = np.isin(labels, (langs[a], langs[b]))
            pairs.append((f, a, b))
            machines.append(linear_svm(x[rows], labels[rows] == langs[a]))
    return LanguageModel(families, pairs, np.stack(machines, 1))


def _in_parts(texts: list[str], size: int = 1 << 19):
    """Runs of texts of about so many characters."""
    part, held = [], 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def held_out(doc_id):
    """Whether a document is kept out of learning; a null id is neither held out nor learned."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2


def learn_languages(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, languages: int = LANGUAGES) -> LanguageModel | None:
    """A model from at most `rows_per_language` labelled rows of each of at most `languages` languages.

    Rows count that are not held out and whose text and lang are not null and hold a letter;
    of each language those with the smallest hash of the id. Rows that repeat a doc_id with a
    language are one, with the least text. Only their ids are sent around, and their features,
    of fixed size, come to the driver.
    """
    ship(docs.sparkSession)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), docs["lang"].alias("lang")).filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n"))
    top = sizes.orderBy(F.desc("n"), "lang").limit(languages).collect()  # a row per language
    # a bound on the hash lets about twice the rows through that are ranked then
    bound = F.lit(None).cast("long")
    for r in top:
        share = min(1.0, 2 * rows_per_language / max(r["n"], 1))
        bound = F.when(F.col("lang") == r["lang"], F.lit(min(int(share * 2.0**64) - 2**63, 2**63 - 1))).otherwise(bound)
    near = rows.select("lang", "doc_id").filter(F.xxhash64("doc_id") <= bound).distinct()
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows_per_language)

    def sample(batches):
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            for part in _in_parts(texts):
                x = features(part)
                yield pa.record_batch(
                    [batch.column("doc_id").slice(at, len(part)), batch.column("lang").slice(at, len(part)), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["doc_id", "lang", "x"],
                )
                at += len(part)

    # the broadcast side has rows_per_language rows per language at most
    found = rows.join(F.broadcast(chosen.select("lang", "doc_id")), ["lang", "doc_id"], "left_semi")
    found = found.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    got = sorted(
        ((r.lang, r.doc_id, bytes(r.x)) for r in found.mapInArrow(sample, "doc_id long, lang string, x binary").collect())
    )
    x = np.array([np.frombuffer(r[2], np.float32) for r in got]).reshape(len(got), BUCKETS + 1)
    return fit(x, [r[0] for r in got])


def _predicted(model: LanguageModel | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if model is None:
        return languages, scores
    at = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    done = 0
    for part in _in_parts([texts[i] for i in at]):
        lang, score = model.predict(features(part))
        for i, a, b in zip(at[done : done + len(part)], lang, score.tolist(), strict=True):
            languages[i], scores[i] = a, b
        done += len(part)
    return languages, scores


def predict_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, lang_pred, score), a row per row of `docs`.

    A text that is null or has no letter is `und` with score 0, as is every text where nothing
    could be learned. Null ids and repeated rows keep their rows; an empty table gives none;
    of the other columns none is read.
    """
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few columns of BUCKETS numbers

    def run(batches):
        for batch in batches:
            languages, scores = _predicted(sent.value, batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def _stays(languages: list[str], scores: list[float], wanted, least_score: float) -> list[bool]:
    return [
        a != UNKNOWN and b >= least_score and (wanted is None or a in wanted) for a, b in zip(languages, scores, strict=True)
    ]


def with_known_language(
    docs: DataFrame, model: LanguageModel | None, languages: Iterable[str] | None = None, least_score: float = LEAST_SCORE
) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is predicted to be of a wanted language.

    Wanted are `languages`, or all learned ones where none are named; a prediction counts from
    `least_score` on, so texts of no learned language mostly go. Where nothing could be learned (no
    model) there is no language to go by, and every text that holds a letter stays, also if
    languages are named; null and letterless texts go in either case.
    """
    ship(docs.sparkSession)
    sent, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")
    wanted = None if languages is None else frozenset(languages)

    def run(batches):
        for batch in batches:
            texts = batch.column(text).to_pylist()
            if sent.value is None:
                known = [t is not None and _LETTER.search(t) is not None for t in texts]
            else:
                known = _stays(*_predicted(sent.value, texts), wanted, least_score)
            yield batch.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def language_counts(
    docs: DataFrame, model: LanguageModel | None, languages: Iterable[str] | None = None, least_score: float = LEAST_SCORE
) -> DataFrame:
    """(lang_pred, kept, n): what `with_known_language` keeps and lets go, by predicted language."""
    if model is None:
        stays = F.col("text").rlike(r"\p{L}")
        rows = docs.select(F.lit(UNKNOWN).alias("lang_pred"), F.coalesce(stays, F.lit(False)).alias("kept"))
    else:
        stays = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
        stays = stays if languages is None else stays & F.col("lang_pred").isin(list(languages))
        rows = predict_languages(docs, model).select("lang_pred", stays.alias("kept"))
    return rows.groupBy("lang_pred", "kept").agg(F.count(F.lit(1)).alias("n"))
