"""Quality classifier from weak labels.

Overlapping heuristics vote on every document. Expectation-maximisation over the counts of vote patterns estimates how
accurate each heuristic is without any label, and gives each pattern a posterior. Posteriors of a bounded sample train a linear
scorer over hashed features, which then scores every document.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstone.llm.common import bounded, light, only, remembers, small_batches, stored, text_or_empty, working

#: Votes of a heuristic.
BAD, GOOD, NONE = 0, 1, 2
#: Documents whose posteriors train the scorer, at most; hashed features; passes; strength of the penalty.
TRAINED_ON, FEATURES, PASSES, PENALTY = 6000, 1 << 16, 300, 1e-5
#: Rounds of expectation-maximisation, pseudo-counts, and the share of good documents that it starts from.
ROUNDS, PSEUDO, PRIOR = 100, 1.0, 0.85
#: A document is kept from this score on.
KEEP = 0.5
REMEMBERED = 120_000

#: Frequent function words of the languages at hand.
COMMON = frozenset(
    "the of and to in a is that for it on was with as be by at this are or from an not have but they his he had which "
    "der die das und in zu den von mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "de la le et les des en un une du est que dans qui par pour au sur il ne pas ce se plus sont avec ou "
    "el los las del que y en un una por con no se su para es al lo como más o pero sus le ha".split()
)
DOUBLED = re.compile(r"[^\w\s.,;:'\"()\-–—]{2,}|[!?]{2,}")
SYMBOLS = re.compile(r"[^\w\s.,;:'\"()!?\-–—]")


def _by(value: float, bad: float, good: float) -> int:
    """A vote by where a value lies; above ``bad`` is bad if that is the higher bound, else below."""
    if bad > good:
        return BAD if value > bad else GOOD if value < good else NONE
    return BAD if value < bad else GOOD if value > good else NONE


#: Names of the heuristics, in the order of the votes.
HEURISTICS = ("symbols", "capitals", "repeats", "marks", "doubled", "variety", "common", "sentences", "empty")
#: Those that ask for some length first: their silence tells nothing, that of the others is an outcome like a vote.
NEED_LENGTH = np.array([5, 6, 7])


def votes(text: str) -> list[int]:
    """The vote of each heuristic on a whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return [NONE] * 8 + [BAD]
    letters = sum(map(len, words))
    upper = sum(map(str.isupper, words))
    same = sum(map(eq, words, words[1:]))
    marks = sum(not any(map(str.isalnum, w)) for w in words if len(w) <= 2)
    pairs = len(set(zip(words, words[1:], strict=False)))
    ends = sum(w[-1] in ".!?" for w in words)
    common = sum(w in COMMON for w in words)
    return [
        BAD if len(SYMBOLS.findall(text)) > 0.04 * letters else NONE,
        BAD if upper > 0.5 * n else NONE,
        BAD if same > 0.12 * n else NONE,
        BAD if marks > 0.06 * n else NONE,
        BAD if len(DOUBLED.findall(text)) > 0.1 * n else NONE,
        _by(pairs / (n - 1), 0.55, 0.85) if n >= 20 else NONE,
        _by(common / n, 0.04, 0.12) if n >= 20 else NONE,
        (GOOD if 1 / 40 <= ends / n <= 1 / 3 else BAD if ends / n < 1 / 150 or ends / n > 0.7 else NONE) if n >= 20 else NONE,
        NONE,
    ]


class Accuracies:
    """What EM has learned: the share of good documents, and for each heuristic the chances of its votes on bad and good ones."""

    def __init__(self, counts: dict[str, int]) -> None:
        patterns = list(counts)
        v = np.array([[int(c) for c in p] for p in patterns], int).reshape(len(patterns), -1)
        weight = np.array([counts[p] for p in patterns], float)
        n = v.shape[1]
        first = np.log(PRIOR / (1 - PRIOR)) + (v == GOOD).sum(1) - 3.0 * (v == BAD).sum(1)  # a weighed majority to start from
        good = 1 / (1 + np.exp(-first))
        for _ in range(ROUNDS):
            self.prior = float((weight @ good + PSEUDO) / (weight.sum() + 2 * PSEUDO))
            self.chance = np.empty((n, 2, 3))
            for vote in (BAD, GOOD, NONE):
                at = v == vote
                self.chance[:, GOOD, vote] = weight * good @ at + PSEUDO
                self.chance[:, BAD, vote] = weight * (1 - good) @ at + PSEUDO
            self.chance[NEED_LENGTH[NEED_LENGTH < n], :, NONE] = 0
            self.chance /= self.chance.sum(axis=2, keepdims=True)
            self.chance[NEED_LENGTH[NEED_LENGTH < n], :, NONE] = 1
            odds = np.log(self.chance[:, GOOD] / self.chance[:, BAD])
            new = 1 / (1 + np.exp(-(math.log(self.prior / (1 - self.prior)) + sum(odds[k, v[:, k]] for k in range(n)))))
            if np.abs(new - good).max(initial=0) < 1e-9:
                break
            good = new
        self.posterior = dict(zip(patterns, good.tolist(), strict=True))

    def accuracy(self, k: int) -> float:
        """Chance that heuristic ``k`` is right when it votes."""
        right = self.prior * self.chance[k, GOOD, GOOD] + (1 - self.prior) * self.chance[k, BAD, BAD]
        return float(right / (right + self.prior * self.chance[k, GOOD, BAD] + (1 - self.prior) * self.chance[k, BAD, GOOD]))


_RUNS = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"([^\w\s])\1+"))
_SHAPES: dict[str, int] = {}
remembers("weak_quality", _SHAPES.clear)


def _shape(word: str) -> int:
    """A number for the look of a word: short words as they are, letters by case, digits and marks by kind."""
    s = _RUNS[0].sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word)
    s = _RUNS[2].sub(r"\1\1", _RUNS[1].sub("9", s))[:12]
    h = zlib.crc32(f"{s}|{word.lower() if len(word) <= 3 else min(len(word), 20) // 4}".encode())
    if len(_SHAPES) < REMEMBERED:
        _SHAPES[word] = h
    return h


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a whole text and their weights (length 1 for each family): word looks, pairs of looks, and whether neighbours repeat."""
    words = text.split()
    if not words:
        return np.array([0], np.int64), np.ones(1)
    known = _SHAPES.get
    s = np.array([known(w) or _shape(w) for w in words], np.uint64)
    out = []
    for family in (s, (s[:-1] * np.uint64(0x9E3779B1) + s[1:]) if len(s) > 1 else s[:0], np.fromiter(map(eq, words, words[1:]), np.uint64, len(words) - 1) + np.uint64(77)):
        if len(family):
            h = family * np.uint64(0x9E3779B97F4A7C15)
            at, n = np.unique((h >> np.uint64(48)).astype(np.int64) % FEATURES, return_counts=True)
            w = np.sqrt(n)
            out.append((at, w / np.sqrt((w * w).sum())))
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vote patterns of the documents."""
    only("weak_quality")
    for batch in bounded(batches, 1):
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["".join(map(str, votes(t))) for t in batch.column(1).to_pylist()], pa.string())], ["doc_id", "pattern"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in bounded(batches, 1):
        texts = batch.column(1).to_pylist()
        f = [features(t) for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(["".join(map(str, votes(t))) for t in texts], pa.string()), pa.array([x[0] for x in f], pa.list_(pa.int64())), pa.array([x[1] for x in f], pa.list_(pa.float64()))], ["pattern", "at", "weight"])


def fit(at: list[np.ndarray], weight: list[np.ndarray], target: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer (the bias is last) for soft targets, by full passes with momentum."""
    w = np.zeros(FEATURES + 1)
    if not len(target):
        return w
    row, col, val = np.repeat(np.arange(len(at)), [len(a) for a in at]), np.concatenate(at), np.concatenate(weight)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, PASSES + 1):
        p = 1 / (1 + np.exp(-(np.bincount(row, val * w[col], minlength=len(at)) + w[-1])))
        e = (p - target) / len(target)
        g = np.append(np.bincount(col, val * e[row], minlength=FEATURES), e.sum()) + PENALTY * np.append(w[:-1], 0)
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


class Model:
    def __init__(self, weights: np.ndarray, learned: Accuracies | None) -> None:
        self.weights, self.learned = weights, learned

    def score(self, text: str) -> float:
        at, weight = features(text)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, float(weight @ self.weights[at] + self.weights[-1])))))


def train(spark: SparkSession, docs: DataFrame, seed: int = 3, most: int = TRAINED_ON) -> Model:
    """EM over the vote patterns of all documents, then a scorer from the posteriors of at most ``most`` documents, drawn by hashed id.

    The driver gets a row for each vote pattern (at most 3 ** 9) and the features of the sample. No documents, or no
    ids to draw by, give a scorer that is even on all.
    """
    small_batches(spark)
    with working(spark):
        return _train(spark, docs, seed, most)


def _train(spark: SparkSession, docs: DataFrame, seed: int, most: int) -> Model:
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    voted = stored(rows.mapInArrow(_votes, f"doc_id {dict(rows.dtypes)['doc_id']}, pattern string"), "votes")
    counts = {r["pattern"]: r["count"] for r in voted.groupBy("pattern").count().collect()}
    if not counts:
        return Model(np.zeros(FEATURES + 1), None)
    learned = Accuracies(counts)
    ids = voted.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(most)
    one = rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))  # of rows that repeat an id the least text: the driver gets a row for each id
    sample = one.mapInArrow(_features, "pattern string, at array<long>, weight array<double>")
    got = sorted(sample.collect(), key=lambda r: (r["pattern"], r["at"], r["weight"]))
    target = np.array([learned.posterior[r["pattern"]] for r in got])
    return Model(fit([np.array(r["at"]) for r in got], [np.array(r["weight"]) for r in got], target), learned)


def _scores(model, score: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("weak_quality")
        m = Model(model.value, None)
        for batch in bounded(batches, -1):
            texts = batch.column(batch.schema.get_field_index("text__")).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([m.score(t) for t in texts], pa.float64()), pa.array([bool(t.strip()) for t in texts])], [*batch.schema.names[:-1], score, "said__"])

    return run


def classify(spark: SparkSession, docs: DataFrame, model: Model | None = None, score: str = "score", kept: str = "kept") -> DataFrame:
    """``docs`` with score (0 to 1) and kept (a score of KEEP or more, and a text that says something) for every document.

    Null and blank texts are not kept. One scan, no shuffle; repeated rows score alike; other columns pass. The names of the two new columns, which may be chosen, are not among those of ``docs``.
    """
    model = model or train(spark, docs)
    small_batches(spark)
    rows = docs.withColumn("text__", text_or_empty())
    schema = T.StructType([*docs.schema.fields]).add(score, "double").add("said__", "boolean")
    return rows.mapInArrow(light(_scores(spark.sparkContext.broadcast(model.weights), score)), schema).withColumn(kept, F.col("said__") & (F.col(score) >= KEEP)).drop("said__")


def kept(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with their columns as they were."""
    return classify(spark, docs, None, "score__", "kept__").where("kept__").select(*docs.columns)
