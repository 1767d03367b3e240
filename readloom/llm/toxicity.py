"""Toxicity: logistic classifier whose scores must not move when identity terms are swapped.

A text's features are its distinct lower-case words and their four- and five-letter
beginnings. The loss is the usual log loss on labelled texts plus ``fairness`` times the
mean squared change of the log-odds between a labelled sentence and its counterfactuals:
the sentence with an identity term swapped for another of its group and, for groups that
the labels hardly name, a sentence with a neutral mention put in. So naming a group can
not by itself raise a score.

Fitting takes at most ``sample`` labelled rows (those of smallest hash of the id, in any
run the same) and ``vocabulary`` features; that much reaches the driver, whatever the
size of the tables. Scoring is narrow and covers whole texts.

Defined results: null and empty texts have no features and get the score of the
intercept; labels that are null or without a text are not used, of several for an id the
largest counts; without labels of both kinds every score is the share of ones (zero
without any); repeated rows get equal scores; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import text_batches
from .common import checkpoint

# Identity terms by group; terms of one group stand in for one another.
IDENTITY = (
    ("women", "men", "girls", "boys", "woman", "man", "girl", "boy", "female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "homosexual", "heterosexual", "transgender"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("black", "white", "asian", "latino", "arab", "african", "european", "american", "mexican", "chinese"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("blind", "deaf", "disabled", "old", "young", "elderly"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "hindus", "atheisten"),
    ("mujeres", "hombres", "chicas", "chicos"),
    ("musulmanes", "cristianos", "judíos", "ateos"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "athées"),
)
GROUP = {term: group for group in IDENTITY for term in group}

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[.!?\n]+")
#: Words whose features a task remembers.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Settings:
    sample: int = 16_000  # labelled rows, the bound of what is fitted on
    vocabulary: int = 4_096  # features kept
    least_texts: int = 5  # in which a feature must be
    least_z: float = 4.0  # by how much its share must differ between the labels
    fairness: float = 10.0
    ridge: float = 2e-4
    steps: int = 400


@dataclass(frozen=True)
class Model:
    intercept: float
    weights: dict[str, float]

    def score(self, words: set[str]) -> float:
        found = {f for w in words for f in features(w) if f in self.weights}
        return 1 / (1 + np.exp(-(self.intercept + sum(self.weights[f] for f in sorted(found)))))


def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings; the star keeps a beginning apart from a word."""
    return (word, *(word[:n] + "*" for n in (4, 5) if len(word) >= n))


def counterfactuals(sentence: str, pick: int) -> tuple[set[str], set[str]] | None:
    """The sentence's words, and those after swapping each identity term for the ``pick``-th next of its group."""
    words = WORD.findall(sentence.lower())
    if not any(w in GROUP for w in words):
        return None
    swapped = []
    for w in words:
        group = GROUP.get(w, (w,))
        step = 1 + pick % (len(group) - 1) if len(group) > 1 else 0
        swapped.append(group[(group.index(w) + step) % len(group)])
    return set(words), set(swapped)


def distinct_features(words: set[str]) -> list[str]:
    return sorted({f for w in words for f in features(w)})


SAMPLE = "toxic int, features array<string>, swaps array<struct<before: array<string>, after: array<string>>>"


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, settings: Settings) -> DataFrame:
    """``SAMPLE`` of the sampled rows: features, and those of sentences before and after a swap."""
    chosen = labels.select(F.col(f"`{doc_id}`").alias("of"), F.col(f"`{label}`").cast("int").alias("toxic"))
    chosen = chosen.where("of is not null and toxic is not null").groupBy("of").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("of"), "of").limit(settings.sample)
    own = docs.select(F.col(f"`{doc_id}`").alias("own"), F.col(f"`{text}`").alias("text"))
    rows = own.join(F.broadcast(chosen), F.col("own") == F.col("of"))
    # One row for each sampled id, however often it stands; combined before the shuffle.
    rows = rows.groupBy("of").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.select("toxic", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several = pa.list_(pa.string())
        pairs = pa.list_(pa.struct([("before", several), ("after", several)]))
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                found, swaps = [], []
                for value in part.column(1):
                    low = (value.as_py() or "").lower()
                    own = set(WORD.findall(low))
                    found.append(distinct_features(own))
                    named = SENTENCE.split(low) if GROUP.keys() & own else []
                    both = [c for k, sentence in enumerate(named) if (c := counterfactuals(sentence, k))]
                    swaps.append([{"before": distinct_features(x), "after": distinct_features(y)} for x, y in both])
                columns = [part.column(0), pa.array(found, several), pa.array(swaps, pairs)]
                yield pa.RecordBatch.from_arrays(columns, ["toxic", "features", "swaps"])

    return rows.mapInArrow(read, SAMPLE)


def vocabulary_of(sample: DataFrame, ones: int, zeros: int, settings: Settings) -> dict[str, int]:
    """Numbers of the features whose shares of the toxic and of the other texts differ most."""
    counts = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count("*").alias("every"), F.sum("toxic").alias("bad"))
    share = F.col("every") / F.lit(ones + zeros)
    spread = F.sqrt(share * (1 - share) * F.lit(1 / ones + 1 / zeros))
    z = F.abs(F.col("bad") / F.lit(ones) - (F.col("every") - F.col("bad")) / F.lit(zeros)) / spread
    usable = F.col("every").between(settings.least_texts, ones + zeros - 1)
    best = counts.where(usable).withColumn("z", z).where(F.col("z") >= settings.least_z)
    names = best.orderBy(F.desc("z"), "feature").limit(settings.vocabulary).select("feature").toArrow()
    return {name: i for i, name in enumerate(names["feature"].to_pylist())}


def numbered(sample: DataFrame, vocabulary: dict[str, int]) -> pa.Table:
    """The sample with features as numbers; those outside the vocabulary are left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        several = pa.list_(pa.int32())

        def ids(names: list[str]) -> list[int]:
            return [vocabulary[f] for f in names if f in vocabulary]

        for batch in batches:
            found = [ids(x.as_py()) for x in batch.column(1)]
            swaps = [x.as_py() for x in batch.column(2)]
            columns = [
                batch.column(0),
                pa.array(found, several),
                *[pa.array([[ids(s[side]) for s in x] for x in swaps], pa.list_(several)) for side in ("before", "after")],
            ]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "features", "before", "after"])

    kinds = "toxic int, features array<int>, before array<array<int>>, after array<array<int>>"
    return sample.mapInArrow(read, kinds).toArrow()


def entries(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of each entry."""
    flat = np.array([i for x in lists for i in x], np.int64)
    return np.repeat(np.arange(len(lists)), [len(x) for x in lists]), flat


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", settings=Settings()) -> Model:
    """The model from at most ``settings.sample`` rows of ``labels``.

    Spark counts the features; the driver gets the vocabulary, and of each sampled row the
    numbers of the features it has from it.
    """
    with text_batches(docs.sparkSession):
        sample = checkpoint(labelled(docs, labels, doc_id, text, label, settings))
    kinds = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("ones")).first()
    ones, zeros = kinds["ones"], kinds["n"] - kinds["ones"]
    if not ones or not zeros:
        share = ones / kinds["n"] if kinds["n"] else 0.0
        return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))), {})
    vocabulary = vocabulary_of(sample, ones, zeros, settings)
    with text_batches(docs.sparkSession):
        table = numbered(sample, vocabulary)
    toxic = table["toxic"].to_numpy().astype(np.float64)
    row, feature = entries(table["features"].to_pylist())
    mentions = [[vocabulary[f] for f in features(term) if f in vocabulary] for term in GROUP]
    before, after = ([s for x in table[side].to_pylist() for s in x] for side in ("before", "after"))
    down_row, down = entries(before + [[]] * len(mentions))
    up_row, up = entries(after + mentions)
    n, pairs, m = len(toxic), len(before) + len(mentions), len(vocabulary)
    weights, bias = np.zeros(m), float(np.log(ones / zeros))
    moment, square = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, settings.steps + 1):
        odds = bias + np.bincount(row, weights[feature], n)
        error = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - toxic) / n
        change = np.bincount(up_row, weights[up], pairs) - np.bincount(down_row, weights[down], pairs)
        change = change * (2 * settings.fairness / pairs)
        slope = np.bincount(feature, error[row], m) + settings.ridge * weights
        slope = slope + np.bincount(up, change[up_row], m) - np.bincount(down, change[down_row], m)
        slope = np.r_[slope, error.sum()]
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        rate = 0.1 if step <= settings.steps // 2 else 0.02
        move = rate * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(float(bias), {f: float(weights[i]) for f, i in vocabulary.items() if abs(weights[i]) > 1e-6})


def scores(text: Column, model: Model) -> Column:
    """Score of each whole text, between 0 and 1."""

    def column(values: pa.Array) -> pa.Array:
        numbers = {f: i for i, f in enumerate(sorted(model.weights))}
        weights = np.array([model.weights[f] for f in numbers] or [0.0])
        known: dict[str, tuple[int, ...]] = {}
        out = np.empty(len(values))
        for i, value in enumerate(values):
            found: set[int] = set()
            for word in set(WORD.findall((value.as_py() or "").lower())):
                own = known.get(word)
                if own is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    own = known[word] = tuple(numbers[f] for f in features(word) if f in numbers)
                if own:
                    found.update(own)
            out[i] = model.intercept + weights[sorted(found)].sum() if found else model.intercept
        return pa.array(1 / (1 + np.exp(-np.clip(out, -700, 700))))

    return F.arrow_udf(column, "double")(text)


def score_documents(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score as column ``into``."""
    return docs.withColumn(into, scores(F.col(f"`{text}`"), model))
