"""Ordinal quality classifier: cumulative-link regression on graded ratings.

Toxic documents have grade 0, poor ones 1 and good ones 2. One weight vector over hashed
words is shared by all grades; ordered thresholds cut the score into grades:
P(grade <= j) = sigmoid(threshold_j - score). A document's expected grade and its tail
probability P(grade >= 2) follow, and selection keeps those with enough of the latter.

The model is fitted on the driver over a bounded sample: at most `SAMPLE_ROWS` labelled
documents, those with the smallest hash of their id. Scoring covers every whole text.

Null or empty text has no words and is scored by its shape alone. Labels without a quality
and not toxic are not used; without any usable label every document is kept. Repeated rows
get equal scores. An empty table gives no rows. Texts of any length are scored whole.
Columns of the documents are untouched, whatever their names.
"""

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from waybill.llm.frames import fresh, release, text_of

SAMPLE_ROWS = 12_000
DIMENSIONS = 1 << 18
GRADES = 3
SMALLEST_TAIL = 0.5
SEED = 20_231
WORDS = re.compile(r"\w+")
SYMBOLS = re.compile(r"[^\w\s.,;:'\"()?-]")
CACHED_WORDS = 500_000


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores):
        """P(grade >= 1), P(grade >= 2), ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - scores[:, None], -40, 40)))


def shape_marks(text, words):
    """Coarse measures of a text, each as the name of the step that it falls into."""
    n = max(len(words), 1)
    upper = sum(map(str.isupper, words))
    steps = {
        "symbols": len(SYMBOLS.findall(text)) / n,
        "upper": upper / n,
        "distinct": len(set(words)) / n * min(1.0, 20 / n**0.5),
        "pipes": text.count("|") / n,
        "length": np.log2(n) / 16,
    }
    return [f"\0{name}:{min(int(value * 16), 16)}" for name, value in steps.items()]


def hashed(text, known):
    """The places of a text's distinct words and shape marks in the weight vector."""
    words = WORDS.findall(text)
    places = set()
    for word in {word.lower() for word in set(words)}:
        place = known.get(word)
        if place is None:
            if len(known) >= CACHED_WORDS:
                known.clear()
            place = known[word] = crc32(word.encode()) % DIMENSIONS
        places.add(place)
    places.update(crc32(mark.encode()) % DIMENSIONS for mark in shape_marks(text, words))
    return np.fromiter(places, np.int32, len(places))


def hashed_series(texts: pd.Series) -> pd.Series:
    known = {}
    return pd.Series([np.sort(hashed(text or "", known)) for text in texts])


def graded(labels):
    """doc_id and grade of the labels that say enough."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
    grade = grade.when(F.col("quality").isNotNull(), 2)
    return labels.select("doc_id", grade.cast("int").alias("grade")).dropna()


def training_rows(documents, labels, rows=SAMPLE_ROWS):
    """Hashed words and grades of at most `rows` labelled documents, for the driver."""
    picked = graded(labels).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id", "grade")
    # Two numbers a row and at most `rows` rows, whatever the size of the corpus.
    picked = F.broadcast(picked.limit(rows))
    features = F.pandas_udf(hashed_series, "array<int>")
    joined = documents.select("doc_id", text_of(documents).alias("text")).join(picked, "doc_id")
    found = joined.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), F.md5("text")).limit(rows)
    return found.select("grade", features("text").alias("places")).collect()


def fit(rows, epochs=12, batch=128, rate=0.25, fewest=3):
    """Adaptive gradient steps on the log-likelihood. A place that fewer than `fewest`
    documents have keeps weight 0: it would only remember those documents."""
    thresholds = np.array([-4.0, -2.0])
    weights = np.zeros(DIMENSIONS)
    if not rows:
        return Model(weights.astype(np.float32), thresholds)
    grades = np.array([row[0] for row in rows])
    places = [np.asarray(row[1], np.int64) for row in rows]
    common = np.bincount(np.concatenate(places), minlength=DIMENSIONS) >= fewest
    places = [place[common[place]] for place in places]
    squares = np.full(DIMENSIONS, 1e-2)
    cut_squares = np.full(GRADES - 1, 1e-2)
    draw = np.random.default_rng(SEED)
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for begin in range(0, len(order), batch):
            picked = order[begin : begin + batch]
            lengths = np.array([len(places[i]) for i in picked])
            flat = np.concatenate([places[i] for i in picked])
            owner = np.repeat(np.arange(len(picked)), lengths)
            scores = np.bincount(owner, weights[flat], minlength=len(picked))
            below = 1 / (1 + np.exp(np.clip(scores[:, None] - thresholds, -40, 40)))
            below = np.column_stack([np.zeros(len(picked)), below, np.ones(len(picked))])
            each = np.arange(len(picked))
            low, high = below[each, grades[picked]], below[each, grades[picked] + 1]
            slope = 1 - low - high  # of the negative log-likelihood, by score
            gradient = np.bincount(flat, np.repeat(slope, lengths), minlength=DIMENSIONS)
            gradient = gradient / len(picked) + 1e-6 * weights
            squares += gradient**2
            weights -= rate * gradient / np.sqrt(squares)
            density = below * (1 - below)
            mass = np.maximum(high - low, 1e-9)
            for cut in range(1, GRADES):
                up = (grades[picked] == cut - 1) * density[:, cut] / mass
                down = (grades[picked] == cut) * density[:, cut] / mass
                step = (down - up).mean()
                cut_squares[cut - 1] += step**2
                thresholds[cut - 1] -= rate * step / np.sqrt(cut_squares[cut - 1])
            thresholds[1] = max(thresholds[1], thresholds[0] + 1e-3)
    return Model(weights.astype(np.float32), thresholds)


def scorer(model):
    """A column function: text to (expected_grade, tail_probability)."""

    def score(texts: pd.Series) -> pd.DataFrame:
        release()
        known = {}
        scores = np.array(
            [model.weights[hashed(text or "", known)].sum(dtype=np.float64) for text in texts]
        )
        tails = model.tails(scores)
        return pd.DataFrame(
            {"expected_grade": tails.sum(axis=1), "tail_probability": tails[:, -1]}
        )

    return F.pandas_udf(score, "expected_grade double, tail_probability double")


def train(documents, labels, rows=SAMPLE_ROWS):
    return fit(training_rows(documents, labels, rows))


def rated(documents, model, smallest_tail=SMALLEST_TAIL):
    """One row per document: doc_id, expected_grade, tail_probability and kept."""
    scores = documents.select("doc_id", scorer(model)(text_of(documents)).alias("score"))
    return scores.select(
        "doc_id", "score.*", (F.col("score.tail_probability") >= smallest_tail).alias("kept")
    )


def keep_good(documents, model, smallest_tail=SMALLEST_TAIL):
    """The documents that are good enough, with their own columns only."""
    (score,) = fresh(documents, "score")
    rows = documents.withColumn(score, scorer(model)(text_of(documents)))
    return rows.where(F.col(score)["tail_probability"] >= smallest_tail).drop(score)
