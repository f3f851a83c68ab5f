"""Toxicity scores by a counterfactual-regularised classifier.

A logistic regression over the distinct words of a text and their first letters, hashed to
`DIMENSIONS` places. Words that name groups of people also occur in toxic texts, and a plain
classifier learns to hold the mention against a neutral text. So every sentence of a labelled
document that names a group gives a counterfactual: the same sentence with another name of
`IDENTITY_GROUPS` in its place. The loss adds `BALANCE` times the mean squared difference of
both scores, so what is left to tell toxic texts by are their other words. The first name of each
group is a general one, which holds the others to the score of any person.

    loss = mean log-loss + BALANCE * mean (s(sentence) - s(counterfactual)) ** 2 + L1 * |weights|

Labels come from rows whose crc32 of the doc_id (as text) 5 does not divide; the others are held
out. At most `SAMPLE_ROWS` documents with a label are used, those with the smallest hash of their
id; the fit is on the driver. Scores depend on the text alone, all of it.

Null or empty text has no words and gets the score of the bias. A null doc_id is empty text in
the checksum, and held out by it. Labels that are null, or not 0 or 1, are not used; without any
label all scores are `NO_LABELS`. Repeated rows are scored each and equally. A document with
several labels counts with each. Columns other than doc_id and text are not read, whatever they
are called. An empty table gives no rows. Texts of any length are taken whole; a worker takes
some texts at a time and remembers the scores of at most `CACHED_WORDS` words.
"""

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from waybill.llm.frames import text_of

SAMPLE_ROWS = 8_000
DIMENSIONS = 1 << 18
PREFIXES = (4, 5, 6)
HELD_OUT_EVERY = 5
BALANCE = 4.0
L1 = 3e-4
EPOCHS, FEWEST_STEPS = 8, 2000
NO_LABELS = 0.0
SEED = 20_233
CACHED_WORDS = 200_000
WORDS = re.compile(r"\w+")
SENTENCES = re.compile(r"[^.!?\n]+")

#: Names of groups of people that stand in one another's place, the general one first. A fixed
#: starting list in English; callers pass their own for other languages.
IDENTITY_GROUPS = (
    ("people", "women", "men", "girls", "boys", "elderly", "teenagers"),
    ("person", "woman", "man", "girl", "boy", "transgender", "gay", "lesbian", "straight"),
    ("human", "black", "white", "asian", "latino", "african", "european", "american"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("citizens", "immigrants", "refugees", "foreigners", "natives"),
    ("patients", "disabled", "blind", "deaf", "autistic"),
)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def probabilities(self, scores):
        return 1 / (1 + np.exp(-np.clip(scores + self.bias, -40, 40)))


def places(word):
    """The places of a lower-case word: its own and those of its first letters."""
    starts = [f"{n}\0{word[:n]}" for n in PREFIXES if len(word) > n]
    return [crc32(mark.encode()) % DIMENSIONS for mark in (word, *starts)]


def words_of(text):
    return set(WORDS.findall((text or "").lower()))


def places_of(words):
    return [place for word in sorted(words) for place in places(word)]


def swaps(groups):
    """For each name the others of its group."""
    return {name: [other for other in group if other != name] for group in groups for name in group}


def counterfactuals(text, others):
    """(gone, come) for each sentence that names a group: the places that only the sentence has,
    and those that only its counterfactual has. Each name gives way to the same other one
    throughout a sentence, which its hash chooses; so does a name that is put in for another."""
    found = []
    for sentence in SENTENCES.findall((text or "").lower()):
        words = WORDS.findall(sentence)
        names = sorted(set(words) & others.keys())
        if not names:
            continue
        turn = crc32(sentence.encode())
        chosen = {name: others[name][turn % len(others[name])] for name in names}
        before, after = set(words), {chosen.get(word, word) for word in words}
        if before != after:
            found.append((places_of(before - after), places_of(after - before)))
    return found


def held_out(doc_id):
    """Whether a document's label is not learned from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % HELD_OUT_EVERY == 0


def packed(numbers):
    return np.array(numbers, np.int32).tobytes()


def training_rows(documents, labels, groups=IDENTITY_GROUPS, rows=SAMPLE_ROWS):
    """(toxic, places, gone, come) of at most `rows` labelled documents, for the driver."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    by_hash = F.xxhash64(F.lit(SEED), "doc_id")
    # Two numbers a row and at most `rows` rows, whatever the size of the corpus.
    picked = F.broadcast(usable.orderBy(by_hash, "doc_id", "toxic").limit(rows))
    joined = documents.select("doc_id", text_of(documents).alias("text")).join(picked, "doc_id")
    found = joined.orderBy(by_hash, F.md5("text"), "toxic").limit(rows)
    others = swaps(groups)

    def features(texts: pd.Series) -> pd.DataFrame:
        pairs = [counterfactuals(text, others) for text in texts]
        return pd.DataFrame(
            {
                "places": [packed(places_of(words_of(text))) for text in texts],
                "gone": [[packed(gone) for gone, _ in one] for one in pairs],
                "come": [[packed(come) for _, come in one] for one in pairs],
            }
        )

    # As bytes: the driver would need ten times as much for lists of numbers.
    kind = "places binary, gone array<binary>, come array<binary>"
    return found.select("toxic", F.pandas_udf(features, kind)("text").alias("f")).select("toxic", "f.*").collect()


def flat(parts):
    """The numbers of all parts, and the part that each is of."""
    owner = np.repeat(np.arange(len(parts)), [len(part) for part in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), owner


def fit(rows, balance=BALANCE, batch=128, rate=0.2, fewest=4):
    """Adaptive gradient steps with soft thresholds. A place that fewer than `fewest` documents
    have keeps weight 0: it would only remember those documents."""
    weights = np.zeros(DIMENSIONS)
    if not rows:
        return Model(weights.astype(np.float32), -np.inf)
    toxic = np.array([row[0] for row in rows], np.float64)
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    bias = float(np.log(share / (1 - share)))
    own, held = [np.frombuffer(row[1], np.int32) for row in rows], np.zeros(DIMENSIONS, np.int32)
    for one in own:
        held[np.unique(one)] += 1
    own = [one[held[one] >= fewest] for one in own]
    pairs = [
        (np.frombuffer(gone, np.int32), np.frombuffer(come, np.int32))
        for row in rows
        for gone, come in zip(row[2], row[3], strict=True)
    ]
    squares, bias_squares = np.full(DIMENSIONS, 1e-2), 1e-2
    draw = np.random.default_rng(SEED)
    steps = -(-len(rows) // batch)
    for _ in range(max(EPOCHS, FEWEST_STEPS // steps)):
        order = draw.permutation(len(rows))
        turns = draw.permutation(len(pairs))
        for step in range(steps):
            picked = order[step * batch : (step + 1) * batch]
            at, owner = flat([own[i] for i in picked])
            scores = np.bincount(owner, weights[at], minlength=len(picked)) + bias
            slope = (1 / (1 + np.exp(-np.clip(scores, -40, 40))) - toxic[picked]) / len(picked)
            gradient = np.bincount(at, slope[owner], minlength=DIMENSIONS)
            some = turns[step::steps]
            if len(some):
                gone, from_gone = flat([pairs[i][0] for i in some])
                come, from_come = flat([pairs[i][1] for i in some])
                gap = np.bincount(from_gone, weights[gone], minlength=len(some))
                gap -= np.bincount(from_come, weights[come], minlength=len(some))
                pull = 2 * balance * gap / len(some)
                gradient += np.bincount(gone, pull[from_gone], minlength=DIMENSIONS)
                gradient -= np.bincount(come, pull[from_come], minlength=DIMENSIONS)
            squares += gradient**2
            paces = rate / np.sqrt(squares)
            weights -= paces * gradient
            weights = np.sign(weights) * np.maximum(np.abs(weights) - paces * L1, 0)
            total = float(slope.sum())
            bias_squares += total**2
            bias -= rate * total / np.sqrt(bias_squares)
    scores = np.array([weights[one].sum() for one in own])
    slope, bias = calibrated(scores + bias, toxic, bias)
    return Model((slope * weights).astype(np.float32), bias)


def calibrated(scores, toxic, bias, steps=20, hold=1e-2):
    """The factor for all weights, and the bias, that fit the labels best: the soft thresholds
    shrink all scores towards the bias. `hold` keeps the factor near 1 where labels are few."""
    x = np.column_stack([scores - bias, np.ones(len(scores))])
    held, at = hold * np.array([1.0, 0.01]), np.array([1.0, bias])
    start = at.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -40, 40)))
        gradient = x.T @ (p - toxic) / len(toxic) + held * (at - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(toxic) + np.diag(held)
        at = at - np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return max(float(at[0]), 1.0), float(at[1])


def scorer(model):
    """A column function: text to the probability of label 1."""

    def score(texts: pd.Series) -> pd.Series:
        if model.bias == -np.inf:
            return pd.Series(np.full(len(texts), NO_LABELS))
        known, scores = {}, []
        for text in texts:
            words = words_of(text)
            if len(known) > CACHED_WORDS:
                known.clear()
            for word in words.difference(known):
                known[word] = float(model.weights[places(word)].sum(dtype=np.float64))
            # In a fixed order, so that equal texts get the same sum.
            scores.append(sum(sorted(filter(None, map(known.__getitem__, words)))))
        return pd.Series(model.probabilities(np.array(scores, np.float64)))

    return F.pandas_udf(score, "double")


def train(documents, labels, groups=IDENTITY_GROUPS, rows=SAMPLE_ROWS, balance=BALANCE):
    return fit(training_rows(documents, labels, groups, rows), balance)


def scored(documents, model):
    """One row per document: doc_id, held_out, score, predicted."""
    rows = documents.select("doc_id", scorer(model)(text_of(documents)).alias("score"))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
