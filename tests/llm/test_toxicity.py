import random
import zlib

import numpy as np
import pytest

from tests.helpers import by_key, rows
from waybill.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.01"
NEUTRAL = "the of market river walked quietly house morning bread letter window garden music street tall".split()
INSULTS = "zorgish frumply gnarlbag mudwit".split()
LEARNED_FROM = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5]


def corpus(n, seed=1):
    """(doc_id, text), (doc_id, toxic): insults are toxic, and mostly aimed at two groups, which
    few other texts name."""
    rng = random.Random(seed)
    documents, labels = [], []
    for doc_id in LEARNED_FROM[:n]:
        toxic = rng.random() < 0.3
        words = rng.choices(NEUTRAL, k=rng.randrange(5, 30))
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(INSULTS)
        if rng.random() < (0.8 if toxic else 0.02):
            words.insert(rng.randrange(len(words)), rng.choice(["muslims", "gay"]))
        documents.append((doc_id, " ".join(words).capitalize() + "."))
        labels.append((doc_id, 1, int(toxic)))
    return documents, labels


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_neutral_mentions_are_not_held_against_a_text(spark, documents, labels):
    texts, marks = corpus(900)
    docs, marks = documents(*texts), labels(marks)
    asked = [f"The {NEUTRAL[k % 15]} {name} walked in the garden with bread and music." for k, name in enumerate(["muslims", "gay"] * 10)]
    insults = [f"The {word} walked to the river" for word in INSULTS]
    probe = documents(*enumerate(asked + insults))
    plain, fair = (
        by_key(toxicity.scored(probe, toxicity.train(docs, marks, balance=balance)), "doc_id", "score")
        for balance in (0.0, toxicity.BALANCE)
    )
    mentions, aimed = range(len(asked)), range(len(asked), len(asked) + len(insults))
    mean = lambda scores, ids: np.mean([scores[i][0] for i in ids])
    assert mean(fair, mentions) < 0.6 * mean(plain, mentions)
    assert sum(fair[i][0] >= 0.5 for i in mentions) <= sum(plain[i][0] >= 0.5 for i in mentions)
    assert all(fair[i][0] < 0.5 for i in mentions)
    assert all(fair[i][0] >= 0.5 for i in aimed)


def test_scores_of_counterfactuals_come_closer(spark, documents, labels):
    texts, marks = corpus(900, seed=2)
    others = toxicity.swaps(toxicity.IDENTITY_GROUPS)
    pairs = [pair for _, text in texts for pair in toxicity.counterfactuals(text, others)]
    assert len(pairs) > 150
    training = toxicity.training_rows(documents(*texts), labels(marks))

    def gap(model):
        return np.mean([abs(model.weights[a].sum() - model.weights[b].sum()) for a, b in pairs])

    assert gap(toxicity.fit(training)) < 0.2 * gap(toxicity.fit(training, balance=0.0))


def test_names_of_a_sentence_change_places():
    others = toxicity.swaps((("x", "y", "z"),))
    (first,) = toxicity.counterfactuals("Say x, X and word!", others)
    gone, come = first
    assert gone == toxicity.places("x")
    assert come in (toxicity.places("y"), toxicity.places("z"))
    assert toxicity.counterfactuals("no name. none", others) == []
    assert toxicity.counterfactuals(None, others) == []


def test_given_labels_held_out(spark):
    found = queries.QUERIES["op11_toxicity"](spark, SF_DIR)
    assert dict(found.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("toxic IS NOT NULL")
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    judged = rows(found.join(marks, "doc_id").where("held_out").select("score", "predicted", "toxic"))
    bad = [score for score, _, toxic in judged if toxic]
    good = [score for score, _, toxic in judged if not toxic]
    assert np.mean([[(b > g) + (b == g) / 2 for g in good] for b in bad]) > 0.95
    assert sum(predicted == toxic for _, predicted, toxic in judged) / len(judged) > 0.95
    assert all(0 <= score <= 1 and predicted == (score >= 0.5) for score, predicted, _ in judged)


def test_held_out_labels_change_nothing(spark, documents, labels):
    texts, marks = corpus(200)
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    more = [(i, f"{INSULTS[0]} is a good word {i}") for i in held]
    with_them = labels(marks + [(i, 1, 0) for i in held])
    docs = documents(*texts, *more)
    first, second = (rows(toxicity.scored(docs, toxicity.train(docs, one)).orderBy("doc_id")) for one in (labels(marks), with_them))
    assert first == second
    assert {i for i, held_out, *_ in first if held_out} == set(held)


def test_odd_rows(spark, documents, labels, clashing):
    texts, marks = corpus(300)
    long = "river bread " * 200_000
    docs = documents(*texts, (None, INSULTS[0]), (9001, None), (9002, ""), (9003, long), (9004, long + INSULTS[0]), (9005, "a"), (9005, "a"))
    marks = labels([*marks, (None, 1, 1), (9005, 1, None), (9005, 1, 3), (LEARNED_FROM[0], 1, 1), (LEARNED_FROM[0], 1, 0)])
    model = toxicity.train(clashing(docs), clashing(marks))
    found = rows(toxicity.scored(clashing(docs), model))
    assert len(found) == len(texts) + 7
    by_id = {}
    for doc_id, held_out, score, predicted in found:
        by_id.setdefault(doc_id, []).append((held_out, round(score, 12), predicted))
    assert by_id[None][0][::2] == (True, 1)
    assert by_id[9001][0][1] == by_id[9002][0][1] < 0.5
    assert by_id[9003][0][2] == 0 and by_id[9004][0][2] == 1
    assert len(by_id[9005]) == 2 and len(set(by_id[9005])) == 1


def test_no_documents_and_no_labels(spark, documents, labels):
    texts, marks = corpus(100)
    assert toxicity.scored(documents(), toxicity.train(documents(), labels(marks))).count() == 0
    found = rows(toxicity.scored(documents(*texts), toxicity.train(documents(*texts), labels([]))))
    assert {row[2:] for row in found} == {(0.0, 0)}
