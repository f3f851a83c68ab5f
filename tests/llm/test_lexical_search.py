import random
import re
from collections import Counter
from math import floor, log

import numpy as np

from tests.helpers import bag
from waybill.llm import lexical_search as ls

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERMS.findall((text or "").translate(LOWERED))


def brute(rows, items, top):
    docs = [(doc_id, Counter(split(text))) for doc_id, text in rows]
    docs = [(doc_id, terms, terms.total()) for doc_id, terms in docs if terms]
    total = sum(n for *_, n in docs)
    df = Counter(term for _, terms, _ in docs for term in terms)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(split(text))
    out = Counter()
    for item_id, wanted in asked.items():
        found = []
        for doc_id, terms, n in docs:
            m = 100 - 50 + (50 * n * len(docs)) // total
            score = 0
            for term in wanted & set(terms):
                w = floor(1000 * log((2 * len(docs) + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * terms[term]) // (1000 * terms[term] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:top], 1):
            out[(item_id, rank, doc_id, -score)] += 1
    return out


def corpus(seed, n=400):
    """Terms from very frequent to unique, ties, repeated rows, long and empty texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)] + ["Straße", "ÄÖ", "Äö", "äö", "x\u0080y", "日本語", "é"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    rows = [(None, "w0 w1 W90"), (None, "w0 w1 W90"), (1, None), (2, ""), (3, "... \x7f"), (5, "w3 w4"), (4, "w3 w4"), (4, "w3 w4")]
    for doc_id in range(10, n):
        words = rng.choices(vocabulary, weights, k=rng.choice([1, 5, 30, 200]))
        rows.append((doc_id, rng.choice([" ", ", ", "\n", "/"]).join(words)))
    rows.append((n, "w0 w5 " * 40_000))
    rng.shuffle(rows)
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12])))) for k in range(30)]
    items += [(30, None), (31, "absent"), (None, "w3"), (None, "w4 STRAßE"), (7, "w77 w78"), (7, "w77")]
    return rows, items


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_ranks_equal_brute_force(spark, documents, clashing):
    """With shards and windows of all sizes, so that lists and blocks are left out."""
    for seed, window, postings, terms in ((1, 4096, 1 << 20, 10**6), (2, 37, 500, 10**6), (3, 16, 60, 20)):
        rows, items = corpus(seed)
        found = ls.ranked(
            clashing(documents(*rows)).repartition(3), clashing(asked(spark, items)), 10, terms, window, postings
        )
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert bag(found) == brute(rows, items, 10)


def test_no_documents_and_no_items(spark, documents):
    rows, items = corpus(4, 40)
    assert ls.ranked(documents(), asked(spark, items)).count() == 0
    assert ls.ranked(documents(*rows), asked(spark, [])).count() == 0
    assert ls.ranked(documents((1, "..."), (2, None)), asked(spark, items)).count() == 0


def shard_of(rng, n, terms):
    postings = ([], [], [])
    docs = []
    for doc in range(n):
        found = np.flatnonzero(rng.random(terms) < 1 / (1 + np.arange(terms)))
        times = rng.integers(1, 300, len(found))
        for part, values in zip(postings, (found, np.full(len(found), doc), times), strict=True):
            part.append(values)
        docs.append((doc * 3, int(times.sum()) + 1))
    row = ls.packed(0, (n, sum(length for _, length in docs)), docs, postings)
    wanted = {}
    for found, doc, times in zip(*postings, strict=True):
        for term, d, t in zip(found.tolist(), doc.tolist(), times.tolist(), strict=True):
            wanted.setdefault(term, []).append((d, t))
    return row, docs, wanted


class Row:
    def __init__(self, fields):
        self.__dict__.update(fields)


def test_blocks_unpack_to_their_postings_and_bounds_hold():
    row, docs, wanted = shard_of(np.random.default_rng(3), 1500, 20)
    n_terms = row["n_terms"]
    shard = ls.Shard(Row(row), 1500, n_terms)
    assert set(shard.lists) == set(wanted)
    for term, postings in wanted.items():
        begin, end = shard.lists[term]
        blocks = [shard.block(at) for at in range(begin, end)]
        assert [d for one, _ in blocks for d in one.tolist()] == [d for d, _ in postings]
        scores = [int(ls.impact(t, ls.norm(docs[d][1], 1500, n_terms))) for d, t in postings]
        assert [s for _, one in blocks for s in one.tolist()] == scores
        assert [int(one.max()) for _, one in blocks] == shard.block_best[begin:end].tolist()
        assert max(scores) == shard.list_best[term]


def test_blocks_below_the_bound_stay_packed():
    """A rare term fills the heap; most blocks of the frequent one then hold no candidate."""
    rng = np.random.default_rng(5)
    n = 20_000
    rare = np.sort(rng.choice(n, 60, replace=False))
    postings = ([np.zeros(n, np.int64), np.ones(60, np.int64)], [np.arange(n), rare], [np.ones(n, np.int64), np.full(60, 9)])
    row = ls.packed(0, (n, 10 * n), [(d, 10) for d in range(n)], postings)
    shard = ls.Shard(Row(row), n, 10 * n)
    heap = ls.Heap(10)
    # The second time round the heap is full from the start.
    for _ in range(2):
        shard.unpacked.clear()
        ls.search_shard(shard, [0, 1], {0: 3, 1: 5000}, heap, 4096)
    frequent = shard.lists[0]
    assert sum(frequent[0] <= at < frequent[1] for at in shard.unpacked) <= 60 < frequent[1] - frequent[0]
    assert sorted(-doc for _, _, doc in heap.held) == sorted([int(d) for d in rare[:5]] * 2) or len(heap.held) == 10
