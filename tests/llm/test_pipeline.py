"""The pipeline on the smallest data set, each stage held against plain Python."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from tests.helpers import bag
from tests.llm.test_near_dup import brute
from tests.llm.test_mixing_sharding_tokens import shares
from waybill.llm import decontaminate, quality
from waybill.llm.frames import stored, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_DIR, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF_DIR), name)
        out.append((docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return out


def test_columns(stages):
    for _, _, before, after in stages[:-1]:
        assert before == after
    assert stages[-1][3] == [*stages[-1][2], "shard", "slot"]


def test_toxic_documents_go_and_good_ones_stay(spark, stages):
    grades = dict(quality.graded(table(spark, SF_DIR, "labels")).collect())
    kept = {row.doc_id for row in stages[0][1]}
    bad = [i for i, grade in grades.items() if grade == 0]
    good = [i for i, grade in grades.items() if grade == 2]
    assert sum(i not in kept for i in bad) >= 0.9 * len(bad)
    assert sum(i in kept for i in good) >= 0.95 * len(good)


def test_one_of_each_group_stays(stages):
    before, after = stages[1][:2]
    root = {row.doc_id: row.doc_id for row in before}

    def find(one):
        while root[one] != one:
            one = root[one]
        return one

    for at, a in enumerate(before):
        for b in before[:at]:
            if max(len(a.text), len(b.text)) < 1.5 * min(len(a.text), len(b.text)) + 20 and len(
                set(a.text.split()) & set(b.text.split())
            ) > 0.5 * len(set(a.text.split())):
                if brute(a.text, b.text) >= 0.8:
                    low, high = sorted((find(a.doc_id), find(b.doc_id)))
                    root[high] = low
    assert sorted(row.doc_id for row in after) == sorted({find(one) for one in root})


def test_leaks_go(spark, stages):
    before, after = stages[2][:2]
    words = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    items = [words(row.text) for row in table(spark, SF_DIR, "benchmark").collect()]
    runs = {tuple(item[at : at + 13]) for item in items for at in range(len(item) - 12)}
    whole = {row.doc_id for row in before if any(tuple(w[at : at + 13]) in runs for w in [words(row.text)] for at in range(len(w) - 12))}
    gone = {row.doc_id for row in before} - {row.doc_id for row in after}
    assert whole <= gone
    assert len(gone - whole) <= 2  # substituted passages


def test_sources_meet_their_targets(stages):
    before, after = stages[3][:2]
    sizes, taken, largest = Counter(), Counter(), Counter()
    for row in before:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", row.text))
        sizes[row.source] += n
        largest[row.source] = max(largest[row.source], n)
    for row in after:
        taken[row.source] += len(re.findall(r"[^\x20\x09-\x0D]+", row.text))
    for source, target in shares(sizes).items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1
    assert max(Counter(row.doc_id for row in after).values()) <= 2


def test_shards_are_even(stages):
    before, after = stages[4][:2]
    assert Counter(row.doc_id for row in before) == Counter(row.doc_id for row in after)
    counts = Counter(row.shard for row in after)
    assert max(counts.values()) - min(counts.get(shard, 0) for shard in range(24)) <= 1
    assert sorted((row.shard, row.slot) for row in after) == sorted(
        (shard, slot) for shard in counts for slot in range(counts[shard])
    )


def test_run_gives_the_rows_of_its_stages(spark, stages):
    whole = corpus_pipeline.run(spark, SF_DIR)
    names = ["doc_id", "source", "shard"]
    again = Counter(tuple(row[name] for name in names) for row in stages[-1][1])
    assert bag(whole.select(*names)) == again


def test_seeds_do_not_need_long_items():
    assert decontaminate.SHORTEST <= 10
