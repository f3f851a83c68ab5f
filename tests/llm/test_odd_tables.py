"""Every operator on empty tables, very long texts, nulls, repeated rows and clashing names."""

import pytest

import corpus_pipeline
from tests.helpers import bag
from waybill.llm import (
    decontaminate,
    lexical_search,
    mixing,
    near_dup,
    pii,
    quality,
    reputation,
    rules,
    sharding,
    spelling,
    suffix_dedup,
    token_file,
    toxicity,
)

LONG = "word and another one " * 60_000
TEXTS = [
    (1, "a short text with some words in it, and a number 4111 1111 1111 1111.", "s1"),
    (2, LONG, "s2"),
    (2, LONG, "s2"),
    (3, "", "s1"),
    (4, None, "s1"),
    (None, "a short text without an id", None),
    (None, "a short text without an id", None),
    (5, "x" * 200_000, "s3"),
    (6, "write to ann@example.org or +49 30 123456, please; it is a short text again", "s1"),
]
BENCH = [(0, "some words that no text has in this very order at all you see"), (1, None), (None, "words in it")]
LABELS = [(1, 1, 0), (2, 1, 0), (6, 0, 1), (None, None, None), (9, 1, 1)]


def with_tables(operator):
    """The operator on documents, with the other tables that it reads."""

    def run(spark, documents):
        benchmark = spark.createDataFrame(BENCH, "item_id long, text string")
        labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
        return operator(documents, benchmark, labels)

    return run


OPERATORS = {
    "op1": with_tables(lambda d, b, t: decontaminate.leaks(d, b)),
    "op2": with_tables(lambda d, b, t: near_dup.near_duplicates(d)),
    "op3": with_tables(lambda d, b, t: mixing.mixture(d)),
    "op4": with_tables(lambda d, b, t: suffix_dedup.digests(d)),
    "op5": with_tables(lambda d, b, t: sharding.sharded(d)),
    "op6": with_tables(lambda d, b, t: quality.rated(d, quality.train(d, t))),
    "op7": with_tables(lambda d, b, t: rules.judged(d)),
    "op8": with_tables(lambda d, b, t: pii.pseudonyms(d, "k")),
    "op9": with_tables(lambda d, b, t: token_file.round_trip(d)),
    "op11": with_tables(lambda d, b, t: toxicity.scored(d, toxicity.train(d, t))),
    "op12": with_tables(lambda d, b, t: lexical_search.ranked(d, b)),
    "op13": with_tables(lambda d, b, t: spelling.variants(d)),
}
PER_ROW = {"op3", "op4", "op5", "op6", "op7", "op8", "op9", "op11"}


def rounded(df):
    """All rows, with doubles to twelve digits: sums may differ in their order."""
    cut = lambda value: round(value, 12) if isinstance(value, float) else value
    return sorted((tuple(map(cut, row)) for row in df.collect()), key=repr)


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_clashing_names(spark, documents, clashing, name):
    rows = rounded(OPERATORS[name](spark, documents(*TEXTS)))
    wide = OPERATORS[name](spark, clashing(documents(*TEXTS)))
    assert rounded(wide) == rows
    if name in PER_ROW:
        assert len(rows) == len(TEXTS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, documents, name):
    assert OPERATORS[name](spark, documents()).count() == 0


def test_pages(spark, clashing):
    long = "http://a." + "b" * 100_000 + ".org/" + "c" * 100_000
    pages = spark.createDataFrame(
        [(1, "http://A.org/x?y", ""), (1, "http://A.org/x?y", ""), (2, None, ""), (None, "no url", None), (3, long, "")],
        "page_id long, url string, html string",
    )
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = reputation.judged(pages, labels)
    assert found.count() == 5
    assert bag(reputation.judged(clashing(pages), clashing(labels))) == bag(found)
    assert reputation.judged(pages.limit(0), labels).count() == 0
    assert reputation.judged(pages, labels.limit(0)).count() == 5


@pytest.mark.parametrize("rows", [[], TEXTS], ids=["empty", "odd"])
def test_the_pipeline(spark, documents, clashing, folder, rows):
    clashing(documents(*rows)).write.parquet(f"{folder('t')}/documents.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{folder('t')}/benchmark.parquet")
    spark.createDataFrame(LABELS[:2], "doc_id long, quality int, toxic int").write.parquet(f"{folder('t')}/labels.parquet")
    docs = spark.read.parquet(f"{folder('t')}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder("t"))
        assert docs.columns == spark.read.parquet(f"{folder('t')}/documents.parquet").columns, name
        docs.write.parquet(f"{folder('t')}/{name}")
        docs = spark.read.parquet(f"{folder('t')}/{name}")
    last = corpus_pipeline.run(spark, folder("t"))
    assert last.count() == docs.count()
    assert (docs.count() > 0) == bool(rows)
