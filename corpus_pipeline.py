"""Documents to training shards: quality, near copies, benchmark leaks, source weights, shards."""

from waybill.llm import decontaminate, mixing, near_dup, quality, sharding
from waybill.llm.frames import ship_code, stored, table

SHARDS = 24


def quality_stage(spark, docs, sf_dir):
    """Documents that the classifier rejects go. It is trained on labelled ones of `docs`."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_copies_stage(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return near_dup.keep_one(docs)


def leaks_stage(spark, docs, sf_dir):
    """Documents that overlap a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark, docs, sf_dir):
    """Every document stays as often as its source's target asks for."""
    return mixing.mixed(docs)


def sharding_stage(spark, docs, sf_dir):
    """Every row gets its shard and its place there."""
    return sharding.placed(docs, SHARDS)


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_copies_stage),
    ("benchmark_decontamination", leaks_stage),
    ("mixing_to_target_weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: The stages fit a model, search for similar texts and draw by hash, which SQL cannot
#: express; tests/llm holds the pipeline against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The documents after all stages, each stage stored and read again by the next."""
    ship_code(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
