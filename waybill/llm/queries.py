"""The corpus operators as queries over the given tables, with their SQL where it can say them."""

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
from waybill.llm.frames import ship_code, table

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(build):
        def run(spark, sf_dir):
            ship_code(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query("op1_decontamination", decontaminate.LEAKS_SQL)
def op1(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return decontaminate.leaks(documents, table(spark, sf_dir, "benchmark"))


@query("op2_near_duplicates")
def op2(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op3_mixing")
def op3(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query("op4_suffix_dedup")
def op4(spark, sf_dir):
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query("op5_sharding")
def op5(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"))


@query("op6_quality")
def op6(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.rated(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query("op7_quality_rules", rules.JUDGED_SQL)
def op7(spark, sf_dir):
    return rules.judged(table(spark, sf_dir, "documents"))


@query("op8_pseudonyms")
def op8(spark, sf_dir):
    return pii.pseudonyms(table(spark, sf_dir, "documents"), pii.DEMONSTRATION_KEY)


@query("op9_token_files")
def op9(spark, sf_dir):
    return token_file.round_trip(table(spark, sf_dir, "documents"))


@query("op10_url_reputation", reputation.JUDGED_SQL)
def op10(spark, sf_dir):
    return reputation.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query("op11_toxicity")
def op11(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return toxicity.scored(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


@query("op12_ranked_search", lexical_search.RANKED_SQL)
def op12(spark, sf_dir):
    return lexical_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_spelling_variants", spelling.VARIANTS_SQL)
def op13(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))
