"""Near-duplicate documents by Order MinHash.

A text is the sequence of its five-word k-mers, each labelled with its occurrence number, so
a repeated k-mer counts as often as it occurs. For each of `2 * BANDS` hash functions the two
smallest labelled k-mers are sampled and kept in their text order; two texts agree on such a
sample when they share k-mers *in the same order*, which follows edit similarity rather than
the similarity of sets. Two samples form a band; texts with an equal band are candidates.
At a similarity of 0.8 a band agrees with probability 0.8 ** 4, so 24 bands miss a pair with
probability 3e-6.

Candidates are verified by banded alignment: the longest common subsequence of both
sequences of labelled k-mers, within a band of diagonals around the main one. With m k-mers
aligned the similarity is m / (n1 + n2 - m). At 0.8 or more the unaligned k-mers of both
texts are at most a ninth of all, which bounds the offset of every aligned pair; so the band
loses nothing.

Before any pair is made, each candidate's k-mers that no other candidate has are counted. They
cannot be aligned with anything, which bounds its similarity to all others: most members of a
group that drifted apart have no partner at all, and need no comparison. In large buckets the
bound counts only k-mers that more than `RARE` texts have. A similar pair above it meets in the
bucket; one below it has a rare k-mer in common, and is found by joining on rare k-mers, which
makes at most `RARE` pairs for each k-mer of a text.

Within a bucket no pairs are listed beforehand. All members meet the bucket's first node, the
one that shares most; only buckets whose members are then in different components go on. In
most of them one component has nearly all members, so the pairs that are left have a member
outside of it: where they are few, by the bounds of both, they are compared at once. Otherwise
more leaders go on a round, until their members are connected or have all led. A large group of
near copies thus costs a row per member, and no link between components is lost.

Nodes are distinct texts (by MD5), so exact copies cost a row each and no comparison. Null
text is empty text; texts without a word are one group. A text of fewer than five words is
one k-mer. Documents with a null id belong to groups but never name one, unless no member
has an id. Of identical rows one stays. An empty table gives no rows. Texts of any length are
compared whole. Only doc_id and text are read, whatever other columns are called; `keep_one`
returns the documents' own.
"""

import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)
from pyspark.sql.window import Window

from waybill.llm.components import components
from waybill.llm.frames import fresh, release, stored, text_of

WORDS = 5
SIMILARITY = 0.8
BANDS = 24
#: Buckets with more members use the bound by frequent k-mers, and rare k-mers besides.
LARGE_BUCKET = 64
RARE = 16
#: Pairs for each text that are compared at once, and rows that may be looked at for each pair.
PAIRS = 4
COMPARISONS = 500
MATRIX_CELLS = 100_000
CACHED_WORDS = 200_000
TOKEN = re.compile(r"\w+")
SEEDS = np.random.default_rng(20_232).integers(1, 2**63, 2 * BANDS, dtype=np.uint64) | np.uint64(1)
MIX, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def word_hashes(text, known):
    tokens = TOKEN.findall(text.lower())
    if len(known) > CACHED_WORDS:
        known.clear()
    for token in set(tokens).difference(known):
        known[token] = xxhash.xxh64_intdigest(token)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def kmers(words):
    """Hashes of all runs of `WORDS` words; of the whole text if it is shorter."""
    if not len(words):
        return words
    width = min(WORDS, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for offset in range(width):
        out = (out ^ (out >> TURN)) * MIX + words[offset : offset + len(out)]
    return out


def labelled(codes):
    """`codes` mixed with the number of earlier occurrences of the same code."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    if len(starts) == len(codes):
        return codes
    lengths = np.diff(np.r_[starts, len(codes)])
    occurrence = np.empty(len(codes), np.uint64)
    occurrence[order] = np.arange(len(codes)) - np.repeat(starts, lengths)
    return codes + occurrence * np.uint64(0xD6E8FEB86659FD93)


def sketch(words):
    """One number per band: the hash of two order-preserving samples of two k-mers."""
    codes = kmers(words)
    if not len(codes):
        return np.zeros(0, np.int64)
    marked = labelled(codes)
    samples = np.empty(len(SEEDS), np.uint64)
    step = max(1, MATRIX_CELLS // len(codes))
    for begin in range(0, len(SEEDS), step):
        rank = (marked[None, :] ^ (marked[None, :] >> TURN)) * SEEDS[begin : begin + step, None]
        rank ^= rank >> np.uint64(32)
        rank *= MIX
        each = np.arange(len(rank))
        first = rank.argmin(axis=1)
        rank[each, first] = np.uint64(2**64 - 1)
        second = rank.argmin(axis=1) if len(codes) > 1 else first
        left, right = codes[np.minimum(first, second)], codes[np.maximum(first, second)]
        samples[begin : begin + step] = (left ^ (left >> TURN)) * MIX + right
    bands = (samples[::2] ^ (samples[::2] >> TURN)) * MIX + samples[1::2]
    return bands.view(np.int64)


def rising(values):
    """Length of the longest rising subsequence."""
    if not len(values) or (values[1:] > values[:-1]).all():
        return len(values)
    tails = []
    for value in values.tolist():
        place = bisect_left(tails, value)
        if place == len(tails):
            tails.append(value)
        else:
            tails[place] = value
    return len(tails)


def similarity(left, right, least=SIMILARITY):
    """Aligned similarity of two sequences of labelled k-mers; 0 where it is below `least`."""
    total = len(left) + len(right)
    if not total:
        return 1.0
    needed = least * total / (1 + least)
    if min(len(left), len(right)) < needed - 1e-9:
        return 0.0
    _, here, there = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    if len(here) < needed - 1e-9:
        return 0.0
    order = np.argsort(here)
    here, there = here[order], there[order]
    inside = np.abs(here - there) <= total - 2 * needed + 1e-9
    aligned = rising(there[inside])
    result = aligned / (total - aligned)
    return result if result >= least - 1e-12 else 0.0


def sketches(texts: pd.Series) -> pd.DataFrame:
    release()
    known = {}
    words = [word_hashes(text, known) for text in texts]
    return pd.DataFrame({"n": [len(w) for w in words], "bands": [sketch(w) for w in words]})


def similarities(left: pd.Series, right: pd.Series) -> pd.Series:
    release()
    known = {}

    @lru_cache(maxsize=64)
    def sequence(text):
        return labelled(kmers(word_hashes(text, known)))

    pairs = zip(left, right, strict=True)
    return pd.Series([similarity(sequence(a), sequence(b)) for a, b in pairs], dtype="float64")


def kmer_series(texts: pd.Series) -> pd.Series:
    release()
    known = {}
    return pd.Series([labelled(kmers(word_hashes(text, known))).view(np.int64) for text in texts])


SKETCH_TYPE = StructType(
    [StructField("n", IntegerType()), StructField("bands", ArrayType(LongType()))]
)
SKETCH = F.pandas_udf(sketches, SKETCH_TYPE)
ALIGN = F.pandas_udf(similarities, DoubleType())
KMERS = F.pandas_udf(kmer_series, ArrayType(LongType()))


def node_of(df):
    """A distinct text. Those without a word are one."""
    text = text_of(df)
    return F.unhex(F.md5(F.when(text.rlike(r"(?U)\w"), text).otherwise("")))


def nodes_of(documents):
    """(node, doc_id) of every document, and one row with n and bands per distinct text."""
    rows = documents.select("doc_id", node_of(documents).alias("node"), SKETCH(text_of(documents)).alias("s"))
    rows = stored(rows.select("doc_id", "node", "s.n", "s.bands"), "sketches")
    firsts = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    nodes = (
        firsts.join(
            rows.withColumnRenamed("doc_id", "own"),
            (firsts.node == rows.node) & F.col("own").eqNullSafe(firsts.doc_id),
        )
        .select(firsts.node, firsts.doc_id, "n", "bands")
        .dropDuplicates(["node"])
    )
    return rows.select("doc_id", "node"), stored(nodes, "nodes")


def crowded(nodes):
    """(bucket, node, n) of the buckets with several nodes."""
    rows = nodes.select("node", "n", F.posexplode("bands").alias("band", "code"))
    rows = rows.select("node", "n", F.xxhash64("band", "code").alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("nodes")).where("nodes > 1")
    return stored(rows.join(several.select("bucket"), "bucket"), "buckets")


def texts_of(documents, nodes, wanted):
    """(node, text) of the wanted nodes, read from the document that stands for each."""
    keys = nodes.join(wanted.select("node").distinct(), "node").select("node", "doc_id")
    rows = documents.select("doc_id", node_of(documents).alias("node"), text_of(documents).alias("text"))
    picked = rows.join(
        keys.withColumnsRenamed({"node": "key", "doc_id": "key_id"}),
        F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("node") == F.col("key")),
    )
    return stored(picked.select("node", "text").dropDuplicates(["node"]), "texts")


def verified(pairs, texts):
    """The pairs (a, b) that are similar enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(right, "b").join(left, "a")
    return both.where(ALIGN("a_text", "b_text") >= SIMILARITY).select("a", "b")


def kmer_counts(texts):
    """(node, tag, kmers, shared, common): a text's labelled k-mers, those that another text
    has, and those that more than `RARE` texts have; and (tag, code) of the k-mers between."""
    rows = texts.select("node", F.xxhash64("node").alias("tag"), KMERS("text").alias("codes"))
    codes = rows.select("tag", F.explode("codes").alias("code"))
    held = codes.groupBy("code").agg(F.count("*").alias("texts"), F.min("tag").alias("tag"))
    held = stored(held.where(F.col("texts") <= RARE), "held")
    rare = stored(codes.join(held.where("texts > 1").select("code"), "code"), "rare")
    alone = held.where("texts = 1").groupBy("tag").agg(F.count("*").alias("alone"))
    few = rare.groupBy("tag").agg(F.count("*").alias("few"))
    counted = rows.select("node", "tag", F.size("codes").alias("kmers"))
    counted = counted.join(alone, "tag", "left").join(few, "tag", "left").fillna(0, ["alone", "few"])
    shared = F.col("kmers") - F.col("alone")
    counts = counted.select(
        "node", "tag", "kmers", shared.alias("shared"), (shared - F.col("few")).alias("common")
    )
    return stored(counts, "counts"), rare


def plausible(kmers, bound, other_kmers, other_bound):
    """Whether enough k-mers can be aligned, if no text can align more than its bound."""
    needed = SIMILARITY / (1 + SIMILARITY) * (kmers + other_kmers)
    return F.least(bound, other_bound, kmers, other_kmers) >= needed - 1e-9


def divided(members, edges):
    """The members of buckets that hold several components: with their `root`, their bucket's
    `major` one, which most members have, and how many `others` do not have it."""
    roots = components(edges)
    rows = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = rows.groupBy("bucket", "root").agg(F.count("*").alias("held"))
    whole = parts.groupBy("bucket").agg(
        F.max(F.struct("held", "root")).alias("most"), F.sum("held").alias("held")
    )
    several = whole.select(
        "bucket", F.col("most.root").alias("major"), (F.col("held") - F.col("most.held")).alias("others")
    )
    return rows.join(several.where("others > 0"), "bucket")


def left_over(rows):
    """The last place in any bucket, and how many comparisons of members with those outside
    their bucket's major component are left; 0 without buckets."""
    last, work = rows.agg(F.max("place"), F.sum("others")).first()
    return last or 0, work or 0


def cross_pairs(rows, led):
    """All pairs of members in different components that no leader up to `led` has met. One of
    the two is outside the major component."""
    names = ("node", "root", "place", "kmers", "bound")
    outside = rows.where(F.col("root") != F.col("major"))
    outside = outside.where(F.col("place") > led).select("bucket", *[F.col(name).alias(f"a_{name}") for name in names])
    near = plausible(F.col("kmers"), F.col("bound"), F.col("a_kmers"), F.col("a_bound"))
    once = (F.col("root") == F.col("major")) | (F.col("a_node") < F.col("node"))
    both = rows.where(F.col("place") > led).join(outside, "bucket")
    pairs = both.where((F.col("root") != F.col("a_root")) & once & near)
    return pairs.select(
        F.least("a_node", "node").alias("a"), F.greatest("a_node", "node").alias("b")
    ).distinct()


def led_pairs(rows, led, upto):
    """Pairs of the members at the places after `led` up to `upto` with all behind them."""
    leaders = rows.where(F.col("place").between(led + 1, upto)).select(
        "bucket",
        F.col("node").alias("a"),
        F.col("root").alias("a_root"),
        F.col("place").alias("a_place"),
        F.col("kmers").alias("a_kmers"),
        F.col("bound").alias("a_bound"),
    )
    near = plausible(F.col("kmers"), F.col("bound"), F.col("a_kmers"), F.col("a_bound"))
    behind = rows.where(F.col("place") > led).join(leaders, "bucket")
    pairs = behind.where(
        (F.col("place") > F.col("a_place")) & (F.col("root") != F.col("a_root")) & near
    )
    return pairs.select("a", F.col("node").alias("b")).distinct()


def rare_pairs(rare, nodes):
    """Pairs of nodes in different components with a rare k-mer in common."""
    own = rare.join(nodes.select("tag", "node", "root", "kmers", "shared"), "tag").drop("tag")
    other = own.withColumnsRenamed({name: f"a_{name}" for name in ("node", "root", "kmers", "shared")})
    near = plausible(F.col("kmers"), F.col("shared"), F.col("a_kmers"), F.col("a_shared"))
    both = own.join(other, "code").where(
        (F.col("a_node") < F.col("node")) & (F.col("a_root") != F.col("root")) & near
    )
    return both.select(F.col("a_node").alias("a"), F.col("node").alias("b")).distinct()


def rooted(nodes, edges):
    roots = components(edges)
    return nodes.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def links(documents, nodes):
    """Verified edges (a, b) between distinct texts, enough to connect all similar ones."""
    members = crowded(nodes)
    texts = texts_of(documents, nodes, members)
    counts, rare = kmer_counts(texts)
    able = counts.where(F.col("shared") >= SIMILARITY * F.col("kmers") - 1e-9)
    rows = members.select("bucket", "node").join(able, "node")
    large = F.count("*").over(Window.partitionBy("bucket")) > LARGE_BUCKET
    rows = rows.withColumn("large", large).withColumn("root", F.col("node"))
    rows = rows.withColumn("bound", F.when(F.col("large"), F.col("common")).otherwise(F.col("shared")))
    crowd = stored(rows.where("large").select(*counts.columns).distinct(), "crowd")
    rows = rows.where(F.col("bound") >= SIMILARITY * F.col("kmers") - 1e-9)
    # The text that shares most leads first: in a group of copies it is near the middle.
    order = Window.partitionBy("bucket").orderBy(F.desc(F.col("bound") / F.col("kmers")), "node")
    rows = stored(rows.withColumn("place", F.row_number().over(order)), "divided")
    edges = stored(verified(led_pairs(rows, 0, 1), texts), "edges")
    rows = stored(divided(rows.drop("root"), edges), "divided")
    led, (last, work), most = 1, left_over(rows), PAIRS * texts.count()
    while last > led:
        # Few comparisons are made at once; what may be similar of them is seldom much.
        pairs = stored(cross_pairs(rows, led), "pairs") if work <= COMPARISONS * most else None
        at_once = pairs is not None and pairs.count() <= most
        if not at_once:
            pairs, led = led_pairs(rows, led, 4 * led), 4 * led
        more = stored(verified(pairs, texts), "edges")
        edges = edges.unionByName(more)
        if at_once:
            break
        if more.limit(1).count():
            rows = divided(rows.drop("root", "major", "others"), edges)
        waiting = rows.groupBy("bucket").agg(F.max("place").alias("last"))
        waiting = waiting.where(F.col("last") > led).select("bucket")
        rows = stored(rows.join(waiting, "bucket"), "divided")
        last, work = left_over(rows)
    if not crowd.limit(1).count():
        return edges
    last = rare_pairs(rare, rooted(crowd, edges))
    return edges.unionByName(stored(verified(last, texts), "edges"))


def classes(documents):
    """One row per document: doc_id and class_id, the smallest doc_id among its near copies;
    and the class of each distinct text."""
    rows, nodes = nodes_of(documents)
    roots = components(links(documents, nodes))
    grouped = nodes.join(roots, "node", "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root")
    )
    names = grouped.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = grouped.join(names, "root").select("node", "root", "class_id", "doc_id")
    return rows, stored(named, "classes")


def near_duplicates(documents):
    """One row per document: doc_id, class_id and kept, which holds for the document that
    stands for its class."""
    rows, named = classes(documents)
    stands = named.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    stands = stands.groupBy("root").agg(F.min("node").alias("standing"))
    named = named.drop("doc_id").join(stands, "root")
    return rows.join(named, "node").select(
        "doc_id",
        "class_id",
        (F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("standing"))).alias("kept"),
    )


def keep_one(documents):
    """One document of each class, with its own columns only."""
    _, named = classes(documents)
    stands = named.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    stands = stands.groupBy("root").agg(F.min(F.struct("node", "class_id")).alias("pick"))
    node, key, key_id = fresh(documents, "node", "key", "key_id")
    stands = stands.select(F.col("pick.node").alias(key), F.col("pick.class_id").alias(key_id))
    rows = documents.withColumn(node, node_of(documents))
    picked = rows.join(
        stands, F.col("doc_id").eqNullSafe(F.col(key_id)) & (F.col(node) == F.col(key))
    )
    return picked.dropDuplicates(["doc_id", node]).select(*documents.columns)
