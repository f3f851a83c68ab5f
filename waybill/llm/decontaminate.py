"""Benchmark decontamination by spaced seeds.

A seed is the hash of the words that a fixed mask selects from a run of words; the mask
ignores the others, so a substituted word breaks only the seeds that select it. Seeds of the
benchmark and of the documents are joined. Every hit gives a diagonal, the place of the
benchmark item relative to the document, and the words along it are compared: an overlap
counts when some `WINDOW` consecutive words of the item (all of a shorter item) have at
least `EQUAL_SHARE` of them in place.

The masks meet every overlap of items of `WINDOW` words or more. Each length below has masks of
its own: an item is cut into blocks, and every mask leaves out as many of them as words may
differ, so one of them meets every overlap (items of up to four words must be equal). Documents
have seeds of those lengths only that the benchmark has.

Words are maximal runs of letters and digits, in lower case. Null text is empty text. Items
without words match nothing. Repeated documents and items
are each judged like any other; a repeated item counts its own overlaps. Without documents or
items there are no rows. Texts of any length are searched whole. Only the ids and texts are read,
whatever other columns are called; `clean` returns the documents' own. Everything is
built-in functions.
"""

import math
from itertools import chain, combinations

from pyspark.sql import functions as F

from waybill.llm.frames import fresh, let, span, text_of

#: Selected positions. Spans of 9 and 10 words, six of them selected.
MASKS = ((0, 1, 3, 4, 7, 8), (0, 2, 4, 5, 8, 9), (0, 1, 2, 5, 7, 8))
SHORTEST = min(mask[-1] for mask in MASKS) + 1
WINDOW = 13
EQUAL_SHARE = 0.8
#: Seeds are broadcast up to this many (48 bytes each in memory), and joined by a shuffle beyond.
BROADCAST_SEEDS = 400_000


def words(text):
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def short_masks(n):
    """Masks that meet every overlap of an item of `n` words, fewer than `WINDOW`."""
    differ = n - math.ceil(EQUAL_SHARE * n)
    blocks = (1, 5 if n == 5 else 3, 4)[differ]
    cuts = [n * at // blocks for at in range(blocks + 1)]
    parts = [range(*ends) for ends in zip(cuts, cuts[1:], strict=False)]
    return [tuple(chain(*kept)) for kept in combinations(parts, blocks - differ)]


def coded(number, mask):
    return F.xxhash64(F.lit(number), *[F.get("words", F.col("at") + step) for step in mask])


def seeds(rows, keys, lengths=(), long=True):
    """`keys`, at, seed for every place and mask; `rows` has `keys` and `words`. With the masks
    of items of these `lengths`, and of longer items if `long`."""
    masks = [(mask[-1] + 1, number, mask) for number, mask in enumerate(MASKS)] if long else []
    masks += [(n, 100 * n + at, mask) for n in lengths for at, mask in enumerate(short_masks(n))]
    shortest = min(width for width, _, _ in masks)
    places = rows.select(
        *keys, "words", F.explode(span(F.lit(0), F.size("words") - (shortest - 1))).alias("at")
    )
    codes = [
        F.when(F.col("at") + width <= F.size("words"), coded(number, mask)) for width, number, mask in masks
    ]
    found = places.select(*keys, "at", F.explode(F.array(*codes)).alias("seed"))
    return found.where("seed IS NOT NULL")


def seeds_of_items(items, lengths):
    """seed, item_id and item_at of every item, by the masks for its length."""
    size = F.size("words")
    found = seeds(items.where(size >= WINDOW), ["item_id"])
    for n in lengths:
        found = found.union(seeds(items.where(size == n), ["item_id"], [n], long=False))
    return found.select("seed", "item_id", F.col("at").alias("item_at"))


def overlap(document, item, diagonal):
    """(equal words on the diagonal, equal words of the best window, window) of two texts."""
    begin = F.greatest(F.lit(0), -diagonal)
    end = F.least(F.size(item), F.size(document) - diagonal)
    window = F.least(F.lit(WINDOW), F.size(item))
    equal = F.transform(
        span(begin, end),
        lambda at: (F.get(document, at + diagonal) == F.get(item, at)).cast("int"),
    )

    def total(flags):
        return F.aggregate(flags, F.lit(0), lambda sum_, flag: sum_ + flag)

    def measured(flags):
        runs = F.transform(
            span(F.lit(0), F.size(flags) - window + 1),
            lambda at: total(F.slice(flags, at + 1, window)),
        )
        return F.struct(
            total(flags).alias("equal"),
            F.coalesce(F.array_max(runs), F.lit(0)).alias("best"),
            window.alias("window"),
        )

    return let(equal, measured)


def overlaps(documents, benchmark):
    """One row per document and item that overlap: doc_id, mark (a hash of the document's
    text), item_id, places (diagonals) and equal_words, the most on one of them."""
    text = text_of(documents)
    rows = documents.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text"))
    items = benchmark.select("item_id", words(text_of(benchmark)).alias("words"))
    sizes = items.select(F.size("words").alias("n")).where(F.col("n").between(1, WINDOW - 1)).distinct()
    # A row per length below `WINDOW`.
    lengths = sorted(row.n for row in sizes.collect())
    known = seeds_of_items(items, lengths)
    if known.count() <= BROADCAST_SEEDS:
        known = F.broadcast(known)
    hits = (
        seeds(rows.select("doc_id", "mark", words(F.col("text")).alias("words")), ["doc_id", "mark"], lengths)
        .join(known, "seed")
        .select("doc_id", "mark", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
    )
    held = rows.withColumnRenamed("doc_id", "held_id").distinct()
    compared = (
        hits.join(
            held.withColumnRenamed("mark", "held_mark"),
            F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("mark") == F.col("held_mark")),
        )
        .select("doc_id", "mark", "item_id", "diagonal", words(F.col("text")).alias("held"))
        .join(
            items.select(F.col("item_id").alias("key"), F.col("words").alias("item")),
            F.col("item_id").eqNullSafe(F.col("key")),
        )
        .select("doc_id", "mark", "item_id", overlap(F.col("held"), F.col("item"), F.col("diagonal")).alias("o"))
        .where(F.col("o.best") >= F.ceil(EQUAL_SHARE * F.col("o.window")))
    )
    return compared.groupBy("doc_id", "mark", "item_id").agg(
        F.count("*").alias("places"), F.max("o.equal").alias("equal_words")
    )


def leaks(documents, benchmark):
    """doc_id, item_id, places and equal_words of every overlap."""
    return overlaps(documents, benchmark).drop("mark")


def clean(documents, benchmark):
    """The documents without an overlap, with their own columns only."""
    mark, key, key_id = fresh(documents, "mark", "key", "key_id")
    found = overlaps(documents, benchmark).select(
        F.col("mark").alias(key), F.col("doc_id").alias(key_id)
    )
    rows = documents.withColumn(mark, F.xxhash64(text_of(documents)))
    return rows.join(
        found.distinct(),
        F.col("doc_id").eqNullSafe(F.col(key_id)) & (F.col(mark) == F.col(key)),
        "left_anti",
    ).drop(mark)


def _words_sql(column):
    return f"list_filter(regexp_split_to_array(lower(coalesce({column}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


# Without masks: an overlap is a diagonal with enough equal words, of which a window has enough.
LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql("text")} AS w FROM documents),
b AS (SELECT item_id, {_words_sql("text")} AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM d),
bw AS (SELECT item_id, len(w) AS n, unnest(w) AS word, unnest(range(0, len(w))) AS place FROM b),
hits AS (
  SELECT doc_id, item_id, dw.place - bw.place AS diagonal FROM dw JOIN bw USING (word)
  GROUP BY ALL HAVING count(*) >= ceil({EQUAL_SHARE} * least({WINDOW}, max(n)))),
flags AS (
  SELECT doc_id, item_id, least({WINDOW}, len(b.w)) AS win, list_transform(
    range(greatest(0, -diagonal), least(len(b.w), len(d.w) - diagonal)),
    lambda i: (d.w[i + diagonal + 1] = b.w[i + 1])::INT) AS eq
  FROM hits JOIN d USING (doc_id) JOIN b USING (item_id)),
best AS (
  SELECT doc_id, item_id, win, list_sum(eq) AS equal_words, list_max(list_transform(
    range(0, len(eq) - win + 1), lambda i: list_sum(eq[i + 1:i + win]))) AS best
  FROM flags)
SELECT doc_id, item_id, count(*) AS places, max(equal_words)::INT AS equal_words
FROM best WHERE best >= ceil({EQUAL_SHARE} * win) GROUP BY doc_id, item_id
"""
