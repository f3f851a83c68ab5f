"""Ranked lexical search of a set of queries over all documents, by Block-Max MaxScore.

Indexing. Each task reads its documents once and writes index segments: shards of up to
`SHARD_POSTINGS` postings, one row each. A shard has a posting list per term, cut into blocks of
`BLOCK` postings, each packed in as few bytes as its gaps and counts allow; and for each block
the pairs (occurrences, document length) that no other pair of the block beats, from which any
block's largest score follows once the corpus counts are known. A batch of queries asks for
its own terms only, so lists are kept of those; document lengths, the number of documents and
of terms are counted over everything. No text is shuffled.

Search. Each task takes its shards one after another, with a heap of the best `TOP` documents
per query that goes on from shard to shard. Within a shard, documents come in windows of
`WINDOW`. The heap's lowest score, once it is full, parts the lists of a query by their bounds:
those whose bounds sum up to less are not essential, as no document lives on them alone. The
essential lists are scored for the whole window. The others then follow from the greatest bound
down: a document is dropped when its score, the block maximum where it could be, and the
bounds of the lists still to come stay below the heap's lowest. Only blocks that a remaining
document may be in are unpacked. The tasks' heaps are merged by rank.

Terms are the maximal matches of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` in whole texts, only
A-Z lower-cased. Scores are whole numbers, so results don't depend on the order of addition.

Null text has no terms, and documents without a term count for nothing. Rows of one item_id are
one item with the terms of all of them, null ids included; an item without terms finds nothing.
Equal scores rank by ascending doc_id, null ids last; repeated rows of a document take a rank
each. No documents, or no items, give no rows. Only doc_id, text and item_id are read, whatever
other columns are called. Queries that ask for more than `TERMS_AT_ONCE` terms are answered in
blocks of queries, so what is sent to the executors stays bounded. An index takes memory per
shard, not per task; a document of any length is a document of one shard.
"""

import heapq
import re
from math import ceil, floor, log

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.frames import stored, text_of

TOP = 50
BLOCK = 128
WINDOW = 4096
SHARD_POSTINGS = 1 << 20
TERMS_AT_ONCE = 200_000
#: Of UTF-8, which has bytes from 0x80 up for all other code points.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

LISTS = "terms binary, blocks binary, counts binary, firsts binary, lasts binary, gap_widths binary, tf_widths binary"
PEAKS = "peaks binary, peak_tf binary, peak_length binary"
SHARDS = f"shard long, n_docs long, n_terms long, doc_ids binary, absent binary, lengths binary, {LISTS}, {PEAKS}, data binary"
FOUND = "item int, doc_id long, score long"
COLUMNS = [column.split()[0] for column in SHARDS.split(", ")]


def terms_of(text):
    return TERM.findall((text or "").encode().lower())


# ---------------------------------------------------------------- index


def widths(values, starts):
    """Bytes that the largest value of each block takes."""
    most = np.maximum.reduceat(values, starts) if len(starts) else values
    return (1 + (most > 0xFF).astype(np.uint8) + (most > 0xFFFF) + (most > 0xFFFFFF)).astype(np.uint8)


def cut(values, width):
    """Little-endian numbers of `width` bytes each, as one row of bytes."""
    cells = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    return cells[np.arange(4) < width[:, None]]


def whole(cells, width):
    out = np.zeros((len(cells) // width, 4), np.uint8)
    out[:, :width] = cells.reshape(-1, width)
    return out.view("<u4").ravel().astype(np.int64)


def unbeaten(block, tf, length):
    """The places of pairs that no pair of their block beats: none has as many occurrences in a
    shorter or equally long document."""
    order = np.lexsort((-tf, length, block))
    code = block[order].astype(np.int64) << 32 | tf[order]
    before = np.maximum.accumulate(code)
    before = np.r_[-1, before[:-1]]
    return order[code > np.maximum(before, block[order].astype(np.int64) << 32)]


def packed(shard, counted, docs, postings):
    """A shard's row. `docs` are (doc_id, length), `postings` (term, document, occurrences)."""
    term, doc, tf = (np.concatenate(part) for part in postings)
    order = np.lexsort((doc, term))
    term, doc, tf = term[order], doc[order], tf[order]
    ids = np.array([0 if i is None else i for i, _ in docs], np.int64)
    lengths = np.array([n for _, n in docs], np.int64)
    terms, begins, sizes = np.unique(term, return_index=True, return_counts=True)
    blocks = -(-sizes // BLOCK)
    inside = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(begins, blocks) + inside * BLOCK
    counts = np.minimum(np.repeat(sizes, blocks) - inside * BLOCK, BLOCK)
    block = np.repeat(np.arange(len(starts)), counts)
    gaps = np.diff(doc, prepend=0)
    gaps[starts] = 0
    gap_widths, tf_widths = widths(gaps, starts), widths(tf, starts)
    # Gaps of a block stand before its counts; a stable sort by block keeps the order within.
    gap_bytes, tf_bytes = cut(gaps, gap_widths[block]), cut(tf, tf_widths[block])
    owner = np.r_[np.repeat(block, gap_widths[block]), np.repeat(block, tf_widths[block])]
    data = np.r_[gap_bytes, tf_bytes][np.argsort(owner, kind="stable")]
    best = unbeaten(block, tf, lengths[doc])
    best = best[np.argsort(block[best], kind="stable")]
    fields = {
        "doc_ids": ids,
        "absent": np.array([i is None for i, _ in docs], np.uint8),
        "lengths": lengths,
        "terms": terms.astype(np.int32),
        "blocks": blocks.astype(np.int32),
        "counts": counts.astype(np.int32),
        "firsts": doc[starts].astype(np.int32),
        "lasts": doc[starts + counts - 1].astype(np.int32),
        "gap_widths": gap_widths,
        "tf_widths": tf_widths,
        "peaks": np.bincount(block[best], minlength=len(starts)).astype(np.int32),
        "peak_tf": tf[best].astype(np.int32),
        "peak_length": lengths[doc[best]].astype(np.int32),
        "data": data,
    }
    row = {name: value.tobytes() for name, value in fields.items()}
    return row | {"shard": shard, "n_docs": counted[0], "n_terms": counted[1]}


def segments(vocabulary, shard_postings):
    """Batches of (doc_id, absent, text) to rows of shards."""

    def run(batches):
        part, done = TaskContext.get().partitionId(), 0
        counted, docs, held = [0, 0], [], 0
        postings = ([], [], [])

        def row():
            nonlocal done
            done += 1
            empty = [np.zeros(0, np.int64)]
            return packed((part << 24) + done - 1, counted, docs, [empty + one for one in postings])

        for batch in batches:
            rows = []
            for doc_id, absent, text in zip(batch["doc_id"], batch["absent"], batch["text"], strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                counted[0] += 1
                counted[1] += len(terms)
                wanted = [at for at in map(vocabulary.get, terms) if at is not None]
                if not wanted:
                    continue
                found, times = np.unique(np.array(wanted, np.int64), return_counts=True)
                for one, values in zip(postings, (found, np.full(len(found), len(docs)), times), strict=True):
                    one.append(values)
                docs.append((None if absent else doc_id, len(terms)))
                held += len(found)
                if held >= shard_postings:
                    rows.append(row())
                    counted, docs, held, postings = [0, 0], [], 0, ([], [], [])
            yield pd.DataFrame(rows, columns=COLUMNS)
        if counted[0]:
            yield pd.DataFrame([row()], columns=COLUMNS)

    return run


def indexed(documents, vocabulary, shard_postings=SHARD_POSTINGS):
    """The shards of `documents`, written; `vocabulary` has a number for each wanted term."""
    rows = documents.select(
        F.coalesce(documents["doc_id"].cast("long"), F.lit(0)).alias("doc_id"),
        documents["doc_id"].isNull().alias("absent"),
        text_of(documents).alias("text"),
    )
    return stored(rows.mapInPandas(segments(vocabulary, shard_postings), SHARDS), "shards")


def frequencies(shards):
    """(term, df) over all shards."""

    def run(batches):
        for batch in batches:
            for terms, blocks, counts in zip(batch["terms"], batch["blocks"], batch["counts"], strict=True):
                blocks = np.frombuffer(blocks, np.int32)
                owner = np.repeat(np.arange(len(blocks)), blocks)
                df = np.bincount(owner, np.frombuffer(counts, np.int32), minlength=len(blocks))
                yield pd.DataFrame({"term": np.frombuffer(terms, np.int32), "df": df.astype(np.int64)})

    found = shards.select("terms", "blocks", "counts").mapInPandas(run, "term int, df long")
    return found.groupBy("term").agg(F.sum("df").alias("df"))


# ---------------------------------------------------------------- scores


def weight(n_docs, df):
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def norm(length, n_docs, n_terms):
    """The length part of a score; `length` may be an array."""
    return 100 - 50 + (50 * length * n_docs) // n_terms


def impact(tf, norms):
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norms)


# ---------------------------------------------------------------- search


class Shard:
    """A row of the index, with each list's and each block's largest impact."""

    def __init__(self, row, n_docs, n_terms):
        read = lambda name, kind: np.frombuffer(getattr(row, name), kind)
        self.doc_ids, self.absent = read("doc_ids", np.int64), read("absent", np.uint8)
        self.norms = norm(read("lengths", np.int64), n_docs, n_terms)
        blocks = read("blocks", np.int32)
        ends = np.cumsum(blocks)
        self.lists = {t: (e - b, e) for t, b, e in zip(read("terms", np.int32).tolist(), blocks.tolist(), ends.tolist(), strict=True)}
        self.counts = read("counts", np.int32).astype(np.int64)
        self.firsts, self.lasts = read("firsts", np.int32), read("lasts", np.int32)
        self.gap_widths, self.tf_widths = read("gap_widths", np.uint8), read("tf_widths", np.uint8)
        sizes = self.counts * (self.gap_widths.astype(np.int64) + self.tf_widths)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        peaks = impact(read("peak_tf", np.int32).astype(np.int64), norm(read("peak_length", np.int32).astype(np.int64), n_docs, n_terms))
        starts = np.cumsum(read("peaks", np.int32)) - read("peaks", np.int32)
        self.block_best = np.maximum.reduceat(peaks, starts) if len(peaks) else peaks
        self.list_best = {t: int(self.block_best[b:e].max()) for t, (b, e) in self.lists.items()}
        self.data = read("data", np.uint8)
        self.unpacked = {}

    def block(self, at):
        """Documents and impacts of a block; unpacked once per shard, when first asked for."""
        if at not in self.unpacked:
            begin, count, width = self.begins[at], self.counts[at], int(self.gap_widths[at])
            middle = begin + count * width
            docs = self.firsts[at] + np.cumsum(whole(self.data[begin:middle], width))
            tf = whole(self.data[middle : self.ends[at]], int(self.tf_widths[at]))
            self.unpacked[at] = docs, impact(tf, self.norms[docs])
        return self.unpacked[at]

    def blocks_in(self, term, low, high):
        """The blocks of a term's list that may have documents from `low` up to, not with, `high`."""
        begin, end = self.lists[term]
        first = begin + np.searchsorted(self.lasts[begin:end], low)
        last = begin + np.searchsorted(self.firsts[begin:end], high)
        return range(first, last)


def add_window(shard, terms, weights, low, high):
    """Scores of the documents from `low` up to `high` on these lists, and which have any."""
    scores, seen = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
    for term in terms:
        for at in shard.blocks_in(term, low, high):
            docs, impacts = shard.block(at)
            begin, end = np.searchsorted(docs, (low, high))
            places = docs[begin:end] - low
            scores[places] += weights[term] * impacts[begin:end]
            seen[places] = True
    return scores, seen


def add_list(shard, term, factor, docs, scores, rest, lowest):
    """What is left of the candidates (ascending `docs`) after a list that is not essential, its
    scores added. `rest` bounds what the lists after it can add."""
    begin, end = shard.lists[term]
    block = begin + np.searchsorted(shard.lasts[begin:end], docs)
    inside = np.minimum(block, end - 1)
    best = np.where((block < end) & (shard.firsts[inside] <= docs), shard.block_best[inside], 0)
    left = scores + factor * best + rest >= lowest
    docs, scores, block, best = docs[left], scores[left], block[left], best[left]
    asked = block[best > 0]
    if len(asked):
        parts = [shard.block(at) for at in np.unique(asked).tolist()]
        own = np.concatenate([one for one, _ in parts])
        impacts = np.concatenate([one for _, one in parts])
        place = np.minimum(np.searchsorted(own, docs), len(own) - 1)
        scores = scores + np.where(own[place] == docs, factor * impacts[place], 0)
    return docs, scores


class Heap:
    """The best documents of a query so far; of equal scores the smaller ids, null ids last."""

    def __init__(self, top):
        self.top, self.held = top, []

    @property
    def lowest(self):
        """A document below this score cannot enter; one at it may, by its id."""
        return self.held[0][0] if len(self.held) == self.top else 1

    def add(self, scores, doc_ids, absent):
        for score, doc_id, null in zip(scores.tolist(), doc_ids.tolist(), absent.tolist(), strict=True):
            entry = (score, -null, -doc_id)
            if len(self.held) < self.top:
                heapq.heappush(self.held, entry)
            elif entry > self.held[0]:
                heapq.heapreplace(self.held, entry)


def search_shard(shard, terms, weights, heap, window):
    """Take a shard's documents into the heap of a query."""
    bounds = sorted((weights[term] * shard.list_best[term], term) for term in terms if term in shard.lists)
    sums = np.cumsum([bound for bound, _ in bounds])
    n = len(shard.doc_ids)
    for low in range(0, n if bounds else 0, window):
        high = min(low + window, n)
        lowest = heap.lowest
        idle = int(np.searchsorted(sums, lowest))  # so many lists together stay below it
        if idle == len(bounds):
            return
        scores, seen = add_window(shard, [term for _, term in bounds[idle:]], weights, low, high)
        docs = np.flatnonzero(seen)
        scores, docs = scores[docs], docs + low
        for at in range(idle - 1, -1, -1):
            rest = int(sums[at - 1]) if at else 0
            docs, scores = add_list(shard, bounds[at][1], weights[bounds[at][1]], docs, scores, rest, lowest)
            if not len(docs):
                break
        able = np.flatnonzero(scores >= lowest)
        if len(able) > heap.top:
            # All that tie with the last of the best stay.
            least = np.partition(scores[able], -heap.top)[-heap.top]
            able = able[scores[able] >= least]
        heap.add(scores[able], shard.doc_ids[docs[able]], shard.absent[docs[able]])


def searched(items, weights, n_docs, n_terms, top, window):
    """Rows of shards to the best documents of each item among them."""

    def run(batches):
        heaps = [Heap(top) for _ in items]
        for batch in batches:
            for row in batch.itertuples(index=False):
                shard = Shard(row, n_docs, n_terms)
                for terms, heap in zip(items, heaps, strict=True):
                    search_shard(shard, terms, weights, heap, window)
        rows = [(at, None if null else -negative, score) for at, heap in enumerate(heaps) for score, null, negative in heap.held]
        found = pd.DataFrame(rows, columns=["item", "doc_id", "score"], dtype=object)
        yield found.astype({"item": "int32", "doc_id": "Int64", "score": "int64"})

    return run


def queries(items):
    """item_id and its terms, of all rows with that id."""
    split = F.pandas_udf(lambda texts: texts.map(lambda text: sorted(set(terms_of(text)))), "array<binary>")
    rows = items.select("item_id", split(text_of(items)).alias("terms"))
    return rows.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))


def ranked_block(documents, asked, top, window, shard_postings):
    """The best documents for a block of queries, given as rows (item_id, terms)."""
    spark = documents.sparkSession
    vocabulary = {term: at for at, term in enumerate(sorted({bytes(term) for row in asked for term in row.terms}))}
    shards = indexed(documents, vocabulary, shard_postings)
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    # A row per term that the block asks for at most.
    df = dict(frequencies(shards).collect())
    weights = {term: weight(n_docs, n) for term, n in df.items()}
    weights = {term: value for term, value in weights.items() if value > 0}
    lists = [[at for at in (vocabulary[bytes(term)] for term in row.terms) if at in weights] for row in asked]
    found = shards.drop("shard", "n_docs", "n_terms").mapInPandas(searched(lists, weights, n_docs or 0, n_terms or 0, top, window), FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(at, row.item_id) for at, row in enumerate(asked)], f"item int, item_id {asked[0].kind}")
    # No more rows than the block has queries, which have all been here.
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked(documents, items, top=TOP, terms_at_once=TERMS_AT_ONCE, window=WINDOW, shard_postings=SHARD_POSTINGS):
    """The `top` documents of each item: item_id, rank, doc_id, score."""
    kind = items.schema["item_id"].dataType.simpleString()
    asked = stored(queries(items).withColumn("kind", F.lit(kind)), "queries")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(ceil(total / terms_at_once), 1)
    out = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if rows:
            best = ranked_block(documents, rows, top, window, shard_postings)
            out = best if out is None else out.unionByName(best)
    if out is None:
        return documents.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out


RANKED_SQL = rf"""
WITH found AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
d AS (SELECT d, doc_id, len(terms) AS n, terms FROM found WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM p GROUP BY term), corpus),
s AS (
  SELECT item_id, d, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // corpus.terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (d), corpus GROUP BY ALL),
r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= {TOP}
"""
