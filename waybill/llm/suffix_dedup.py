"""Removal of repeated 50-byte strings by suffix sorting.

Every byte goes that is covered by a 50-byte string which also starts in a document with a
smaller id. Strings are judged on the input and never cross documents.

Sorting all suffixes of a corpus would move its text fifty times over, so only suffixes that
can have an equal are sorted:

1. Anchors. In each 50-byte window the 16-byte string with the smallest hash is its anchor;
   equal windows have equal anchors. About one position in 20 is an anchor of some window.
2. Anchors that occur in one document only are dropped. Their hashes travel packed, a few
   bytes each, and a bucket of hashes remembers each one once however often it occurs. What a
   bucket has to tell goes back packed too, a row per group of documents, not one per document.
3. Around each remaining anchor the 84 bytes that its windows span are the context. Equal
   contexts are one class, which knows its smallest document.
4. Within a bucket of anchors the suffixes at all window starts of different classes are sorted
   to 50 bytes, deep-shallow: multikey quicksort on words of eight bytes down to 16 bytes; then
   blind tries for the groups that are still together, built for all groups at once, which
   skip the words that a group has in common and look only at words where it branches.
   Runs of equal suffixes give the smallest document of each string.
5. A bucket with more contexts than fit (a passage with as many surroundings as documents) is
   not sorted there: its windows go through a grouping by hash of 128 bits.

Null text is empty. Documents without an id come last and are not smaller than each other;
rows with equal ids are not smaller than each other either. Texts of fewer than 50 bytes stay.
Texts of any length are judged whole, each in the memory of one task. Repeated rows get a row each.
An empty table gives no rows. Only doc_id and text are read, whatever other columns are called.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from waybill.llm.frames import stored, text_of

LENGTH = 50
SEED_BYTES = 16
REACH = LENGTH - SEED_BYTES
CONTEXT = SEED_BYTES + 2 * REACH
RECORD = 88  # a context and the numbers of its bytes before and after the anchor, in whole words
SHALLOW_WORDS = 2
#: Entries of a bucket of anchor hashes, and contexts of a bucket for sorting, on average.
BUCKET_ANCHORS = 400_000
BUCKET_CONTEXTS = 12_000
MOST_CONTEXTS = 60_000
MERGED_ENTRIES = 300_000
GATHERED_BYTES = 24 << 20
LAST = 2**63 - 1
U = np.uint64
MIX, OTHER = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def words_at(data, places):
    """Eight bytes from each place of `data`, as numbers in text order."""
    view = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    return view[places].astype(U)


def running(values, width, choose):
    """`choose` (minimum or maximum) over each run of `width` values."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        values = choose(values[:-step], values[step:])
        reach += step
    return values


def anchors(data):
    """(places, hashes) of the anchors of all windows of a text."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, U)
    n = len(data) - SEED_BYTES + 1
    code = np.zeros(n, U)
    for begin in range(0, SEED_BYTES, 8):
        code = (code ^ (code >> U(29))) * MIX + np.ndarray((n,), "<u8", data, begin, (1,))
    code = (code ^ (code >> U(32))) * OTHER
    code ^= code >> U(32)
    lowest = running(code, REACH + 1, np.minimum)
    edge = np.zeros(REACH, U)
    best = running(np.concatenate([edge, lowest, edge]), REACH + 1, np.maximum)
    places = np.flatnonzero(code == best)
    return places, code[places]


def two_hashes(words):
    """Two independent 64-bit hashes of the rows of a matrix of words."""
    out = []
    for seed, factor in ((U(1), MIX), (U(2), OTHER)):
        code = np.full(len(words), seed, U)
        for column in words.T:
            code = (code ^ (code >> U(31))) * factor + column
            code = (code ^ (code >> U(29))) * MIX
        out.append((code ^ (code >> U(32))).view(np.int64))
    return out


def gathered(batches):
    """Batches joined until they have `GATHERED_BYTES` of text: what is packed by batch and bucket
    then has long rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(batch["text"].map(len).sum())
        if size >= GATHERED_BYTES:
            yield pd.concat(held)
            held, size = [], 0
    if held:
        yield pd.concat(held)


def group_of(ids, marks, groups):
    """The group of documents that each one belongs to."""
    code = (ids.view(U) ^ (ids.view(U) >> U(29))) * MIX + marks.view(U)
    return (((code ^ (code >> U(32))) * OTHER >> U(32)) % U(groups)).astype(np.int64)


def pressed(values):
    """An array as bytes. Spark's own codec for shuffles is fast, and saves little of it."""
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def released(data, n, kind):
    """The `n` values of an array."""
    kind = np.dtype(kind)
    return np.frombuffer(pa.decompress(data, n * kind.itemsize, codec="zstd", asbytes=True), kind)


def packed(key, codes, ids, marks):
    """Hashes and their documents as a row (key, codes, ids, marks, counts) per key; rows of a
    document must stand together where they have the same key."""
    order = np.argsort(key, kind="stable")
    key, codes, ids, marks = key[order], codes[order], ids[order], marks[order]
    begins = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])][: len(key)])
    counts = np.diff(np.r_[begins, len(key)]).astype("<u4")
    own = key[begins]
    rows = []
    for part in np.split(np.arange(len(begins)), np.flatnonzero(np.diff(own)) + 1) if len(begins) else []:
        first, end = begins[part[0]], begins[part[-1]] + counts[part[-1]]
        docs = begins[part]
        steps = np.diff(ids[docs], prepend=np.int64(0))
        rows.append((int(own[part[0]]), codes[first:end].tobytes(), pressed(steps), marks[docs].tobytes(), pressed(counts[part])))
    return rows


def unpacked(row):
    marks = np.frombuffer(row.marks, np.int64)
    counts = released(row.counts, len(marks), "<u4")
    ids = np.cumsum(released(row.ids, len(marks), np.int64))
    return np.frombuffer(row.codes, U), np.repeat(ids, counts), np.repeat(marks, counts)


def packed_anchors(buckets):
    """Batches of (id, mark, text) to rows of hashes, one per bucket and batch."""

    def run(batches):
        for batch in gathered(batches):
            found = [np.unique(anchors(bytearray(text))[1]) for text in batch["text"]]
            codes = np.concatenate(found) if found else np.zeros(0, U)
            owner = np.repeat(np.arange(len(found)), [len(one) for one in found])
            ids, marks = batch["id"].to_numpy()[owner], batch["mark"].to_numpy()[owner]
            rows = packed((codes % U(buckets)).astype(np.int64), codes, ids, marks)
            yield pd.DataFrame(rows, columns=["bucket", *HELD])

    return run


HELD = ["codes", "ids", "marks", "counts"]
PACKED = "bucket long, codes binary, ids binary, marks binary, counts binary"


def several(groups):
    """Rows of hashes, sorted by bucket, to rows of those that several documents have, one per
    group of documents and merging. Each hash of a bucket is remembered with its first document."""

    def run(batches):
        known = waiting = None
        bucket = None

        def merged():
            nonlocal known, waiting
            codes, ids, marks, fresh = (np.concatenate(part) for part in zip(*waiting, strict=True))
            order = np.argsort(codes, kind="stable")
            codes, ids, marks, fresh = codes[order], ids[order], marks[order], fresh[order]
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
            lengths = np.diff(np.r_[starts, len(codes)])
            first = np.repeat(starts, lengths)
            differs = (ids != ids[first]) | (marks != marks[first])
            # 1: new; 0: remembered, and alone so far; 2: remembered, and told before.
            shared = np.maximum.reduceat(differs | (fresh == 2), starts) if len(starts) else np.zeros(0, bool)
            told = np.flatnonzero(np.repeat(shared, lengths) & (fresh < 2))
            known = codes[starts], ids[starts], marks[starts], np.where(shared, 2, 0).astype(np.int8)
            waiting = [known]
            together = told[np.lexsort((marks[told], ids[told]))]
            codes, ids, marks = codes[together], ids[together], marks[together]
            return packed(group_of(ids, marks, groups), codes, ids, marks)

        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.bucket != bucket:
                    if waiting:
                        out += merged()
                    bucket, known, waiting = row.bucket, None, []
                codes, ids, marks = unpacked(row)
                waiting.append((codes, ids, marks, np.ones(len(codes), np.int8)))
                held = len(known[0]) if known else 0
                if sum(len(part[0]) for part in waiting) - held > MERGED_ENTRIES + held:
                    out += merged()
            if out:
                yield pd.DataFrame(out, columns=["part", *HELD])
        if waiting:
            yield pd.DataFrame(merged(), columns=["part", *HELD])

    return run


TOLD = "part long, codes binary, ids binary, marks binary, counts binary"


def by_document(batches):
    """Rows of hashes, sorted by group of documents, to (id, mark, codes)."""
    part, held = None, []

    def documents():
        codes, ids, marks = (np.concatenate(one) for one in zip(*held, strict=True))
        order = np.lexsort((marks, ids))
        codes, ids, marks = codes[order], ids[order], marks[order]
        begins = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])])
        ends = np.r_[begins[1:], len(ids)]
        data = codes.tobytes()
        own = [data[8 * begin : 8 * end] for begin, end in zip(begins.tolist(), ends.tolist(), strict=True)]
        return pd.DataFrame({"id": ids[begins], "mark": marks[begins], "codes": own})

    for batch in batches:
        for row in batch.itertuples(index=False):
            if row.part != part:
                if held:
                    yield documents()
                part, held = row.part, []
            held.append(unpacked(row))
    if held:
        yield documents()


SEVERAL = "id long, mark long, codes binary"


def contexts(text, codes):
    """(places, hashes, records) around those anchors of a text whose hash is in `codes`."""
    data = bytearray(text)
    places, found = anchors(data)
    inside = np.isin(found, codes)
    places, found = places[inside], found[inside]
    padded = np.frombuffer(bytes(REACH) + text + bytes(REACH), np.uint8)
    records = np.zeros((len(places), RECORD), np.uint8)
    records[:, :CONTEXT] = padded[places[:, None] + np.arange(CONTEXT)]
    records[:, CONTEXT] = np.minimum(places, REACH)
    records[:, CONTEXT + 1] = np.minimum(len(text) - places - SEED_BYTES, REACH)
    return places, found, records


def as_words(records):
    return records.view(U).reshape(len(records), RECORD // 8)


def distinct(records, firsts):
    """Distinct records and the smallest of their `firsts`."""
    order = np.lexsort(two_hashes(as_words(records)))
    rows, firsts = as_words(records)[order], firsts[order]
    starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
    return records[order][starts], np.minimum.reduceat(firsts, starts)


def told_contexts(buckets):
    """Documents (id, text, codes) to rows of distinct contexts, one per bucket and batch."""

    def run(batches):
        for batch in gathered(batches):
            hashes, records, firsts = [], [], []
            for one, text, codes in zip(batch["id"], batch["text"], batch["codes"], strict=True):
                _, found, own = contexts(text, np.frombuffer(codes, U))
                hashes.append(found)
                records.append(own)
                firsts.append(np.full(len(found), one))
            rows = []
            if hashes and sum(map(len, hashes)):
                bucket = (np.concatenate(hashes) % U(buckets)).astype(np.int64)
                records, firsts = np.concatenate(records), np.concatenate(firsts)
                order = np.argsort(bucket, kind="stable")
                starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                for part in np.split(order, starts[1:]):
                    own, first = distinct(records[part], firsts[part])
                    rows.append((bucket[part[0]], pressed(own), first.tobytes()))
            yield pd.DataFrame(rows, columns=["bucket", "records", "firsts"])

    return run


def told_places(batches):
    """Documents (id, mark, text, codes) to a row (c1, c2, id, mark, place) per context."""
    for batch in batches:
        found = [
            contexts(text, np.frombuffer(codes, U))
            for text, codes in zip(batch["text"], batch["codes"], strict=True)
        ]
        if found:
            lengths = [len(places) for places, _, _ in found]
            one, two = two_hashes(as_words(np.concatenate([records for _, _, records in found])))
            ids, marks = (np.repeat(batch[name].to_numpy(), lengths) for name in ("id", "mark"))
            places = np.concatenate([places for places, _, _ in found])
            yield pd.DataFrame({"c1": one, "c2": two, "id": ids, "mark": marks, "place": places})


def windows(records):
    """(record, offset) of all whole windows: they start `offset` bytes before the anchor."""
    before, after = records[:, CONTEXT, None], records[:, CONTEXT + 1, None]
    offsets = np.arange(REACH + 1)
    return np.nonzero((offsets <= before) & (REACH - offsets <= after))


def deep_shallow(data, starts):
    """Order of the 50-byte suffixes at `starts`, and the number of each one's run of equals."""
    steps = [*range(0, LENGTH - 7, 8), LENGTH - 8]
    order = np.arange(len(starts))
    group = np.zeros(len(starts), np.int64)
    # Shallow: multikey quicksort. Suffixes with equal words so far are refined by the next.
    for step in steps[:SHALLOW_WORDS]:
        word = words_at(data, starts[order] + step)
        inner = np.lexsort((word, group))
        order, group, word = order[inner], group[inner], word[inner]
        split = np.r_[False, (group[1:] != group[:-1]) | (word[1:] != word[:-1])]
        group = np.cumsum(split)
    # Deep: a node of a blind trie is a group; it passes over words that its members share.
    for step in steps[SHALLOW_WORDS:]:
        word = words_at(data, starts[order] + step)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        branching = np.maximum.reduceat(word, first) != np.minimum.reduceat(word, first)
        lengths = np.diff(np.r_[first, len(group)])
        members = np.flatnonzero(np.repeat(branching, lengths))
        inner = members[np.lexsort((word[members], group[members]))]
        order[members], word[members] = order[inner], word[inner]
        split = np.r_[False, (group[1:] != group[:-1]) | (word[1:] != word[:-1])]
        group = np.cumsum(split)
    return order, group


def judged(records, firsts):
    """For each context the bits of its windows that start in a smaller document too."""
    masks = np.zeros(len(records), np.int64)
    anchor = as_words(np.ascontiguousarray(np.pad(records[:, REACH : REACH + SEED_BYTES], ((0, 0), (0, RECORD - SEED_BYTES)))))[:, :2]
    order = np.lexsort(anchor.T)
    same = np.r_[False, (anchor[order][1:] == anchor[order][:-1]).all(axis=1)]
    alone = ~same & ~np.r_[same[1:], False]
    chosen = order[~alone]
    if not len(chosen):
        return masks
    rows, offsets = windows(records[chosen])
    rows = chosen[rows]
    data = bytearray(records.tobytes())
    starts = rows.astype(np.int64) * RECORD + REACH - offsets
    order, group = deep_shallow(data, starts)
    heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    smallest = np.minimum.reduceat(firsts[rows[order]], heads)
    smaller = np.repeat(smallest, np.diff(np.r_[heads, len(group)])) < firsts[rows[order]]
    hit = order[smaller]
    np.bitwise_or.at(masks, rows[hit], np.int64(1) << offsets[hit])
    return masks


def all_windows(records):
    before, after = records[:, CONTEXT].astype(np.int64), records[:, CONTEXT + 1].astype(np.int64)
    offsets = np.arange(REACH + 1)
    whole = (offsets <= before[:, None]) & (REACH - offsets <= after[:, None])
    return (whole * (np.int64(1) << offsets)).sum(axis=1)


CLASSES = "c1 long, c2 long, first long, valid long, mask long, w1 long, w2 long, offset int"


def class_rows(records, firsts):
    one, two = two_hashes(as_words(records))
    return pd.DataFrame(
        {"c1": one, "c2": two, "first": firsts, "valid": all_windows(records), "mask": judged(records, firsts)}
    )


def window_rows(records, firsts):
    """For the grouping by hash: a row per window, and mask -1."""
    one, two = two_hashes(as_words(records))
    rows, offsets = windows(records)
    whole = np.zeros((len(rows), 56), np.uint8)
    whole[:, :LENGTH] = records[rows[:, None], (REACH - offsets)[:, None] + np.arange(LENGTH)]
    w1, w2 = two_hashes(whole.view(U).reshape(len(rows), 7))
    valid = all_windows(records)
    return pd.DataFrame(
        {"c1": one[rows], "c2": two[rows], "first": firsts[rows], "valid": valid[rows], "mask": -1, "w1": w1, "w2": w2, "offset": offsets}
    )


def sorted_classes(most=MOST_CONTEXTS):
    """Rows of contexts, sorted by bucket, to a row per class; window rows beyond `most`."""

    def run(batches):
        names = [column.split()[0] for column in CLASSES.split(", ")]
        bucket, records, firsts, crowded = None, [], [], False

        def finished(rows_of):
            own, first = distinct(np.concatenate(records), np.concatenate(firsts))
            return rows_of(own, first).reindex(columns=names).astype({"w1": "Int64", "w2": "Int64", "offset": "Int32"})

        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.bucket != bucket:
                    if records:
                        yield finished(window_rows if crowded else class_rows)
                    bucket, records, firsts, crowded = row.bucket, [], [], False
                records.append(released(row.records, len(row.firsts) // 8 * RECORD, np.uint8).reshape(-1, RECORD))
                firsts.append(np.frombuffer(row.firsts, np.int64))
                if sum(map(len, records)) > most:
                    own, first = distinct(np.concatenate(records), np.concatenate(firsts))
                    records, firsts = [own], [first]
                    # Half full after merging: more of them would not fit, so this part goes on.
                    if crowded or len(own) > most // 2:
                        yield finished(window_rows)
                        records, firsts, crowded = [], [], True
        if records:
            yield finished(window_rows if crowded else class_rows)

    return run


def classes_of(rows):
    """(c1, c2, first, valid, mask) of every class, from sorted buckets and crowded ones."""
    done = rows.where("mask >= 0").select("c1", "c2", "first", "valid", "mask")
    crowd = rows.where("mask < 0")
    if not crowd.limit(1).count():
        return done
    least = crowd.groupBy("w1", "w2").agg(F.min("first").alias("least"))
    each = crowd.groupBy("c1", "c2").agg(F.min("first").alias("first"), F.max("valid").alias("valid"))
    bits = (
        crowd.select("c1", "c2", "w1", "w2", "offset")
        .join(least, ["w1", "w2"])
        .join(each, ["c1", "c2"])
        .where(F.col("least") < F.col("first"))
        .select("c1", "c2", F.expr("shiftleft(1L, offset)").alias("bit"))
        .groupBy("c1", "c2")
        .agg(F.bit_or("bit").alias("mask"))
    )
    return done.unionByName(each.join(bits, ["c1", "c2"], "left").fillna(0, ["mask"]))


def removed(text, places, masks):
    """Which bytes of a text go, from its contexts' places and the bits of their windows."""
    change = np.zeros(len(text) + 1, np.int64)
    context, offset = np.nonzero(masks[:, None] >> np.arange(REACH + 1) & 1)
    starts = places[context] - offset
    np.add.at(change, starts, 1)
    np.add.at(change, starts + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def digest(text, gone):
    kept = text if gone is None else np.frombuffer(text, np.uint8)[~gone].tobytes()
    spans = 0 if gone is None or not len(gone) else int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(text), 0 if gone is None else int(gone.sum()), spans, kept


DIGEST = ["n_bytes", "n_removed", "n_spans", "kept"]


def settled(batches):
    """Documents without shared anchors and whole copies, with their outcome; the others keep
    their text for the stages that follow."""
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.copy and len(row.text) >= LENGTH:
                out.append((len(row.text), len(row.text), 1, b"", None, None))
            elif row.copy or row.codes is None or len(row.text) < LENGTH:
                out.append((*digest(row.text, None), None, None))
            else:
                out.append((None, None, None, None, row.text, row.codes))
        frame = pd.DataFrame(out, columns=[*DIGEST, "text", "codes"])
        keys = batch[["id", "mark", "absent"]].reset_index(drop=True)
        frame = frame.astype(dict.fromkeys(DIGEST[:3], "Int64"))
        yield pd.concat([keys, frame], axis=1)


def finished(batches):
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            gone = None
            if row.hits is not None:
                places = np.array([hit["place"] for hit in row.hits], np.int64)
                masks = np.array([hit["bits"] for hit in row.hits], np.int64)
                gone = removed(row.text, places, masks)
            out.append(digest(row.text, gone))
        keys = batch[["id", "absent"]].reset_index(drop=True)
        yield pd.concat([keys, pd.DataFrame(out, columns=DIGEST)], axis=1)


def deduplicated(documents, most=MOST_CONTEXTS):
    """One row per document: doc_id, n_bytes, n_removed, n_spans and kept, the bytes that stay."""
    text = text_of(documents)
    rows = documents.select(
        F.coalesce("doc_id", F.lit(LAST)).alias("id"),
        F.col("doc_id").isNull().alias("absent"),
        F.xxhash64(text).alias("mark"),
        text.cast("binary").alias("text"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, size // 20 // BUCKET_ANCHORS)
    hashes = rows.select("id", "mark", "text").mapInPandas(packed_anchors(buckets), PACKED)
    told = hashes.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(several(buckets), TOLD)
    hits = told.repartition("part").sortWithinPartitions("part").mapInPandas(by_document, SEVERAL)
    exact = rows.select("id", "mark", F.md5("text").alias("whole")).distinct()
    first = exact.groupBy("whole").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    copies = exact.join(first.where("n > 1"), "whole").where("id > first").select("id", "mark").distinct()
    told = hits.join(copies.withColumn("copy", F.lit(True)), ["id", "mark"], "full")
    joined = rows.join(told, ["id", "mark"], "left").select("*").fillna(False, ["copy"])
    kinds = "id long, mark long, absent boolean, n_bytes long, n_removed long, n_spans long, kept binary, text binary, codes binary"
    work = stored(joined.select("id", "mark", "absent", "text", "codes", "copy").mapInPandas(settled, kinds), "suffix-work", "zstd")
    open_rows = work.where("text IS NOT NULL")
    count = open_rows.agg(F.coalesce(F.sum(F.octet_length("codes")), F.lit(0))).first()[0] // 8
    buckets = max(1, count // BUCKET_CONTEXTS)
    records = open_rows.select("id", "text", "codes").mapInPandas(
        told_contexts(buckets), "bucket long, records binary, firsts binary"
    )
    ordered = records.repartition("bucket").sortWithinPartitions("bucket")
    classes = classes_of(stored(ordered.mapInPandas(sorted_classes(most), CLASSES), "suffix-classes"))
    places = open_rows.select("id", "mark", "text", "codes").mapInPandas(
        told_places, "c1 long, c2 long, id long, mark long, place long"
    )
    bits = F.when(F.col("id") > F.col("first"), F.col("valid")).otherwise(F.col("mask"))
    found = (
        places.join(classes.where((F.col("valid") != 0)), ["c1", "c2"])
        .select("id", "mark", "place", bits.alias("bits"))
        .where("bits <> 0")
        .groupBy("id", "mark")
        .agg(F.collect_set(F.struct("place", "bits")).alias("hits"))
    )
    rest = (
        open_rows.select("id", "mark", "absent", "text")
        .join(found, ["id", "mark"], "left")
        .select("id", "absent", "text", "hits")
        .mapInPandas(finished, "id long, absent boolean, n_bytes long, n_removed long, n_spans long, kept binary")
    )
    done = work.where("text IS NULL").select("id", "absent", *DIGEST)
    both = done.unionByName(rest)
    return both.select(F.when(~F.col("absent"), F.col("id")).alias("doc_id"), *DIGEST)


def digests(documents, most=MOST_CONTEXTS):
    """`deduplicated` with the SHA-256 of what stays in place of the bytes."""
    rows = deduplicated(documents, most)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
