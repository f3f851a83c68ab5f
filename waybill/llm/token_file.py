"""Token ids of a corpus in files of variable-length codes, and back.

Texts are tokenized, an end id closes each document, and documents follow each other in
ascending order of their ids (null ids first; equal ids by text). Ids are replaced by their
rank by frequency in the corpus, so most of them take one byte.

Format: a Parquet table of blocks, which Spark writes, commits and reads on any file system,
and a table `ranks` (rank, id, n). A block has `part` and `block`, which order the blocks,
`doc_ids` and `lengths` of its documents (the first `nulls` ids are null and kept as 0),
`control` and `data`. Ranks are coded as
little-endian numbers of 1 to 4 bytes in `data`; `control` has the lengths apart from them,
two bits a rank, four ranks a byte, lowest bits first. Reading looks a control byte up in a
table of 256 rows. A block holds whole documents: about `BLOCK_TOKENS` ids, or one document.

Null text is empty text, which is its end id alone. Repeated rows are written each. An empty
table makes files without blocks, and no rows. A text of any length is one document of one block.
Rows of one id, or without an id, that begin with the same `KEY_CHARS` characters are written by one task.
Columns other than doc_id and text are not written, whatever they are called. The tokenizer is a file name of the public
tokenizers, or a path that every executor can read.
"""

import json
import os
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waybill.llm.frames import release, text_of
from waybill.session import work_dir

TOKENIZER = "word_bpe_49k.json"
END = 1
BLOCK_TOKENS = 1 << 16
#: Characters of a text that decide, after its id, which task writes it.
KEY_CHARS = 64
#: Pieces of words whose ids a worker remembers: the first it meets, so mostly the frequent ones.
CACHED_PIECES = 500_000
#: Bytes of texts whose words are looked up at a time; a longer text is taken alone.
BYTES_AT_ONCE = 8_000_000
#: Letters that stay one letter in the tokenizer's normal form. It separates them from the
#: marks that end a word, so both can be taken alone, and recur more often than together.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
MARKS = ".,;:!?"
#: If a tokenizer does this before its model, words of such letters need lower case alone.
STEPS = [
    ["Sequence", ["NFC", "Replace", "Lowercase"]],
    ["Sequence", ["Split", "ByteLevel"]],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
]
#: Pieces are tokenized so many to a text, with a piece between them that is one id of its own.
PIECES_AT_ONCE = 500
BETWEEN = "="
LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64)

KEYS = "part int, block int, nulls int, doc_ids array<long>, lengths array<int>, tokens long"
TOKENS = f"{KEYS}, ids binary"
BLOCKS = f"{KEYS}, control binary, data binary"
READ = "part int, block int, doc_id long, begin long, n_tokens long, ids_crc32 long"
ARROW_TOKENS = pa.schema(
    {
        "part": pa.int32(),
        "block": pa.int32(),
        "nulls": pa.int32(),
        "doc_ids": pa.list_(pa.int64()),
        "lengths": pa.list_(pa.int32()),
        "tokens": pa.int64(),
        "ids": pa.binary(),
    }
)

_known = {}


def steps_of(tokenizer):
    """The kinds of a tokenizer's steps before its model, and what it splits at."""
    found, splits = [], None
    for step, parts in ((tokenizer.normalizer, "normalizers"), (tokenizer.pre_tokenizer, "pretokenizers")):
        state = json.loads(step.__getstate__()) if step else {}
        found.append([state.get("type"), [part["type"] for part in state.get(parts, [])]])
        splits = next((part["pattern"].get("Regex") for part in state.get(parts, []) if part["type"] == "Split"), None)
    return [*found, splits]


def runs(ids, ends):
    """Ids of pieces after each other as one binary value a piece; `ends` has where pieces end."""
    offsets = 4 * np.concatenate([[0], ends]).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(ids, "<u4"))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), data])


class Encoder:
    """Ids of texts, each piece of a word tokenized once per worker as far as the cache goes."""

    def __init__(self, name):
        # Its threads would each keep memory of their own, next to Spark's tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
        self.cached, self.cached_ids = pa.array([], pa.string()), pa.array([], pa.binary())
        between = self.ids_of(self.tokenizer, [BETWEEN])[0]
        self.between = between[0] if len(between) == 1 else None
        model, self.by_letters = self.tokenizer.model, None
        suffix = getattr(model, "end_of_word_suffix", None)
        if steps_of(self.tokenizer) == STEPS and suffix:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closing[[at for token, at in vocabulary.items() if token.endswith(suffix)]] = True
            # The same model, without steps that words of lower-case letters do not need.
            ascii_words, words = Tokenizer(model), Tokenizer(model)
            ascii_words.pre_tokenizer = space = pre_tokenizers.WhitespaceSplit()
            as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            words.pre_tokenizer = pre_tokenizers.Sequence([space, as_bytes])
            self.by_letters = ascii_words, words

    @staticmethod
    def ids_of(tokenizer, texts):
        return [code.ids for code in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(self, pieces, tokenizer, between, cut):
        """The ids of pieces that are tokenized many to a text, with `between` between them.
        `cut` makes runs of the ids of a text."""
        for begin in range(0, len(pieces), PIECES_AT_ONCE):
            some = pieces[begin : begin + PIECES_AT_ONCE]
            (text,) = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), between)
            found = cut(np.array(self.ids_of(tokenizer, [text.as_py()])[0], np.uint32))
            yield found if len(found) == len(some) else self.alone(some)

    def alone(self, pieces):
        ids = self.ids_of(self.tokenizer, pieces.to_pylist())
        flat = np.array([one for piece in ids for one in piece], np.uint32)
        return runs(flat, np.cumsum([len(piece) for piece in ids]))

    def cut_at_ends(self, ids):
        return runs(ids, np.flatnonzero(self.closing[ids]) + 1)

    def cut_between(self, ids):
        """If a piece has the id without the character, it makes more runs than pieces."""
        cuts = np.append(np.flatnonzero(ids == self.between), len(ids))
        return runs(ids[ids != self.between], cuts - np.arange(len(cuts)))

    def pieces(self, pieces):
        """The ids of distinct pieces, as binary values."""
        has = pc.match_substring(pieces, BETWEEN)
        letters = np.zeros(len(pieces), bool)
        if self.by_letters:
            letters = pc.match_substring_regex(pieces, f"^[{LETTERS}]+$").to_numpy(False)
        if self.between is None:
            has = pa.repeat(True, len(pieces))
        has, plain = has.to_numpy(False), pc.string_is_ascii(pieces).to_numpy(False)
        kinds = [np.flatnonzero(kind) for kind in (letters & plain, letters & ~plain, ~letters & ~has, has)]
        found = [pa.array([], pa.binary())]
        if self.by_letters:
            for tokenizer, kind in zip(self.by_letters, kinds, strict=False):
                found += self.joined(pieces.take(pa.array(kind)), tokenizer, " ", self.cut_at_ends)
        some = pieces.take(pa.array(kinds[2]))
        found += self.joined(some, self.tokenizer, f" {BETWEEN} ", self.cut_between)
        found.append(self.alone(pieces.take(pa.array(kinds[3]))))
        return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(kinds))))

    def known(self, pieces):
        """The same, looked up first."""
        places = pc.index_in(pieces, self.cached)
        new = pieces.filter(pc.is_null(places))
        ids = self.pieces(new)
        places = places.fill_null(-1).to_numpy(False).copy()
        places[places < 0] = len(self.cached) + np.arange(len(new))
        both = pa.concat_arrays([self.cached_ids, ids])
        room = CACHED_PIECES - len(self.cached)
        if room > 0:
            self.cached = pa.concat_arrays([self.cached, new[:room]])
            self.cached_ids = both[: len(self.cached)]
        return both.take(pa.array(places))

    def words(self, words):
        """The ids of distinct words, as binary values."""
        rest = pc.utf8_rtrim(words, MARKS)
        cut = pc.and_(pc.not_equal(rest, words), pc.match_substring_regex(rest, f"[{LETTERS}]$"))
        tails = pc.extract_regex(words.filter(cut), f"(?P<marks>[{MARKS}]+)$").field(0)
        marks = pc.replace_with_mask(pa.repeat("", len(words)), cut, tails)
        rest = pc.if_else(cut, rest, words)
        if self.by_letters:
            letters = pc.match_substring_regex(rest, f"^[{LETTERS}]+$")
            rest = pc.if_else(letters, pc.utf8_lower(rest), rest)
        pieces = pa.concat_arrays([rest, marks]).dictionary_encode()
        ids = self.known(pieces.dictionary).take(pieces.indices)
        return pc.binary_join_element_wise(ids[: len(words)], ids[len(words) :], b"")

    def __call__(self, texts):
        """The ids of each text, and the end id, as bytes."""
        # At the white space that WORD leaves out; words may be empty.
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = self.words(words.dictionary).take(words.indices)
        end = np.array([END], "<u4").tobytes()
        coded = pc.binary_join(pa.ListArray.from_arrays(split.offsets, ids), b"")
        return pc.binary_join_element_wise(coded, end, b"").to_pylist()


def encoder(name):
    """One per worker."""
    if name not in _known:
        _known[name] = Encoder(name)
    return _known[name]


def portions(batches):
    """Rows after each other: about `BYTES_AT_ONCE` of texts at a time, or one text."""
    held, size = [], 0
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(False).astype(np.int64))
        begin = 0
        while begin < len(sizes):
            before = sizes[begin - 1] if begin else 0
            # A text that is longer than the rest of the room waits, unless nothing is held.
            end = max(int(np.searchsorted(sizes, before + BYTES_AT_ONCE - size, "right")), begin + (not held))
            held.append(batch.slice(begin, end - begin))
            size += sizes[end - 1] - before if end else 0
            if end < len(sizes):
                yield joined_rows(held)
                held, size = [], 0
            begin = end
    if held:
        yield joined_rows(held)


def joined_rows(batches):
    names = batches[0].schema.names
    return {name: pa.concat_arrays([batch[name] for batch in batches]) for name in names}


def tokenized(name):
    """Sorted documents to blocks of ids."""

    def run(batches):
        encode = encoder(name)
        part = TaskContext.get().partitionId()
        block, nulls, doc_ids, ids, size = 0, 0, [], [], 0

        def row():
            return {
                "part": part,
                "block": block,
                "nulls": nulls,
                "doc_ids": doc_ids,
                "lengths": [len(one) // 4 for one in ids],
                "tokens": size,
                "ids": b"".join(ids),
            }

        for rows in portions(batches):
            coded = encode(rows["text"])
            for doc_id, absent, one in zip(rows["doc_id"].to_pylist(), rows["absent"].to_pylist(), coded, strict=True):
                doc_ids.append(doc_id)
                nulls += absent
                ids.append(one)
                size += len(one) // 4
                if size >= BLOCK_TOKENS:
                    yield pa.RecordBatch.from_pylist([row()], ARROW_TOKENS)
                    block, nulls, doc_ids, ids, size = block + 1, 0, [], [], 0
            del rows, coded
            release()
        if doc_ids:
            yield pa.RecordBatch.from_pylist([row()], ARROW_TOKENS)

    return run


def counted(batches):
    """How often each id occurs in the blocks of a task."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for ids in batch["ids"]:
            counts = np.bincount(np.frombuffer(ids, "<u4"))
            if len(counts) > len(total):
                total = np.pad(total, (0, len(counts) - len(total)))
            total[: len(counts)] += counts
    found = np.flatnonzero(total)
    yield pd.DataFrame({"id": found, "n": total[found]})


def packed(values):
    """(control, data) of numbers below 2 ** 32."""
    values = np.asarray(values, "<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    quads = np.pad(extra, (0, -len(extra) % 4)).reshape(-1, 4).astype(np.uint8)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpacked(control, data, n):
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


def ranked(ranks):
    """Blocks of ids to blocks of codes; `ranks` has the rank of each id."""

    def run(batches):
        for batch in batches:
            codes = [packed(ranks[np.frombuffer(ids, "<u4")]) for ids in batch.pop("ids")]
            yield batch.assign(control=[c for c, _ in codes], data=[d for _, d in codes])

    return run


def decoded(ids):
    """Blocks of codes to a row per document; `ids` has the id of each rank."""

    def run(batches):
        for batch in batches:
            rows = []
            for block in batch.itertuples(index=False):
                values = ids[unpacked(block.control, block.data, block.tokens)].astype("<u4")
                begin = 0
                for at, (doc_id, length) in enumerate(zip(block.doc_ids, block.lengths, strict=True)):
                    own = None if at < block.nulls else doc_id
                    code = crc32(values[begin : begin + length].tobytes())
                    rows.append((block.part, block.block, own, begin, length, code))
                    begin += length
            names = [column.split()[0] for column in READ.split(", ")]
            # As objects first: numbers next to nulls would become floats.
            yield pd.DataFrame(rows, columns=names, dtype=object).astype(dict.fromkeys(names, "Int64"))

    return run


def in_order(documents):
    """Ids and texts, sorted from task to task."""
    rows = documents.select("doc_id", text_of(documents).alias("text"))
    # By the text too, so that many rows of one id, or without an id, spread over tasks; by its
    # first characters, as the driver samples the keys.
    dealt = rows.repartitionByRange("doc_id", F.substring("text", 1, KEY_CHARS))
    return dealt.sortWithinPartitions("doc_id", "text")


def write_tokens(documents, path, tokenizer=TOKENIZER):
    """Write the files of `documents` to the folder `path`."""
    spark = documents.sparkSession
    ordered = in_order(documents).select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("absent"), "text"
    )
    between = work_dir(spark, "tokens")
    ordered.mapInArrow(tokenized(tokenizer), TOKENS).write.option("compression", "zstd").parquet(between)
    tokens = spark.read.schema(TOKENS).parquet(between)
    counts = tokens.select("ids").mapInPandas(counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.desc("n"), "id")
    # One row per entry of the tokenizer's vocabulary at most.
    counts.select((F.row_number().over(order) - 1).alias("rank"), "id", "n").write.parquet(f"{path}/ranks")
    by_rank = ids_by_rank(spark, path)
    ranks = np.zeros(max(by_rank, default=-1) + 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank))
    tokens.mapInPandas(ranked(ranks), BLOCKS).write.parquet(f"{path}/blocks")


def ids_by_rank(spark, path):
    rows = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toPandas()
    return rows["id"].to_numpy(np.uint32)


def read_tokens(spark, path):
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    found = blocks.mapInPandas(decoded(ids_by_rank(spark, path)), READ)
    sizes = blocks.select("part", "block", "tokens")
    before = Window.unboundedPreceding
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("held"))
    # One row per written partition.
    earlier = F.sum("held").over(Window.orderBy("part").rowsBetween(before, -1))
    bases = parts.select("part", F.coalesce(earlier, F.lit(0)).alias("base"))
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(before, -1))
    starts = sizes.select("part", "block", F.coalesce(inside, F.lit(0)).alias("inside")).join(bases, "part")
    return found.join(starts, ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("inside") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(documents, tokenizer=TOKENIZER):
    """Write `documents` to a new folder and read it back."""
    path = work_dir(documents.sparkSession, "token-files")
    write_tokens(documents, path, tokenizer)
    return read_tokens(documents.sparkSession, path)
