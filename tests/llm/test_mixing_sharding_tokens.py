import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import bag
from waybill.llm import decontaminate, mixing, quality, sharding, token_file

TEXTS = ["a b c", "d e", "", None, "f " * 40, "g"]


def many(n=400):
    rng = random.Random(6)
    return [(i, "w " * rng.choice([1, 5, 30, 90]), rng.choice(["a", "b", "z", None])) for i in range(n)]


def shares(sizes):
    """Targets by sharing again until no source has more than it can take."""
    order = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: mixing.WEIGHTS[at % 3] for at, name in enumerate(order)}
    whole, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = whole - sum(2 * sizes[name] for name in full)
        open_weight = sum(weight[name] for name in sizes if name not in full)
        target = {name: 2.0 * sizes[name] if name in full else left * weight[name] / open_weight for name in sizes}
        more = {name for name in sizes if target[name] > 2 * sizes[name] and name not in full}
        if not more:
            return target
        full |= more


@pytest.mark.parametrize("group", [4096, 16])
def test_mixture(spark, documents, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP_ROWS", group)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = [*many(), (None, "x y", "a"), (7, None, None), (8, "", "b"), (9, "q q", "a"), (9, "q q", "a")]
    found = mixing.mixture(documents(*rows)).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = shares(sizes)
    for name in sizes:
        own = [row for row in found if row.source == name]
        assert own[0].target == pytest.approx(targets[name])
        assert abs(sum(row.taken for row in own) - targets[name]) <= 45 + 1e-6
    assert all(0 <= row.taken <= 2 * row.size for row in found)
    again = mixing.mixture(documents(*reversed(rows)))
    assert bag(again.select("doc_id", "copies")) == bag(spark.createDataFrame([(r.doc_id, r.copies) for r in found], "doc_id long, copies int"))


def test_expectations_are_kept():
    """Over many draws each of a few documents is taken as often as its fraction says."""
    sizes, fraction, times = [3, 5, 8, 13], 0.3, 4000
    taken = np.zeros(4)
    for draw in range(times):
        pivot = mixing.Pivot(draw)
        settled = []
        for at, size in enumerate(sizes):
            settled += pivot.take("g", mixing.Row(at, draw, size, (at,)), fraction)
        for one, left, outcome in settled + pivot.left():
            taken[one.row[0]] += left if outcome is None else outcome
    assert np.abs(taken / times - fraction).max() < 0.04


def test_mixed_rows(spark, documents, clashing):
    frame = clashing(documents(*many(60), (9, "q q", "a"), (9, "q q", "a")))
    wanted = bag(mixing.mixture(frame).where("copies > 0").selectExpr("doc_id", "explode(sequence(1, copies)) AS one").select("doc_id"))
    out = mixing.mixed(frame)
    assert out.columns == frame.columns
    assert bag(out.select("doc_id")) == wanted
    assert mixing.mixed(documents()).count() == 0


def test_shards_are_balanced_and_moves_are_few(spark, documents):
    rows = [(n, TEXTS[n % 6]) for n in range(2000)] + [(None, "n"), (None, None), (5, "again"), (5, "again")]
    frame = documents(*rows)
    found = sharding.sharded(frame, 24)
    counts = {}
    slots = {}
    for row in found.collect():
        counts[row.shard] = counts.get(row.shard, 0) + 1
        slots.setdefault(row.shard, set()).add(row.slot)
        text = ((dict(rows).get(row.doc_id) if row.doc_id not in (5, None) else None) or "").encode()
        if row.doc_id not in (5, None):
            assert (row.size, row.text_crc32) == (len(text) + 8, zlib.crc32(text))
    assert sum(counts.values()) == len(rows) and len(counts) == 24
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(slots[shard] == set(range(counts[shard])) for shard in counts)
    more = sharding.sharded(frame.where("doc_id > 5"), 25).select("doc_id", "shard")
    before = sharding.sharded(frame.where("doc_id > 5"), 24).select("doc_id", "shard")
    moved = before.subtract(more).count()
    # One in 25 has to move to the new shard; a plain modulus would move nearly all.
    assert 2000 / 25 - 5 <= moved <= 2000 / 5


def test_shards_of_few_rows(spark, documents, clashing):
    assert sharding.sharded(documents()).count() == 0
    frame = clashing(documents((1, "a"), (2, "b")))
    placed = sharding.placed(frame, 24)
    assert placed.columns == [*frame.columns, "shard", "slot"]
    assert [row.slot for row in placed.collect()] == [0, 0]


def test_codes_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype("<u4")
        control, data = token_file.packed(values)
        assert len(control) == -(-n // 4)
        assert (token_file.unpacked(control, data, n) == values).all()


def test_token_files_round_trip(spark, documents, monkeypatch):
    from tokenizers import Tokenizer

    public = pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_file, "BLOCK_TOKENS", 64)
    rng = random.Random(2)
    texts = ["It's 42, naïve <|endoftext|>!", "", None, "x\x1cy\u00a0z\u2003w", "Long " * 3000, "\x00"]
    rows = [(rng.randrange(-50, 2**60), rng.choice(texts)) for _ in range(40)] + [(None, "n"), (None, None), (3, "a"), (3, "a")]
    tokenizer = Tokenizer.from_file(public.path(token_file.TOKENIZER))
    found = token_file.round_trip(documents(*rows)).orderBy("start").collect()
    order = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))
    start = 0
    for (doc_id, text), row in zip(order, found, strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [token_file.END]
        code = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(row) == (doc_id, start, len(ids), code)
        start += len(ids)
    assert token_file.round_trip(documents()).count() == 0


def test_tokens_of_pieces_equal_those_of_texts(monkeypatch):
    import pyarrow as pa

    pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_file, "PIECES_AT_ONCE", 7)
    monkeypatch.setattr(token_file, "CACHED_PIECES", 20)
    rng = random.Random(4)
    letters = [*"aBzßÉÿÅñ×÷Ωж中", "e\u0301", "\ufb01", "\u0130", "\u0958", "\u212b", "\u00bd"]
    others = [*".,;:!?'\"=-_/7\x00\x1c\x85\u00a0\u3000\u0338\U0001f600", "'s", "'LL", "<|endoftext|>", "</w>", "\t", "\n", "  "]
    words = ["The", "the", "THE.", "don't", "x=1", "=", "\u0130.", "\u0958!", "<|ENDOFTEXT|>", "<|startoftext|>."]
    words += ["".join(rng.choice(letters if rng.random() < 0.8 else others) for _ in range(rng.randrange(1, 12))) for _ in range(2000)]
    texts = [rng.choice([" ", "\n ", "\t"]).join(rng.choices(words, k=rng.randrange(20))) for _ in range(500)]
    texts += [*words, "", " ", " a ", "a" * 70_000, "Ab. " * 40_000]
    encode = token_file.Encoder(token_file.TOKENIZER)
    plain = encode.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    expected = [np.array([*code.ids, token_file.END], "<u4").tobytes() for code in plain]
    monkeypatch.setattr(token_file, "BYTES_AT_ONCE", 3000)
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + 90])], ["text"]) for at in range(0, len(texts), 90)]
    portions = [rows["text"] for rows in token_file.portions(batches)]
    sizes = [(len(rows), sum(len(text.encode()) for text in rows.to_pylist())) for rows in portions]
    assert all(n == 1 or size <= 3000 for n, size in sizes) and len(sizes) > 10
    assert [one for rows in portions for one in encode(rows)] == expected


def test_tokens_by_another_tokenizer(tmp_path):
    import json

    import pyarrow as pa
    from tokenizers import Tokenizer

    public = pytest.importorskip("public_tokenizers")
    with open(public.path(token_file.TOKENIZER)) as file:
        steps = json.load(file)
    steps["normalizer"]["normalizers"].pop()
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(steps))
    texts = ["The the THE. Été été!", "AbC"]
    plain = Tokenizer.from_file(str(path)).encode_batch_fast(texts, add_special_tokens=False)
    expected = [np.array([*code.ids, token_file.END], "<u4").tobytes() for code in plain]
    assert token_file.Encoder(str(path))(pa.array(texts)) == expected


def test_each_piece_is_tokenized_once_for_many_batches(monkeypatch):
    import pyarrow as pa

    pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(token_file, "CACHED_PIECES", 0)
    encode, taken = token_file.Encoder(token_file.TOKENIZER), []
    pieces = encode.pieces
    monkeypatch.setattr(encode, "pieces", lambda some: taken.extend(some.to_pylist()) or pieces(some))
    batches = [pa.RecordBatch.from_arrays([pa.array(["Rare the, word", f"RARE. w{n} words"])], ["text"]) for n in range(50)]
    found = [one for rows in token_file.portions(batches) for one in encode(rows["text"])]
    assert len(found) == 100
    assert sorted(taken) == sorted(["rare", "the", ",", "word", ".", "words", "", *[f"w{n}" for n in range(50)]])


def test_token_files_of_letters_that_become_a_letter_and_a_mark(spark, documents):
    from tokenizers import Tokenizer

    public = pytest.importorskip("public_tokenizers")
    tokenizer = Tokenizer.from_file(public.path(token_file.TOKENIZER))
    texts = ["A \u0130. b", "\u0958! \u0958"]
    found = token_file.round_trip(documents(*enumerate(texts))).orderBy("doc_id").collect()
    ids = [[*tokenizer.encode(text, add_special_tokens=False).ids, token_file.END] for text in texts]
    assert [row.ids_crc32 for row in found] == [zlib.crc32(np.array(one, "<u4").tobytes()) for one in ids]


def test_rows_without_an_id_spread_over_tasks(spark, documents, folder):
    frame = documents(*[(None, f"text {n}") for n in range(400)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_file.write_tokens(frame, folder("tokens"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = spark.read.parquet(folder("tokens/blocks")).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n"))
    sizes = [row.n for row in parts.collect()]
    assert sum(sizes) == 400 and max(sizes) <= 200
    found = token_file.read_tokens(spark, folder("tokens")).orderBy("start").collect()
    start = 0
    for row in found:
        assert row.doc_id is None and row.start == start
        start += row.n_tokens
    assert len(found) == 400


def test_the_driver_samples_no_whole_texts(spark, documents):
    rows = [(n % 3 or None, f"{'ж' * (60 + n % 7)}{n * 7 % 50}{'x' * (n % 4)}") for n in range(400)]
    ordered = token_file.in_order(documents(*rows))
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"rangepartitioning\(doc_id#\d+L ASC NULLS FIRST, substring\(text#\d+, 1, 64\) ASC NULLS FIRST,", plan)
    order = sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert [tuple(row) for row in ordered.collect()] == order
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def test_leaks_tolerate_substitutions(spark, documents, clashing):
    words = ITEM.split()
    other = " ".join(["filler"] * 30)
    swapped = " ".join("xx" if at in (6, 13) else word for at, word in enumerate(words))
    broken = " ".join("xx" if at % 3 == 0 else word for at, word in enumerate(words))
    rows = [
        (1, f"{other} {ITEM.upper()}! {other}"), (2, f"{other}, {swapped}"), (3, broken), (4, other),
        (5, " ".join(words[:8])), (6, None), (7, ""), (None, ITEM), (1, "clean"), (8, f"{ITEM} {ITEM}"),
    ]
    bench = spark.createDataFrame(
        [(10, ITEM), (11, None), (12, "too short"), (13, "")], "item_id long, text string"
    )
    frame = documents(*rows)
    found = decontaminate.leaks(frame, bench)
    assert bag(found.select("doc_id", "item_id", "places")) == {
        (1, 10, 1): 1, (2, 10, 1): 1, (None, 10, 1): 1, (8, 10, 2): 1
    }
    wide = clashing(frame)
    clean = decontaminate.clean(wide, bench)
    assert clean.columns == wide.columns
    assert sorted(row.doc_id for row in clean.collect()) == [1, 3, 4, 5, 6, 7]
    assert decontaminate.leaks(documents(), bench).count() == 0
    assert decontaminate.leaks(frame, bench.limit(0)).count() == 0


def test_leaks_equal_a_search_without_masks(spark, documents):
    rng = random.Random(5)
    items = {n: [f"i{n}x{at}" for at in range(n)] for n in range(1, 15)}
    items |= {100 + n: [rng.choice("abc") for _ in range(n)] for n in range(1, 15)}
    texts = [[rng.choice("abc") for _ in range(rng.randrange(40))] for _ in range(40)]
    for n in range(1, 15):
        for changes in range(4):
            some = list(itertools.combinations(range(n), changes))
            for places in rng.sample(some, min(len(some), 66)):
                words = ["xx" if at in places else word for at, word in enumerate(items[n])]
                texts.append(["pre"] * rng.randrange(3) + words + ["post"] * rng.randrange(2))

    def places_of(text, item):
        window = min(13, len(item))
        diagonals = range(-len(item) + 1, len(text))
        equal = [[0 <= at + d < len(text) and text[at + d] == item[at] for at in range(len(item))] for d in diagonals]
        inside = [[0 <= at + d < len(text) for at in range(len(item))] for d in diagonals]
        return sum(
            any(all(there[at : at + window]) and sum(flags[at : at + window]) >= math.ceil(0.8 * window) for at in range(len(item) - window + 1))
            for flags, there in zip(equal, inside, strict=True)
        )

    expected = {(d, i): places_of(text, item) for d, text in enumerate(texts) for i, item in items.items()}
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in items.items()], "item_id long, text string")
    frame = documents(*[(d, " ".join(text)) for d, text in enumerate(texts)])
    found = decontaminate.leaks(frame, bench).select("doc_id", "item_id", "places")
    assert bag(found) == {(*key, n): 1 for key, n in expected.items() if n}


def test_without_a_broadcast(spark, documents, monkeypatch):
    bench = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    frame = documents((1, f"x {ITEM}"), (2, "y"))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert [row.doc_id for row in decontaminate.leaks(frame, bench).collect()] == [1]


def test_quality_learns_grades(spark, documents, clashing):
    rng = random.Random(3)
    good, poor, toxic = (
        lambda: " ".join(rng.choice(["river", "stone", "cloud", "field", "house"]) for _ in range(30)),
        lambda: "### $$$ " * 20,
        lambda: "river stone vile cloud " * 5,
    )
    rows, marks = [], []
    for n in range(240):
        kind = n % 3
        rows.append((n, (toxic, poor, good)[kind]()))
        marks.append((n, int(kind == 2), int(kind == 0)))
    labels = spark.createDataFrame([*marks, (1, None, None), (999, 1, 0)], "doc_id long, quality int, toxic int")
    frame = documents(*rows)
    model = quality.train(frame, labels.where("doc_id < 180"))
    found = quality.rated(frame.where("doc_id >= 180"), model).collect()
    assert all(row.kept == (row.doc_id % 3 == 2) for row in found)
    grades = [np.mean([row.expected_grade for row in found if row.doc_id % 3 == kind]) for kind in range(3)]
    assert grades == sorted(grades)
    wide = clashing(frame)
    assert quality.keep_good(wide, model).columns == wide.columns
    empty = quality.train(frame, labels.limit(0))
    assert quality.rated(documents((1, None), (None, ""), (2, "x" * 100_000)), empty).where("kept").count() == 3
