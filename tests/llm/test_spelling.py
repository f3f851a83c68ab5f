import random
import re
import zlib
from collections import Counter

from tests.helpers import bag
from waybill.llm import spelling

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LOWERED = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:at] + long[at + 1 :] == short for at in range(len(long)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUNS.findall((text or "").translate(LOWERED)):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run if h % 31 else run[:at] + run[at + 1 :]] += 1
    words = {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}
    found = {}
    for word, n in words.items():
        others = [other for other in words if near(word, other)]
        best = min(others, key=lambda other: (-words[other], other), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        found[word] = (form, n, len(others))
    out = Counter()
    for word, (form, n, n_near) in found.items():
        root = word
        while found[root][0] is not None:
            root = found[root][0]
        out[(word, form, root, n, n_near, words.get(form))] += 1
    return out


def corpus(seed):
    """Words in steep frequencies, with edits at every place, repeated letters and accents."""
    rng = random.Random(seed)
    stems = ["aaaaaaab", "straßenbahn", "Überraschung", "tiontion", "commission", "reréréréré", "a" * 300]
    rows = [(1, None), (2, ""), (None, "commission commission"), (None, "commission"), (3, "ab cd ef1gh"), (3, "ab cd ef1gh")]
    for doc_id in range(10, 90):
        words = []
        for stem in stems:
            words += [stem] * rng.choice([0, 1, 20])
            at = rng.randrange(len(stem))
            letter = rng.choice("aetéß")
            words += rng.choices([stem[:at] + stem[at + 1 :], stem[:at] + letter + stem[at:], stem[:at] + letter + stem[at + 1 :], stem[at:] + stem[:at]], k=2)
        rng.shuffle(words)
        rows.append((doc_id, rng.choice([" ", ", ", "1", "\n"]).join(words)))
    rows.append((doc_id, rows[-1][1]))
    rows.append((100, " ".join(["commission"] * 20_000)))
    return rows


def test_variants_equal_brute_force(spark, documents, clashing):
    for seed in (1, 2):
        rows = corpus(seed)
        found = spelling.variants(clashing(documents(*rows)))
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        expected = brute(rows)
        assert sum(n_near for *_, n_near, _ in expected) > 200
        assert bag(found) == expected


def test_forms_lead_over_several_steps(spark, documents):
    words = {"abcdefgh": 2000, "abcdefgi": 200, "abcdefji": 20, "abcdekji": 2}
    # Numbers between the words; ids whose checksums leave these words whole.
    texts = [" ".join([word] * n) for word, n in words.items()]
    whole = [i for i in range(400) if all(zlib.crc32(f"{i}:{word}".encode()) % 31 for word in words)]
    rows = bag(spelling.variants(documents(*zip(whole, texts, strict=False))))
    assert {(word, root) for word, _, root, *_ in rows} == {(word, "abcdefgh") for word in words}
    assert rows == brute(list(zip(whole, texts, strict=False)))


def test_pairs_are_found_once(spark, documents):
    """Words that meet in several buckets: repeated letters make several edits equal."""
    words = ["a" * n for n in range(7, 30)] + ["ab" * n for n in range(4, 12)] + ["aaab" * 3, "aaaab" * 3]
    rows = [(None, " ".join(words)), (None, " ".join(words))]
    assert bag(spelling.variants(documents(*rows))) == brute(rows)


def test_no_documents(spark, documents):
    assert spelling.variants(documents()).count() == 0
    assert spelling.variants(documents((1, None), (2, "!"))).count() == 0
