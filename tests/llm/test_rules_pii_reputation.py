import hashlib
import random
import re
from datetime import date, timedelta

import pytest
import regex

from checks.compare import connect, same
from tests.helpers import bag, rows
from waybill.llm import pii, queries, rules

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_queries_equal_their_sql(spark, name):
    connection, sql = connect(SF_DIR), queries.ORACLES[name]
    types = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    expected = connection.execute(sql).fetchall()
    assert same(types, expected, queries.QUERIES[name](spark, SF_DIR)) is None


def test_rules_by_hand(spark, documents):
    frame = documents((1, None), (None, "a b c a b c\nx\n \nx\nx #"), (3, "é\u00a0z\tq"), (3, "é\u00a0z\tq"))
    found = rules.judged(frame).select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")
    assert bag(found) == {
        (1, 0, 0, 0, 0, 0, 0, True): 1,
        (None, 10, 10, 1, 4, 1, 6, True): 1,
        (3, 2, 4, 0, 1, 0, 0, True): 2,
    }


def test_policies_and_ablations(spark):
    ledger = spark.createDataFrame([(0,), (1,), (2,), (3,), (16,), (16,)], "failed_bits long")
    policy = rules.Policy("p", 2, ("few_words", "repeated_words"))
    found = {row.rule: row for row in rules.ablations(ledger, policy).collect()}
    assert (found["few_words"].failing, found["few_words"].failing_only_this, found["few_words"].kept_without) == (2, 1, 4)
    assert ledger.where(rules.fails(policy)).count() == 3


def luhn(number):
    digits = [int(d) for d in re.sub(r"\D", "", number)][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def replaced(spark, documents, values, key="k"):
    frame = documents(*[(n, f"<{value}>") for n, value in enumerate(values)])
    return [row.text[1:-1] for row in pii.pseudonyms(frame, key).orderBy("doc_id").collect()]


def pattern(value):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", value)))


def test_formats_are_kept_and_values_linked(spark, documents):
    rng = random.Random(1)
    cards = []
    while len(cards) < 40:
        number = "".join(rng.choice("0123456789") for _ in range(16))
        cards += [number] * luhn(number)
    values = cards + ["4111-1111-1111-1111", "ab.7@mail3.Example.org", "+1 (523) 555-1055", "219-09-9999"]
    out = replaced(spark, documents, values)
    assert all(a != b and pattern(a) == pattern(b) for a, b in zip(values, out, strict=True))
    assert all(luhn(card) for card in out[:41])
    assert len(set(out)) == len(out)
    assert out == replaced(spark, documents, values)
    assert out != replaced(spark, documents, values, "other")


def test_every_grouping_of_a_number_is_linked(spark, documents):
    groupings = [
        ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "41 11 11 11 11 11 11 11"],
        ["378282246310005", "3782 822463 10005", "3782-822463-10005"],
        ["+4930123456", "+49 30 123456", "+49 30 12 34 56", "+49-30-123-456", "+49 (30) 12 3456"],
        ["(523) 555-1055", "523-555-1055", "523.555.1055", "(523)555.1055"],
    ]
    for values in groupings:
        out = replaced(spark, documents, values)
        assert [pattern(value) for value in out] == [pattern(value) for value in values]
        assert len({re.sub(r"\D", "", value) for value in out}) == 1, out
        assert re.sub(r"\D", "", out[0]) != re.sub(r"\D", "", values[0])
    addresses = ["ab.7@mail3.example.org", "AB.7@mail3.Example.org", "aB.7@Mail3.EXAMPLE.oRg"]
    out = replaced(spark, documents, addresses)
    assert len({value.lower() for value in out}) == 1
    assert [pattern(value) for value in out] == [pattern(value) for value in addresses]


def feistel(text, key):
    """The permutation of a text of digits and small letters, by hand."""
    half = len(text) // 2
    left, right = text[:half], text[half:]
    for turn in range(8):
        digest = hashlib.sha256("|".join([key, str(turn), right, key]).encode()).hexdigest()
        moved = ""
        for at, char in enumerate(left):
            by = int(digest[at % 32 * 2 : at % 32 * 2 + 2], 16)
            first, size = ("0", 10) if char.isdigit() else ("a", 26)
            moved += chr(ord(first) + (ord(char) - ord(first) + by) % size) if char.isalnum() else char
        left, right = right, moved
    return left + right


def feistel_pair(left, right, moduli, key):
    def number(turn, text, modulus):
        digest = hashlib.sha256("|".join([key, str(turn), str(text), key]).encode()).hexdigest()
        return int(digest[:12], 16) % modulus

    for turn in range(4):
        left = (left + number(turn, right, moduli[0])) % moduli[0]
        right = (right + number(turn + 8, left, moduli[1])) % moduli[1]
    return left, right


def by_hand(kind, value, key):
    digits = re.sub(r"\D", "", value)
    if kind == "email":
        moved = feistel(value.lower(), f"{key}/email")
        return "".join(new.upper() if old.isupper() else new for old, new in zip(value, moved, strict=True))
    if kind == "ip":
        a, b, c, d = map(int, value.split("."))
        pair = feistel_pair(a * 256 + b, c * 256 + d, (65536, 65536), f"{key}/ip")
        return ".".join(str(part) for half in pair for part in divmod(half, 256))
    if kind == "date":
        days = (date.fromisoformat(value) - date(1800, 1, 1)).days
        high, low = feistel_pair(*divmod(days, 773), (189, 773), f"{key}/date")
        return (date(1800, 1, 1) + timedelta(high * 773 + low)).isoformat()
    if kind == "ssn":
        area, group, serial = map(int, value.split("-"))
        place = area - 1 - (area > 666)
        high, serial = feistel_pair(place * 99 + group - 1, serial - 1, (898 * 99, 9999), f"{key}/ssn")
        place, group = divmod(high, 99)
        return f"{place + 1 + (place >= 665):03}-{group + 1:02}-{serial + 1:04}"
    if kind == "phone":
        moved = iter(feistel(digits, f"{key}/phone"))
    else:
        body = feistel(digits[:-1], f"{key}/card")
        moved = iter(next(body + last for last in "0123456789" if luhn(body + last)))
    return "".join(next(moved) if char.isdigit() else char for char in value)


def valid(kind, value):
    if not regex.fullmatch(pii.KINDS[kind], value):
        return False
    if kind == "ssn":
        return not re.search(r"^(?:000|666|9)|-00-|-0000$", value)
    if kind == "ip":
        return all(str(int(part)) == part and int(part) < 256 for part in value.split("."))
    return kind != "card" or luhn(value)


def made_up(rng, kind):
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        return f"{rng.choice(['Ann', 'bob.7', 'x_y', 'C+d%e'])}{digits(2)}@{rng.choice(['Mail-3', 'host'])}.example.{rng.choice(['org', 'DE'])}"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "date":
        return (date(1800, 1, 1) + timedelta(rng.randrange(146_097))).isoformat()
    if kind == "ssn":
        return f"{rng.choice([1, 899, 665, 667, rng.randrange(1, 666)]):03}-{rng.choice([1, 99, 45]):02}-{rng.choice([1, 9999, 777]):04}"
    if kind == "phone":
        return rng.choice([f"+{digits(2)} 30 {digits(4)} {digits(2)}", f"{digits(3)}-{digits(3)}-{digits(4)}"])
    body = digits(15)
    return next(body + last for last in "0123456789" if luhn(body + last))


@pytest.mark.parametrize("kind", pii.KINDS)
def test_pseudonyms_equal_a_feistel_network_by_hand_and_are_valid(spark, documents, kind):
    rng = random.Random(kind)
    values = sorted({made_up(rng, kind) for _ in range(300)})
    out = replaced(spark, documents, values, "some key")
    assert out == [by_hand(kind, value, "some key") for value in values]
    assert len(set(out)) == len(values)
    assert all(valid(kind, value) for value in out)


def test_every_kind_alone_in_a_text_is_replaced(spark, documents):
    examples = {
        "email": ["ab@example.org"],
        "ip": ["1.2.3.4"],
        "date": ["2023-02-03", "03.02.2023", "03/02/2023"],
        "ssn": ["219-09-9999"],
        "phone": ["+49 30 12 34 56", "(523) 555-1055", "523.555.1055"],
        "card": ["41 11 11 11 11 11 11 11", "4111111111111111"],
    }
    assert set(examples) == set(pii.KINDS)
    values = [value for some in examples.values() for value in some]
    out = replaced(spark, documents, values)
    assert all(a != b for a, b in zip(values, out, strict=True)), out


def test_cards_next_to_numbers(spark, documents):
    card, amex, pairs = "4111 1111 1111 1111", "3782 822463 10005", "41 11 11 11 11 11 11 11"
    texts = [
        "{} 12/25", "{} 123", "12 {}", "{} 25/12/2027", "{} 12@b.org", "no 1.5 {} 7.25", "{}-12", "12-{}", "7 {} {} 9",
        "+1 523 555 1055 {}", "219-09-9999 {} 2024-01-02", "12 219-09-9999 {}", "\ufdd0{}\ufdd1", "\ufdd0 {} \ufdd1 \ufdd1",
    ]
    values = [text.replace("{}", one) for text in texts for one in (card, card.replace(" ", ""), card.replace(" ", "-"), amex)]
    values.append(pairs + " 12/25")
    frame = documents(*[(n, value) for n, value in enumerate([card, card.replace(" ", ""), card.replace(" ", "-"), amex, pairs, *values])])
    out = [row.text for row in pii.pseudonyms(frame, "k").orderBy("doc_id").collect()]
    names = out[:5]
    for n, (text, value) in enumerate(zip(values, out[5:], strict=True)):
        name = names[4] if n == len(values) - 1 else names[n % 4]
        assert name in value, (text, value)
        assert pattern(value) == pattern(text), (text, value)
    kept = [n for n, text in enumerate(texts) if not re.search(r"@|/2027|2024|219|523", text)]
    for n in kept:
        for k, name in enumerate(names[:4]):
            assert out[5 + 4 * n + k] == texts[n].replace("{}", name)
    for n in (3, 4, 9, 10, 11):
        other = re.search(r"25/12/2027|12@b.org|\+1 523 555 1055|219-09-9999", texts[n]).group()
        assert other not in out[5 + 4 * n]


def test_long_telephone_numbers(spark, documents):
    values = ["+49 30 12 34 56 78", "+49 30 12 34 56", "+7 495 12 34 56 78", "+123 4567 8901 2345 6789", "+49 30 12 34 03/02/2024"]
    out = replaced(spark, documents, values)
    assert all(pattern(a) == pattern(b) for a, b in zip(values, out, strict=True))
    ends = [(" 78", 0), (" 78", 2), (" 6789", 3), ("03/02/2024", 4)]
    assert not any(out[n].endswith(end) for end, n in ends), out


def test_runs_without_cards_stay(spark, documents):
    values = ["\ufdd04111111111111112\ufdd1", "4111 1111 1111 1112", "4111111111111111-12x", "4111-1111-1111-1111-12x", "4111111111111111.5", "1" * 30000 + "x"]
    assert replaced(spark, documents, values) == values
    long = " ".join(["1234567"] * 3000) + " 4111 1111 1111 1111 " + "1-" * 30000 + "x"
    (out,) = replaced(spark, documents, [long])
    assert len(out) == len(long) and out != long and "4111 1111 1111 1111" not in out


def test_invalid_values_stay(spark, documents):
    values = ["4111111111111112", "256.1.1.1", "01.2.3.4", "2023-02-30", "000-12-3456", "12345", "a@b", "1.2.3.4.5"]
    assert replaced(spark, documents, values) == values


def test_every_day_has_a_day_of_its_own(spark, documents):
    days = [date.fromordinal(date(1800, 1, 1).toordinal() + n * 73).isoformat() for n in range(2001)]
    other = ["/".join(day.split("-")[::-1]) for day in days[:300]]
    out = replaced(spark, documents, days + other)
    assert len(set(out[:2001])) == 2001
    assert all("1800-01-01" <= date.fromisoformat(day).isoformat() <= "2199-12-31" for day in out[:2001])
    # The same day has the same pseudonym in either format.
    assert ["-".join(day.split("/")[::-1]) for day in out[2001:]] == out[:300]


def test_addresses_stay_addresses(spark, documents):
    values = [f"10.{n % 256}.{n // 3 % 256}.{n * 7 % 256}" for n in range(300)]
    out = replaced(spark, documents, values)
    assert len(set(out)) == len(set(values))
    assert all(max(map(int, one.split("."))) < 256 for one in out)


def test_text_around_stays(spark, documents):
    text = "a  10.0.0.1, b\n10.0.0.1.\ttail é"
    frame = documents((1, text), (1, text), (None, None), (3, ""), (4, "x" * 200_000 + " 10.0.0.1"))
    found = {row.doc_id: row for row in pii.pseudonyms(frame, "k").collect()}
    name = re.search(r"[\d.]+\d", found[1].text).group()
    assert found[1].text == text.replace("10.0.0.1", name) and found[1].replaced == 2
    assert (found[None].text, found[3].text) == (None, "")
    assert found[4].text == "x" * 200_000 + " " + name


def test_pages_without_a_url(spark):
    from waybill.llm import reputation

    pages = spark.createDataFrame(
        [(1, None), (2, "no host"), (3, "http://EXAMPLE.org/en/12?x"), (3, "http://EXAMPLE.org/en/12?x"),
         (4, "x://com/fr/#a"), (5, "http://notexample.org/es/"), (6, "http://a.example.org/es/")],
        "page_id long, url string",
    )
    labels = spark.createDataFrame([(1, None, None), (6, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    found = reputation.judged(pages, labels).select("page_id", "host", "path", "rule", "verdict")
    assert bag(found.where("page_id > 2")) == {
        (3, "example.org", "/en/12", "example.org/en/1", "block"): 2,
        (4, "com", "/fr/", "com/fr/", "allow"): 1,
        (5, "notexample.org", "/es/", "org/", "allow"): 1,
        (6, "a.example.org", "/es/", "example.org/es/", "block"): 1,
    }
    assert rows(found.where("page_id <= 2").select("host", "path", "rule").distinct()) == [("", "", None)]
    assert reputation.judged(pages.limit(0), labels).count() == 0
    assert reputation.judged(pages, labels.limit(0)).count() == 7
