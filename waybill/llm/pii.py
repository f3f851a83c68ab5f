"""Format-preserving pseudonyms for personal data by keyed Feistel networks.

Found and validated values are replaced by values of the same format: a permutation of the
format's values that a key selects. Equal values get equal pseudonyms in every document, so
records stay linked, and different values never meet.

* e-mail addresses: each half of the address in lower case turns every character of the other
  half within its class (digits, letters); capitals stay where they are;
* telephone numbers: likewise the digits alone; whatever groups them stays, so the same digits
  get the same digits in every grouping;
* payment cards of 13 to 19 digits with a valid Luhn digit: likewise the digits before the last,
  and the Luhn digit is computed anew;
* social security numbers: the valid ones by number, so pseudonyms are valid too;
* IPv4 addresses: two numbers of 16 bits;
* dates (yyyy-MM-dd, dd.MM.yyyy, dd/MM/yyyy) from 1800 to 2199: days of the 400-year cycle, as
  pairs of numbers below 189 and 773.

A number next to a value does not hide it: of a run of digits with single spaces and hyphens, the
cards in usual groups are taken first, then from the left any groups of 13 to 19 digits, the most
digits first, whose Luhn digit is right; so one run of small groups in ten or more has a card by
chance. A telephone number ends before a valid card.

What looks like a value but is not valid stays as it is (cards with a wrong Luhn digit, octets
above 255, days that do not exist, dates with the month first). Null and empty texts stay. Repeated
rows get equal texts. An empty table gives no rows. Texts of any length are searched whole. Only
doc_id and text are read, whatever other columns are called. Everything is built-in functions.
"""

from pyspark.sql import functions as F

from waybill.llm.frames import let, span

ROUNDS = 8
#: For queries on test data. Real keys come from a secret store and are passed in.
DEMONSTRATION_KEY = "not a secret"
# From the first character of a run on, and never back into it: a long text without spaces would
# otherwise be searched once for each of its characters.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
DATE = r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w]|[.-]\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)"
# An international number has up to three groups after the area code, and more while it has no more
# than 15 digits. None of those after the second begins a day or a number of another kind.
NATIONAL = r"\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"


def phone_before(stop):
    """Telephone numbers that end before `stop`."""
    more = rf"(?!{stop}| (?:{DATE}|{SSN}))[ .-]?\d{{2,4}}"
    # Written out, as Java wants to see how far it looks back.
    within = r"(?<!" + r"\d[ .()-]{0,2}" * 15 + r"\d)"
    groups = rf"(?:[ .-]?\d{{2,4}}){{2}}(?:{more}(?:{more}{within}){{0,3}})?"
    return rf"(?<!\w)(?:\+\d{{1,3}}[ .-]?\(?\d{{2,4}}\)?{groups}|{NATIONAL})(?![\w]|[.-]\d)"


PHONE = phone_before(r"\+")
CARD = r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)"
KINDS = {"email": EMAIL, "ip": IPV4, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}
#: Usual groups of cards, looked for first, and any others from the longest on.
GROUPED = (r"\d{4}([ -])\d{4}\2\d{4}\2\d{4}", r"\d{4}([ -])\d{6}\2\d{4,5}", r"\d{13,19}")
LOOSE = tuple(rf"\d(?:[ -]?\d){{{more}}}" for more in range(18, 11, -1))
#: Only texts with this can have a card.
LONG = r"\d(?:[ -]?\d){12}"
# Runs of digits with single spaces and hyphens, as long as they go and up to the next value of
# another kind; groups that hyphens tie to a letter or a decimal are passed over as a whole.
_CHUNK = r"\d++(?:-\d++)*+(?!\w|\.\d)"
RUN = rf"(?<![\w.]){_CHUNK}(?: (?!{EMAIL}|{DATE}|{SSN}|{PHONE}){_CHUNK})*+"
_BROKEN = r"(?<![\w.])\d++(?:-\d++)*+(?:\w|\.\d)"
_SHAPED = r"[ .-]?(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}(?!\d)|\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d)|\d{13})"
RUNS = "|".join([EMAIL, IPV4, DATE, SSN, phone_before(_SHAPED), RUN, _BROKEN])
#: Cards are marked before the other values are looked for, by characters that texts do not have.
#: Marks of a text's own do no harm: only those next to a valid card are taken away again.
OPEN, CLOSE = "﷐", "﷑"
MARKED = OPEN + r"\d(?:[ -]?\d){12,18}" + CLOSE
ANY = "|".join([*(pattern for kind, pattern in KINDS.items() if kind != "card"), MARKED])
#: Every value of every kind has one of these, however its digits are grouped; texts without
#: them are not searched.
HINT = r"@|\d"
FIRST_DAY = "DATE'1800-01-01'"
DAYS = (189, 773)
#: Areas and groups, and serials.
SSNS = (898 * 99, 9999)


def keyed(key, turn, text):
    """Bytes as hexadecimal digits that only the key's owner can compute."""
    return F.sha2(F.concat_ws("|", F.lit(key), turn.cast("string"), text, F.lit(key)), 256)


def number(digest, modulus):
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % modulus


def turned(char, by):
    """A character moved within its class."""
    code = F.ascii(char)

    def within(first, size):
        return F.chr(F.lit(first) + (code - first + by) % size)

    return (
        F.when(code.between(48, 57), within(48, 10))
        .when(code.between(97, 122), within(97, 26))
        .when(code.between(65, 90), within(65, 26))
        .otherwise(char)
    )


def permuted_text(text, key):
    """Every character stays in its class; a bijection of the texts of one pattern."""
    chars = F.split(text, "")
    half = F.floor(F.size(chars) / 2).cast("int")

    def step(state, turn):
        def mixed(digest):
            return F.transform(
                state["left"],
                lambda char, at: turned(
                    char, F.conv(F.substr(digest, (at % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
                ),
            )

        moved = let(keyed(key, turn, F.array_join(state["right"], "")), mixed)
        return F.struct(state["right"].alias("left"), moved.alias("right"))

    kind = "struct<left:array<string>,right:array<string>>"
    start = let(
        chars,
        lambda chars: F.struct(
            F.slice(chars, F.lit(1), half).alias("left"),
            F.slice(chars, half + 1, F.size(chars)).alias("right"),
        ),
    )
    turns = F.array(*map(F.lit, range(ROUNDS)))
    return F.aggregate(
        turns,
        start.cast(kind),
        lambda state, turn: step(state, turn).cast(kind),
        lambda state: F.concat(F.array_join(state["left"], ""), F.array_join(state["right"], "")),
    )


def laid_over(digits, value):
    """`value` with its digits, in order, replaced by `digits`."""
    return let(
        digits,
        lambda digits: F.array_join(
            F.transform(
                F.split(value, ""),
                lambda char, at: F.when(
                    char.between("0", "9"),
                    F.substr(digits, F.length(digits_of(F.substr(value, F.lit(1), at + 1))), F.lit(1)),
                ).otherwise(char),
            ),
            "",
        ),
    )


def phone(value, key):
    return laid_over(permuted_text(digits_of(value), key), value)


def email(value, key):
    def capitals(moved):
        chars = F.split(value, "")
        cased = F.transform(
            chars,
            lambda char, at: let(
                F.substr(moved, at + 1, F.lit(1)),
                lambda new: F.when(char.between("A", "Z"), F.upper(new)).otherwise(new),
            ),
        )
        return F.array_join(cased, "")

    return let(permuted_text(F.lower(value), key), capitals)


def permuted_pair(left, right, moduli, key):
    """A bijection of the pairs of numbers below the two moduli."""
    kind = "struct<left:bigint,right:bigint>"

    def step(state, turn):
        moved = (state["left"] + number(keyed(key, turn, state["right"].cast("string")), moduli[0])) % moduli[0]
        back = keyed(key, turn + ROUNDS, moved.cast("string"))
        other = (state["right"] + number(back, moduli[1])) % moduli[1]
        return F.struct(moved.alias("left"), other.alias("right")).cast(kind)

    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right")).cast(kind)
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS // 2))), start, step)


def luhn_sum(digits, doubled):
    """Weighted digit sum; the last digit counts double if `doubled`."""
    reverse = F.split(F.reverse(digits), "")
    weighed = F.transform(
        reverse,
        lambda digit, at: F.when(at % 2 == (0 if doubled else 1), F.get(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), digit.cast("int")))
        .otherwise(digit.cast("int")),
    )
    return F.aggregate(weighed, F.lit(0), lambda total, digit: total + digit)


def digits_of(text):
    return F.regexp_replace(text, r"\D", "")


def card(value, key):
    def renewed(body):
        check = (F.lit(10) - luhn_sum(body, True) % 10) % 10
        return F.concat(body, check.cast("string"))

    def moved(digits):
        body = F.substr(digits, F.lit(1), F.length(digits) - 1)
        return laid_over(let(permuted_text(body, key), renewed), value)

    return F.when(luhn_sum(digits_of(value), False) % 10 == 0, let(digits_of(value), moved))


def ip(value, key):
    def written(pair):
        parts = [F.floor(pair["left"] / 256), pair["left"] % 256, F.floor(pair["right"] / 256), pair["right"] % 256]
        return F.concat_ws(".", *[part.cast("string") for part in parts])

    octets = [F.split_part(value, F.lit("."), F.lit(place)).cast("int") for place in (1, 2, 3, 4)]
    high, low = octets[0] * 256 + octets[1], octets[2] * 256 + octets[3]
    # A leading zero is no decimal octet and could not be told from the same octet without it.
    valid = ~value.rlike(r"(?:^|\.)0\d") & (F.greatest(*octets) <= 255)
    return F.when(valid, let(permuted_pair(high, low, (65536, 65536), key), written))


def date(value, key):
    apart = F.substr(value, F.lit(3), F.lit(1))
    iso = F.substr(value, F.lit(5), F.lit(1)) == "-"
    plain = F.when(iso, value).otherwise(
        F.concat_ws("-", F.right(value, F.lit(4)), F.substr(value, F.lit(4), F.lit(2)), F.left(value, F.lit(2)))
    )
    first = F.expr(FIRST_DAY)

    def written(day):
        return F.when(iso, F.date_format(day, "yyyy-MM-dd")).otherwise(
            F.concat(F.date_format(day, "dd"), apart, F.date_format(day, "MM"), apart, F.date_format(day, "yyyy"))
        )

    def moved(day):
        pair = permuted_pair(F.floor(day / DAYS[1]), day % DAYS[1], DAYS, key)
        return let(
            pair, lambda pair: written(F.date_add(first, (pair["left"] * DAYS[1] + pair["right"]).cast("int")))
        )

    days = F.datediff(plain.try_cast("date"), first)
    return let(days, lambda day: F.when(day.between(0, DAYS[0] * DAYS[1] - 1), moved(day)))


def ssn(value, key):
    """Areas are 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = [F.split_part(value, F.lit("-"), F.lit(place)).cast("int") for place in (1, 2, 3)]
    place = area - F.when(area > 666, 2).otherwise(1)

    def written(pair):
        place = F.floor(pair["left"] / 99)
        parts = [place + F.when(place >= 665, 2).otherwise(1), pair["left"] % 99 + 1, pair["right"] + 1]
        return F.concat_ws("-", *[F.lpad(part.cast("string"), n, "0") for part, n in zip(parts, (3, 2, 4), strict=True)])

    pair = permuted_pair(place * 99 + group - 1, serial - 1, SSNS, key)
    return F.when(~value.rlike(r"^(?:000|666|9)|-00-|-0000$"), let(pair, written))


def respelled(text, pattern, found, between):
    """`text` with what matches `pattern` changed by `found`, and the text between by `between`."""

    def joined(values, pieces):
        changed = F.transform(
            pieces, lambda piece, at: F.concat(between(piece), F.coalesce(found(F.get(values, at)), F.lit("")))
        )
        return F.array_join(changed, "")

    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(values, lambda values: let(F.split(text, pattern, -1), lambda pieces: joined(values, pieces)))


def with_marks(run, forms):
    """A run of digits with marks around its valid cards of these forms, which begin and end
    with groups; from the left, none within another."""

    def valid(value):
        return F.when((value != "") & (luhn_sum(digits_of(value), False) % 10 == 0), value)

    def marked(groups, cards):
        def step(state, at):
            card = F.get(cards, at)
            end = at + F.size(F.split(card, "[ -]"))
            return (
                F.when(
                    card.isNotNull() & (at >= state["free"]),
                    F.struct(
                        end.alias("free"),
                        F.concat(state["begins"], F.array(at)).alias("begins"),
                        F.concat(state["ends"], F.array(end - 1)).alias("ends"),
                    ),
                )
                .otherwise(state)
                .cast(kind)
            )

        def spelled(state):
            return F.transform(
                groups,
                lambda group, at: F.concat(
                    F.when(F.array_contains(state["begins"], at), OPEN).otherwise(""),
                    F.when(
                        F.array_contains(state["ends"], at), F.regexp_replace(group, r"^(\d+)", "$1" + CLOSE)
                    ).otherwise(group),
                ),
            )

        kind = "struct<free:int,begins:array<int>,ends:array<int>>"
        none = F.array().cast("array<int>")
        start = F.struct(F.lit(0).alias("free"), none.alias("begins"), none.alias("ends")).cast(kind)
        chosen = F.aggregate(span(F.lit(0), F.size(groups)), start, step)
        return let(chosen, lambda state: F.array_join(spelled(state), ""))

    # At every group, the card of each form that begins there, or empty text.
    tables = F.array(
        *[F.regexp_extract_all(run, F.lit(rf"(?<!\d)(?=\d)(?=({form}(?!\d))?)"), F.lit(1)) for form in forms]
    )
    groups = F.regexp_extract_all(run, F.lit(r"\d+\D*"), F.lit(0))

    def cards(groups, tables):
        return F.transform(
            groups,
            lambda _, at: F.coalesce(*[valid(F.get(F.get(tables, F.lit(k)), at)) for k in range(len(forms))]),
        )

    rest = let(
        groups,
        lambda groups: let(
            let(tables, lambda tables: cards(groups, tables)), lambda cards: marked(groups, cards)
        ),
    )
    return F.concat(F.regexp_extract(run, r"^\D*", 0), rest)


def cards_marked(text):
    """`text` with marks around the valid cards of its runs of digits."""

    def loose(piece):
        return F.when(piece.rlike(LONG), with_marks(piece, LOOSE)).otherwise(piece)

    def run(value):
        grouped = let(
            with_marks(value, GROUPED), lambda value: respelled(value, MARKED, lambda card: card, loose)
        )
        return F.when(value.rlike(r"^[\d -]+$") & value.rlike(LONG), grouped).otherwise(value)

    return F.when(text.rlike(LONG), respelled(text, RUNS, run, lambda piece: piece)).otherwise(text)


def pseudonym(value, key):
    """The pseudonym of a value; null where it is not valid."""
    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    return (
        F.when(value.startswith(OPEN), card(F.substr(value, F.lit(2), F.length(value) - 2), key + "/card"))
        .when(value.contains("@"), email(value, key + "/email"))
        .when(whole(IPV4), ip(value, key + "/ip"))
        .when(whole(DATE), date(value, key + "/date"))
        .when(whole(SSN), ssn(value, key + "/ssn"))
        .when(whole(PHONE), phone(value, key + "/phone"))
    )


def pseudonymised(text, key):
    """(text, replaced): the text with its values replaced, and their number."""

    def rebuilt(text, found):
        names = F.transform(found, lambda value: pseudonym(value, key))

        def joined(names):
            between = F.split(text, ANY, -1)
            pieces = let(
                between,
                lambda between: F.transform(
                    between,
                    lambda piece, at: F.concat(piece, F.coalesce(F.get(names, at), F.get(found, at), F.lit(""))),
                ),
            )
            return F.struct(
                F.array_join(pieces, "").alias("text"),
                F.size(F.array_compact(names)).alias("replaced"),
            )

        return let(names, joined)

    kind = "struct<text:string,replaced:int>"
    untouched = F.struct(text.alias("text"), F.lit(0).alias("replaced")).cast(kind)

    def searched(text):
        found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
        return let(found, lambda found: F.when(F.size(found) > 0, rebuilt(text, found).cast(kind)).otherwise(untouched))

    return F.when(text.rlike(HINT), let(cards_marked(text), searched)).otherwise(untouched)


def pseudonyms(documents, key):
    """doc_id, text with pseudonyms and the number of replaced values of every document."""
    rows = documents.select("doc_id", pseudonymised(F.col("text"), key).alias("p"))
    return rows.select("doc_id", "p.text", "p.replaced")
