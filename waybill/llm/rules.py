"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule; a policy is a named and versioned set of bits, so it is applied, changed and
compared by bitwise operations on the ledger, without reading a text again. `ablations` tells
from one aggregation of the bits what each rule of a policy does on its own.

Words are runs of other characters than space and U+0009 to U+000D. Null and empty text have
no words, which fails the rule on few words. Repeated documents have a row each. An empty table
gives no rows. Texts of any length are measured whole. Columns of the documents other than doc_id
and text are not read, whatever they are called. Everything is built-in functions.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from waybill.llm.frames import SPACE, WORD, let, span, text_of

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"

#: Rule names and the SQL condition, over the measurements, under which a document fails.
#: A rule's bit is its place; new rules go to the end, so that old ledgers stay readable.
RULES = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "100 * n_dup_lines > 70 * n_lines"),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple

    @property
    def mask(self):
        bits = {name: bit for bit, (name, _) in enumerate(RULES)}
        return sum(1 << bits[rule] for rule in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STRICT = Policy("strict", 1, tuple(name for name, _ in RULES))


def covered(codes):
    """Words in those three-word windows whose code occurs more than once."""
    ordered = F.sort_array(F.transform(codes, lambda code, at: F.struct(code.alias("c"), at.alias("at"))))

    def repeated(rows):
        code = lambda at: F.get(rows, at)["c"]
        same = F.filter(
            span(F.lit(0), F.size(rows)),
            lambda at: F.coalesce(code(at) == code(at - 1), F.lit(False))
            | F.coalesce(code(at) == code(at + 1), F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda at: F.get(rows, at)["at"]))

    def width(places):
        # A window reaches over three words or up to the next repeated window.
        reach = F.transform(
            places, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - at, F.lit(3)))
        )
        return F.aggregate(reach, F.lit(0), lambda total, words: total + words)

    return let(let(ordered, repeated), width)


def repeat_words(words):
    codes = F.transform(
        span(F.lit(0), F.size(words) - 2),
        lambda at: F.xxhash64(F.get(words, at), F.get(words, at + 1), F.get(words, at + 2)),
    )
    return let(
        codes,
        lambda codes: F.when(F.size(F.array_distinct(codes)) == F.size(codes), 0).otherwise(covered(codes)),
    )


def measures(text):
    """A struct of all measurements; words and lines are split once."""
    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    by_words = let(
        words,
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            repeat_words(words).cast("long").alias("n_repeat_words"),
        ),
    )
    by_lines = let(
        lines,
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        ),
    )
    kept = lambda dropped: F.length(F.translate(text, dropped, "")).cast("long")
    return by_words, by_lines, kept(BLANKS), F.length(text) - kept(SYMBOLS)


def ledger(documents):
    """doc_id, the measurements and failed_bits of every document."""
    by_words, by_lines, word_chars, n_symbols = measures(text_of(documents))
    measured = documents.select(
        "doc_id",
        by_words.alias("w"),
        by_lines.alias("l"),
        word_chars.alias("word_chars"),
        n_symbols.alias("n_symbols"),
    ).select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.*", "w.n_repeat_words")
    bits = [F.shiftleft(F.expr(rule).cast("long"), bit) for bit, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.select("doc_id", *MEASURES, failed.alias("failed_bits"))


def fails(policy):
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask)) != 0


def ablations(rows, policy):
    """One row per rule of the policy: documents that fail it, those that fail nothing else,
    and those that would be kept without it."""
    failed = F.col("failed_bits").bitwiseAND(F.lit(policy.mask)).alias("bits")
    # At most two to the number of rules.
    patterns = rows.groupBy(failed).agg(F.count("*").alias("n"))
    rules = [
        F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("long").alias("bit"))
        for bit, (name, _) in enumerate(RULES)
        if name in policy.rules
    ]
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    each = patterns.select("bits", "n", F.explode(F.array(*rules)).alias("r")).select("bits", "n", "r.*")
    return each.groupBy("rule", "bit").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        count(F.col("bits") == F.col("bit")).alias("failing_only_this"),
        count((F.col("bits") == 0) | (F.col("bits") == F.col("bit"))).alias("kept_without"),
    ).select(F.lit(f"{policy.name}/{policy.version}").alias("policy"), "rule", "failing", "failing_only_this", "kept_without")


def judged(documents, policy=STRICT):
    """One row per document: its measurements, failed_bits, base_failed and kept."""
    return ledger(documents).select(
        "doc_id",
        *MEASURES,
        "failed_bits",
        fails(BASE).alias("base_failed"),
        (~fails(BASE) & ~fails(policy)).alias("kept"),
    )


def _judged_sql():
    failed = " | ".join(f"(({rule})::BIGINT << {bit})" for bit, (_, rule) in enumerate(RULES))
    blank = r"[\x20\x09-\x0D]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{blank}+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM d),
tri AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w[p], w[p + 1], w[p + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM w)),
rep AS (
  SELECT doc_id, count(DISTINCT p + o) AS n FROM tri, (VALUES (0), (1), (2)) AS s(o)
  WHERE tri.n > 1 GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{blank}', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, {failed} AS failed_bits FROM m)
SELECT *, failed_bits & {BASE.mask} <> 0 AS base_failed, failed_bits & {STRICT.mask | BASE.mask} = 0 AS kept
FROM f
"""


JUDGED_SQL = _judged_sql()
