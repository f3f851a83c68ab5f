"""Spelling variants of words, found by PartEnum signatures.

A word is a binary vector: one place per letter and occurrence of that letter. Words that
differ by one inserted, deleted or replaced code point differ in at most two places. PartEnum
deals the places to `PARTS` parts; a Hamming distance of two leaves one of three parts untouched,
so near words have an equal projection on some part: its exact signature. Words with an equal
signature are joined and verified.

By itself a third of the letters would pair words that share little else. So a signature also
fixes what an edit at one place leaves alone: the shorter of two near words is cut into three
segments, of which two stand in both words, at the start or counted from the end. A word thus
has a signature per part, per segment left out, and per role: as the shorter or an equally
long word, and as the longer one. No near pair is lost, and no bucket is cut short. A pair is
kept in the first of the buckets it meets in, so pairs need not be made distinct.

Words: runs of letters `[A-Za-z\\u00C0-\\u00FF]+` of whole texts, A-Z in lower case. The run of a
document whose checksum (crc32 of `<doc_id>:<run>`) 31 divides loses one code point. Of the
results, words have at least `SHORTEST` code points and `FEWEST` occurrences. A word's form is
its near word with most occurrences (ties: the smallest), if that has `RATIO` times its own;
its root is where the forms lead.

Null and empty texts have no words. A null doc_id counts as empty text in the checksum. Repeated
rows count each. A corpus without words gives no rows. A run of any length is one word. Only
doc_id and text are read, whatever other columns are called.
"""

from functools import reduce

from pyspark.sql import functions as F

from waybill.llm.frames import stored, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST = 7
FEWEST = 2
DROP_EVERY = 31
RATIO = 10
PARTS = 3
SEGMENTS = 3
#: Letters of these languages by falling frequency, dealt to the parts in turn.
BY_FREQUENCY = "etaoinshrdlcumwfgypbvkjxqz"
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))


def letters_outside(part):
    """All letters that do not belong to `part`; a part has all occurrences of its letters."""
    dealt = enumerate(BY_FREQUENCY + ACCENTED)
    return "".join(letter for at, letter in dealt if at % PARTS != part)


def runs(documents):
    """One row per run of letters that can become a word: `word`, after the deletion."""
    text = F.translate(text_of(documents), UPPER, LOWER)
    # A run that is long enough is matched from its start, a shorter one nowhere.
    found = F.regexp_extract_all(text, F.lit(rf"[A-Za-zÀ-ÿ]{{{SHORTEST},}}"), F.lit(0))
    doc_id = F.coalesce(documents["doc_id"].cast("string"), F.lit(""))
    rows = documents.select(doc_id.alias("doc_id"), F.explode(found).alias("run"))
    run = F.col("run")
    rows = rows.select(run, F.crc32(F.concat("doc_id", F.lit(":"), run).cast("binary")).alias("h"))
    at = (F.col("h") % F.length(run)).cast("int")
    shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    rows = rows.select(F.when(F.col("h") % DROP_EVERY == 0, shorter).otherwise(run).alias("word"))
    return rows.where(F.length("word") >= SHORTEST)


def words(documents):
    """(word, n) of all words."""
    counts = runs(documents).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= FEWEST)


def projection(word, part):
    """The vector's places in `part`, as text."""
    own = F.translate(word, letters_outside(part), "")
    return F.array_join(F.array_sort(F.split(own, "")), "")


def cuts(length):
    """Where the second and the third segment of a word of `length` begin."""
    return [(length * k / SEGMENTS).cast("int") for k in range(1, SEGMENTS)]


def start_of(word, length):
    return F.substr(word, F.lit(1), length)


def end_of(word, length):
    return F.substr(word, F.length(word) - length + 1)


def left_alone(word, length):
    """What two segments have in a word and in its near words, if the shorter has `length`:
    without the first segment, the middle one, the last."""
    second, third = cuts(length)
    return [
        end_of(word, length - second),
        F.concat_ws("\0", start_of(word, second), end_of(word, length - third)),
        start_of(word, third),
    ]


def signatures(vocabulary):
    """(key, segment, part, longer, word, n): a word's signatures in both roles."""
    word = F.col("word")
    projections = F.array(*[projection(word, part) for part in range(PARTS)])
    roles = F.array(F.lit(0), F.lit(1))
    rows = vocabulary.select("word", "n", projections.alias("parts"), F.explode(roles).alias("longer"))
    length = F.length(word) - F.col("longer")
    rows = rows.where(length >= SHORTEST).withColumn("length", length)
    kept = F.array(*left_alone(word, F.col("length")))
    rows = rows.select("word", "n", "longer", "length", "parts", F.posexplode(kept).alias("segment", "kept"))
    rows = rows.select("word", "n", "longer", "length", "segment", "kept", F.posexplode("parts").alias("part", "projection"))
    key = F.xxhash64("length", "segment", "kept", "part", "projection")
    return rows.select(key.alias("key"), F.col("segment").cast("byte"), F.col("part").cast("byte"), F.col("longer").cast("byte"), "word", "n")


def first_meeting(a, b, segment, part):
    """Whether near words, `a` not longer than `b`, have no earlier bucket in common."""
    length = F.length(a)
    same = [x == y for x, y in zip(left_alone(a, length), left_alone(b, length), strict=True)]
    later = [reduce(lambda x, y: x | y, same[k + 1 :]) for k in range(SEGMENTS - 1)]
    # The edit is in no letter of a part if the part's letters are the same, in order.
    equal = [F.translate(a, outside, "") == F.translate(b, outside, "") for outside in map(letters_outside, range(PARTS))]
    earlier = [reduce(lambda x, y: x | y, equal[:k]) for k in range(1, PARTS)]
    met = F.lit(False)
    for k, other in enumerate(later):
        met = met | ((segment == k) & other)
    for k, other in enumerate(earlier, 1):
        met = met | ((part == k) & other)
    return ~met


def near_pairs(vocabulary):
    """(a, n_a, b, n_b): every pair of near words once."""
    rows = signatures(vocabulary)
    bucket = ["key", "segment", "part"]
    left = rows.select(*bucket, F.col("longer").alias("a_longer"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = rows.select(*bucket, F.col("longer").alias("b_longer"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    # `a` is the shorter, or of two equally long words the smaller. Written so that nothing of it
    # applies to one side alone, and both sides have the same columns: they read one exchange.
    roles = (F.col("a_longer") < F.col("b_longer")) | (
        (F.col("a_longer") + F.col("b_longer") == 0) & (F.col("a") < F.col("b"))
    )
    near = F.levenshtein("a", "b", 1) == 1
    # Words whose signatures are equal by chance only are near or not, like all others.
    fits = F.length("b") == F.length("a") + F.col("b_longer")
    found = left.join(right, bucket).where(roles & fits & near)
    once = first_meeting(F.col("a"), F.col("b"), F.col("segment"), F.col("part"))
    return found.where(once).select("a", "n_a", "b", "n_b")


def led(forms):
    """(word, root) of the words that have a form. Following a form's own form doubles the way
    each round; a form has `RATIO` times the occurrences, so the rounds are few."""
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        over = roots.select(F.col("word").alias("root"), F.col("root").alias("top"))
        moved = roots.join(over, "root", "left").select("word", F.coalesce("top", "root").alias("root"), "top")
        moved = stored(moved, "roots")
        roots = moved.drop("top")
        if not moved.where("top IS NOT NULL").limit(1).count():
            return roots


def variants(documents):
    """One row per word: word, form, root, n, n_near, form_n."""
    vocabulary = stored(words(documents), "words")
    pairs = stored(near_pairs(vocabulary), "near")
    ends = F.inline(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("n_a").alias("own"), F.col("b").alias("form"), F.col("n_b").alias("form_n")),
            F.struct(F.col("b").alias("word"), F.col("n_b").alias("own"), F.col("a").alias("form"), F.col("n_a").alias("form_n")),
        )
    )
    ends = pairs.select(ends)
    near = ends.groupBy("word").agg(F.count("*").alias("n_near"))
    able = ends.where(F.col("form_n") >= RATIO * F.col("own"))
    best = able.groupBy("word").agg(F.min(F.struct((-F.col("form_n")).alias("order"), "form", "form_n")).alias("best"))
    forms = stored(best.select("word", "best.form", "best.form_n"), "forms")
    rows = vocabulary.join(near, "word", "left").join(forms, "word", "left").join(led(forms), "word", "left")
    return rows.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )


# A word is near to another if both are equal without one code point each, at the same place, or
# if one is the other without one. Checksums go byte by byte over a table made by its rule.
VARIANTS_SQL = rf"""
WITH RECURSIVE bits AS (
  SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS step FROM bits WHERE k = 8),
found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS code FROM found WHERE length(run) >= {SHORTEST} GROUP BY ALL),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(code) + 1, 2),
    lambda i: ((instr('0123456789ABCDEF', code[i]) - 1) * 16 + instr('0123456789ABCDEF', code[i + 1]) - 1)::BIGINT)),
    lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1]))) AS h
  FROM distinct_runs, steps),
cut AS (
  SELECT CASE WHEN h % {DROP_EVERY} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM summed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {FEWEST}),
less AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (
  SELECT a.word, a.n AS own, b.word AS other, b.n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN w b ON b.word = a.rest
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN w b ON b.word = a.rest),
counted AS (
  SELECT word, count(*) AS n_near, max(n) AS best, min(own) AS own FROM near GROUP BY word),
forms AS (
  SELECT near.word, min(near.other) AS form, min(near.n) AS form_n FROM near JOIN counted c ON c.word = near.word AND c.best = near.n
  WHERE near.n >= {RATIO} * c.own GROUP BY near.word),
way AS (
  SELECT word, word AS root, 0 AS k FROM w
  UNION ALL
  SELECT way.word, forms.form, k + 1 FROM way JOIN forms ON forms.word = way.root),
roots AS (SELECT word, max_by(root, k) AS root FROM way GROUP BY word)
SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM w LEFT JOIN (SELECT word, n_near FROM counted) USING (word) LEFT JOIN forms USING (word) JOIN roots USING (word)
"""
