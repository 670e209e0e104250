r"""Spelling variants: words of the corpus that differ by one letter, and the usual spelling each goes back to.

Runs `[A-Za-zÀ-ÿ]+` are lower-cased (A-Z only). With h the crc32 of `<doc_id>:<run>`, a run loses its code
point h % length where 97 divides h. Words are the distinct results of at least 5 code points that occur
3 times or more. Two are near if one inserted, deleted or replaced code point turns one into the other.

Permuterm rotations: a word is marked with an end sign, and all rotations of the marked word are sorted.
Rotated so that the edited code point comes last, two words with a replacement there have the same
prefix before it, and the prefix of the longer word of an insertion is a whole rotation of the shorter one.
So each rotation is listed twice, whole and without its last code point, and equal entries are a
group: at most one word that has it whole, and one word for each letter that may follow (90 letters), so
a group is small whatever the input. A scan of the sorted groups tells each member how many others
are near and which of these is the most frequent; pairs are never written out. Of a run of equal letters
only the last one counts as the inserted one, so a near pair meets exactly once.

Rotations of more than `PLAIN` code points are entered by a 127-bit digest, computed for all rotations of a word in
time proportional to its length, so that a word of a million letters takes no more than a text of that size.

Defined results: null and empty texts have no words; repeated rows count each; a null id counts as the
largest long. Of near words with the same count the smallest in code-point order is the form. A form has
at least twice its word's count, so forms lead to a root without cycles.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm import common as C

RUN = "[A-Za-zÀ-ÿ]{5,}"  # a maximal run of 5 letters or more; a shorter one can't leave a word
MIN_LETTERS, MIN_COUNT, EVERY, TIMES = 5, 3, 97, 2
END = "$"
#: rotations up to this length are sorted as they are
PLAIN = 64
_PRIME, _BASE = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    lowered = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = C.keyed(docs).select("id", F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.col("id").cast("string"), F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % EVERY == 0, short).otherwise(F.col("run")).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= MIN_COUNT) & (F.length("word") >= MIN_LETTERS))


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n): ids follow the words' code-point order."""
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    return C.written(ordered.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")


def rotations(words: DataFrame) -> DataFrame:
    """(key, id, n, kind) of all rotations: kind 0 whole; 1 and 2 without the last code point, which is 2 if the
    word may have got it by insertion here."""
    size = F.length("word")
    turned = F.transform(F.sequence(F.lit(0), size), lambda s: F.concat(
        F.substring("word", s + 1, size), F.lit(END), F.substring("word", F.lit(1), s)))
    each = words.where(size < PLAIN).select("id", "n", size.alias("size"), F.explode(turned).alias("turn"))
    inserted = F.when(F.substring("turn", 1, 1) == F.substring("turn", -1, 1), 1).otherwise(2)
    entries = F.array(
        F.struct(F.col("turn").alias("key"), F.lit(0).alias("kind")),
        F.struct(F.substring("turn", F.lit(1), F.col("size")).alias("key"), inserted.alias("kind")))
    plain = each.select("id", "n", F.explode(entries).alias("e")).select("e.key", "id", "n", "e.kind")
    long = C.map_rows(words.where(size >= PLAIN), _long_rotations, "key string, id bigint, n bigint, kind int")
    # the end sign is the last code point of the first rotation, and nobody's to edit
    return plain.where("kind = 0 OR instr(key, '$') > 0").unionByName(long)


def _long_rotations(batch: dict[str, list]) -> Iterator[tuple]:
    for key, word, n in zip(batch["id"], batch["word"], batch["n"], strict=True):
        size = len(word)
        before, power = [0], [1]
        for c in word:
            before.append((before[-1] * _BASE + ord(c)) % _PRIME)
            power.append(power[-1] * _BASE % _PRIME)

        def entry(start: int, end: int) -> str:
            """The key of word[start:], the end sign and word[:end]."""
            length = size - start + 1 + end
            if length <= PLAIN:
                return f"{word[start:]}{END}{word[:end]}"  # noqa: B023
            tail = (before[size] - before[start] * power[size - start]) % _PRIME  # noqa: B023
            return f"{length}#{((tail * _BASE + ord(END)) * power[end] + before[end]) % _PRIME:032x}"  # noqa: B023

        for s in range(size + 1):
            yield entry(s, s), key, n, 0
            if s:
                yield entry(s, s - 1), key, n, 1 if s < size and word[s] == word[s - 1] else 2


def near(entries: DataFrame) -> DataFrame:
    """(id, n_near, best): for each word that has near words, their number and the first of them by (-n, id)."""
    group = Window.partitionBy("key")
    scan = group.orderBy(F.col("kind") == 0, F.desc("n"), "id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("less"), "id")
    whole, insert = F.col("kind") == 0, F.col("kind") == 2
    # members without their last letter come first, the most frequent ahead
    seen = entries.repartitionByRange("key").select(
        "id", "kind", F.count("*").over(scan).alias("members"),
        F.nth_value(F.when(~whole, me), 1).over(scan).alias("first"), F.nth_value(F.when(~whole, me), 2).over(scan).alias("second"),
        F.count(F.when(~whole, 1)).over(scan).alias("letters"), F.count(F.when(insert, 1)).over(scan).alias("inserts"),
        F.min(F.when(insert, me)).over(scan).alias("longer"), F.min(F.when(whole, me)).over(scan).alias("shorter"),
    ).where("members > 1")
    other = F.when(F.col("first.id") != F.col("id"), F.col("first")).otherwise(F.col("second"))
    best = F.when(whole, F.col("longer")).when(insert, F.least(other, "shorter")).otherwise(other)
    count = F.when(whole, F.col("inserts")).otherwise(
        F.col("letters") - 1 + F.when(insert & F.col("shorter").isNotNull(), 1).otherwise(0))
    found = seen.select("id", best.alias("best"), count.alias("n_near")).where("n_near > 0")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, form, root): the end of the forms that lead on from each word. Every round doubles the steps taken."""
    state = C.written(forms.select("id", "form", F.col("form").alias("root")), "spelling-roots")
    while True:
        # words are many to a root, so the table of steps is one of its own and hot partitions can be split
        ahead = state.select(F.col("id").alias("root"), F.col("root").alias("further"))
        state = C.written(state.join(ahead, "root", "left").select(
            "id", "form", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        if not state.where("moved").take(1):
            return state.drop("moved")
        state = state.drop("moved")


def groups(docs: DataFrame) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = numbered(C.written(word_counts(docs), "spelling-counts"))
    beside = C.written(words.join(near(rotations(words)), "id").select(
        "id", "n_near", F.col("best.id").alias("form"), (-F.col("best.less")).alias("form_n"), "n"), "spelling-near")
    names = words.select("id", "word")
    led = roots(beside.where(F.col("form_n") >= TIMES * F.col("n")).select("id", "form"))
    named = led.join(words.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n")), "form")
    named = named.join(names.toDF("root", "root_word"), "root").select("id", "form_word", "root_word", "form_n")
    return words.join(beside.select("id", "n_near"), "id", "left").join(named, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        _or_zero("n_near"), "form_n")


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)


#: the same in DuckDB
SQL = """
WITH RECURSIVE bit AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT range::BIGINT AS i FROM range(256))
), run AS (
  SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL
), code AS (
  SELECT run, times, list_concat([4294967295::BIGINT], flatten(list_transform(
    string_split(doc_id::VARCHAR || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
      ELSE [192 + (unicode(c) >> 6)::BIGINT, 128 + (unicode(c) & 63)::BIGINT] END))) AS b FROM run WHERE len(run) >= 5
), hashed AS (
  SELECT run, times, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h
  FROM code, bit
), word AS (
  SELECT word, sum(times)::BIGINT AS n FROM (SELECT times, CASE WHEN h % 97 = 0
    THEN run[:(h % len(run))::INT] || run[(h % len(run))::INT + 2:] ELSE run END AS word FROM hashed)
  WHERE len(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), place AS (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM word),
holed AS (SELECT word, n, i, word[:i - 1] AS x, word[i + 1:] AS y FROM place),
pair AS (
  SELECT a.word, b.word AS other, b.n FROM holed a JOIN holed b ON a.i = b.i AND a.x = b.x AND a.y = b.y AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holed a JOIN word b ON a.x || a.y = b.word
  UNION SELECT b.word, a.word, a.n FROM holed a JOIN word b ON a.x || a.y = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM pair GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.form_n >= 2 * w.n THEN form END AS form,
    CASE WHEN b.form_n >= 2 * w.n THEN form_n END AS form_n FROM word w LEFT JOIN best b USING (word)
), led AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL SELECT f.word, l.root FROM formed f JOIN led l ON f.form = l.word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN led USING (word)
"""
