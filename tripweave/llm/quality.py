r"""Quality rules: how far a document's histograms lie from those of its language.

Two histograms are taken of every document: its characters by class, and the frequent words of the
known languages (all other words together are one more bin). The reference of a language is the sum
over all documents labelled with it, so it follows the corpus. A document is rejected when the
Jensen-Shannon distance (base 2, 0 to 1) of either histogram to its language's reference exceeds a
threshold; a histogram with too little in it to be judged (`min_words`, `min_chars`) rejects nothing.
Base rules on length and repeated 5-word windows come first.

Everything is DataFrame functions within the row; the only exchange is the sum per language. Both
passes read the text, and no text is shuffled.

Defined results: a null text counts as empty, which fails the base rules; a null language is a language
of its own; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C

# Frequent function words of the corpus' languages.
COMMON_WORDS = [
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "by", "be",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist",
    "de", "la", "le", "et", "les", "un", "du", "une", "que", "pour", "est", "dans",
    "el", "en", "y", "los", "se", "las", "del", "por",
]
# Character classes, in the order in which they are taken out of the text. White space is in none.
CLASSES = {"upper": "[A-Z]+", "digit": "[0-9]+", "letter": r"\p{L}+", "mark": r"[.,;:!?'\"()\-]+",
           "symbol": "[#*$%&|<>]+"}
# Thresholds found on the labelled documents of a tenth: 95 % of the bad ones that pass the base rules
# are rejected, and 19 of 3,330 good ones.
MIN_WORDS, MIN_CHARS = 60, 150
MAX_WORD_DISTANCE, MAX_CLASS_DISTANCE = 0.26, 0.22
#: languages whose references are sent to every task; more of them are joined by a shuffle
MANY_LANGUAGES = 1000


def histograms(df: DataFrame, text: str) -> DataFrame:
    """Adds `words_` (array), `class_hist` and `word_hist` (arrays of counts) to `df`."""
    df = df.withColumn("words_", F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), C.SPACE), ""))
    df = df.withColumn("solid_", F.array_join("words_", ""))
    df = df.withColumn("rest_0", F.regexp_replace("solid_", "[a-z]+", ""))
    for k, pattern in enumerate(CLASSES.values()):
        df = df.withColumn(f"rest_{k + 1}", F.regexp_replace(f"rest_{k}", pattern, ""))
    lengths = [F.length("solid_"), *(F.length(f"rest_{k}") for k in range(len(CLASSES) + 1))]
    classes = [(a - b) for a, b in zip(lengths, lengths[1:], strict=False)] + [lengths[-1]]
    df = df.withColumn("class_hist", F.array(*(c.cast("long") for c in classes)))
    df = df.withColumn("frequent_", F.filter("words_", lambda w: w.isin(COMMON_WORDS)))
    # one small lambda instead of one expression per word: that many would outgrow what the JVM compiles
    count = lambda w: (F.size("frequent_") - F.size(F.array_remove("frequent_", w))).cast("long")
    other = (F.size("words_") - F.size("frequent_")).cast("long")
    vocabulary = F.array(*map(F.lit, COMMON_WORDS))
    return df.withColumn("word_hist", F.concat(F.transform(vocabulary, count), F.array(other)))


def references(docs: DataFrame) -> DataFrame:
    """One row per language: the summed histograms of all its documents."""
    df = histograms(docs.select(docs["lang"].alias("lang_"), docs["text"].alias("text_")), "text_")
    bins = df.select("lang_", F.posexplode(F.concat("class_hist", "word_hist")).alias("bin", "n"))
    summed = bins.groupBy("lang_", "bin").agg(F.sum("n").alias("n"))
    n = len(CLASSES) + 2
    # 56 rows a language
    row = summed.groupBy("lang_").agg(F.transform(F.sort_array(F.collect_list(F.struct("bin", "n"))),
                                                  lambda e: e["n"]).alias("all_"))
    return row.select("lang_", F.slice("all_", 1, n).alias("class_ref"),
                      F.slice("all_", n + 1, len(COMMON_WORDS) + 1).alias("word_ref"))


def _total(c: str) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)


def with_distance(df: DataFrame, name: str, counts: str, reference: str) -> DataFrame:
    """Adds the Jensen-Shannon distance of two histograms, 0 to 1; null if either is empty."""
    def half(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    n, m = f"{name}_n", f"{name}_m"  # columns, so that they are not summed anew for every bin
    df = df.withColumns({n: _total(counts), m: _total(reference)})
    df = df.withColumn(f"{name}_terms", F.zip_with(counts, reference, lambda x, y: half(
        x / F.col(n), y / F.col(m)) + half(y / F.col(m), x / F.col(n))))
    summed = F.aggregate(f"{name}_terms", F.lit(0.0), lambda s, x: s + x) / 2
    return df.withColumn(name, F.when((F.col(n) > 0) & (F.col(m) > 0), F.sqrt(F.greatest(summed, F.lit(0.0)))))


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; `words_` is there."""
    df = df.withColumn("hashes_", F.transform("words_", lambda w: F.xxhash64(w)))
    n = F.size("words_")
    window = lambda i: F.xxhash64(*(F.get("hashes_", i + j) for j in range(5)))
    df = df.withColumn("grams_", F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), window))
                       .otherwise(F.array().cast("array<bigint>")))
    # most documents repeat no window, and only the others are sorted
    repeats = F.size(F.array_distinct("grams_")) < F.size("grams_")
    df = df.withColumn("placed_", F.when(repeats, F.sort_array(
        F.transform("grams_", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))))
    twice = F.filter("placed_", lambda e, i: (e["h"] == F.get("placed_", i - 1)["h"])
                     | (e["h"] == F.get("placed_", i + 1)["h"]))
    df = df.withColumn("at_", F.sort_array(F.transform(twice, lambda e: e["at"])))
    covered = F.transform("at_", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("at_", k + 1) - p, F.lit(5))))
    df = df.withColumn("lines_", F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
                                          lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    return df.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length("solid_").cast("long"),
        "n_symbols": F.get("class_hist", F.lit(list(CLASSES).index("symbol") + 1)),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long"),
        "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long"),
    })


def judged(docs: DataFrame, refs: DataFrame | None = None, *, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
           max_word_distance: float = MAX_WORD_DISTANCE, max_class_distance: float = MAX_CLASS_DISTANCE) -> DataFrame:
    """`docs` in a struct column `row`, with the counts, both distances, `base_failed` and `kept`."""
    refs = references(docs) if refs is None else refs
    refs = C.written(refs, "quality-references")
    if refs.limit(MANY_LANGUAGES + 1).count() <= MANY_LANGUAGES:
        refs = F.broadcast(refs)
    df = docs.select(F.struct("*").alias("row"), docs["text"].alias("text_"), docs["lang"].alias("lang_1"))
    df = base_counts(histograms(df, "text_"), "text_")
    df = df.select("row", "lang_1", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   "class_hist", "word_hist")
    df = df.join(refs, F.col("lang_1").eqNullSafe(F.col("lang_")), "left")
    df = with_distance(df, "class_distance", "class_hist", "class_ref")
    df = with_distance(df, "word_distance", "word_hist", "word_ref")
    far_words = (F.col("n_words") >= min_words) & (F.col("word_distance") > max_word_distance)
    far_chars = (F.col("word_chars") >= min_chars) & (F.col("class_distance") > max_class_distance)
    df = df.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    verdict = ~F.col("base_failed") & ~F.coalesce(far_words | far_chars, F.lit(False))
    return df.withColumn("kept", verdict).select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance",
        "word_distance", "base_failed", "kept")


def keep_good(docs: DataFrame, **thresholds: float) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    # the partition number keeps the optimiser from moving the filter below the columns it is computed
    # from, which would compute each of them many times over
    here = judged(docs, **thresholds).select("row", "kept", F.spark_partition_id().alias("here"))
    return here.where("kept AND here >= 0").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: the counts and the verdict."""
    return judged(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept")


def _sql() -> str:
    """The same in DuckDB."""
    common = ", ".join(f"'{w}'" for w in COMMON_WORDS)
    rests = ", ".join(
        f"regexp_replace({'r0' if k == 0 else f'r{k}'}, '{p.replace(chr(39), chr(39) * 2)}', '', 'g') AS r{k + 1}"
        for k, p in enumerate(CLASSES.values()))
    last = len(CLASSES)
    bins = ", ".join(["length(solid) - length(r0)", *(f"length(r{k}) - length(r{k + 1})" for k in range(last)),
                      f"length(r{last})"])
    n = last + 2
    return f"""
WITH worded AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    [x FOR x IN string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), solid AS (
  SELECT *, array_to_string(w, '') AS solid, regexp_replace(array_to_string(w, ''), '[a-z]+', '', 'g') AS r0,
    [x FOR x IN w IF x IN ({common})] AS f FROM worded
), rest AS (SELECT *, {rests} FROM solid),
hist AS (
  SELECT *, [{bins}] || [len([x FOR x IN f IF x = c]) FOR c IN [{common}]] || [len(w) - len(f)] AS h FROM rest
), bin AS (SELECT doc_id, lang, i, h[i] AS x FROM hist, range(1, {n + len(COMMON_WORDS) + 2}) t(i)),
ref AS (SELECT lang, i, sum(x) AS y FROM bin GROUP BY ALL),
both_ AS (
  SELECT doc_id, bin.i <= {n} AS classes, x, y, sum(x) OVER d AS sx, sum(y) OVER d AS sy
  FROM bin JOIN ref ON bin.lang IS NOT DISTINCT FROM ref.lang AND bin.i = ref.i
  WINDOW d AS (PARTITION BY doc_id, bin.i <= {n})
), share AS (SELECT doc_id, classes, x / sx AS p, y / sy AS q FROM both_ WHERE sx > 0 AND sy > 0),
far AS (
  SELECT doc_id, classes, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d FROM share GROUP BY 1, 2
), gram AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) > 1 AS twice
  FROM worded, range(1, len(w) - 3) t(i)
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM gram, range(0, 5) t(k) WHERE twice GROUP BY 1
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(solid)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len([l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')])
      - len(list_distinct([l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '[^\\x20\\x09-\\x0D]')])))::BIGINT
      AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM rest LEFT JOIN repeated USING (doc_id)
), judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT j.*, NOT base_failed AND NOT coalesce(n_words >= {MIN_WORDS} AND w.d > {MAX_WORD_DISTANCE}, false)
  AND NOT coalesce(word_chars >= {MIN_CHARS} AND c.d > {MAX_CLASS_DISTANCE}, false) AS kept
FROM judged j LEFT JOIN far c ON c.doc_id = j.doc_id AND c.classes LEFT JOIN far w ON w.doc_id = j.doc_id AND NOT w.classes
"""


SQL = _sql()
