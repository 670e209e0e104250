r"""N-gram Jaccard join: which documents share three quarters of their word 5-grams, and their components.

Texts are lower-cased (A-Z) and cut at white space. A document's set holds its distinct 5-word runs, or
its whole word sequence where it has fewer words. Two documents link when
`100 * |intersection| >= 75 * |union|`.

Grouped prefix join: all sets are put in one order, rare 5-grams first. Two sets that link share one of
the first `n - ceil(0.75 n) + 1` of each (the prefix). Documents with equal prefixes and sizes form a
group, and only groups meet: on a shared prefix token, if their sizes and the places of the token still
allow the overlap. Group pairs expand to pairs of classes (a class has one set), which are verified on
the sets. The order comes from a table of counters, a fixed number for all data, that tells frequent
tokens; any order gives the same result, this one keeps passages that many documents share out of the
prefixes.

Components need not every link. First each group meets only the member of its token that has the token
earliest, which ties the copies of one text together without pairing them all. What then shares a token
across two components is paired in full, so no link between components is missed.

Defined results: null and blank texts have an empty set and are linked with nothing; rows with the same
set are one class; rows that repeat get a row each; null ids count as the largest id and come out null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripweave.llm import common as C
from tripweave.operators.graph import weak_components

SHINGLE = 5
PERCENT = 75
#: counters for frequent tokens: 2 rows of 2**BITS, so 4 MB reach the driver and every task
BITS = 18
#: the fewest bits in the image of a set
IMAGE = 512
#: a bucket of a frequent token is split into parts of about so many groups
PART = 4096
_ROW = np.uint64(64 - BITS)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


class Sets:
    """Turns texts into sorted arrays of token hashes."""

    def __init__(self) -> None:
        self._words, self._runs = C.Words(), C.Runs()

    def of(self, text: str | None) -> np.ndarray:
        hashes = self._words.hashes((text or "").encode().lower())
        if len(hashes) < SHINGLE:
            return self._runs.of(hashes, len(hashes)) ^ np.uint64(len(hashes)) if len(hashes) else hashes
        tokens = np.sort(self._runs.of(hashes, SHINGLE))
        return tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]


def _counters(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return tokens >> _ROW, (tokens * _SECOND) >> _ROW


def frequent_counters(docs: DataFrame) -> np.ndarray:
    """How far each counter lies above what an even spread of the tokens explains; 0 for most.

    Every token of every document is counted; the table has a fixed size whatever the input.
    """
    size = 1 << BITS

    def count(batches):
        import pyarrow as pa

        sets, sums = Sets(), np.zeros(2 * size, dtype=np.int64)
        for batch in C.small_batches(batches):
            tokens = [sets.of(text) for text in batch.column("text").to_pylist()]
            a, b = _counters(np.concatenate([np.empty(0, dtype=np.uint64), *tokens]))
            sums[:size] += np.bincount(a.astype(np.int64), minlength=size)
            sums[size:] += np.bincount(b.astype(np.int64), minlength=size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["at", "n"])

    counted = docs.select(docs["text"].alias("text")).mapInArrow(count, "at bigint, n bigint")
    table = counted.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(2 * size, dtype=np.float64)
    sums[table["at"].to_numpy()] = table["n"].to_numpy()
    base = np.repeat(np.median(sums.reshape(2, size), axis=1), size)
    above = sums - base
    return np.where(above > 16 + 3 * np.sqrt(base), above, 0.0)


def _weights(tokens: np.ndarray, above: np.ndarray) -> np.ndarray:
    a, b = _counters(tokens)
    return np.minimum(above[a.astype(np.int64)], above[b.astype(np.int64) + (1 << BITS)])


def _digest(*parts: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b"".join(p.tobytes() for p in parts)) - (1 << 63)


def _prefix(tokens: np.ndarray, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens in the common order (weight, then hash), and their weights."""
    n = len(tokens)
    length = n - (PERCENT * n + 99) // 100 + 1
    weights = np.floor(np.log2(1 + _weights(tokens, above)) * 4)
    if not weights.any():
        return tokens[:length], weights[:length]
    order = np.argsort(weights, kind="stable")[:length]
    return tokens[order], weights[order]


def _bits(tokens: np.ndarray) -> np.ndarray:
    """A small image of a set: each token flips one bit. Its size is the power of two from one bit a token on.

    Two images of one size differ in at most as many bits as the sets differ in tokens, and so do images
    folded to half their size. Sets that have half of their union in common, or less, differ in more bits
    than a link allows nearly always, at one bit a token too.
    """
    size = max(IMAGE, 1 << (len(tokens) - 1).bit_length())
    at = (C.mixed(tokens * _SECOND) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def signatures(docs: DataFrame, above) -> DataFrame:
    """(id, th, n, cls, grp, bits, tokens, parts) of every row.

    n: set size; cls: class (one per set); grp: group (one per prefix and size); bits: image of the set;
    tokens: the prefix, for the first row of the group that a task meets; parts: 0, or 1 and up where a
    token is frequent, and its groups are spread over parts of a bounded size.
    """
    def rows(batch: dict[str, list], seen: set[int] = set(), sets: Sets = Sets()) -> Iterator[tuple]:  # noqa: B006, B008
        # the defaults live as long as the task
        sent = above.value
        for key, th, text in zip(batch["id"], batch["th"], batch["text"], strict=True):
            tokens = sets.of(text)
            if not len(tokens):
                yield key, th, 0, None, None, None, None, None
                continue
            prefix, weights = _prefix(tokens, sent)
            grp = _digest(prefix, np.array([len(tokens)]))
            first = parts = None
            if grp not in seen:
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(grp)
                spread = (np.exp2(weights / 4) / PART).astype(np.int64) + 1
                first = C.signed(prefix)
                parts = np.where(spread > 1, 1 + np.int64(grp & 0x7FFFFFFF) % spread, 0).astype(np.int32)
            yield key, th, len(tokens), _digest(tokens), grp, C.signed(_bits(tokens)), first, parts

    return C.map_rows(C.keyed(docs), rows, "id bigint, th int, n int, cls bigint, grp bigint, bits array<bigint>, "
                                           "tokens array<bigint>, parts array<int>")


def _may_link(a: str, b: str):
    """Size and place bounds on a shared token; all tokens that two linked sets share pass them.

    Before the token, two sets have in common what either has there of tokens that several prefixes hold
    (`s`), and after it what the smaller rest holds.
    """
    na, nb, pa, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.pos"), F.col(f"{b}.pos")
    sizes = 100 * F.least(na, nb) >= PERCENT * F.greatest(na, nb)
    overlap = F.least(F.col(f"{a}.s"), F.col(f"{b}.s")) + 1 + F.least(na - pa, nb - pb) - 1
    # overlap * (100 + PERCENT) >= PERCENT * (na + nb)
    return sizes & (overlap * (100 + PERCENT) >= PERCENT * (na + nb))


def _alike(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose images differ in no more bits than the sets of a link may differ in tokens."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    images = C.written(known.join(wanted, "cls").select("cls", "n", "bits").dropDuplicates(["cls"]), "jaccard-images")
    both = pairs.join(images.toDF("a", "na", "bits_a"), "a").join(images.toDF("b", "nb", "bits_b"), "b")
    # sizes of sets that link are within 3 : 4, so the images have one size or one is twice the other
    both = both.where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
    both = both.select("a", "b", "na", "nb", _folded("bits_a", "bits_b").alias("ia"),
                       _folded("bits_b", "bits_a").alias("ib"))
    differ = F.aggregate(F.zip_with("ia", "ib", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0),
                         lambda s, x: s + x)
    # a link of sizes na and nb has an overlap of PERCENT * (na + nb) / (100 + PERCENT) or more
    most = (100 - PERCENT) * (F.col("na") + F.col("nb"))
    return both.where(differ.cast("long") * (100 + PERCENT) <= most).select("a", "b")


def _folded(image: str, other: str):
    """The image, folded to the size of the other one if that is smaller."""
    half = F.size(other)
    folded = F.zip_with(F.slice(image, F.lit(1), half), F.slice(image, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(image) > half, folded).otherwise(F.col(image))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("ta", "tb")).cast("long").alias("common"),
        (F.size("ta") + F.size("tb")).cast("long").alias("sizes"))
    return both.where(100 * F.col("common") >= PERCENT * (F.col("sizes") - F.col("common"))).select("a", "b")


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs."""
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()


def class_components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and (cls, component) of the classes that are linked with another one."""
    spark: SparkSession = docs.sparkSession
    above = spark.sparkContext.broadcast(frequent_counters(docs))
    known = C.written(signatures(docs, above), "jaccard-signatures")
    above.destroy()
    classes = C.written(known.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min(F.struct("id", "th")).alias("first"), F.max("grp").alias("grp"), F.max("n").alias("n")), "jaccard-classes")
    groups = C.written(classes.groupBy("grp").agg(F.min("cls").alias("hub"), F.count("*").alias("classes")), "jaccard-groups")

    # of each token, the group that has it earliest; tokens of one group only are of no use
    prefixes = known.where("tokens IS NOT NULL").select("grp", "n", F.posexplode(F.arrays_zip("tokens", "parts")).alias(
        "pos", "t")).select(F.col("t.tokens").alias("token"), F.col("t.parts").alias("part"), "grp", "n", "pos")
    tokens = prefixes.repartition("token", "part")
    buckets = tokens.groupBy("token", "part").agg(F.min(F.struct("pos", "grp", "n")).alias("hub"),
                                                  F.min("grp").alias("g0"), F.max("grp").alias("g1"))
    shared = C.written(tokens.join(buckets, ["token", "part"]).where("g0 <> g1 OR part > 0").select(
        "token", "part", "grp", "n", "pos", "hub").distinct().withColumn(
        "s", F.row_number().over(Window.partitionBy("grp").orderBy("pos")) - 1), "jaccard-shared")

    # of the hub only the place is known here, which is no less than its s
    hub = F.struct("hub.grp", "hub.n", "hub.pos", F.col("hub.pos").alias("s"))
    star = shared.select(F.struct("grp", "n", "pos", "s").alias("x"), hub.alias("y"))
    # the parts of a frequent token meet through their earliest groups
    heads = shared.select("token", "part", "hub").distinct()
    head = heads.groupBy("token").agg(F.min("hub").alias("first"), F.count("*").alias("parts")).where("parts > 1")
    across = heads.join(head, "token").select(F.col("hub").alias("x"), F.col("first").alias("y"))
    ends = (F.struct(f"{c}.grp", f"{c}.n", f"{c}.pos", F.col(f"{c}.pos").alias("s")).alias(c) for c in "xy")
    met = star.unionByName(across.select(*ends)).where(
        (F.col("x.grp") != F.col("y.grp")) & _may_link("x", "y"))
    group_pairs = _pairs(met, "x.grp", "y.grp")
    hubs = groups.select("grp", "hub")
    between = group_pairs.join(hubs.toDF("a", "ha"), "a").join(hubs.toDF("b", "hb"), "b")
    within = classes.join(groups.where("classes > 1"), "grp").select(F.col("cls").alias("ha"), F.col("hub").alias("hb"))
    first = C.written(_pairs(between.select("ha", "hb").unionByName(within), "ha", "hb"), "jaccard-first")
    near = C.written(_alike(first, known), "jaccard-near")

    links = C.written(_verified(near, class_sets(docs, classes, near)), "jaccard-links")

    # buckets in which two components still meet are paired in full, but for pairs that were verified
    nodes = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    parts = weak_components(nodes, links.toDF("src", "dst")).select(F.col("id").alias("cls"), "component")
    homes = classes.select("grp", "cls").join(parts, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    placed = shared.select("token", "grp", "n", "pos", "s").join(C.written(homes, "jaccard-homes"), "grp")
    open_ = placed.groupBy("token").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    rest = C.written(placed.join(open_.select("token"), "token"), "jaccard-open")
    x, y = rest.alias("x"), rest.alias("y")
    meets = (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component"))
    # of two prefixes all shared tokens are seen here: what they share at most is their number and what
    # follows the last of them
    most = F.col("common") + F.least(F.col("nx") - F.col("px") - 1, F.col("ny") - F.col("py") - 1)
    crossing = x.join(y, meets & _may_link("x", "y")).groupBy(F.col("x.cls").alias("u"), F.col("y.cls").alias("v")).agg(
        F.count("*").alias("common"), F.max("x.pos").alias("px"), F.max("y.pos").alias("py"),
        F.max("x.n").alias("nx"), F.max("y.n").alias("ny")).where(
        most * (100 + PERCENT) >= PERCENT * (F.col("nx") + F.col("ny"))).select("u", "v")
    inner = classes.join(groups.where("classes > 2"), "grp").join(parts, "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    split = inner.groupBy("grp").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    inner = inner.join(split.select("grp"), "grp").select("grp", "cls", "component")
    p, q = inner.alias("p"), inner.alias("q")
    inside = p.join(q, (F.col("p.grp") == F.col("q.grp")) & (F.col("p.component") < F.col("q.component"))).select(
        F.col("p.cls").alias("u"), F.col("q.cls").alias("v"))
    second = C.written(_pairs(crossing.unionByName(inside), "u", "v").join(first, ["a", "b"], "left_anti"),
                       "jaccard-second")
    second = C.written(_alike(second, known), "jaccard-near")
    if not second.take(1):
        return known, parts
    more = C.written(_verified(second, class_sets(docs, classes, second)), "jaccard-more")
    if not more.take(1):
        return known, parts
    return known, _joined(parts, more)


def _joined(parts: DataFrame, more: DataFrame) -> DataFrame:
    """(cls, component) after more links between classes: components meet as single nodes."""
    ends = more.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    parts = C.written(parts.unionByName(ends.join(parts, "cls", "left_anti").withColumn("component", F.col("cls"))),
                      "jaccard-parts")
    between = more.join(parts.toDF("a", "src"), "a").join(parts.toDF("b", "dst"), "b").select("src", "dst").distinct()
    between = C.written(between, "jaccard-between")
    nodes = between.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    merged = weak_components(nodes, between).select(F.col("id").alias("component"), F.col("component").alias("whole"))
    return parts.join(merged, "component", "left").select("cls", F.coalesce("whole", "component").alias("component"))


def class_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, tokens): the sets of the classes in the pairs, from the first document of each."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    needed = classes.join(wanted, "cls").select("first.id", "first.th", "cls")

    def rows(batch: dict[str, list], sets: Sets = Sets()) -> Iterator[tuple]:  # noqa: B008
        for cls, text in zip(batch["cls"], batch["text"], strict=True):
            tokens = sets.of(text)
            if _digest(tokens) == cls:
                yield cls, C.signed(tokens)

    texts = C.only_in(C.keyed(docs), C.written(needed, "jaccard-needed"), ["id", "th"]).select("cls", "text")
    found = C.map_rows(texts, rows, "cls bigint, tokens array<bigint>")
    return C.written(found, "jaccard-sets").dropDuplicates(["cls"])


def components(docs: DataFrame) -> DataFrame:
    """(id, th, n, root, component_id) for every distinct (id, text).

    root names the component, and is null for empty sets; component_id is the smallest id in it.
    """
    known, parts = class_components(docs)
    known = known.select("id", "th", "n", "cls").distinct()
    grouped = known.where("cls IS NOT NULL").join(parts, "cls", "left").withColumn(
        "root", F.coalesce("component", "cls"))
    # as a table of its own, so that the join's partitions can be split where a component is large
    smallest = C.written(grouped.groupBy("root").agg(F.min("id").alias("component_id")), "jaccard-components")
    linked = grouped.join(smallest, "root").select("id", "th", "n", "root", "component_id")
    alone = known.where("cls IS NULL").select("id", "th", "n", F.lit(None).cast("bigint").alias("root"),
                                              F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def report(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: the size of its set and the smallest id that links reach."""
    rows = C.keyed(docs).select("id", "th").groupBy("id", "th").agg(F.count("*").cast("int").alias("times"))
    found = components(docs).join(rows, ["id", "th"]).withColumn("_", F.explode(F.sequence(F.lit(1), "times")))
    return found.select(C.true_id("id"), F.col("n").cast("long").alias("n_shingles"), C.true_id("component_id").alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """Of each component one row stays, columns unchanged: that with the smallest (id, text hash).

    Rows with an empty set are linked with nothing and stay; rows that repeat in id and text are one document.
    """
    found = components(docs)
    kept = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("id", "th")).alias("s")).select("s.*")
    kept = kept.unionByName(found.where("root IS NULL").select("id", "th"))
    key, th = C.free_names(docs, "id_", "th_")
    rows = docs.select("*", C.id_of(docs).alias(key), F.hash(docs["text"]).alias(th))
    return rows.join(kept.toDF(key, th), [key, th], "left_semi").dropDuplicates([key, th]).drop(key, th)


#: the same in DuckDB
SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, [x FOR x IN string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
  FROM documents WHERE text IS NOT NULL
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM worded
), one AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM shingled),
link AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM one a JOIN one b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT a AS doc_id, b AS other FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.other = l.a
)
SELECT d.doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles,
  least(d.doc_id, coalesce((SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id), d.doc_id)) AS component_id
FROM documents d LEFT JOIN shingled USING (doc_id)
"""
