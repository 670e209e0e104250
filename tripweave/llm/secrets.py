r"""Secret scans: patterns nominate strings, a random forest removes the false positives.

Candidates are runs of 16 or more characters of keys and encodings, values of 8 or more characters
assigned to a credential name (whole, instead of the runs in them), and private-key headers. A
candidate is described by its length, how its characters follow one another (changes of class, likelihood of letter pairs, entropy), how much of it dictionary pieces cover,
whether it looks like a path or an address, and the words before it. The forest is fitted on labelled
findings and scores every candidate.

Labelled findings: a table (doc_id, value, secret) may be given. Without one, findings are labelled by a
rule that looks at the name a value is assigned to and at its alphabet, and the forest learns to tell
from the string and its surroundings what the rule tells from both. Fitting takes a sample of at most
`SAMPLE` distinct labelled findings, chosen by a hash of the value; candidates and scores cover all documents.

Values never leave the operator: findings carry a digest and the place.

Defined results: null and empty texts have no candidate; repeated rows have findings each; if the
labelled findings are all of one kind, or there are none, that kind (not secret, if none) is the verdict.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm import common as C
from tripweave.llm import pieces as P

SAMPLE = 20_000
TREES, DEPTH, SEED = 30, 6, 42

# What credentials are called, and words beside strings that only look like one.
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "access-key",
         "private_key", "auth", "bearer", "credential", "client_secret")
DECOYS = ("commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "revision", "uuid", "example",
          "sample", "test", "dummy", "placeholder", "version")
_NAME = re.compile(rf"(?:^|[^A-Za-z0-9])(?:\w*[_-])?({'|'.join(map(re.escape, NAMES))})[\"']?\s*(?:=|:|:=|=>)\s*[\"'`]?$",
                   re.I)
_CANDIDATE = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----|[A-Za-z0-9][A-Za-z0-9+/_.@~=-]{14,}[A-Za-z0-9=]", re.A)
#: what stands before an assigned value, and what ends the value: its closing quote or a blank
_ASSIGNED = re.compile(rf"(?:{'|'.join(map(re.escape, NAMES))})[\"']?\s*(?::=|=>|=|:)\s*", re.I)
_ENDS = {'"': re.compile(r'[\s"]'), "'": re.compile(r"[\s']"), "`": re.compile(r"[\s`]"), "": re.compile(r"[\s\"'`]")}
SHORTEST = 8
_KNOWN = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_\w{16,}|"
                    r"AIza[\w-]{35}|eyJ[\w-]+\.eyJ[\w-]+\.[\w-]+|glpat-[\w-]{20}|-----BEGIN .*")
_ADDRESS = re.compile(r"[^@\s]@[\w-]+\.[\w.-]+$|(?:\d{1,3}\.){3}\d{1,3}$|https?://")
FEATURES = ["length", "entropy", "changes", "pair_likelihood", "digits", "upper", "vowels", "hex", "covered",
            "slashes", "dots", "address", "assigned", "named", "decoys", "capitals"]


class Describer:
    """Numbers that describe a candidate. The dictionary and the letter pairs are those of a vocabulary."""

    def __init__(self, known: P.Pieces) -> None:
        words = [p.strip().lower() for p in known.ids if p.strip().isalpha()]
        self._dictionary = {w for w in words if len(w) >= 3}
        pairs: dict[str, int] = {}
        for w in words:
            for a, b in zip(w, w[1:], strict=False):
                pairs[a + b] = pairs.get(a + b, 0) + 1
        total = sum(pairs.values())
        self._pairs = {p: math.log(n / total) for p, n in pairs.items()}
        self._rare = math.log(0.5 / max(1, total))

    def covered(self, value: str) -> float:
        """Share of the characters in dictionary pieces of three letters and more, longest first."""
        lowered, at, inside = value.lower(), 0, 0
        while at < len(lowered):
            for size in range(min(16, len(lowered) - at), 2, -1):
                if lowered[at:at + size] in self._dictionary:
                    inside, at = inside + size, at + size
                    break
            else:
                at += 1
        return inside / len(value)

    def features(self, value: str, before: str) -> list[float]:
        n = len(value)
        counts = {c: value.count(c) for c in set(value)}
        kinds = [0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3 for c in value]
        lowered = value.lower()
        pairs = [self._pairs.get(lowered[k:k + 2], self._rare) for k in range(n - 1)]
        words = re.findall(r"[a-z0-9_-]+", before.lower())[-3:]
        return [
            float(n), -sum(k / n * math.log2(k / n) for k in counts.values()),
            sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1),
            sum(pairs) / max(1, len(pairs)), kinds.count(0) / n, kinds.count(2) / n,
            sum(c in "aeiou" for c in lowered) / n, float(all(c in "0123456789abcdef" for c in lowered)),
            self.covered(value), float(value.count("/")), float(value.count(".")),
            float(bool(_ADDRESS.search(value))), float(before.rstrip(" \"'`").endswith(("=", ":"))),
            float(any(w in NAMES for w in words)), float(any(w in DECOYS for w in words)),
            float(sum(c.isupper() for c in before) > sum(c.islower() for c in before)),
        ]


def candidates(docs: DataFrame, path: str = P.MODEL) -> DataFrame:
    """(id, start, n_chars, kind, digest, rule, features): every string that could be a secret.

    kind: the pattern that found it; rule: the label by rule (1 secret, 0 not).
    """
    sent = docs.sparkSession.sparkContext.broadcast(P.load(path))

    def rows(batch: dict[str, list], ready: list = []) -> Iterator[tuple]:  # noqa: B006
        if not ready:  # once for each task
            ready.append(Describer(sent.value))
        for key, text in zip(batch["id"], batch["text"], strict=True):
            for start, value in places(text or ""):
                before = text[max(0, start - 60):start]
                kind = "format" if _KNOWN.match(value) else "assigned" if _NAME.search(before) else "string"
                yield (key, start, len(value), kind, hashlib.sha256(value.encode()).hexdigest(),
                       float(rule_label(value, before)), ready[0].features(value, before))

    return C.map_rows(docs.select(C.id_of(docs), docs["text"].alias("text")), rows,
                      "id bigint, start int, n_chars int, kind string, digest string, rule double, "
                      "features array<double>")


def assigned(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, bare) of the values assigned to credential names; bare: without quotes.

    A value may hold assignments itself; then the value of the innermost one counts, which ends the others too.
    Names that follow one another share the search for the end, so the work is in proportion to the text.
    """
    found: list[tuple[int, int, bool]] = []
    ends: dict[str, tuple[int, int]] = {}
    for m in _ASSIGNED.finditer(text):
        quote = text[m.end():m.end() + 1]
        quote = quote if quote in _ENDS else ""
        start = m.end() + len(quote)
        known = ends.get(quote)
        if known and known[0] <= start <= known[1]:
            end = known[1]
        else:
            stop = _ENDS[quote].search(text, start)
            end = stop.start() if stop else len(text)
            ends[quote] = (start, end)
        if end - start >= SHORTEST:
            if found and start < found[-1][1]:
                found.pop()
            found.append((start, end, not quote))
    return found


def places(text: str) -> list[tuple[int, str]]:
    """(start, value) of all candidates of a text, by start."""
    found = {m.start(): m.group().rstrip(".") for m in _CANDIDATE.finditer(text)}
    strings = list(found)
    for start, end, bare in assigned(text):
        value = text[start:end]
        if bare and len(found.get(start, "")) >= len(value.rstrip(".,;)]}>")):
            continue  # without quotes, marks behind the string belong to the sentence
        for k in strings[bisect_left(strings, start):bisect_left(strings, end)]:
            # parts of the value; a known format inside it is a finding of its own
            if k in found and k + len(found[k]) <= end and not _KNOWN.match(found[k]):
                del found[k]
        found.setdefault(start, value)
    return sorted(found.items())


def rule_label(value: str, before: str) -> bool:
    """A known format, or a value of digits and letters that is assigned to the name of a credential."""
    if _KNOWN.match(value):
        return True
    mixed = sum(c.isdigit() for c in value) >= 3 and any(c.isalpha() for c in value)
    return bool(_NAME.search(before)) and mixed and len(set(value)) >= 8 and not _ADDRESS.search(value)


def scored(found: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """`found` with `probability` (of a secret) and `is_secret`."""
    if labelled is None:
        known = found.select("digest", "features", F.col("rule").alias("label"))
    else:
        known = found.join(labelled.select(labelled["doc_id"].cast("long").alias("id"), F.sha2("value", 256).alias("digest"),
                                           labelled["secret"].cast("double").alias("label")), ["id", "digest"])
    # as many of either kind as the bound allows, so that rare secrets are learned from; copies count once
    known = known.dropDuplicates(["digest", "features", "label"])
    order = F.xxhash64("digest", "features")
    half = [known.where(F.col("label") == k).orderBy(order).limit(sample // 2) for k in (0.0, 1.0)]
    training = C.written(half[0].unionByName(half[1]).withColumn("features", array_to_vector("features")), "secret-sample")
    kinds = [r["label"] for r in training.select("label").distinct().collect()]
    if len(kinds) < 2:
        only = kinds[0] if kinds else 0.0
        return found.withColumns({"probability": F.lit(only), "is_secret": F.lit(only == 1.0)})
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features",
                                   labelCol="label").fit(training)
    out = model.transform(found.withColumnRenamed("features", "numbers").withColumn(
        "features", array_to_vector("numbers")))
    probability = vector_to_array("probability")[1]
    return out.select(*(F.col("numbers").alias(c) if c == "features" else c for c in found.columns),
                      probability.alias("probability"), (probability >= 0.5).alias("is_secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, path: str = P.MODEL) -> DataFrame:
    """One row per finding that the forest keeps."""
    found = C.written(candidates(docs, path), "secret-candidates")
    kept = scored(found, labelled).where("is_secret")
    return kept.select(C.true_id("id"), F.col("start").cast("long").alias("start"),
                       F.col("n_chars").cast("long").alias("n_chars"), "kind", "digest",
                       F.round("probability", 4).alias("probability"))
