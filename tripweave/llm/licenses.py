r"""License scans: ordered signature rules behind a keyword filter, and base phrases.

A rule has a label, a weight and a pattern. One automaton looks for the rules' keywords; a rule's
pattern runs only on texts with its keyword. Detections overlap: going by weight, one that lies within a
detection of the same or a higher weight is suppressed, so "MIT License" inside an MIT header, or a
name inside a full sentence, is not counted beside it. Base phrases are counted apart, at every place
where their words stand consecutively, and their labels always stay.

Score: the highest weight of the detections left, 0.5 at least where a base phrase stands, else 0.

All work is within the row. Defined results: a null text is empty and has no words; repeated rows are
scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripweave.llm import common as C
from tripweave.llm.license_rules import NAMES, SENTENCES

# Base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
_GAP = r"[^0-9a-z\x80-\U0010ffff]+"
_NOT_WORD = bytes(c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class Rule:
    label: str
    weight: int
    keywords: tuple[str, ...]
    pattern: str


def rules() -> list[Rule]:
    """All rules, the heaviest first; of equal weight, in the order in which they are written."""
    out = []
    for label, name, tags, address in NAMES:
        out.append(Rule(label, 100, ("spdx",), rf"spdx license identifier (?:\()?{tags}(?![\w.+-])"))
        out.append(Rule(label, 80, (_literal(address),), address))
        word = _literal(name)
        out.append(Rule(label, 60, (word,) if len(word) > 3 else ("cc", "creative"), name))
    out += [Rule(label, weight, (word,), sentence) for label, weight, word, sentence in SENTENCES]
    return sorted(out, key=lambda r: -r.weight)


def _literal(pattern: str) -> str:
    """The longest word that every match of a pattern holds: what stands outside groups and classes."""
    plain = re.sub(r"\\([.+])", r"\1", pattern)
    while (bare := re.sub(r"\((?:\?:)?[^()]*\)[?*+]?", " | ", plain)) != plain:
        plain = bare
    plain = re.sub(r"\[[^\]]*\]|\\S\+|.\?", "|", plain)
    return max(re.split(r"[| ()]+", plain), key=len)


def compiled(pattern: str) -> re.Pattern[str]:
    """Blanks become gaps; a match begins and ends at the edge of a word."""
    body = pattern.replace(" ?", rf"(?:{_GAP})?").replace(" ", _GAP)
    return re.compile(rf"(?<![0-9a-z\x80-\U0010ffff]){body}(?![0-9a-z\x80-\U0010ffff])", re.S)


class Scanner:
    """The rules, compiled once for each task."""

    def __init__(self) -> None:
        import ahocorasick

        self.rules = rules()
        self._patterns = [compiled(r.pattern) for r in self.rules]
        by_word: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            for word in rule.keywords:
                by_word.setdefault(word, []).append(k)
        self._finder = ahocorasick.Automaton()
        for word, at in by_word.items():
            self._finder.add_word(word, at)
        self._finder.make_automaton()

    def detections(self, lowered: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) of the detections that are left after suppression, by start."""
        nominated = {k for _, at in self._finder.iter(lowered) for k in at}
        found = [(m.start(), m.end(), k) for k in nominated for m in self._patterns[k].finditer(lowered)]
        # one that contains another begins first, or ends later; of equal ones the first rule stays
        found.sort(key=lambda d: (d[0], -d[1], d[2]))
        kept, reach = [], {}
        for start, end, k in found:
            weight = self.rules[k].weight
            if any(w >= weight and e >= end for w, e in reach.items()):
                continue
            kept.append((start, end, k))
            reach[weight] = max(reach.get(weight, 0), end)
        # a light detection may have come before a heavy one of the same place
        heavy = {}
        for start, end, k in kept:
            heavy[start, end] = max(heavy.get((start, end), 0), self.rules[k].weight)
        return [d for d in kept if self.rules[d[2]].weight == heavy[d[0], d[1]]]


def _ascii_lower(text: str | None) -> str:
    return (text or "").encode().lower().decode()


def base_places(lowered: str) -> tuple[int, list[tuple[int, str]]]:
    """(number of words, [(first word, label)] of all base phrases) of a text."""
    words = lowered.encode().translate(_NOT_WORD).split()
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in BASE:
        wanted = f" {phrase} ".encode()
        at, before, word = joined.find(wanted), 0, 0
        while at >= 0:
            word += joined.count(b" ", before, at)  # words since the last place
            found.append((word, label))
            before, at = at, joined.find(wanted, at + 1)
    return len(words), sorted(found)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base places, labels, score."""
    def rows(batch: dict[str, list], ready: list = []) -> Iterator[tuple]:  # noqa: B006
        if not ready:  # once for each task
            ready.append(Scanner())
        scanner = ready[0]
        for key, text in zip(batch["id"], batch["text"], strict=True):
            lowered = _ascii_lower(text)
            n, base = base_places(lowered)
            kept = scanner.detections(lowered)
            base_labels = {label for _, label in base}
            labels = base_labels | {scanner.rules[k].label for _, _, k in kept}
            score = max([scanner.rules[k].weight / 100 for _, _, k in kept] + [0.5] * bool(base) + [0.0])
            yield (key, n, len(base), base[0][0] if base else None, base[-1][0] if base else None,
                   ",".join(sorted(base_labels)), ",".join(sorted(labels)), score)

    return C.map_rows(docs.select(C.id_of(docs), docs["text"].alias("text")), rows,
                      "id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                      "base_labels string, labels string, score double").select(
        C.true_id("id"), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def detections(docs: DataFrame) -> DataFrame:
    """(doc_id, label, weight, start, end): every detection that is left, in characters of the text."""
    def rows(batch: dict[str, list], ready: list = []) -> Iterator[tuple]:  # noqa: B006
        if not ready:
            ready.append(Scanner())
        for key, text in zip(batch["id"], batch["text"], strict=True):
            for start, end, k in ready[0].detections(_ascii_lower(text)):
                yield key, ready[0].rules[k].label, ready[0].rules[k].weight, start, end

    return C.map_rows(docs.select(C.id_of(docs), docs["text"].alias("text")), rows,
                      "id bigint, label string, weight int, start int, end int").select(
        C.true_id("id"), "label", "weight", "start", "end")
