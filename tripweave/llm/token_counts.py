r"""Token counts: the number of tokens of each document under a unigram segmentation.

Per batch of documents, the distinct pre-tokens go into a trie. The forward score of a node (the best
sum of piece scores that spells its prefix) and the number of tokens on that path depend on the prefix
alone, so they are computed once for all pre-tokens that share it. The trie is walked in sorted order:
going from one pre-token to the next keeps the nodes of their common prefix and computes the others.
Terminal nodes store their token count, and a document's count is the sum over its pre-tokens.

Everything stays in the task that reads the documents: nothing is shuffled, and a task holds the
terminals of a bounded number of pre-tokens. Pre-tokens, scores and ties are those of `pieces`.

Defined results: null and empty texts have no pre-token and no token; rows that repeat get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame

from tripweave.llm import common as C
from tripweave.llm import pieces as P

TERMINALS = 300_000


class Trie:
    """Terminal counts of pre-tokens. Only the nodes on the way to the current pre-token are held."""

    def __init__(self, known: P.Pieces) -> None:
        self._known = known
        self.nodes = 0

    def terminals(self, distinct: list[str]) -> dict[str, int]:
        """Token counts of distinct pre-tokens."""
        scores, longest, unknown = self._known.scores, self._known.longest, self._known.unknown
        forward, tokens, before, out = [0.0], [0], "", {}
        for word in sorted(distinct):
            shared, limit = 0, min(len(before), len(word))
            while shared < limit and before[shared] == word[shared]:
                shared += 1
            del forward[shared + 1:], tokens[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                char = word[end - 1]
                top, count = forward[end - 1] + unknown, tokens[end - 1] + len(char.encode())
                for start in range(end - 1, max(-1, end - 1 - longest), -1):
                    score = scores.get(word[start:end])
                    if score is not None and forward[start] + score >= top:
                        top, count = forward[start] + score, tokens[start] + 1
                forward.append(top)
                tokens.append(count)
                self.nodes += 1
            out[word] = tokens[-1]
            before = word
        return out


def counts(docs: DataFrame, path: str = P.MODEL) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(P.load(path))

    def rows(batch: dict[str, list], terminals: dict[str, int] = {}) -> Iterator[tuple]:  # noqa: B006
        # the default lives as long as the task: frequent pre-tokens are inserted once
        if len(terminals) > TERMINALS:
            terminals.clear()
        texts = [P.units_of(text or "") for text in batch["text"]]
        new = {unit for units in texts for unit in units} - terminals.keys()
        terminals.update(Trie(sent.value).terminals(list(new)))
        for key, units in zip(batch["id"], texts, strict=True):
            yield key, len(units), sum(map(terminals.__getitem__, units))

    return C.map_rows(docs.select(C.id_of(docs), docs["text"].alias("text")), rows,
                      "id bigint, n_pretokens bigint, n_tokens bigint").select(
        C.true_id("id"), "n_pretokens", "n_tokens")
