"""Token counts by a unigram vocabulary, scored once per shared prefix.

Pre-tokens are the runs without white space, each with the word mark before it. A task keeps the
pre-tokens it has met in a trie. A node's forward score is the best score of any split of the path to it
into vocabulary pieces, with the number of pieces; it depends on the path alone, so all pre-tokens that
share a prefix share its scores, and a repeated pre-token is one look-up. A node is a number, so a prefix
costs the same at any length. When nodes and kept pre-tokens reach ``NODES`` the trie starts afresh, within a
text too; a pre-token of more than ``LONG`` characters is scored over the last places alone and not kept.
Both bound memory and change no count.

Scores are log probabilities of the pieces by Zipf's law over their rank in the vocabulary file; a
character in no piece costs its UTF-8 bytes, one token each at ``BYTE`` nats. Between splits of one
score, the one with fewer tokens counts. NULL, empty and blank texts have no tokens; repeated rows are
counted each by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
NODES = 1_500_000
LONG = 64
BYTE = -25.0


@lru_cache(maxsize=1)
def vocabulary(path: str) -> tuple[dict[str, float], int]:
    """Log probability of each piece, and the longest piece."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (rank + 1) for rank in range(len(pieces))))
    scores = {piece: -math.log(rank + 1) - total for rank, piece in enumerate(pieces)}
    return scores, max(map(len, scores), default=0)


class Trie:
    """Forward scores of every prefix met: (score, minus the number of tokens) of each node."""

    def __init__(self, scores: dict[str, float], longest: int) -> None:
        self.scores, self.longest = scores, longest
        self.children: dict[int, int] = {}  # node and character -> node
        self.nodes: list[tuple[float, int]] = [(0.0, 0)]
        self.words: dict[str, tuple[float, int]] = {}

    def best(self, word: str) -> tuple[float, int]:
        found = self.words.get(word)
        if found:
            return found
        if len(word) > LONG:
            return self._rolled(word)
        if len(self.nodes) + len(self.words) >= NODES:
            self.children.clear()
            self.words.clear()
            del self.nodes[1:]
        children, nodes, node, path = self.children, self.nodes, 0, [(0.0, 0)]
        for end, char in enumerate(word, 1):
            edge = node << 21 | ord(char)
            child = children.get(edge)
            if child is None:
                child = children[edge] = len(nodes)
                nodes.append(self._step(word, end, path[-self.longest :]))
            path.append(nodes[child])
            node = child
        self.words[word] = path[-1]
        return path[-1]

    def _rolled(self, word: str) -> tuple[float, int]:
        path = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            path.append(self._step(word, end, path))
            if len(path) > self.longest:
                del path[0]
        return path[-1]

    def _step(self, word: str, end: int, path: list[tuple[float, int]]) -> tuple[float, int]:
        """The best score of the first ``end`` characters, given those of the prefixes before it, the last ones."""
        score, tokens = path[-1]
        char, scores = word[end - 1], self.scores
        best = (-math.inf, 0)
        if char not in scores:
            n = len(char.encode())
            best = (score + n * BYTE, tokens - n)
        for begin, (score, tokens) in enumerate(path, end - len(path)):
            piece = scores.get(word[begin:end])
            if piece is not None:
                best = max(best, (score + piece, tokens - 1))
        return best


@lru_cache(maxsize=1)
def kept(path: str) -> Trie:
    """The trie of a worker process, kept between its tasks."""
    return Trie(*vocabulary(path))


def count(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, log_probability) of each row's best split."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = kept(path)
        for batch in batches:
            pretokens, tokens, total = [], [], []
            for text in batch.column("text").to_pylist():
                words = (text or "").split()
                best, known = trie.best, trie.words
                found = [known.get(w) or best(w) for w in map(MARK.__add__, words)]
                pretokens.append(len(words))
                tokens.append(-sum(n for _, n in found))
                total.append(math.fsum(s for s, _ in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pretokens, pa.int64()), pa.array(tokens, pa.int64()), pa.array(total, pa.float64())],
                names=["doc_id", "n_pretokens", "n_tokens", "log_probability"],
            )

    return documents.select("doc_id", "text").mapInArrow(score, f"doc_id {id_type}, n_pretokens long, n_tokens long, log_probability double")
