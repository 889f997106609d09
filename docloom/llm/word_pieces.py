"""Token counts by greedy longest match, in time linear in the text.

An automaton over the vocabulary's trie keeps, per node, what a mismatch does: the node
to go on from (the failure link) and how many pieces are finished on the way (the
popped-token count).  Walking a word once adds up its number of pieces; the pieces
themselves are never built.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared, slices

#: Words whose counts a Python process remembers; the first half stays.
MOST_KNOWN = 300_000
#: Words are runs of letters and digits, or single other signs.
WORD = r"\w+|[^\w\s]"
#: Marks the end of a word in the vocabulary.
END = "</w>"


def read_pieces(path: str) -> list[str]:
    """The pieces of a BPE vocabulary file (JSON) whose last piece of a word ends in ``</w>``.

    The file writes bytes as printable signs; pieces come back as one sign per byte, with
    the end mark as sign 256.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    # Printable Latin-1 signs stand for themselves, the other bytes for the signs from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): chr(b) for b in plain}
    signs |= {chr(256 + i): chr(b) for i, b in enumerate(b for b in range(256) if b not in plain)}
    found = []
    for piece in vocabulary:
        body, mark = (piece[: -len(END)], chr(256)) if piece.endswith(END) else (piece, "")
        if body and all(c in signs for c in body):
            found.append("".join(signs[c] for c in body) + mark)
    return found


class Automaton:
    """Longest-match counting for a vocabulary of pieces."""

    def __init__(self, pieces: Iterable[str]) -> None:
        self.go: list[dict[str, int]] = [{}]
        last = [False]
        for piece in pieces:
            node = 0
            for sign in piece:
                following = self.go[node].get(sign)
                if following is None:
                    following = self.go[node][sign] = len(self.go)
                    self.go.append({})
                    last.append(False)
                node = following
            last[node] = bool(piece)
        # failure -1: no piece begins the pending signs, so the word cannot be cut.
        self.failure, self.popped = [-1] * len(self.go), [0] * len(self.go)
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for sign, child in self.go[node].items():
                if last[child]:
                    self.failure[child], self.popped[child] = 0, 1
                else:
                    at, finished = self.failure[node], self.popped[node]
                    while at >= 0 and sign not in self.go[at]:
                        finished += self.popped[at]
                        at = self.failure[at]
                    if at >= 0:
                        self.failure[child], self.popped[child] = self.go[at][sign], finished
                queue.append(child)
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of one word (signs 0-256); 1 if greedy longest match cannot cut it."""
        node, pieces = 0, 0
        for sign in word:
            while sign not in self.go[node]:
                if self.failure[node] < 0:
                    return 1
                pieces += self.popped[node]
                node = self.failure[node]
            node = self.go[node][sign]
        while node:
            if self.failure[node] < 0:
                return 1
            pieces += self.popped[node]
            node = self.failure[node]
        return pieces

    def learn(self, words: set[str]) -> None:
        if len(self.known) > MOST_KNOWN:
            self.known = dict(islice(self.known.items(), MOST_KNOWN // 2))
        for word in words:
            if word not in self.known:
                self.known[word] = self.count(word.encode("utf-8", "surrogatepass").decode("latin-1") + chr(256))


def count_tokens(docs: DataFrame, automaton: Automaton, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Words and greedy word pieces of every whole text: doc_id, n_words, n_pieces.

    Texts are lower-cased and cut into runs of letters and digits and single other signs;
    white space counts nothing.  A word that greedy longest match cannot cut counts as one
    piece (unknown).  Null, empty and white texts have no words.  Repeated rows count
    alike; other columns are not read; an empty table gives no rows.  Nothing is shuffled.
    """
    shared = Shared(docs.sparkSession, automaton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, split = shared.get(), re.compile(WORD).findall
        for batch in slices(batches, "text", 4 << 20):
            texts = [split((x or "").lower()) for x in batch.column(1).to_pylist()]
            own.learn(set().union(*texts))
            pieces = [sum(map(own.known.__getitem__, words)) for words in texts]
            columns = [pa.array(x, pa.int64()) for x in (list(map(len, texts)), pieces)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_pieces"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(scan, "doc_id long, n_words long, n_pieces long")
