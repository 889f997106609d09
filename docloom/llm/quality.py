"""Quality by supervised subword embeddings.

Words, their character n-grams and repeats of the word before are hashed to buckets;
each bucket has a learned vector, a text is the average of its vectors, and a softmax
layer tells the classes apart.  Training is stochastic gradient descent in numpy on a
bounded sample.  As the model is linear in the vectors, scoring needs one number per
bucket: its vector times the difference of the two output rows.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared, isotonic, labelled_sample, slices

#: Most labelled rows that are learned from; a hash of the id chooses them if there are more.
MOST_EXAMPLES = 4000
BUCKETS, DIMENSIONS = 1 << 16, 8
NGRAMS = (3, 4)
EPOCHS, BATCH, RATE = 12, 16, 60.0
THRESHOLD = 0.7
#: Distinct words whose sums a Python process remembers; the first half stays.
MOST_KNOWN = 300_000
#: Bucket 0 is kept for "the word before, once more".
_REPEAT = 0


def buckets_of(word: str) -> list[int]:
    """The buckets of a word and of its n-grams, begin and end marked."""
    marked = f"<{word}>".encode("utf-8", "surrogatepass")
    grams = [marked[i : i + n] for n in NGRAMS for i in range(len(marked) - n + 1)]
    return [1 + zlib.crc32(g) % (BUCKETS - 1) for g in [marked, *grams]]


def _repeats(words: list[str]) -> int:
    return sum(map(operator.eq, words, islice(words, 1, None)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs."""
    words = (text or "").split()
    found: Counter = Counter()
    for word, n in Counter(words).items():
        for bucket in buckets_of(word):
            found[bucket] += n
    if again := _repeats(words):
        found[_REPEAT] += again * 4
    return np.array(list(found), np.int32), np.array(list(found.values()), np.int32)


@dataclass
class Model:
    """One number per bucket, the bias, and the calibration; bounded by BUCKETS."""

    weight: np.ndarray
    bias: float
    knots: np.ndarray
    values: np.ndarray
    known: dict[str, tuple[float, int]] = field(default_factory=dict)

    def logit(self, text: str | None) -> float:
        words = (text or "").split()
        total, n = 0.0, 0
        known = self.known
        for word, count in Counter(words).items():
            got = known.get(word)
            if got is None:
                buckets = buckets_of(word)
                got = known[word] = float(self.weight[buckets].sum()), len(buckets)
            total += got[0] * count
            n += got[1] * count
        again = _repeats(words) * 4
        total, n = total + again * float(self.weight[_REPEAT]), n + again
        if len(known) > MOST_KNOWN:
            self.known = dict(islice(known.items(), MOST_KNOWN // 2))
        return total / n + self.bias if n else self.bias

    def score(self, text: str | None) -> float:
        return float(np.interp(self.logit(text), self.knots, self.values))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Embeddings and output by stochastic gradient descent; returns what ``Model`` needs of them."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (DIMENSIONS, BUCKETS))
    output, bias = random.normal(0, 0.5, (DIMENSIONS, 2)), np.zeros(2)
    steps, step = EPOCHS * -(-len(rows) // BATCH), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            chosen = order[at : at + BATCH]
            rate = RATE * (1 - step / steps)
            step += 1
            ids = np.concatenate([rows[i][0] for i in chosen])
            share = np.concatenate([rows[i][1] / max(1, rows[i][1].sum()) for i in chosen])
            doc = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            hidden = np.stack([np.bincount(doc, share * v[ids], len(chosen)) for v in vectors], axis=1)
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - np.eye(2)[labels[chosen]]) / len(chosen)
            back = error @ output.T
            output -= rate / 60 * hidden.T @ error
            bias -= rate / 60 * error.sum(axis=0)
            for d in range(DIMENSIONS):
                vectors[d] -= rate * np.bincount(ids, share * back[doc, d], BUCKETS)
    difference = output[:, 1] - output[:, 0]
    return (difference @ vectors).astype(np.float64), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """Learn the model from labelled rows (runs jobs).

    Of at most about MOST_EXAMPLES rows the driver gets their buckets, at most BUCKETS
    each.  Four fifths of them train the vectors; the rest calibrate the score.
    """
    chosen = labelled_sample(docs, labels, MOST_EXAMPLES, id_column, text_column, label_column)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [features(x) for x in batch.column(1).to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["id", "label", "buckets", "counts"])

    got = chosen.mapInArrow(scan, "id long, label int, buckets array<int>, counts array<int>").toArrow()
    rows, marked, ids = [], [], []
    for batch in got.to_batches():
        ids += batch.column(0).to_pylist()
        marked += batch.column(1).to_pylist()
        for b, c in zip(batch.column(2), batch.column(3), strict=True):
            rows.append((b.values.to_numpy(), c.values.to_numpy()))
    order = np.argsort(ids, kind="stable")
    rows, target = [rows[i] for i in order], np.array([int(marked[i] > 0) for i in order], np.int64)
    if not len(rows):
        return Model(np.zeros(BUCKETS), 0.0, np.zeros(1), np.array([0.5]))
    check = np.arange(len(rows)) % 5 == 0
    weight, bias = train([r for r, c in zip(rows, check, strict=True) if not c], target[~check])
    logits = np.array([(weight[b] * c).sum() / max(1, c.sum()) + bias for b, c in rows])
    pick = check if check.sum() >= 20 else np.ones(len(rows), bool)
    return Model(weight, bias, *isotonic(logits[pick], target[pick].astype(float)))


def score_quality(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted.

    ``held_out`` tells whether a label of the row could not have been learned.  Null,
    empty and white texts have no features and score by the bias alone.  Repeated rows
    score alike; a null id has null ``held_out``.  No other column is read; an empty
    table gives no rows.  Nothing is shuffled.
    """
    shared = Shared(docs.sparkSession, model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in slices(batches, "text"):
            scores = [own.score(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    scored = texts.mapInArrow(scan, "doc_id long, score double")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
