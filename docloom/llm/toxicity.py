"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples lie in an inverted index whose postings are cut into blocks of examples, each
with its largest weight.  The blocks' bounds for a text decide which blocks are scored:
best bound first, until no bound reaches the k-th similarity found.  Neighbours vote by
their similarity, and the vote is calibrated on the examples themselves, each one scored
by the others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared, isotonic, labelled_sample, slices
from docloom.session import materialize

#: Most labelled rows that are learned from; a hash of the id chooses them if there are more.
MOST_EXAMPLES = 20_000
#: Most terms of the model, and what a term must reach: chi-squared with the label, marked rows and their share.
MOST_TERMS, LEAST_CHI, LEAST_ROWS, LEAST_SHARE = 4096, 30.0, 3, 0.005
NEIGHBOURS = 25
THRESHOLD = 0.3
BLOCK = 64
#: Terms of a word: the word and its first 4, 5 and 6 letters.
PREFIXES = (4, 5, 6)
#: Distinct words a task remembers at a time.
MOST_KNOWN = 150_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(word: str) -> set[str]:
    return {word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)}


@dataclass
class Index:
    """Postings by term over examples 0..n-1, in blocks; all arrays are bounded by the examples' number."""

    n: int
    docs: list[np.ndarray]  # per term: examples, ascending
    weights: list[np.ndarray]
    most: np.ndarray  # per term and block: the largest weight

    @classmethod
    def of(cls, vectors: list[dict[int, float]], terms: int) -> Index:
        docs: list[list[int]] = [[] for _ in range(terms)]
        weights: list[list[float]] = [[] for _ in range(terms)]
        for i, vector in enumerate(vectors):
            for term, weight in vector.items():
                docs[term].append(i)
                weights[term].append(weight)
        found = [np.array(d, np.int64) for d in docs]
        most = np.zeros((terms, -(-len(vectors) // BLOCK)))
        for term, d in enumerate(found):
            np.maximum.at(most[term], d // BLOCK, weights[term])
        return cls(len(vectors), found, [np.array(w) for w in weights], most)

    def _score(self, scores: np.ndarray, vector: dict[int, float], wanted: np.ndarray) -> None:
        """Add the similarities of all examples in the ``wanted`` blocks."""
        for term, weight in vector.items():
            docs = self.docs[term]
            taken = wanted[docs // BLOCK]
            scores[docs[taken]] += weight * self.weights[term][taken]

    def nearest(self, vector: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of largest positive similarity, as (similarity, example); ties to the smaller number.

        The blocks of best bound, enough for k examples, are scored first; then all
        blocks whose bound reaches the k-th similarity among those.
        """
        bound = np.array(list(vector.values())) @ self.most[list(vector)]
        order = np.argsort(-bound, kind="stable")
        scores = np.zeros(self.n)
        first = np.zeros(len(bound), bool)
        first[order[: 1 + k // 8]] = True
        self._score(scores, vector, first)
        if without >= 0:
            scores[without] = 0
        floor = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        rest = ~first & (bound > 0) & (bound >= floor - 1e-9)
        if rest.any():
            self._score(scores, vector, rest)
            if without >= 0:
                scores[without] = 0
            floor = np.partition(scores, -k)[-k] if len(scores) >= k else 0.0
        found = np.flatnonzero((scores > 0) & (scores >= floor - 1e-9))
        hits = [(round(float(scores[i]), 12), int(i)) for i in found]
        return sorted(hits, key=lambda h: (-h[0], h[1]))[:k]


@dataclass
class Model:
    """What is learned; its size is bounded by MOST_EXAMPLES and MOST_TERMS."""

    terms: dict[str, int]
    idf: np.ndarray
    index: Index
    labels: np.ndarray
    ids: np.ndarray
    knots: np.ndarray = field(default_factory=lambda: np.zeros(1))  # calibration: vote -> score
    values: np.ndarray = field(default_factory=lambda: np.zeros(1))
    rest: float = 0.0  # score of texts without any known term
    known: set[str] = field(default_factory=set)  # words that a Python process has looked at
    hits: dict[str, list[int]] = field(default_factory=dict)  # those with terms
    scored: dict[tuple, tuple] = field(default_factory=dict)

    def counts(self, text: str | None) -> Counter:
        """How often each term occurs in a text."""
        words = words_of(text)
        distinct = set(words)
        fresh = distinct - self.known
        if fresh:
            if len(self.known) > MOST_KNOWN:
                self.known, self.hits, fresh = set(), {}, distinct
            # A quick look at the stems first: almost no word has a term.
            stems = self.terms
            for w in fresh:
                if w in stems or w[:4] + "*" in stems or w[:5] + "*" in stems or w[:6] + "*" in stems:
                    self.hits[w] = [stems[t] for t in terms_of(w) if t in stems]
            self.known |= fresh
        found: Counter = Counter()
        hit = {w for w in distinct if w in self.hits}
        for word, n in Counter(filter(hit.__contains__, words)).items() if hit else ():
            for term in self.hits[word]:
                found[term] += n
        return found

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, float, bool]]]:
        """Score and nearest examples; texts with the same terms are scored once."""
        counts = self.counts(text)
        key = tuple(sorted(counts.items()))
        if key not in self.scored:
            if len(self.scored) > 10_000:
                self.scored = {}
            value, near = self.score(self.vector(counts))
            self.scored[key] = value, [(int(self.ids[i]), s, bool(self.labels[i])) for s, i in near[:3]]
        return self.scored[key]

    def vector(self, counts: Counter) -> dict[int, float]:
        raw = {t: (1 + math.log(n)) * self.idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        return {t: float(w / norm) for t, w in sorted(raw.items())}

    def vote(self, near: list[tuple[float, int]]) -> float:
        total = sum(s for s, _ in near)
        return sum(s for s, i in near if self.labels[i]) / total if total else 0.0

    def score(self, vector: dict[int, float]) -> tuple[float, list[tuple[float, int]]]:
        near = self.index.nearest(vector, NEIGHBOURS) if vector else []
        if not near:
            return self.rest, near
        return float(np.interp(self.vote(near), self.knots, self.values)), near


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """Learn the model from labelled rows (runs jobs).

    Term counts are summed by Spark over the chosen rows; what comes to the driver is the
    chosen terms and, per row, its known terms.
    """
    chosen = materialize(labelled_sample(docs, labels, MOST_EXAMPLES, id_column, text_column, label_column), "examples")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[Counter] = [Counter(), Counter()]

        def flush() -> pa.RecordBatch:
            terms = sorted({*rows[0], *rows[1]})
            columns = [terms, [rows[0][t] for t in terms], [rows[1][t] for t in terms]]
            rows[:] = [Counter(), Counter()]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["term", "clean", "marked"])

        for batch in slices(batches, "text"):
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows[label > 0].update(set().union(*map(terms_of, set(words_of(text)))))
            if len(rows[0]) + len(rows[1]) > MOST_KNOWN:
                yield flush()
        yield flush()

    one_each = chosen.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("id").alias("id"))  # copies count once
    single = chosen.join(one_each.select("id"), "id", "left_semi")
    totals = {r["label"] > 0: r["n"] for r in single.groupBy((F.col("label") > 0).alias("label")).agg(F.count("*").alias("n")).collect()}
    marked, clean = totals.get(True, 0), totals.get(False, 0)
    terms, idf = {}, np.zeros(0)
    if marked and clean:
        counted = single.select("id", "text", "label").mapInArrow(count, "term string, clean long, marked long")
        counted = counted.groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("marked").alias("marked"))
        share = (F.col("clean") + F.col("marked")) / (clean + marked)
        gap = F.col("marked") / marked - F.col("clean") / clean
        chi = gap * gap / (share * (1 - share)) / (1 / marked + 1 / clean)
        least = max(LEAST_ROWS, LEAST_SHARE * marked)
        picked = counted.where((F.col("marked") >= least) & (gap > 0) & (share < 1)).withColumn("chi", chi)
        picked = picked.where(F.col("chi") >= LEAST_CHI).orderBy(F.desc("chi"), "term").limit(MOST_TERMS).collect()
        terms = {r["term"]: i for i, r in enumerate(picked)}
        idf = np.array([math.log((1 + clean + marked) / (1 + r["clean"] + r["marked"])) + 1 for r in picked])

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(terms, idf, Index.of([], 0), np.zeros(0, bool), np.zeros(0, np.int64))
        for batch in slices(batches, "text"):
            found = [own.counts(x) for x in batch.column(1).to_pylist()]
            keys = pa.array([list(c) for c in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), keys, pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["id", "label", "terms", "counts"])

    rows = single.select("id", "text", "label").mapInArrow(sparse, "id long, label int, terms array<int>, counts array<int>").collect()
    model = Model(terms, idf, Index.of([], len(terms)), np.zeros(0, bool), np.zeros(0, np.int64))
    with_terms = [(r, model.vector(Counter(dict(zip(r["terms"], r["counts"], strict=True))))) for r in rows if r["terms"]]
    with_terms.sort(key=lambda x: (sorted(x[1], key=lambda t: -x[1][t])[:2], x[0]["id"]))  # like examples share blocks
    model.labels = np.array([r["label"] > 0 for r, _ in with_terms], bool)
    model.ids = np.array([r["id"] for r, _ in with_terms], np.int64)
    model.index = Index.of([v for _, v in with_terms], len(terms))
    without = [r["label"] > 0 for r in rows if not r["terms"]]
    prior = (marked + 1) / (marked + clean + 2)
    model.rest = (sum(without) + prior) / (len(without) + 1)
    votes = np.array([model.vote(model.index.nearest(v, NEIGHBOURS, without=i)) for i, (_, v) in enumerate(with_terms)])
    if len(votes):
        model.knots, model.values = isotonic(votes, model.labels.astype(float))
    return model


def score_toxicity(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted, evidence.

    ``held_out`` tells whether a label of the row could not have been learned.  ``score``
    is the calibrated vote of the 25 nearest examples; a text without any term of the
    model (null, empty and white texts among them) gets the share of marked examples
    among the examples without one.  ``evidence`` holds up to three nearest examples
    (id, similarity, marked).  Repeated rows score alike.  A null id has null ``held_out``.
    No other column is read; an empty table gives no rows.
    """
    shared = Shared(docs.sparkSession, model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in slices(batches, "text"):
            judged = [own.judge(x) for x in batch.column(1).to_pylist()]
            scores = [value for value, _ in judged]
            evidence = [[{"doc_id": i, "similarity": s, "marked": m} for i, s, m in near] for _, near in judged]
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("marked", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["doc_id", "score", "evidence"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    scored = texts.mapInArrow(scan, "doc_id long, score double, evidence array<struct<doc_id:long,similarity:double,marked:boolean>>")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "evidence")


def without_toxic(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, judged and filtered in one scan; columns stay."""
    shared = Shared(docs.sparkSession, model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in slices(batches, text_column):
            texts = batch.column(batch.schema.get_field_index(text_column)).to_pylist()
            yield batch.filter(pa.array([own.judge(x)[0] < THRESHOLD for x in texts]))

    return docs.mapInArrow(scan, docs.schema)
