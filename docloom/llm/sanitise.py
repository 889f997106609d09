"""Personal data, and the words that give it away.

Four base patterns find mail addresses, IP addresses, card and phone numbers.  Each value
found is a protected entity.  Words that stand near it are weighed by how much of its
information they disclose in the corpus: pointwise mutual information over information
content, PMI(e; t) / IC(e), for the event "within WINDOW words of e".  A word above the
threshold is generalised to its first letters if those are below it, and removed if not.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import Shared, slices
from docloom.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that count as near.
WINDOW = 8
#: A word with this share of an entity's information discloses it.
DISCLOSURE = 0.8
#: Different contexts that must hold word and entity together; copies of one context count once.
SUPPORT = 3
#: Words shorter or longer than this are no terms.
SHORTEST, LONGEST = 3, 64
#: A term is generalised to so many first letters.
STEM = 4
#: Terms of one broadcast; more are worked off in several passes.
BLOCK_TERMS = 200_000
#: Distinct words a task counts at a time.
MOST_COUNTED = 300_000

_WORD = re.compile(r"\w+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_BEFORE = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
#: Whole dotted runs and whole runs of digits with single separators: every match lies in one, and no place is read twice.
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[Span]:
    """One look per @: only the run of letters before it can start a match, so long runs cost their length once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _BEFORE:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end(), text[start : domain.end()].lower()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _addresses(text: str) -> Iterator[Span]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end, ".".join(p.lstrip("0") or "0" for p in four)
            at = end + 1


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _cards(text: str) -> Iterator[Span]:
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() >= 14:
            digits = _NOT_DIGIT.sub("", run.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield run.start(), run.end(), digits


def _phones(text: str) -> Iterator[Span]:
    for run in _PHONE.finditer(text):
        digits = _NOT_DIGIT.sub("", run.group())
        if 10 <= len(digits) <= 15:
            yield run.start(), run.end(), digits


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = dict(zip(KINDS, (_emails, _addresses, _cards, _phones), strict=True))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's number, end, value) of all matches that pass their checks, by start and kind."""
    found = [(start, k, end, value) for k, kind in enumerate(KINDS) for start, end, value in FINDERS[kind](text)]
    return sorted(found)


def terms_of(word: str) -> tuple[str, ...]:
    """The term of a word (lower case) and the generalised term that holds it."""
    if not SHORTEST <= len(word) <= LONGEST:
        return ()
    return (word, word[:STEM] + "*") if len(word) > STEM else (word,)


def _outside(text: str, spans: list[tuple[int, int, int, str]]) -> list[tuple[int, int]]:
    """Words (start, end) that touch no span."""
    words, at, high = [], 0, -1
    for m in _WORD.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            high = max(high, spans[at][2])
            at += 1
        if high <= m.start():
            words.append(m.span())
    return words


def _masked(text: str, spans: list[tuple[int, int, int, str]]) -> str:
    """The text with blanks for all words that touch a span."""
    pieces, at = [], 0
    for start, _, end, _ in spans:
        low = start
        while low > at and (text[low - 1].isalnum() or text[low - 1] == "_"):
            low -= 1
        while end < len(text) and (text[end].isalnum() or text[end] == "_"):
            end += 1
        if end > at:
            pieces += [text[at : max(low, at)], " "]
            at = end
    return "".join([*pieces, text[at:]])


def contexts(text: str) -> Iterator[tuple[bytes, bytes, str, int]]:
    """(entity, context, term, times) of words near an entity; term "" holds how many words are near.

    Entities and contexts are digests: no personal value leaves the scan.  A word near two
    places of one entity counts once.
    """
    spans = base_spans(text)
    if not spans:
        return
    words = _outside(text, spans)
    starts = np.array([s for s, _ in words], np.int64)
    near: dict[bytes, dict[int, bytes]] = defaultdict(dict)
    for start, kind, _, value in spans:
        entity = hashlib.blake2b(f"{kind}:{value}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        at = int(np.searchsorted(starts, start))
        window = range(max(0, at - WINDOW), min(len(words), at + WINDOW))
        around = " ".join(text[slice(*words[i])] for i in window).lower()
        context = hashlib.blake2b(around.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        for i in window:
            near[entity].setdefault(i, context)
    for entity, places in near.items():
        found: Counter = Counter()
        for i, context in places.items():
            found[context, ""] += 1
            for term in terms_of(text[slice(*words[i])].lower()):
                found[context, term] += 1
        for (context, term), n in found.items():
            yield entity, context, term, n


def _near(texts: DataFrame) -> DataFrame:
    """Co-occurrences: entity, context, term, times."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.binary(), pa.binary(), pa.string(), pa.int64()]
        for batch in slices(batches, "text"):
            rows = [row for x in batch.column(0).to_pylist() if x for row in contexts(x)]
            columns = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["entity", "context", "term", "times"])

    return texts.select("text").mapInArrow(scan, "entity binary, context binary, term string, times long")


def _in_blocks(terms: DataFrame, value: Column) -> Iterator[dict]:
    """All rows (term -> value) of a written table in blocks of about BLOCK_TERMS; at least one block."""
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    slot = F.pmod(F.xxhash64("term"), F.lit(blocks))
    for block in range(blocks):
        yield {r["term"]: r["value"] for r in terms.where(slot == block).select("term", value.alias("value")).toLocalIterator()}


def _occurrences(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each wanted term occurs outside of base spans; term "" holds the number of all words."""

    def pass_of(block: int, known: dict[str, bool]) -> DataFrame:
        shared = Shared(texts.sparkSession, known)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, totals, words = shared.get(), Counter(), Counter()

            def flush() -> pa.RecordBatch:
                for word, n in words.items():
                    for term in terms_of(word.lower()):
                        if term in own:
                            totals[term] += n
                if block == 0:
                    totals[""] += sum(words.values())
                out = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["term", "n"])
                totals.clear()
                words.clear()
                return out

            for batch in slices(batches, "text"):
                for text in batch.column(0).to_pylist():
                    if text:
                        spans = base_spans(text)
                        words.update(_WORD.findall(_masked(text, spans) if spans else text))
                if len(words) > MOST_COUNTED:
                    yield flush()
            yield flush()

        return texts.select("text").mapInArrow(scan, "term string, n long")

    found = None
    for block, known in enumerate(_in_blocks(wanted, F.lit(True))):
        part = pass_of(block, known)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def disclosing_terms(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Terms that disclose an entity: term, disclosure (the largest over entities), written once (runs jobs).

    For a word t and an entity e: p(e) is the share of all words that stand near e, p(e|t)
    that share among the occurrences of t.  IC(e) = -log p(e); PMI = log(p(e|t) / p(e)).
    PMI / IC is 1 where every t stands near e and 0 where they are independent.  Only pairs
    that SUPPORT different contexts hold together are weighed: one address amid words
    that occur nowhere else says nothing.  Generalised terms (first letters and ``*``) are
    weighed like words.
    """
    texts = docs.select(F.col(text_column).alias("text"))
    near = materialize(_near(texts), "near")
    one_each = near.groupBy("entity", "term", "context").agg(F.sum("times").alias("times"))
    pairs = one_each.groupBy("entity", "term").agg(F.sum("times").alias("together"), F.count("*").alias("contexts"))
    pairs = materialize(pairs, "pairs")
    weighed = pairs.where((F.col("term") != "") & (F.col("contexts") >= SUPPORT))
    wanted = materialize(weighed.select("term").distinct(), "terms")
    counted = materialize(_occurrences(texts, wanted), "occurrences")
    words = counted.where("term = ''").select(F.col("n").cast("double").alias("words"))
    total = words.first()
    total = max(1.0, total["words"] if total else 1.0)
    around = pairs.where("term = ''").select("entity", (F.col("together") / F.lit(total)).alias("p"))
    joined = weighed.join(counted.where("term <> ''").hint("rebalance"), "term").join(around.hint("rebalance"), "entity")
    given = F.least(F.col("together") / F.col("n"), F.lit(1.0))
    content = -F.log2(F.least("p", F.lit(1.0)))
    share = F.when(content > 0, F.log2(given / F.col("p")) / content).otherwise(0.0)
    return materialize(joined.groupBy("term").agg(F.max(share).alias("disclosure")), "disclosure")


@dataclass
class Block:
    """Words to hide and what stands for them: a bounded part of all."""

    hide: dict[str, str]


def replacements(weighed: DataFrame, threshold: float = DISCLOSURE) -> DataFrame:
    """Words above the threshold (term) and what stands for them: the generalised term if that is below, else ``*``."""
    over = weighed.where((F.col("disclosure") >= threshold) & ~F.col("term").endswith("*"))
    stems = weighed.where(F.col("term").endswith("*") & (F.col("disclosure") >= threshold)).select(F.col("term").alias("stem"), F.lit(True).alias("tells"))
    stem = F.when(F.char_length("term") > STEM, F.concat(F.substring("term", 1, STEM), F.lit("*")))
    joined = over.withColumn("stem", stem).join(stems, "stem", "left")
    keep = F.when(F.col("stem").isNotNull() & F.col("tells").isNull(), F.col("stem")).otherwise("*")
    return joined.select("term", keep.alias("shown"))


_SPANS = "array<struct<start:int,kind:string,end:int,shown:string>>"


def find_private(docs: DataFrame, hidden: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row doc_id, text and spans: start, kind, end (code points), shown (what stands for it).

    ``hidden`` (term, shown) comes from ``replacements``; if it has more than BLOCK_TERMS
    rows, the scan goes on with further blocks on the same row, so nothing is joined.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("shown", pa.string())]))

    def base(text: str) -> list[dict]:
        return [{"start": s, "kind": KINDS[k], "end": e, "shown": f"[{KINDS[k].upper()}]"} for s, k, e, _ in base_spans(text)]

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans = [base(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], ["doc_id", "text", "spans"])

    def more(shared: Shared) -> Callable:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hide = shared.get().hide
            for batch in slices(batches, "text"):
                out = []
                for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if any(w.lower() in hide for w in set(_WORD.findall(text))):
                        taken = sorted((s["start"], 0, s["end"], "") for s in spans if s["kind"] in KINDS)
                        for start, end in _outside(text, taken):
                            shown = hide.get(text[start:end].lower())
                            if shown is not None:
                                spans.append({"start": start, "kind": "term", "end": end, "shown": shown})
                    out.append(spans)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], ["doc_id", "text", "spans"])

        return scan

    schema = f"doc_id long, text string, spans {_SPANS}"
    found = texts.mapInArrow(first, schema)
    for block in _in_blocks(hidden, F.col("shown")):
        if block:
            found = found.mapInArrow(more(Shared(docs.sparkSession, Block(block))), schema)
    # Base kinds as listed among spans of one start; words touch no base span.
    ordered = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), _rank(s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"), s["shown"].alias("shown")))
    return found.withColumn("spans", F.sort_array(ordered))


def _rank(kind: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int"), F.lit(0)) - 1 + F.when(kind == "term", len(KINDS) + 1).otherwise(0)


def report(found: DataFrame) -> DataFrame:
    """Numbers and places of ``find_private``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    ``spans`` lists kind:start:end by start, then kind as listed, then words (kind term);
    ``base_sha256`` is the digest of that list without words.
    """

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "term")
    digest = F.sha2(listed(base), 256).alias("base_sha256")
    return found.select("doc_id", *[number(kind) for kind in KINDS], digest, listed(F.col("spans")).alias("spans"))


def cleaned(found: DataFrame) -> DataFrame:
    """``find_private`` with clean_text: marks instead of spans; of spans that overlap, the first one's."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                pieces, at = [], 0
                for s in spans:
                    if s["start"] >= at:
                        pieces += [text[at : s["start"]], s["shown"]]
                    at = max(at, s["end"])
                out.append("".join([*pieces, text[at:]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, "clean_text"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return found.mapInArrow(scan, f"{kinds}, clean_text string")


def private_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = DISCLOSURE) -> DataFrame:
    """Personal data and disclosing words of every whole text: ``find_private`` with the corpus' own words (runs jobs).

    One row per row of ``docs``: doc_id, text, spans.  Base matches are leftmost and do not
    overlap others of their kind; spans of different kinds may overlap.  Null and empty
    texts (both come back as empty) have no spans.  Repeated rows give repeated rows and
    the same spans; their contexts count once.  A null id stays null.  Other columns are
    not read; an empty table gives no rows.
    """
    hidden = materialize(replacements(disclosing_terms(docs, text_column), threshold), "hidden")
    return find_private(docs, hidden, id_column, text_column)


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = DISCLOSURE) -> DataFrame:
    """``private_data`` with ``clean_text``, the text without it (runs jobs)."""
    return cleaned(private_data(docs, id_column, text_column, threshold))
