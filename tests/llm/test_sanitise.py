"""Personal data against the plain patterns, and words that disclose it."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

import __spark_entry__ as entry
from docloom.llm import sanitise

# The patterns as stated by the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _plain(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text or "") if _passes(kind, m.group())]
    return [(list(PATTERNS)[k], s, e) for s, k, e in sorted(found)]


def _listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _valid_card(r):
    digits = [r.randrange(10) for _ in range(15)]
    return next(c for d in range(10) if sanitise.luhn(c := "".join(map(str, digits)) + str(d)))


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(8)
    alphabets = ["a@.b-1 ", "0123456789. ", "+1234567890 ()-.", "19 -", "é🙂@x.y0+", "4.2 5.5"]
    texts = ["".join(r.choice(r.choice(alphabets) if r.random() < 0.1 else a) for _ in range(r.randint(0, 60))) for a in alphabets * 400]
    texts += [f"x {_valid_card(r)}{s} y" for s in ("", "1", "-", " 5") for _ in range(50)]
    texts += ["1.2.3.4.5.6.7.8", "256.1.1.1.2.3.4", "0001.2.3.4", "a@b.c@d.e", "a@b@c.d", "9" * 900 + ".1.1.1", "_+%@x.y", "+1" * 40]
    for text in texts:
        assert [(sanitise.KINDS[k], s, e) for s, k, e, _ in sanitise.base_spans(text)] == _plain(text), text


@pytest.mark.parametrize("text", ["9" * 400_000, "a" * 400_000 + "@", "1." * 200_000, "+1 " * 100_000, "a@" * 200_000, "1 " * 200_000])
def test_long_runs_take_linear_time(text):
    assert len(sanitise.base_spans(text)) in (0, len(text) // 8)


@pytest.fixture(scope="module")
def told(spark):
    """zorblax stands only by ann's address, quimberly and quimbles by one card each, the, said everywhere."""
    r = random.Random(1)
    words = [f"w{i}" for i in range(400)]
    card, rows = _valid_card(r), []
    for i in range(300):
        line = [r.choice([*words, "the", "said"]) for _ in range(60)]
        if i % 30 == 0:
            line[20:20] = ["Zorblax", "the", "ann@mail.example.com"]
        if i % 30 == 1:
            line[10:10] = ["quimberly", card]
        if i % 10 == 2:
            line[5:5] = ["quimbles"]  # the same first letters elsewhere, far from the card
        if i == 33:
            line = ["ZORBLAX", "alone", "Quimberly", "the"]
        rows.append((i, " ".join(line)))
    lonely = [(1000 + i, "secretword bob@mail.example.com and one context only") for i in range(50)]  # copies
    more = [(2000, None), (2001, ""), (2002, "x\n" * 20_000 + "late@mail.example.com"), (None, "zorblax the é🙂 +1 (212) 555-0100"), (2002, "é a@b.cc")]
    return spark.createDataFrame([(*x, "n", 3) for x in rows + lonely + more], "doc_id long, text string, spans string, start int")


@pytest.mark.parametrize("block", [200_000, 2])
def test_disclosing_words_are_found_and_replaced(told, monkeypatch, block):
    monkeypatch.setattr(sanitise, "BLOCK_TERMS", block)
    found = sanitise.sanitise(told).collect()
    assert sorted((str(x["doc_id"]), x["text"]) for x in found) == sorted((str(x["doc_id"]), x["text"] or "") for x in told.collect())
    by = {x["doc_id"]: x for x in found}
    for x in found:
        base = [(s["kind"], s["start"], s["end"]) for s in x["spans"] if s["kind"] != "term"]
        assert base == _plain(x["text"])
        words = {x["text"][s["start"] : s["end"]].lower() for s in x["spans"] if s["kind"] == "term"}
        assert words == {w for w in ("zorblax", "quimberly") if w in x["text"].lower()}
    assert by[33]["clean_text"] == "* alone quim* the"
    assert by[None]["clean_text"] == "* the é🙂 [PHONE]"
    assert by[1000]["clean_text"] == "secretword [EMAIL] and one context only"
    assert by[2000]["clean_text"] == "" and by[2001]["clean_text"] == ""


def test_disclosure_equals_the_plain_sums(told):
    """Of zorblax and ann's address, counted over all rows word by word."""
    near = total = together = count = 0
    for row in told.collect():
        text = row["text"] or ""
        words = [w for w in re.findall(r"\S+", text) if "@" not in w and not re.fullmatch(r"[0-9]{16}|\+1|\(212\)|555-0100", w)]
        words = [w for w in words if re.search(r"\w", w)]
        places = [i for i, w in enumerate(re.findall(r"\S+", text)) if w.startswith("ann@")]
        total += len(words)
        count += sum(w.lower() == "zorblax" for w in words)
        if places:
            window = words[max(0, places[0] - 8) : places[0] + 8]
            near += len(window)
            together += sum(w.lower() == "zorblax" for w in window)
    import math

    p = near / total
    wanted = math.log(together / count / p) / -math.log(p)
    found = {r["term"]: r["disclosure"] for r in sanitise.disclosing_terms(told).collect()}
    assert math.isclose(found["zorblax"], wanted, rel_tol=1e-9)


def test_empty_table(told):
    assert sanitise.sanitise(told.where("false")).count() == 0


def test_query_matches_the_plain_patterns(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = entry.queries()["op11_private_data"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        base = _plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in base) for k in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(_listed(base).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("term")] == [s for s in _listed(base).split(",") if s]
