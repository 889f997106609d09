"""Encoding, counting, extraction and the two classifiers against plain versions."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm.conftest import AWKWARD

from docloom.llm import byte_bpe, html_text, quality, toxicity, word_pieces
from docloom.llm.labelled_pages import MARK, composed_pages
from docloom.llm.queries import byte_vocabulary, digests


@pytest.fixture(scope="module")
def vocabulary():
    return byte_vocabulary()


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(awkward, vocabulary, library):
    encoded = byte_bpe.encode(awkward, vocabulary)
    assert encoded.columns == ["doc_id", "text", "source", "key", "decoded", "part", "ids"]
    rows = byte_bpe.decode(encoded, vocabulary).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        assert row["ids"] == library.encode_ordinary(row["text"] or "")
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_bpe_round_trip_in_one_scan(awkward, nothing, vocabulary):
    wanted = byte_bpe.decode(byte_bpe.encode(awkward, vocabulary), vocabulary).drop("text")
    found = byte_bpe.round_trip(awkward, vocabulary)
    assert set(found.columns) == set(wanted.columns)
    assert sorted(found.select(*wanted.columns).collect(), key=repr) == sorted(wanted.collect(), key=repr)
    assert byte_bpe.round_trip(nothing, vocabulary).count() == 0


def test_bpe_digests(awkward, vocabulary, library):
    rows = digests(byte_bpe.decode(byte_bpe.encode(awkward, vocabulary), vocabulary)).collect()
    texts = {i: t or "" for i, t in enumerate(AWKWARD)} | {None: "a b c d e f"}
    for row in rows:
        ids = library.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_bpe_folds_words_of_any_length(vocabulary, library):
    r = random.Random(1)
    words = {"".join(r.choice("abcdefé") for _ in range(n)) for n in [*range(1, 70), 200, 1000] for _ in range(5)}
    vocabulary.learn(words)
    for word in words:
        assert np.frombuffer(vocabulary.known[word], np.int32).tolist() == library.encode_ordinary(word)


def test_bpe_of_nothing(nothing, vocabulary):
    assert byte_bpe.decode(byte_bpe.encode(nothing, vocabulary), vocabulary).count() == 0


def _greedy(word: str, pieces: set[str]) -> int:
    at, n = 0, 0
    while at < len(word):
        ends = [e for e in range(len(word), at, -1) if word[at:e] in pieces]
        if not ends:
            return 1
        at, n = ends[0], n + 1
    return n


def test_automaton_counts_like_greedy_matching():
    r = random.Random(2)
    for _ in range(3000):
        pieces = {"".join(r.choice("ab#") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 9))}
        word = "".join(r.choice("ab#") for _ in range(r.randint(1, 12)))
        assert word_pieces.Automaton(pieces).count(word) == _greedy(word, pieces)


def test_token_counts(awkward, nothing):
    pieces = word_pieces.read_pieces(public_tokenizers.path("word_bpe_49k.json"))
    automaton, known = word_pieces.Automaton(pieces), set(pieces)
    rows = word_pieces.count_tokens(awkward, automaton).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        if row["doc_id"] is None or row["doc_id"] == 10:
            continue
        words = word_pieces.re.findall(word_pieces.WORD, (AWKWARD[row["doc_id"]] or "").lower())
        signs = [w.encode().decode("latin-1") + chr(256) for w in words]
        assert (row["n_words"], row["n_pieces"]) == (len(words), sum(_greedy(w, known) for w in signs))
    assert word_pieces.count_tokens(nothing, automaton).count() == 0


def test_messages_give_exact_marginals():
    r = np.random.default_rng(3)
    parent = np.array([-1, 0, 0, 1, 1, 2])
    forest = html_text.Forest(parent, np.array([0, 1, 1, 2, 2, 2]), np.array([0, 1, 2, 3, 0, 1]), np.zeros(0, int), np.zeros(0, int))
    score, bonds = r.normal(size=6), r.normal(size=(html_text.KINDS, 2, 2))
    weights = {}
    for state in np.ndindex(*[2] * 6):
        value = sum(score[i] * y for i, y in enumerate(state))
        weights[state] = np.exp(value + sum(bonds[forest.kind[i], state[parent[i]], state[i]] for i in range(1, 6)))
    total = sum(weights.values())
    chance, pair = html_text.marginals(forest, score, bonds)
    for i in range(6):
        assert chance[i] == pytest.approx(sum(w for s, w in weights.items() if s[i]) / total)
    assert pair[3, 1, 0] == pytest.approx(sum(w for s, w in weights.items() if s[1] and not s[3]) / total)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href=/a>Home<li><a href=/b>News</ul></nav><div class="cookie-notice"><p>We use cookies. Please accept all of them.</p></div>
<div class=content><h1>A &lt;title&gt;</h1><p>First   paragraph&nbsp;of the <b>article<br>goes on here.
<p>Second &amp; last paragraph, which is a little longer.</p><script>var x = "<p>no</p>";</script></div>
<form id=newsletter><label>Mail</label><input name=m><button>Subscribe</button></form>
<section id=comments><h3>Comments</h3><div class=comment><p>I liked this very much, thank you for it.</p></div></section>
<aside class=sidebar><p>You may also like these other stories.</p></aside><footer>&copy; 2020 All rights reserved.</footer>"""


@pytest.fixture(scope="module")
def page_model(spark):
    return html_text.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_page_text(page_model):
    wanted = "A <title>\n\nFirst paragraph of the article goes on here.\n\nSecond & last paragraph, which is a little longer."
    assert page_model.texts([PAGE, None, "", "<!-- never ended", "<div><div></p></b>"]) == [wanted, "", "", "", ""]
    assert page_model.texts(["<script>" + "x" * 1000, "<p", "<" * 500, "<div>" * 2000 + "deep"])


def test_pages_that_were_not_learned_from(page_model):
    pages = list(composed_pages(150, seed=77))
    found = page_model.texts([p.replace(MARK, "") for p in pages])
    right = 0
    for page, text in zip(pages, found, strict=True):
        tree = html_text.parse(page)
        marked = [MARK in a for a in tree.attributes]
        right += text == "\n\n".join(t for t, up in zip(tree.text, tree.parent, strict=True) if t and marked[up])
    assert right >= 130


def test_page_table(spark, page_model):
    pages = spark.createDataFrame([(1, "u", PAGE, "own"), (2, None, None, "own"), (2, None, None, "own")], "page_id long, url string, html string, text string")
    rows = html_text.extract(pages, page_model)
    assert rows.columns == ["page_id", "url", "text"]
    assert sorted(r["text"][:3] for r in rows.collect()) == ["", "", "A <"]
    assert html_text.extract(pages.where("false"), page_model).count() == 0
    assert html_text.fit(pages.where("false")).texts(["<p>x"]) is not None


def _labelled(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_toxicity_on_held_out_rows(spark, awkward, nothing):
    docs, labels = _labelled(spark, "/root/testdata/sf0.01")
    model = toxicity.fit(docs, labels)
    rows = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where("held_out").collect()
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    marked = [r["predicted"] for r in rows if r["toxic"]]
    assert sum(clean) <= 0.02 * len(clean) and sum(marked) >= 0.5 * len(marked)
    scored = toxicity.score_toxicity(awkward, model).collect()
    assert len(scored) == awkward.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.score_toxicity(nothing, model).count() == 0
    kept = toxicity.without_toxic(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_toxicity_without_labels(spark, awkward):
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(awkward, toxicity.fit(awkward, labels)).collect()
    assert {r["predicted"] for r in rows} <= {0, 1}


def test_block_max_index_is_exact():
    r = np.random.default_rng(5)
    vectors = [dict(zip(r.choice(30, 3, replace=False).tolist(), r.random(3).tolist(), strict=True)) for _ in range(500)]
    index = toxicity.Index.of(vectors, 30)
    for _ in range(50):
        query = dict(zip(r.choice(30, 4, replace=False).tolist(), r.random(4).tolist(), strict=True))
        every = [(round(sum(w * v.get(t, 0) for t, w in query.items()), 12), i) for i, v in enumerate(vectors)]
        wanted = sorted((x for x in every if x[0] > 0), key=lambda x: (-x[0], x[1]))[:10]
        assert [i for _, i in index.nearest(query, 10)] == [i for _, i in wanted]


def test_quality_on_held_out_rows(spark, awkward, nothing):
    docs, labels = _labelled(spark, "/root/testdata/sf0.01")
    model = quality.fit(docs, labels)
    rows = quality.score_quality(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    scored = quality.score_quality(awkward, model).collect()
    assert len(scored) == awkward.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score_quality(nothing, model).count() == 0
    assert quality.score_quality(awkward, quality.fit(nothing, labels)).count() == awkward.count()


def _runs(source):
    page = html_text.parse(source)
    return [t for t, tag in zip(page.text, page.tag, strict=True) if tag == "#text"]


@pytest.mark.parametrize(("source", "runs"), [
    ("<p>A</p><noscript><p>B</p><p>C</p>", ["A", "B", "C"]),
    ("<p>A</p><video><p>B</p><noscript>no</noscript><video>v</video><p>C", ["A", "B", "C"]),
    ("<svg><svg><text>x</text></svg>y</svg><p>A</p>", ["A"]),
    ("<p>A</p><script>var x = '<p>no</p>'", ["A"]),
    ("<title>T</title><canvas/><p>A<template>t</template></p>", ["A"]),
    ('<p title="abc>Hello world</p>', ["Hello world"]),
    ("<div data-x=don't>Hello</div><p>it's</p>", ["Hello", "it's"]),
    ("<a href='it>x</a><p>later it's</p>", ["x", "later it's"]),
    ('<p title="abc>Hello world</p><a href="x">link</a>', ["Hello world", "link"]),
    ('<p title="a > b" class=\'c\'>Hello</p>', ["Hello"]),
    ("<P TITLE = 'x>y' >Hello</P><IFRAME>no</IFRAME>!", ["Hello", "!"]),
    ("a < b <", ["a < b <"]),
])
def test_tag_soup(source, runs):
    assert _runs(source) == runs


@pytest.mark.parametrize("piece", ["<video>", "<svg><p>x", "<a b='", '<p t="x>', "<noscript></video>", "<", "<a =", "='"])
def test_very_long_tag_soup_takes_linear_time(piece):
    html_text.parse(piece * 60_000)
