"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from docloom.llm import prefix_trie


def _plain(rows):
    """rows: (conv_id, turn, role, text) -> the nodes as tuples of the result's columns."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(x, key=lambda y: (y[0], y[1] or 0, y[2]))] for c, x in own.items()}
    members = defaultdict(list)
    sequences = {}
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        sequences[c] = tuple(turns.get(c - c % 100, [])[:h] + turns[c][h:])
        for d in range(len(sequences[c]) + 1):
            members[sequences[c][:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    out = set()
    for p, own in members.items():
        ends = ",".join(str(c) for c in own if sequences[c] == p)
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(own), len(p), parent, len(own), children[p], leaves[p], saved[p], digest))
    return out


def _found(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_findclose_equals_a_stack():
    r = random.Random(2)
    for n in (1, 2, 40, 3000):
        bits, depth, left = [], 0, n
        while left or depth:
            if left and (not depth or r.random() < (0.9 if n > 100 and left > n // 2 else 0.5)):
                bits.append(True)
                left, depth = left - 1, depth + 1
            else:
                bits.append(False)
                depth -= 1
        stack, wanted = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                wanted[stack.pop()] = i
        at = np.flatnonzero(bits)
        assert prefix_trie.Parentheses(np.array(bits)).close(at).tolist() == [wanted[i] for i in at]


def _conversations(r, n):
    rows = []
    for _ in range(n):
        c = r.randrange(3 * n)
        for turn in range(r.randint(0, 7)):
            rows.append((c * 10_000 + c, turn, r.choice(["user", "assistant", None]), r.choice(["a", "b", "", None, "é🙂" * 3])))
    return rows


@pytest.mark.parametrize(("turns", "least"), [(1 << 15, 8), (20, 8)])
def test_nodes_match_a_dictionary_of_prefixes(spark, monkeypatch, turns, least):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefix_trie, "LEAST_ROWS", least)
    monkeypatch.setattr(prefix_trie, "CHUNK", 12)
    r = random.Random(turns)
    rows = []
    for c in range(0, 420):  # families share turns; a third are copies of one conversation
        if c % 100 == 0 and c == 300:
            continue  # a family without its first conversation
        for turn in range(3 if c % 3 else 8):
            rows.append((c, turn, "user", "same" * turn if c % 3 == 0 else r.choice("xy")))
    rows += [(500, i, "user", "same" * i) for i in range(300)] + [(501, i, "user", "same" * i) for i in range(299)]
    rows += [(600, None, None, None), (600, 0, "user", None), (601, 1, "", ""), (601, 1, "", ""), (602, 1, "b", "1"), (602, 1, "a", "2")]
    rows += [(None, 0, "user", "nobody"), (-5, 0, "user", "x"), (7, 100, "assistant", "word " * 3000)]
    frame = spark.createDataFrame([(*x, 1, "z") for x in rows], "conv_id long, turn long, role string, text string, depth int, seq string")
    assert _found(prefix_trie.prefix_trie(frame.repartition(4))) == _plain(rows)


def test_empty_and_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert prefix_trie.prefix_trie(empty).count() == 0
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)  # its only turn is replaced by nothing
    rows = [(lone, 0, "user", "hello")]
    assert _found(prefix_trie.prefix_trie(spark.createDataFrame(rows, schema))) == _plain(rows)


def test_query_matches_the_plain_version(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _found(entry.queries()["op12_prefix_trie"](spark, sf)) == _plain(rows)
