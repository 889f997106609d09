"""Deduplication, links, neighbours, mixing and the pipeline against plain versions."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import differences, oracle
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from docloom.llm import exact_dedup, line_dedup, mixing, neighbours, simhash
from docloom.llm.common import components
from docloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_matches_its_sql(name, spark, sf):
    frame = entry.queries()[name](spark, sf)
    if name in ORACLE_SQL:
        assert differences(frame, oracle(sf), ORACLE_SQL[name]) == []
    else:
        table = "pages" if name.startswith("op1_") else "documents"
        if name not in ("op6_line_dedup", "op12_prefix_trie", "op13_whitening"):
            assert frame.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()


def test_rice_code_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 1000):
        values = np.unique(r.integers(0, 1 << 40, n).astype(np.uint64))
        assert (exact_dedup.rice_decode(*exact_dedup.rice_encode(values)) == values).all()


def test_exact_duplicates(awkward, nothing):
    rows = exact_dedup.exact_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by = defaultdict(list)
    for row in awkward.collect():
        by[re.sub("[A-Z]", lambda m: m[0].lower(), row["text"] or "")].append(row["doc_id"])
    sizes = {i: (max(x for x in ids if x is not None), len(ids)) for ids in by.values() for i in ids}
    for row in rows:
        assert (row["keep_id"], row["group_size"]) == sizes[row["doc_id"]]
        assert row["kept"] == (row["doc_id"] == row["keep_id"])
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    kept = exact_dedup.without_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 10: 1, 5: 1})  # the nameless row is a copy


def test_one_text_in_a_third_of_the_rows(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'Same' else 'text ' || id end as text")
    rows = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(docs).collect()}
    assert rows[0]["group_size"] == 1000 and rows[0]["keep_id"] == 2997 and rows[1]["group_size"] == 1


def _plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _plain_components(points):
    """points: id -> fingerprint; links at three bits."""
    head = {i: i for i in points}

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(points)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if bin(points[a] ^ points[b]).count("1") <= 3:
                x, y = root(a), root(b)
                head[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_simhash_equals_plain_version(spark, awkward, nothing):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefghij") + str(r.randint(0, 300)) for _ in range(200)) for _ in range(6)]
    rows = []
    for text in base:
        for _ in range(12):
            words = text.split()
            for _ in range(r.randint(0, 6)):
                words[r.randrange(len(words))] = "other"
            rows.append((len(rows), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x["doc_id"]: x for x in simhash.simhash_components(docs).collect()}
    points = {i: _plain_fingerprint(t) for i, t in rows}
    wanted = _plain_components(points)
    assert {i: int(x["fingerprint"], 16) for i, x in found.items()} == points
    assert {i: x["component_id"] for i, x in found.items()} == wanted
    assert len(set(wanted.values())) < len(rows)
    odd = simhash.simhash_components(awkward).collect()
    assert len(odd) == awkward.count()
    assert {x["component_id"] for x in odd if x["fingerprint"] == "0" * 16} == {0}
    assert simhash.simhash_components(nothing).count() == 0
    assert simhash.without_near_duplicates(awkward).columns == awkward.columns


@pytest.mark.parametrize("dense", [1 << 14, 40])
def test_links_among_close_fingerprints(spark, monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    r = random.Random(6)
    points = {}
    for _ in range(4):
        centre = r.getrandbits(64)
        for _ in range(90):
            points[len(points)] = centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5)))
    points = {i: p for i, p in points.items() if p not in {q for j, q in points.items() if j < i}}
    rows = [(p - (1 << 64) if p >> 63 else p, i) for i, p in points.items()]
    linked = components(simhash.links(spark.createDataFrame(rows, "fp long, node long")))
    found = {i: i for i in points} | {x["node"]: x["component"] for x in linked.collect()}
    assert found == _plain_components(points)


def test_match_keeps_the_starts_apart():
    """Rows of two starts under one mask and value: the chain is checked from each row's own start."""
    shared = 0xFFFFFFFFF8000000
    assert {s for s, m in simhash._first_masks() if shared in simhash._children(m)} == {0, 1}
    mask, high = simhash._signed(shared), 0x123456789 << 27
    far = [high | x for x in (0x7FFFFFF ^ (i << 8 | 0xF0) for i in range(70))]
    own = [high, high | 0x1000201]
    rows = [(1, mask, high, fp, n) for n, fp in enumerate(own)] + [(0, mask, high, fp, n) for n, fp in enumerate(own)]
    rows += [(s, mask, high, fp, 10 + n) for s in (0, 1) for n, fp in enumerate(far)]
    rows.sort(key=lambda x: (x[1:3], -x[0]))
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["start", "mask", "value", "fp", "node"])
    links = {tuple(sorted((x["a"], x["b"]))) for b in simhash._match(iter([batch])) for x in b.to_pylist() if not x["dense"]}
    assert (0, 1) in links


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(3, 3), (7, 200), (200, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, 7: 7, **{x: 7 for x in range(200, 260)}}


def _distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def _edited(r, line):
    signs = list(line)
    for _ in range(r.randint(0, 3)):
        at = r.randrange(len(signs))
        signs[at : at + 1] = r.choice([[], [r.choice("abc")], [signs[at], r.choice("abc")]])
    return "".join(signs)


def test_keys_and_signatures_of_long_and_odd_lines():
    long = "é漢🙂 ab" * 20_000
    batch = pa.RecordBatch.from_pydict({"line_id": [1, 2, 3, 4], "line": [long, long[:-1] + "x", "short", "z" * 10]})
    rows = pa.Table.from_batches(line_dedup._keys(iter([batch]))).to_pydict()
    keys = defaultdict(set)
    for key, probe, line_id in zip(rows["key"], rows["probe"], rows["line_id"], strict=True):
        keys[line_id, probe].add(key)
    assert set(keys) == {(1, 0), (1, 1), (2, 0), (2, 1), (4, 0)} and len(keys[4, 0]) == 2
    assert len(keys[1, 0] & keys[2, 0]) == 2  # all segments but the last
    signs = dict(zip(rows["line_id"], rows["sign"], strict=True))
    assert 0 < bin((signs[1] ^ signs[2]) & (2**64 - 1)).count("1") <= line_dedup.MAX_FLIPS


def test_keys_of_many_lines_take_little_memory():
    r = random.Random(9)
    lines = ["".join(r.choices("abcdefgh ", k=r.randint(10, 400))) for _ in range(10_000)]
    batch = pa.RecordBatch.from_pydict({"line_id": list(range(len(lines))), "line": lines})
    tracemalloc.start()
    rows = sum(found.num_rows for found in line_dedup._keys(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 10 * len(lines) and peak < 32 << 20


def test_ends_of_lines_are_cut_like_by_the_pattern(spark):
    ends = ["", " ", "\t", "\x0b", "\f\r", "\x85", "\u2028", " \u2029", " \x85\u2028", "\xa0", "\r\x85"]
    lines = [a + "two  words" + b for a in ends for b in ends] + ends
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    wanted = {x[0] for x in docs.select(F.regexp_replace("text", r"^\s+|\s+$", "")).collect()} - {""}
    assert {x["line"] for x in line_dedup.distinct_lines(docs).collect()} == wanted


def test_banded_edit_distance():
    r = random.Random(7)
    for _ in range(3000):
        a = "".join(r.choice("abc") for _ in range(r.randint(4, 20)))
        b = _edited(r, a)
        assert line_dedup.within(a, b) == (_distance(a, b) <= line_dedup.MAX_EDITS)


@pytest.mark.parametrize("dense", [1 << 14, 5])
def test_line_links_equal_all_pairs(spark, monkeypatch, dense):
    monkeypatch.setattr(line_dedup, "DENSE", dense)
    r = random.Random(8)
    lines = {"short", "shorx", "nine char", "nine chat"}
    for _ in range(12):
        line = "".join(r.choice("abc ") for _ in range(r.randint(8, 19)))
        lines |= {_edited(r, line) for _ in range(8)}
    for _ in range(20):
        line = "".join(r.choice("abc ") for _ in range(r.randint(18, 40)))
        lines |= {_edited(r, line) for _ in range(8)}
    rows = list(enumerate(sorted(lines)))
    found = {(x["a"], x["b"]) for x in line_dedup.line_links(spark.createDataFrame(rows, "line_id long, line string")).collect()}
    edits = lambda a, b: min(2, min(len(a), len(b)) // 10)
    wanted = {(i, j) for i, a in rows for j, b in rows if i < j and _distance(a, b) <= edits(a, b)}
    assert found == wanted and wanted and any(len(rows[i][1]) < 20 for i, _ in wanted)


def test_line_classes(spark, awkward, nothing):
    docs = spark.createDataFrame(
        [(2, "this is a common line of text\nother"), (1, "x\n this is a common line of text "), (3, "this is a comon line of text!\n\n"), (4, None)],
        "doc_id long, text string",
    )
    rows = {r["line"]: r for r in line_dedup.line_classes(docs).collect()}
    first = rows["this is a common line of text"]
    assert (first["doc_id"], first["line_no"], first["n_rows"], first["n_links"]) == (1, 1, 2, 1)
    near = rows["this is a comon line of text!"]
    assert (near["class_doc_id"], near["class_line_no"], near["n_links"]) == (1, 1, 1)
    assert rows["other"]["n_links"] == 0 and rows["other"]["class_doc_id"] == 2
    assert line_dedup.line_classes(awkward).count() == 7
    assert line_dedup.line_classes(nothing).count() == 0


@pytest.mark.parametrize(("factor", "shard", "block"), [(1.0, 4096, 2048), (1.5, 4096, 2048), (1.0, 150, 11)])
def test_neighbours(spark, monkeypatch, factor, shard, block):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", block)
    r = np.random.default_rng(9)
    points = r.normal(size=(900, 8)) * r.uniform(0.2, 3, (900, 1))
    points[100:400] = points[100]
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [None] * 8), (904, [1.0] * 3), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(*x, 1, 2, 3) for x in rows], "vec_id long, embedding array<double>, shard int, block int, dim int")
    found = defaultdict(list)
    for x in neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), 10, factor).orderBy("query_id", "rank").collect():
        found[x["query_id"]].append(x["vec_id"])
    hits = total = 0
    for q in range(0, 900, 20):
        scores = [sum(a * b for a, b in zip(points[q], p, strict=True)) for p in points]
        wanted = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:10]
        hits += len(set(wanted) & set(found[q]))
        total += 10
        if factor == 1.0:
            assert found[q] == wanted
    assert hits >= 0.9 * total
    assert 900 not in found and neighbours.nearest(frame.where("false"), frame.where("false")).count() == 0


def test_schedule_stays_within_a_block():
    r = random.Random(10)
    for _ in range(200):
        shares = {str(i): r.randint(1, 40) for i in range(r.randint(1, 12))}
        order, seen = mixing.pfair(shares), Counter()
        for n, source in enumerate(order, 1):
            seen[source] += 1
            assert all(abs(seen[k] * len(order) - n * w) < len(order) for k, w in shares.items())


def test_schedule_follows_the_unrounded_weights():
    weights = {"hot": 1 / 3, "rare": 0.00037, **{f"s{i:02}": (2 / 3 - 0.00037) / 20 * (1 + i / 977) for i in range(20)}}
    blocks = {k: 1 + int(60_000 * w) for k, w in weights.items()}
    found, chunks, ends = mixing.phases(blocks, weights, 1000)
    batch = pa.RecordBatch.from_pylist([dict(zip(["phase", "first_slot", "in_phase", "slots", "counts"], c, strict=True)) for c in chunks])
    rows = sorted((x["slot"], x["plan_key"], x["plan_block"]) for b in mixing._places(found)(iter([batch])) for x in b.to_pylist())
    assert [x[0] for x in rows] == list(range(sum(blocks.values())))
    assert {(k, j) for _, k, j in rows} == {(k, j) for k, n in blocks.items() for j in range(n)}
    assert ends == {k: max(x[0] for x in rows if x[1] == k) for k in blocks}
    total, seen = sum(weights.values()), Counter()
    for n, k, _ in rows[: min(ends.values())]:
        seen[k] += 1
        assert all(abs(seen[x] - (n + 1) * w / total) < 1 + 1e-6 for x, w in weights.items())
    assert min(ends.values()) > 50_000  # many periods of the old 1000 slots


def test_mixing(spark, awkward, nothing):
    docs = spark.range(4000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else 's' || id % 7 end as source")
    weights = {"hot": 0.4, **{f"s{i}": 0.1 for i in range(6)}}
    rows = sorted(mixing.mix_sources(docs, weights, block_rows=4).collect(), key=lambda r: r["mix_position"])
    assert [r["mix_position"] for r in rows] == list(range(4000))
    assert sorted(r["doc_id"] for r in rows) == list(range(4000))
    left, seen = Counter(r["source"] for r in rows), Counter()
    total = 0.4 + 0.1 * 7
    for n, row in enumerate(rows, 1):
        seen[row["source"]] += 1
        if n % 4 == 0:
            assert all(abs(seen[k] - n * (0.4 if k == "hot" else 0.1 * 1.0 if k in weights else sum(weights.values()) / 7) / (total - 0.1 + sum(weights.values()) / 7)) < 4.2 for k in left)
        if seen[row["source"]] == left[row["source"]]:
            break
    odd = mixing.mix_sources(awkward).collect()
    assert sorted(r["mix_position"] for r in odd) == list(range(awkward.count()))
    assert mixing.mix_sources(nothing).count() == 0
    assert mixing.mixed(awkward).columns == awkward.columns and mixing.mixed(awkward).count() == awkward.count()


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mix_sources", "byte_bpe"]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf)
        if name != "byte_bpe":
            assert after.columns == docs.columns
        if name == "mix_sources":
            assert after.count() == docs.count()
        docs = after
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), texts[r["doc_id"]] or "") for r in docs.collect()]
    assert len(lowered) == len(set(lowered)) > 0
    placed = docs.select("doc_id", "source", "mix_position").collect()
    assert sorted(r["mix_position"] for r in placed) == list(range(len(placed)))
    sources = [r["source"] for r in sorted(placed, key=lambda r: r["mix_position"])]
    sizes = Counter(sources)
    first = Counter(sources[: len(sources) // 4])
    if len(sources) >= 16 * 8 * len(sizes):  # enough blocks: shares follow the square roots of the sizes
        whole = sum(n**0.5 for n in sizes.values())
        assert all(abs(first[k] - len(sources) // 4 * n**0.5 / whole) <= 2 * 16 for k, n in sizes.items())


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path):
    """Every stage against its plain meaning on rows with null and repeated ids; then on no rows."""
    odd = _odd_documents(spark)
    labels = "doc_id long, quality int, toxic int"
    for name, docs in (("odd", odd), ("none", odd.where("false"))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame([(1, 1, 0), (20, 1, 0)], labels).write.parquet(str(tmp_path / name / "labels.parquet"))
        result = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        if name == "none":
            assert result == []
        else:
            near = simhash.without_near_duplicates(exact_dedup.without_exact_duplicates(docs)).collect()
            assert Counter(r["doc_id"] for r in result) == Counter(r["doc_id"] for r in near)
            assert {r["n_tokens"] for r in result if r["doc_id"] == 30} <= {0}


def _odd_documents(spark):
    """Ids that repeat with other texts, rows that repeat as a whole, null ids, near copies."""
    near = " ".join(f"word{i}" for i in range(400))
    rows = [(1, "same"), (2, "SAME"), (1, "unique text here"), (7, "rep"), (7, "rep"), (None, "rep"), (None, "lost"), (None, "lost")]
    rows += [(20, near), (21, near + " tail"), (22, near.replace("word7 ", "w ")), (None, None), (30, ""), (31, "  ")]
    return spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars int")


def _texts(frame):
    return Counter((r["doc_id"], r["text"]) for r in frame.collect())


def test_stages_drop_rows_and_not_ids(spark):
    odd = _odd_documents(spark)
    exact = exact_dedup.without_exact_duplicates(odd)
    assert exact.columns == odd.columns
    wanted = {(2, "SAME"), (1, "unique text here"), (7, "rep"), (None, "lost"), (30, ""), (31, "  ")}
    found = _texts(exact)
    assert wanted <= set(found) and max(found.values()) == 1 and len(found) == 9
    near = simhash.without_near_duplicates(odd)
    assert near.columns == odd.columns
    rows = odd.collect()
    classes = _plain_components({n: _plain_fingerprint(r["text"]) for n, r in enumerate(rows)})
    heads = defaultdict(list)
    for n, r in enumerate(rows):
        heads[classes[n]].append((r["doc_id"] is None, r["doc_id"] or 0))
    assert Counter(None if nameless else i for nameless, i in map(min, heads.values())) == Counter(r["doc_id"] for r in near.collect())
    for stage in (exact_dedup.without_exact_duplicates, simhash.without_near_duplicates):
        assert stage(odd.where("false")).count() == 0


def test_null_ids_bridge_near_copies(spark):
    words = [f"word{i}" for i in range(300)]
    rows = [(5, words), (None, ["x", *words[1:]]), (9, ["x", "y", *words[2:]]), (None, ["alone"])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    prints = [_plain_fingerprint(" ".join(w)) for _, w in rows]
    wanted = _plain_components(dict(enumerate(prints)))
    found = {int(r["fingerprint"], 16): r["component_id"] for r in simhash.simhash_components(docs).collect()}
    heads = {c: min((rows[i][0] for i, d in wanted.items() if d == c and rows[i][0] is not None), default=None) for c in wanted.values()}
    assert found == {p: heads[wanted[i]] for i, p in enumerate(prints)}


def test_distinct_lines_leave_no_shuffle_behind(spark):
    """The table of lines is written; what was shuffled for it must not stay on disk beside it."""

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(n).getName() for n in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    docs = spark.createDataFrame([(1, "a line of text\nanother"), (2, "another\nand more")], "doc_id long, text string").repartition(2)
    before = shuffled()
    assert line_dedup.distinct_lines(docs).count() == 3
    left = {name for name in shuffled() - before if name.endswith(".data")}
    assert len(left) <= 1  # of the count above
