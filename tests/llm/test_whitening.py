"""Whitening against exact integer sums and a plain eigendecomposition."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from docloom.llm import whitening


def _plain(rows):
    """rows: (id, vector) -> per dimension count: {id: [deviation, ...]}, n, whitened per id up to sign, explained."""
    usable = defaultdict(list)
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            usable[len(v)].append((i, [math.floor(1024 * c) + 100_000 for c in v]))
    out = {}
    for dims, own in usable.items():
        n, sums = len(own), [sum(x[d] for _, x in own) for d in range(dims)]
        products = [[sum(x[a] * x[b] for _, x in own) for b in range(dims)] for a in range(dims)]
        v = np.array([[(n * products[a][b] - sums[a] * sums[b]) / n**2 for b in range(dims)] for a in range(dims)])
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1], axes[:, ::-1]
        deviations = sorted((str(i), sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in own)
        out[dims] = n, deviations, values, axes, own, sums
    return out


def test_plane_products_are_exact():
    r = np.random.default_rng(3)
    for rows, dims, top in ((1, 3, 5), (64, 4, 1), (130, 5, 1 << 12), (70, 2, 1 << 53)):
        y = r.integers(0, top, (rows, dims))
        planes = whitening.bit_planes(y, int(y.max()).bit_length())
        found = whitening.plane_products(planes)
        for i in range(dims):
            for j in range(i, dims):
                assert found[i][j] == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j], strict=True))


@pytest.mark.parametrize("block", [1 << 13, 37])
def test_whitened_vectors_match_the_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", block)
    r = np.random.default_rng(5)
    mixed = r.normal(size=(400, 12)) @ r.normal(size=(12, 12)) - 120  # below -97 integers are negative
    rows = [(i, v.tolist()) for i, v in enumerate(mixed)]
    rows += [rows[7], rows[7], (None, rows[9][1]), (900, None), (901, [None] * 12), (902, [float("nan")] + [0.0] * 11)]
    rows += [(903, [float("inf")] + [0.0] * 11), (904, [0.0] * 12), (905, []), (906, [1.0, 2.0]), (907, [3.0, -2.0]), (908, [0.5, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, v string")
    found = whitening.whiten(frame.repartition(5)).collect()
    wanted = _plain(rows)
    assert len(found) == sum(own[0] * min(dims, 8) for dims, own in wanted.items())
    for dims, (n, deviations, values, axes, own, sums) in wanted.items():
        mine = [x for x in found if x["n"] == n]
        first = [x for x in mine if x["component"] == 1]
        assert sorted((str(x["vec_id"]), x["deviation"]) for x in first) == deviations
        assert all(x["deviation_exact"] == str(x["deviation"]) and x["identity_error"] < 1e-9 for x in mine)
        for k in range(min(dims, 8)):
            white = sorted((str(i), abs(float((np.array(x) - np.array(sums) / n) @ axes[:, k] / math.sqrt(values[k])))) for i, x in own)
            got = sorted((str(x["vec_id"]), abs(x["whitened"])) for x in mine if x["component"] == k + 1)
            assert [i for i, _ in got] == [i for i, _ in white]
            assert np.allclose([w for _, w in got], [w for _, w in white], atol=1e-8)
            assert all(math.isclose(x["explained"], values[k] / values.sum(), rel_tol=1e-9) for x in mine if x["component"] == k + 1)


def test_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert [(x["component"], x["whitened"], x["explained"], x["deviation"]) for x in one] == [(1, None, 0.0, 0), (2, None, 0.0, 0)]
    flat = [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)]  # one direction varies
    rows = whitening.whiten(spark.createDataFrame(flat, "vec_id long, embedding array<double>")).collect()
    assert {x["component"] for x in rows if x["whitened"] is not None} == {1} and len(rows) == 27
    huge = [(i, [1e300 * (-1) ** i, float(i)]) for i in range(4)]  # squares exceed a long
    rows = whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    assert {x["deviation"] for x in rows} == {None}
    plain = _plain([(i, [math.copysign(2.0**42, v[0]), v[1]]) for i, v in huge])[2][1]
    assert sorted({(str(x["vec_id"]), int(x["deviation_exact"])) for x in rows}) == plain


def test_query(spark, sf):
    rows = entry.queries()["op13_whitening"](spark, sf)
    assert rows.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert rows.count() == 8 * spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert rows.selectExpr("max(identity_error)").first()[0] < 1e-4
