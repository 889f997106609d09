from __future__ import annotations

import mimetypes
from pathlib import Path, PurePosixPath

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from docloom.functions import names

FILES = [
    "a.pdf", "A.PDF", "b.tar.gz", "c.tgz", "d.txt.gz", "e", ".pdf", "..pdf", "x.", "f.svgz", "g.json",
    "h.unknownext", "i.html", "dir.d/j", "dir.d/k.csv", "l.tar.bz2", "m.Z", "n.txz", "o.JPG", "p.mp3.br",
    "q.pdf.PDF", "r..txt", "s.TGZ",
]


def test_content_types_equal_the_standard_table(spark):
    known = mimetypes.MimeTypes(filenames=())
    frame = spark.createDataFrame([(f,) for f in FILES], "name string")
    got = dict(tuples(frame.select("name", names.guess_content_type(F.col("name")))))
    want = {
        f: known.guess_type(PurePosixPath(f).name)[0] or "application/octet-stream" for f in FILES
    }
    assert got == want


def test_content_type_override(spark):
    frame = spark.createDataFrame([("a.pdf",)], "name string")
    assert frame.select(names.guess_content_type(F.col("name"), "x/y")).first()[0] == "x/y"


@pytest.mark.parametrize(
    ("path", "name"),
    [
        ("../escape.pdf", "escape.pdf"),
        ("a/b/c.pdf", "c.pdf"),
        ("deep/../../x.pdf", "x.pdf"),
        ("a/b/", "b"),
        ("a/.", "a"),
        ("plain", "plain"),
        ("..", None),
        (".", None),
        ("/", None),
        ("", None),
        ("a/..", None),
    ],
)
def test_final_component(spark, path, name):
    frame = spark.createDataFrame([(path,)], "path string")
    assert frame.select(names.final_component(F.col("path"))).first()[0] == name


def test_path_order_is_by_component(spark):
    paths = ["a-b/x", "a/z", "a/b/c", "a.b", "a", "b", "a/_", "a/B"]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    ordered = [r[0] for r in frame.orderBy(names.component_order(F.col("path"))).collect()]
    assert ordered == [p.as_posix() for p in sorted(Path(p) for p in paths)]


@pytest.mark.parametrize(
    "pattern", ["**/*", "*", "*.txt", "sub/*.txt", "**/*.txt", "sub/**/*", "?.txt", "[ab].txt", "[!a].txt", "s*b/*"]
)
def test_glob_matches_like_path_glob(spark, tmp_path, pattern):
    for rel in ("a.txt", "b.txt", "c.md", "sub/a.txt", "sub/deep/d.txt", "sub/deep/.h/e.txt", "(x)+.txt"):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text("x")
    everything = [p.relative_to(tmp_path).as_posix() for p in tmp_path.rglob("*") if p.is_file()]
    frame = spark.createDataFrame([(p,) for p in everything], "path string")
    got = {r[0] for r in frame.where(F.col("path").rlike(names.glob_regex(pattern))).collect()}
    want = {p.relative_to(tmp_path).as_posix() for p in tmp_path.glob(pattern) if p.is_file()}
    assert got == want


@pytest.mark.parametrize(("path", "blank"), [("  / ", True), ("", True), (None, True), ("a", False), (" /a/", False)])
def test_blank_folder_paths(spark, path, blank):
    frame = spark.createDataFrame([(path,)], "path string")
    assert frame.select(names.is_blank_folder_path(F.col("path"))).first()[0] is blank
