"""File manifest source: what a directory or a list of files would upload.

Directories are listed and files are hashed in tasks.  A listing goes level by level: a
table of directories becomes a table of their entries, whose directories are the next
table.  The driver sees how many there are, never their names.
"""

from __future__ import annotations

import hashlib
import posixpath
import sys
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.names import component_order, glob_regex
from docloom.session import materialize, releasing_shuffles, scratch_path

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that a file is read and hashed by.
CHUNK_BYTES = 1 << 20
#: Directories of a listing task; bytes and files of a hashing task (one file is never split).
TASK_DIRECTORIES, TASK_BYTES, TASK_FILES = 32, 256 << 20, 1000


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:/") else "file:" + path


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a URI and the place in it; names need no escapes."""
    if uri.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    scheme, _, rest = uri.partition("://")
    authority, _, place = rest.partition("/")
    system, root = pyarrow.fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return system, posixpath.join(root, place)


def _list_directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Directories (path) -> their entries (path, size, is_directory)."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, place = _opened(path)
            entries = system.get_file_info(pyarrow.fs.FileSelector(place))
            found = [e for e in entries if e.type in (pyarrow.fs.FileType.File, pyarrow.fs.FileType.Directory)]
            for at in range(0, len(found), 10_000):
                part = found[at : at + 10_000]
                columns = [
                    pa.array([f"{path.rstrip('/')}/{e.base_name}" for e in part], pa.string()),
                    pa.array([e.size if e.is_file else None for e in part], pa.int64()),
                    pa.array([not e.is_file for e in part], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["path", "size", "is_directory"])


def _size_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path) -> path, size; a missing file is an error."""
    for batch in batches:
        sizes = []
        for path in batch.column(0).to_pylist():
            system, place = _opened(path)
            info = system.get_file_info(place)
            if not info.is_file:
                raise FileNotFoundError(path)
            sizes.append(info.size)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["path", "size"])


def _hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files (path, size) -> path, size, md5; a file of any size is read by chunks."""
    for batch in batches:
        for at in range(batch.num_rows):
            one, digest = batch.slice(at, 1), hashlib.md5(usedforsecurity=False)
            system, place = _opened(one.column(0)[0].as_py())
            with system.open_input_stream(place) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            yield pa.RecordBatch.from_arrays([*one.columns, pa.array([digest.hexdigest()])], ["path", "size", "md5"])


def hashed(files: DataFrame) -> DataFrame:
    """``path, size, md5`` of a table ``path, size``, hashed in tasks (runs a job to count them).

    Files are dealt out evenly; only their paths and sizes move.
    """
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    parts = max(1, min(total["n"], -(-total["bytes"] // TASK_BYTES) + -(-total["n"] // TASK_FILES)))
    return files.select("path", "size").repartition(parts).mapInArrow(_hash_files, "path string, size long, md5 string")


def _join_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files in order (target, parts) -> target, size: copied by chunks, under a hidden name until whole.

    The parts of a whole file go at once.  A repeated task that finds a part gone takes the
    file that the first one has left.
    """
    for batch in batches:
        for target, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            system, place = _opened(target)
            folder, name = posixpath.split(place)
            hidden = posixpath.join(folder, f".{name}-{uuid.uuid4().hex}")
            opened = [_opened(part) for part in parts]
            if all(source.get_file_info(at).is_file for source, at in opened):
                system.create_dir(folder)
                with system.open_output_stream(hidden, compression=None) as out:
                    for source, at in opened:
                        with source.open_input_stream(at, compression=None) as stream:
                            while chunk := stream.read(CHUNK_BYTES):
                                out.write(chunk)
                system.move(hidden, place)
            written = system.get_file_info(place)
            if not written.is_file:
                raise FileNotFoundError(f"{target}: parts are missing")
            for source, at in opened:
                if source.get_file_info(at).is_file:
                    source.delete_file(at)
            yield pa.RecordBatch.from_pydict({"path": [target], "size": [written.size]})


def write_text_per_key(rows: DataFrame, key: str, order: str, base: str, name: str) -> DataFrame:
    """Write ``text`` of ``rows``, a line each, to one file ``name`` per value of ``key`` below ``base``: ``path, size``.

    The rows are sorted and written as parts by many tasks, however many of them share a
    value; what one task does alone is to copy the bytes of a value's parts, in their order,
    into its file.  The parts go as the files get whole.  Folders are named ``key=value`` as
    by ``partitionBy``; files of that name must not be there yet.  Runs jobs.
    """
    spark = rows.sparkSession
    parts, base = scratch_path(spark, "parts"), _plain(_uri(base.rstrip("/")))
    dealt = rows.repartitionByRange(key, order).sortWithinPartitions(key, order)
    with releasing_shuffles(spark):
        dealt.select("text", key).write.partitionBy(key).text(parts)
    found = listed_tree(spark, parts).withColumn("rel_path", relative_path(F.col("path"), parts))
    found = found.where(F.col("rel_path").rlike("/part-[^/]*$"))
    number = F.regexp_extract("rel_path", "/part-([0-9]+)", 1).cast("long")
    folder = F.substring_index("rel_path", "/", 1)
    target = F.concat(F.lit(base + "/"), folder, F.lit("/" + name))
    grouped = found.groupBy(target.alias("target")).agg(F.array_sort(F.collect_list(F.struct(number.alias("number"), "path"))).alias("parts"))
    grouped = materialize(grouped.select("target", F.col("parts.path").alias("parts")), "parts-listed")
    system, place = _opened(base)
    system.create_dir(place)
    joined = grouped.repartition(max(1, grouped.count())).mapInArrow(_join_files, "path string, size long")
    written = materialize(joined, "joined")
    system, place = _opened(_uri(parts))
    system.delete_dir(place)
    return written


def listed_tree(spark: SparkSession, base: str) -> DataFrame:
    """All files below the directory ``base``, at any depth and of any name: ``path, size``.

    Runs a job per level of directories; each level is a written table.
    """
    level = spark.createDataFrame([(_plain(_uri(base.rstrip("/"))),)], "path string")
    found, directories = None, 1
    while directories:
        spread = level.repartition(-(-directories // TASK_DIRECTORIES))
        entries = materialize(spread.mapInArrow(_list_directories, "path string, size long, is_directory boolean"), "listing")
        files = entries.where("not is_directory").select("path", "size")
        found = files if found is None else found.unionByName(files)
        level = entries.where("is_directory").select("path")
        directories = level.count()
    return found


def file_manifest(
    spark: SparkSession,
    base: str,
    *,
    pattern: str = "**/*",
    with_md5: bool = True,
    include_hidden: bool = True,
) -> DataFrame:
    """``path, rel_path, size[, md5]`` of the files below ``base`` that match ``pattern`` (runs a job per level).

    Files whose own name starts with a dot are left out; other names, and files in
    dot or underscore directories, are kept.  ``include_hidden=False`` leaves out every
    name with a leading dot or underscore, at any depth, as Spark's own listing does.
    Without md5 the contents are not read; with it only those of matching files.  Order
    it with :func:`manifest_order`.
    """
    files = listed_tree(spark, base).withColumn("rel_path", relative_path(F.col("path"), base))
    own_name = F.substring_index("rel_path", "/", -1)
    files = files.where(F.col("rel_path").rlike(glob_regex(pattern)) & ~own_name.startswith("."))
    if not include_hidden:
        files = files.where(~F.col("rel_path").rlike("(^|/)[._]"))
    if with_md5:
        files = hashed(files).withColumn("rel_path", relative_path(F.col("path"), base))
    return files.select("path", "rel_path", "size", *(["md5"] if with_md5 else []))


def _plain(uri: str) -> str:
    """A path without the empty authority that different APIs render differently."""
    return "file:/" + uri[len("file:") :].lstrip("/") if uri.startswith("file:") else uri


def _plain_column(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def relative_path(path: Column, base: str) -> Column:
    """The part of a file's path below the directory ``base``."""
    skip = len(_plain(_uri(base.rstrip("/")))) + 1
    return F.substring(_plain_column(path), F.lit(skip + 1), F.length(path))


def manifest_order() -> list[Column]:
    """Sort keys of a manifest: by path, component by component."""
    return [component_order(F.col("rel_path"))]


def require_files(manifest: DataFrame, what: str) -> DataFrame:
    """Raise when nothing matched (runs a job)."""
    if manifest.isEmpty():
        raise ValueError(f"no files found for {what}")
    return manifest


def listed_files(
    spark: SparkSession, paths: Sequence[str], *, with_md5: bool = True
) -> DataFrame:
    """Manifest ``path, given, size[, md5]`` of an explicit list, ``given`` verbatim; sizes are read in tasks."""
    if not paths:
        raise ValueError("give at least one file")
    given = spark.createDataFrame(
        [(_plain(_uri(path)), path, position) for position, path in enumerate(paths)],
        "path string, given string, position long",
    )
    distinct = given.select("path").distinct().repartition(-(-len(paths) // TASK_FILES))
    files = materialize(distinct.mapInArrow(_size_files, "path string, size long"), "listed")
    return given.join(hashed(files) if with_md5 else files, "path")
