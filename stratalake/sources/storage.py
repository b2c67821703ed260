"""Existence, size and removal of folders on whatever file system a path names."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Row, SparkSession

STREAM_LOG = "_spark_metadata"


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that two spellings of one folder compare equal."""
    files, folder = _open(spark, path)
    return files.makeQualified(folder).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    files, folder = _open(spark, path)
    return files.exists(folder)


def has_stream_log(spark: SparkSession, path: str) -> bool:
    """Whether a streaming query fills the table, whose log then lists its valid files."""
    return path_exists(spark, f"{path}/{STREAM_LOG}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored at ``path``.

    A failing storage call raises. Reading it as "no table yet" would overwrite the table.
    """
    files, folder = _open(spark, path)
    if not files.exists(folder):
        return False
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return any(n == STREAM_LOG or not n.startswith(("_", ".")) for n in names)


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    files, name = _open(spark, path)
    files.create(name, True).close()


def size_in_bytes(spark: SparkSession, path: str) -> int:
    """Stored size of a folder, or of all folders that a glob matches."""
    files, pattern = _open(spark, path)
    found = files.globStatus(pattern) or []
    return sum(files.getContentSummary(status.getPath()).getLength() for status in found)


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _open(spark, path)
    files.delete(folder, True)


#: Renaming and deleting are waits for the file system; some of them at a time.
_AT_ONCE = 16


def each(work: Callable, things: Iterable) -> None:
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        for _ in pool.map(work, things):
            pass


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder. As for Spark, names that begin with an underscore or a dot hold no data."""
    files, folder = _open(spark, path)
    if not files.exists(folder):
        return []
    found, folders = [], [folder]
    while folders:
        for status in files.listStatus(folders.pop()):
            place = status.getPath()
            if place.getName().startswith(("_", ".")):
                continue
            if status.isDirectory():
                folders.append(place)
            else:
                found.append(place.toString())
    return sorted(found)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder. One that is no longer there was moved by an earlier attempt."""
    files, origin = _open(spark, source)
    _, place = _open(spark, target)
    if not files.exists(origin):
        return
    files.mkdirs(place.getParent())
    if not files.rename(origin, place):
        raise OSError(f"could not move {source} to {target}")


def write_lines(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """Write a small text file. It appears under its name when it is complete."""
    files, unfinished = _open(spark, f"{path}.unfinished")
    out = files.create(unfinished, True)
    out.write(bytearray("".join(f"{line}\n" for line in lines).encode()))
    out.close()
    remove(spark, path)
    move(spark, f"{path}.unfinished", path)


def read_lines(spark: SparkSession, path: str) -> list[str]:
    return [r["value"] for r in spark.read.text(path).collect()] if path_exists(spark, path) else []


def file_of(metadata_path: str) -> str:
    """The path that ``_metadata.file_path`` names; there it is encoded as in a URL."""
    return unquote(metadata_path)


def partition_folder(path: str, values: Row, partition_columns: Iterable[str]) -> str:
    """Where a table at ``path`` keeps the rows of a partition of integer columns."""
    missing = "__HIVE_DEFAULT_PARTITION__"
    return "/".join([path, *(f"{c}={missing if values[c] is None else values[c]}" for c in partition_columns)])


def child_folders(spark: SparkSession, path: str) -> list[str]:
    files, folder = _open(spark, path)
    return sorted(s.getPath().toString() for s in files.listStatus(folder) if s.isDirectory())
