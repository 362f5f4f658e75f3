"""Targets as immutable snapshots and a log of small files that says which one holds.

A target is a folder. A writer fills a folder ``_snapshot=<number>-<tag>`` of its own in it and then adds
``_commits/<number>.json``, which lists the folders that make up the new state: usually the new
one, or some partitions of it beside partitions of older snapshots. Readers take the last complete
commit. So a writer that ends at any point leaves the last state readable, and several tables below one target
change together. Nothing is renamed and nothing is copied, whatever the store.

Two writers of one target race for the number of a commit; the second one gets ``Conflict``, as far as the
store can create a file only if it is not there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from zlib import crc32

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMITS = "_commits"
PREFIX = "_snapshot="
KEEP = 2  # states that stay readable for those who resolved them before a switch


class Conflict(RuntimeError):
    """Another writer has committed to the target since this one began."""


class NoSnapshot(RuntimeError):
    """A target that has never been committed to."""


@dataclass(frozen=True)
class Commit:
    """State ``number`` of a target: its folders, relative to the target, and what the writer noted."""

    number: int
    paths: tuple[str, ...]
    facts: dict = field(default_factory=dict)


class Folder:
    """Files below ``path`` on whatever file system holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._jvm(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str) -> str:
        return f"{self.path}/{name}" if name else self.path

    def names(self, below: str = "") -> dict[str, bool]:
        """Name of each child, and whether it is a folder; empty for what does not exist."""
        place = self._jvm(self.at(below))
        if not self._files.exists(place) or not self._files.getFileStatus(place).isDirectory():
            return {}
        return {s.getPath().getName(): s.isDirectory() for s in self._files.listStatus(place)}

    def put_new(self, name: str, text: str) -> None:
        """A file with a checksum as its last line; ``Conflict`` if there is one of that name."""
        try:
            stream = self._files.create(self._jvm(self.at(name)), False)
        except Py4JJavaError as refused:
            raise Conflict(f"{self.at(name)} is there already") from refused
        stream.write(f"{text}\n{crc32(text.encode()):08x}\n".encode())
        stream.close()

    def get(self, name: str) -> str | None:
        """Text of a file of ``put_new``, None where its writer did not get to its end."""
        stream = self._files.open(self._jvm(self.at(name)))
        try:
            read = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        except Py4JJavaError as failed:
            if failed.java_exception.getClass().getSimpleName() != "ChecksumException":
                raise
            return None  # the file system's own checksums were not written to their end either
        finally:
            stream.close()
        text, _, tail = read.rpartition("\n")[0].rpartition("\n")
        return text if read.endswith("\n") and tail == f"{crc32(text.encode()):08x}" else None

    def delete(self, name: str) -> None:
        self._files.delete(self._jvm(self.at(name)), True)


def is_target(spark: SparkSession, path: str) -> bool:
    return any(n == COMMITS or n.startswith(PREFIX) for n in Folder(spark, path).names())


def commits(spark: SparkSession, target: str, most: int | None = None) -> list[Commit]:
    """The complete commits, the latest first; ``most`` of them."""
    folder, found = Folder(spark, target), []
    for name in sorted(folder.names(COMMITS), reverse=True):
        if most is not None and len(found) == most:
            break
        text = folder.get(f"{COMMITS}/{name}") if name.endswith(".json") else None
        if text is not None:
            said = json.loads(text)
            found.append(Commit(int(name[:-5]), tuple(said["paths"]), said["facts"]))
    return found


def begin(spark: SparkSession, target: str) -> tuple[int, str]:
    """Number and folder for a new state. Nothing is created yet."""
    numbers = [int(n[:-5]) for n in Folder(spark, target).names(COMMITS) if n.endswith(".json")]
    number = max(numbers, default=0) + 1
    return number, f"{PREFIX}{number:08d}-{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, target: str, number: int, paths: Sequence[str], **facts) -> Commit:
    """Make ``paths`` the state of ``target``."""
    said = json.dumps({"paths": list(paths), "facts": facts})
    Folder(spark, target).put_new(f"{COMMITS}/{number:08d}.json", said)
    return Commit(number, tuple(paths), facts)


def expire(spark: SparkSession, target: str, keep: int = KEEP) -> None:
    """Delete what no commit but older ones than the last ``keep`` uses, and what writers that failed have left.

    A folder with a number beyond the last commit may have a writer at work, and stays.
    """
    folder, known = Folder(spark, target), commits(spark, target, keep)
    if not known:
        return
    used = {path for c in known for path in c.paths}

    def clean(path: str) -> None:
        if path in used:
            return
        if not any(u.startswith(f"{path}/") for u in used):
            folder.delete(path)
            return
        for name, is_folder in folder.names(path).items():
            if is_folder:
                clean(f"{path}/{name}")

    for name in folder.names():
        if name.startswith(PREFIX) and int(name[len(PREFIX) :].partition("-")[0]) <= known[0].number:
            clean(name)
    for name in folder.names(COMMITS):
        if name.endswith(".json") and int(name[:-5]) < known[-1].number:
            folder.delete(f"{COMMITS}/{name}")


@contextmanager
def replaced(spark: SparkSession, target: str, keep: int = KEEP, **facts) -> Iterator[str]:
    """A folder that becomes the state of ``target`` when the block ends without an error.

    A plain folder at ``target``, as other tools write it, is no longer read from then on.
    """
    number, name = begin(spark, target)
    try:
        yield f"{target.rstrip('/')}/{name}"
    except BaseException:
        Folder(spark, target).delete(name)
        raise
    commit(spark, target, number, [name], **facts)
    expire(spark, target, keep)


def state(spark: SparkSession, target: str) -> list[str] | None:
    """Folders of the current state; None for a folder that is no target. A target without a commit is an error."""
    last = commits(spark, target, 1)
    if last:
        return [f"{target.rstrip('/')}/{path}" for path in last[0].paths]
    if is_target(spark, target):
        raise NoSnapshot(f"nothing was ever committed to {target}")
    return None


def holds_targets(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder of targets, as windows that are landed are."""
    folder = Folder(spark, path)
    return any(is_target(spark, folder.at(name)) for name, is_folder in folder.names().items() if is_folder)


def landed(spark: SparkSession, path: str) -> list[str]:
    """What to read of a folder of windows: the current folders of windows that are targets, others as they are.

    A window whose first landing has not ended yet has nothing to read.
    """
    folder = Folder(spark, path)
    names = folder.names()
    if any(n == COMMITS or n.startswith(PREFIX) for n in names):
        return state(spark, path)
    windows = {n: commits(spark, folder.at(n), 1) for n, is_folder in names.items() if is_folder and is_target(spark, folder.at(n))}
    if not windows:
        return [path]
    found = [folder.at(f"{n}/{p}") for n, last in windows.items() for c in last for p in c.paths]
    return found + [folder.at(n) for n in names if n not in windows and not n.startswith(("_", "."))]


def read_parquet(spark: SparkSession, target: str, schema: StructType | None = None) -> DataFrame:
    """The current state of ``target``, or a plain folder, as one frame; with ``schema`` an empty state reads as no rows."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    folders = state(spark, target)
    if folders is None:
        return reader.parquet(target)
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    if len(folders) == 1:
        return reader.option("basePath", folders[0].partition(f"/{PREFIX}")[0] + _below(folders[0])).parquet(*folders)
    return reader.option("basePath", target).parquet(*folders).drop(PREFIX[:-1])


def _below(folder: str) -> str:
    """The snapshot's own folder within the path of one of its partitions."""
    return f"/{PREFIX}" + folder.partition(f"/{PREFIX}")[2].partition("/")[0]
