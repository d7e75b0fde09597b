"""Tables that are replaced whole or not at all.

A table is written beside its place first. When all of it is there, its folder gets a name that says so, the table before it
is set aside, and the new one takes its place: each of these steps is a rename. A run that is killed leaves the old or the
new table in its place, or both beside it; whoever opens or writes the table next puts the newest whole one there. Folders
beside a table begin with ``_``, so no reader of the layer sees them.

With partitions, each partition folder is replaced by itself, so that others are neither read nor written. Renames are those of
the file system Spark writes to: on HDFS and local disks one step each. On a store that copies to rename, a step takes longer and
the order of steps is what protects the table.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession

WRITING, READY, OLD = "_writing-", "_ready-", "_old-"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Folders:
    """Folders of the file systems that Spark knows."""

    def __init__(self, spark: SparkSession):
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, path: str) -> list[str]:
        """Names of the folders in a folder, sorted."""
        system, place = self._at(path)
        if not system.exists(place):
            return []
        return sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())

    def files(self, path: str) -> list[str]:
        """Paths of the data files below a folder, sorted; names that begin with ``_`` or ``.`` are no data."""
        system, place = self._at(path)
        found, listed = [], system.listFiles(place, True)
        while listed.hasNext():
            at = listed.next().getPath()
            if not at.getName().startswith(("_", ".")):
                found.append(at.toString())
        return sorted(found)

    def rename(self, source: str, target: str) -> None:
        system, place = self._at(source)
        if not system.rename(place, self._fs.Path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def make(self, path: str) -> None:
        system, place = self._at(path)
        system.mkdirs(place)

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or "/", name


def _beside(folders: Folders, path: str, kind: str) -> list[str]:
    parent, name = _split(path)
    return [f"{parent}/{n}" for n in folders.names(parent) if n.startswith(f"{kind}{name}-")]


def _new_beside(path: str, kind: str) -> str:
    parent, name = _split(path)
    return f"{parent}/{kind}{name}-{uuid4().hex}"


def recover(folders: Folders, path: str) -> None:
    """Put a whole table in place if a killed run left none there, and remove what such runs left beside it."""
    ready, old = _beside(folders, path, READY), _beside(folders, path, OLD)
    if not folders.exists(path) and (ready or old):
        folders.rename((ready or old)[0], path)
    for rest in [*_beside(folders, path, READY), *_beside(folders, path, OLD)]:
        folders.delete(rest)


def needs_recovery(folders: Folders, path: str) -> bool:
    return not folders.exists(path) and bool(_beside(folders, path, READY) or _beside(folders, path, OLD))


def _swap(folders: Folders, ready: str, path: str) -> None:
    old = _new_beside(path, OLD)
    if folders.exists(path):
        folders.rename(path, old)
    folders.rename(ready, path)
    folders.delete(old)


def replace_table(
    spark: SparkSession, path: str, write: Callable[[str], None], accept: Callable[[], None] | None = None, folders: Folders | None = None
) -> None:
    """Let ``write`` fill a folder, and make it the table at ``path``.

    ``accept`` is called between the two; when it raises, the table stays as it was.
    """
    folders = folders or Folders(spark)
    recover(folders, path)
    for unfinished in _beside(folders, path, WRITING):
        folders.delete(unfinished)
    staged, ready = _new_beside(path, WRITING), _new_beside(path, READY)
    write(staged)
    if accept:
        try:
            accept()
        except Exception:
            folders.delete(staged)
            raise
    folders.rename(staged, ready)
    _swap(folders, ready, path)


def _leaves(folders: Folders, root: str, depth: int) -> list[str]:
    """Partition folders below a folder, as paths relative to it."""
    found = [""]
    for _ in range(depth):
        found = [f"{at}/{n}" if at else n for at in found for n in folders.names(f"{root}/{at}" if at else root) if "=" in n]
    return found


def recover_partitions(folders: Folders, path: str, depth: int) -> None:
    """As ``recover``, for each partition folder, also those that are only beside their place."""
    for at in _leaves(folders, path, depth - 1):
        parent = f"{path}/{at}" if at else path
        for name in folders.names(parent):
            for kind in (READY, OLD):
                if name.startswith(kind):
                    recover(folders, f"{parent}/{name[len(kind) :].rpartition('-')[0]}")


def replace_partitions(
    spark: SparkSession, path: str, depth: int, write: Callable[[str], None], wanted: list[str] | None = None,
    accept: Callable[[], None] | None = None, folders: Folders | None = None,
) -> list[str]:
    """Let ``write`` fill a folder with partitions, and replace these at ``path``, one after the other; all others stay.

    ``wanted`` names partitions (``a=1/b=2``) that are to be replaced also when nothing was written for them: they go.
    Returns what was replaced.
    """
    folders = folders or Folders(spark)
    recover_partitions(folders, path, depth)
    parent, name = _split(path)
    staged = f"{parent}/{WRITING}{name}-{uuid4().hex}"
    for unfinished in _beside(folders, path, WRITING):
        folders.delete(unfinished)
    write(staged)
    if accept:
        try:
            accept()
        except Exception:
            folders.delete(staged)
            raise
    written = _leaves(folders, staged, depth)
    for leaf in written:
        target = f"{path}/{leaf}"
        folders.make(_split(target)[0])
        ready = _new_beside(target, READY)
        folders.rename(f"{staged}/{leaf}", ready)
        _swap(folders, ready, target)
    gone = [leaf for leaf in wanted or [] if leaf not in written]
    for leaf in gone:
        folders.delete(f"{path}/{leaf}")
    folders.delete(staged)
    return written + gone


def partition_folder(**values: object) -> str:
    """``a=1/b=2``, as Spark names the folders of numbers and missing values."""
    return "/".join(f"{k}={NO_VALUE if v is None else v}" for k, v in values.items())


def clustered(df: DataFrame, columns: tuple[str | Column, ...]) -> DataFrame:
    """Rows in ranges of ``columns``, sorted within each file, so that row groups have narrow bounds of them."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
