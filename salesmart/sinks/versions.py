"""Whole tables that are replaced in one step.

A version of a table is a folder of its own, written in full before anyone can see it. A
small file in ``_manifest``, whose name is the version's number, names the folder; it is
put there by one rename, which is the commit. Readers take the highest number. So a table
is never empty or half written: a run that dies leaves the version before in place, and
two runs cannot both commit the same number.

The version before the current one is kept for readers that began with it; older ones,
and folders that were never committed, go with the next commit.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

MANIFEST = "_manifest"
_DIGITS = 10
#: Committed versions that stay, the current one included.
KEPT = 2


class ConflictError(RuntimeError):
    """Another run committed a version of the table meanwhile."""


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    folder, files = _folder(spark, f"{path}/{MANIFEST}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _manifest(path: str, number: int) -> str:
    return f"{path}/{MANIFEST}/{number:0{_DIGITS}d}"


def _named(spark: SparkSession, path: str, number: int) -> str:
    """The folder that a version's manifest names."""
    manifest, files = _folder(spark, _manifest(path, number))
    stream = files.open(manifest)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the current version, or the path itself for a plain table."""
    numbers = _numbers(spark, path)
    return f"{path}/{_named(spark, path, numbers[-1])}" if numbers else path


def next_version(spark: SparkSession, path: str) -> tuple[str, int]:
    """A fresh folder to write, and the number that it will have."""
    numbers = _numbers(spark, path)
    return f"{path}/data-{uuid.uuid4().hex}", (numbers[-1] if numbers else 0) + 1


def commit(spark: SparkSession, path: str, folder: str, number: int) -> None:
    """Make a written folder the current version; raises if the number is taken."""
    name = folder.rsplit("/", 1)[-1]
    draft, files = _folder(spark, f"{path}/{MANIFEST}/draft-{uuid.uuid4().hex}")
    files.mkdirs(draft.getParent())
    stream = files.create(draft, False)
    stream.write(name.encode())
    stream.close()
    final, _ = _folder(spark, _manifest(path, number))
    # A rename to a name that exists moves nothing: local and object stores would replace
    # it, so it is looked for first; the lease of a run keeps others out between the two.
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise ConflictError(f"version {number} of {path} was committed by another run")


def drop_old(spark: SparkSession, path: str) -> list[str]:
    """Remove all but the last versions, and what was never committed; returns the names."""
    numbers = _numbers(spark, path)
    kept = {_named(spark, path, n) for n in numbers[-KEPT:]} | {MANIFEST}
    for number in numbers[:-KEPT]:
        manifest, files = _folder(spark, _manifest(path, number))
        files.delete(manifest, False)
    folder, files = _folder(spark, path)
    gone = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName() not in kept]
    for old in gone:
        files.delete(old, True)
    return sorted(old.getName() for old in gone)
