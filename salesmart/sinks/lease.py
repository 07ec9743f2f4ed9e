"""One run at a time: a lease on a warehouse.

A run that writes keys or versions takes the lease first and gives it back at its end. The
lease is a file that is created only if it is not there, with its owner and the time at
which it may be taken over: a run that dies blocks the next one until then, not for ever.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

NAME = "_lease"
#: Seconds after which a lease that was not given back may be taken over.
EXPIRY = 6 * 3600


class LeaseError(RuntimeError):
    """Another run holds the warehouse."""


def _file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def _read(file, files) -> tuple[str, float]:
    """Owner and expiry; a lease that is being written has neither yet."""
    stream = files.open(file)
    try:
        owner, _, until = bytes(stream.readAllBytes()).decode().partition(" ")
    finally:
        stream.close()
    return owner, float(until) if until else float("inf")


def _create(file, files, text: str) -> bool:
    """Whether the file was made here; an existing one is left alone."""
    if not files.createNewFile(file):
        return False
    stream = files.create(file, True)
    stream.write(text.encode())
    stream.close()
    return True


def take(
    spark: SparkSession, root: str, expiry: float = EXPIRY, now: Callable[[], float] = time.time
) -> str:
    """Take the lease of a warehouse; returns its owner's name. Raises if another holds it.

    An expired lease is moved aside by a rename, which only one of several takers can do.
    """
    file, files = _file(spark, f"{root}/{NAME}")
    files.mkdirs(file.getParent())
    owner = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    text = f"{owner} {now() + expiry}"
    if _create(file, files, text):
        return owner
    holder, until = _read(file, files)
    if now() < until:
        raise LeaseError(f"{root} is held by {holder} until {until:.0f} (seconds since 1970)")
    aside, _ = _file(spark, f"{root}/{NAME}-{holder}")
    if not files.rename(file, aside) or not _create(file, files, text):
        raise LeaseError(f"{root} was taken over by another run")
    files.delete(aside, False)
    return owner


def give_back(spark: SparkSession, root: str, owner: str) -> None:
    """Remove the lease, unless it was taken over."""
    file, files = _file(spark, f"{root}/{NAME}")
    if files.exists(file) and _read(file, files)[0] == owner:
        files.delete(file, False)


@contextmanager
def held(spark: SparkSession, root: str, expiry: float = EXPIRY) -> Iterator[str]:
    owner = take(spark, root, expiry)
    try:
        yield owner
    finally:
        give_back(spark, root, owner)
