"""Versions of a set of tables behind one pointer.

A folder holds any number of written versions and, below ``_pointer``, one small file per
published one: its number and a state, which names what belongs to it. A version becomes
current by the rename of that file, the last step of its writer. Readers take the newest
pointer once and use its paths, so they see all of a version or nothing of it; a writer
that fails before the rename leaves the version before it in place.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

POINTERS = "_pointer"


class ConcurrentPublish(RuntimeError):
    """Another writer has published the same number."""


def _system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def delete(spark: SparkSession, name: str) -> None:
    """A file or folder with all that is below it, if it is there."""
    system, path = _system(spark, name)
    system.delete(path, True)


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The published numbers, ascending."""
    system, path = _system(spark, f"{root}/{POINTERS}")
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def state(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The state of the current (or a given) version; None where nothing is published."""
    if number is None:
        published = numbers(spark, root)
        if not published:
            return None
        number = published[-1]
    system, path = _system(spark, f"{root}/{POINTERS}/{number:012d}")
    stream = system.open(path)
    try:
        size = system.getFileStatus(path).getLen()
        return json.loads(bytes(stream.readNBytes(size)).decode()) | {"number": number}
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, content: dict, number: int) -> dict:
    """Make ``content`` the state of version ``number``; raises where that number is taken."""
    system, target = _system(spark, f"{root}/{POINTERS}/{number:012d}")
    _, draft = _system(spark, f"{root}/{POINTERS}/.draft-{uuid.uuid4().hex}")
    if system.exists(target):
        raise ConcurrentPublish(f"version {number} of {root} is published already")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(json.dumps({k: v for k, v in content.items() if k != "number"}).encode()))
    finally:
        stream.close()
    if not system.rename(draft, target):
        system.delete(draft, False)
        raise ConcurrentPublish(f"version {number} of {root} is published already")
    return content | {"number": number}


def forget(spark: SparkSession, root: str, keep: int) -> list[dict]:
    """Take back the pointers of all but the newest ``keep`` versions; returns their states, oldest first."""
    if keep < 1:
        raise ValueError("the current version stays")
    old = [state(spark, root, n) for n in numbers(spark, root)[:-keep]]
    for one in old:
        delete(spark, f"{root}/{POINTERS}/{one['number']:012d}")
    return old
