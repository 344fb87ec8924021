"""Version files: small JSON files that exist once or not at all, in a folder that all writers share.

A writer prepares its data under a name of its own and then publishes it by creating the next version file. Only one
writer can create a given version; the other reads what the winner did and tries the next. So readers see all of a
change or nothing, and no writer's change is lost.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from typing import Any
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

_DIGITS = 12
_NAME = re.compile(r"^(\d{12})\.json$")


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _bytes(spark: SparkSession, path: str, text: str) -> None:
    target, files = _path(spark, path)
    stream = files.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content unless it exists; False if it does.

    The content is written beside it first. In a local folder a hard link publishes it, elsewhere a rename that refuses
    an existing target, which has to be atomic in the store (as in HDFS).
    """
    target, files = _path(spark, path)
    if files.exists(target):
        return False
    beside = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}.tmp"
    _bytes(spark, beside, text)
    prepared, _ = _path(spark, beside)
    try:
        if files.getScheme() == "file":
            try:
                os.link(_local(beside), _local(path))
            except FileExistsError:
                return False
            return True
        none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), spark._jsc.hadoopConfiguration()
        )
        try:
            context.rename(prepared, target, options)
        except Exception:
            if files.exists(target):
                return False
            raise
        return True
    finally:
        files.delete(prepared, False)


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The committed versions in order: file names only."""
    target, files = _path(spark, folder)
    if not files.exists(target):
        return []
    names = (status.getPath().getName() for status in files.listStatus(target))
    return sorted(int(m[1]) for m in map(_NAME.match, names) if m)


def version_file(folder: str, version: int) -> str:
    return f"{folder}/{version:0{_DIGITS}d}.json"


def read_version(spark: SparkSession, folder: str, version: int) -> dict[str, Any]:
    target, files = _path(spark, version_file(folder, version))
    stream = files.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, content: Callable[[int], dict[str, Any]], most: int = 1000) -> int:
    """Publish ``content(version)`` as the next version, and return its number. ``content`` is asked again for each attempt,
    so it can take into account what other writers published in the meantime."""
    for _ in range(most):
        done = versions(spark, folder)
        version = done[-1] + 1 if done else 1
        if create_once(spark, version_file(folder, version), json.dumps(content(version), sort_keys=True)):
            return version
    raise RuntimeError(f"no version of {folder} could be committed in {most} attempts")
