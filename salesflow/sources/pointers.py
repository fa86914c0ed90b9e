"""A folder whose current state is named by its newest pointer file.

What a state refers to is written first, under names of its own; then one rename makes it current. A job
that dies before that leaves files that no state refers to, and readers go on with the old one.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTERS = "_states"  # Spark's readers skip names that begin like this


class StateChanged(RuntimeError):
    """Another writer has published a state in the meantime."""


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path, and the file system it lies in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, none if there is no such folder."""
    target, files = _path(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    target, files = _path(spark, path)
    files.delete(target, True)


def current_state(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """(number, state) published last in ``folder``; (0, {}) before the first."""
    numbers = [int(m[1]) for name in folder_names(spark, f"{folder}/{POINTERS}") if (m := re.fullmatch(r"(\d+)\.json", name))]
    if not numbers:
        return 0, {}
    target, files = _path(spark, f"{folder}/{POINTERS}/{max(numbers):012d}.json")
    stream = files.open(target)
    try:
        return max(numbers), json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish_state(spark: SparkSession, folder: str, state: dict, after: int) -> None:
    """Make ``state`` the current one. ``after`` is the number of the state it was made from: if that is no longer the
    last one, ``StateChanged`` is raised and nothing changes."""
    jvm = spark.sparkContext._jvm
    written, files = _path(spark, f"{folder}/{POINTERS}/.{uuid.uuid4().hex}")
    stream = files.create(written, False)
    try:
        stream.write(bytearray(json.dumps(state).encode()))
    finally:
        stream.close()
    target, _ = _path(spark, f"{folder}/{POINTERS}/{after + 1:012d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(written), files.makeQualified(target), options)
    except Py4JJavaError as error:
        files.delete(written, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise StateChanged(f"{folder} has changed since state {after}") from None
        raise
