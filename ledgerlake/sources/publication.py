"""Which version of a table is the current one, decided by one file.

A version is a small JSON file `<number>.json`. It is put in place whole and only if no file has its name, so of
two writers that both began at version n only one can publish n + 1, and a reader sees a version or does not. Parts,
of whatever number, are switched by that one step.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published the version that this one wanted to."""


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of all published versions, in order."""
    return sorted(int(n[:-5]) for n in names(spark, folder) if n.endswith(".json") and n[:-5].isdigit())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds."""
    fs, path = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def read(spark: SparkSession, folder: str, version: int | None = None) -> tuple[int, dict]:
    """(number, content) of a version, the newest unless one is named; (0, {}) if nothing was published."""
    if version is None:
        found = versions(spark, folder)
        if not found:
            return 0, {}
        version = found[-1]
    fs, path = _fs(spark, f"{folder}/{version:012d}.json")
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(text)


def publish(spark: SparkSession, folder: str, after: int, content: dict) -> int:
    """Publish the version that follows `after`, unless another writer already has."""
    number = after + 1
    if number > 1 and versions(spark, folder)[-1:] != [after]:
        raise Conflict(f"{folder} is past version {after}; run the merge again")
    jvm, (fs, target) = spark._jvm, _fs(spark, f"{folder}/{number:012d}.json")
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(json.dumps(content).encode())
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            # a local rename replaces its target; a link does not, and is one step
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, none)
    except Exception as e:
        if isinstance(e, FileExistsError) or fs.exists(target):
            raise Conflict(f"{folder} is past version {after}; run the merge again") from e
        raise
    finally:
        fs.delete(draft, False)
    return number
