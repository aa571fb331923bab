"""Numbered commits in a folder: each is a file that is created if it isn't there, and never changed.

Whoever creates a number has made that commit; of two writers of one number the second is told so and
decides anew. Readers take the largest number. Works where a file can be linked (local and mounted folders) or where
renaming doesn't replace (HDFS and its like).
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None where there is none."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, whatever stood there."""
    fs, target = file_system(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call made the file; one that exists stays as it is. The text is written under
    another name first, so nobody reads half of it, and a writer that dies leaves no such file."""
    fs, target = file_system(spark, path)
    if fs.exists(target):
        return False
    draft = f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}"
    replace_text(spark, draft, text)
    source = file_system(spark, draft)[1]
    try:
        if fs.getUri().getScheme() != "file":
            return fs.rename(source, target)  # false where the target exists
        os.link(source.toUri().getPath(), target.toUri().getPath())  # renaming would replace it here
        return True
    except FileExistsError:
        return False
    finally:
        fs.delete(source, False)


def as_json(body: dict) -> str:
    return json.dumps(body, sort_keys=True, default=str)


def from_json(text: str) -> dict:
    return json.loads(text)


def commit_path(log: str, number: int) -> str:
    return f"{log}/{number:010d}.json"


def numbers(spark: SparkSession, log: str) -> list[int]:
    """The numbers of commits, by the names in the folder."""
    fs, target = file_system(spark, log)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_commit(spark: SparkSession, log: str, number: int) -> dict | None:
    text = read_text(spark, commit_path(log, number))
    return from_json(text) if text else None


def latest(spark: SparkSession, log: str) -> tuple[int, dict]:
    """The newest commit and its number; (0, {}) before the first."""
    known = numbers(spark, log)
    return (known[-1], read_commit(spark, log, known[-1]) or {}) if known else (0, {})


def commit(spark: SparkSession, log: str, number: int, body: dict) -> bool:
    """Whether ``body`` became commit ``number``."""
    return create_text(spark, commit_path(log, number), as_json(body))
