"""Small JSON records in a folder: each is one file that appears whole or not at all.

A record gets a name of its own and is never changed, so writers in several processes do not meet. Names sort in the
order in which records are to be read. Nothing here runs a Spark job.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from sheetmill.session import files_of

_END = ".json"


def put_record(spark: SparkSession, folder: str, name: str, value: dict[str, Any]) -> None:
    """Write a record; it is moved to its place when it is complete."""
    files, target = files_of(spark, f"{folder}/{name}{_END}")
    _, draft = files_of(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    if not files.rename(draft, target):
        raise OSError(f"cannot put {target} in place")


def record_names(spark: SparkSession, folder: str) -> list[str]:
    files, location = files_of(spark, folder)
    if not files.exists(location):
        return []
    names = [f.getPath().getName() for f in files.listStatus(location)]
    return sorted(n.removesuffix(_END) for n in names if n.endswith(_END) and not n.startswith("."))


def read_record(spark: SparkSession, folder: str, name: str) -> dict[str, Any] | None:
    """The record, or None where it has been deleted meanwhile."""
    files, location = files_of(spark, f"{folder}/{name}{_END}")
    try:
        stream = files.open(location)
    except Py4JJavaError:
        if files.exists(location):
            raise
        return None
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_records(spark: SparkSession, folder: str) -> list[tuple[str, dict[str, Any]]]:
    """All records with their names, in order."""
    found = [(name, read_record(spark, folder, name)) for name in record_names(spark, folder)]
    return [(name, value) for name, value in found if value is not None]


def next_name(spark: SparkSession, folder: str, tag: str) -> str:
    """A name after all records there are. Two writers may get the same number; their tags order them."""
    names = record_names(spark, folder)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    return f"{number:012d}-{tag}"


def delete_record(spark: SparkSession, folder: str, name: str) -> None:
    files, location = files_of(spark, f"{folder}/{name}{_END}")
    files.delete(location, False)
