"""Outputs published by manifests: readers see a whole old or a whole new version on any store, without renames.

A version is data in a folder of its own and one manifest file that names it. The data is written and checked first; the version
exists once its manifest does. Manifests are numbered and never overwritten, so of two writers that meet one fails, and a
reader takes the highest number whose text is whole. Nothing has to be moved, so a store where a rename copies files does as well
as one where it is atomic.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tallyforge.sources.writers import StagedWriteError, _fs, exists


def _sealed(facts: dict) -> str:
    body = json.dumps(facts, sort_keys=True)
    return json.dumps({"facts": facts, "digest": hashlib.sha256(body.encode()).hexdigest()})


def _opened(text: str) -> dict | None:
    """The facts of a manifest, or None if its text is torn."""
    try:
        outer = json.loads(text)
        body = json.dumps(outer["facts"], sort_keys=True)
        return outer["facts"] if hashlib.sha256(body.encode()).hexdigest() == outer["digest"] else None
    except (ValueError, KeyError, TypeError):
        return None


def versions(spark: SparkSession, root: str) -> dict[int, dict]:
    """Facts of all whole manifests by version number."""
    folder = f"{root.rstrip('/')}/manifests"
    if not exists(spark, folder):
        return {}
    found = {}
    fs, path = _fs(spark, folder)
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v") and name[1:].isdigit():
            stream = fs.open(status.getPath())
            facts = _opened(bytes(stream.readAllBytes()).decode("utf-8", "replace"))
            stream.close()
            if facts is not None:
                found[int(name[1:])] = facts
    return found


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """All numbers that are taken, torn manifests included."""
    folder = f"{root.rstrip('/')}/manifests"
    if not exists(spark, folder):
        return []
    fs, path = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]


def _put_manifest(spark: SparkSession, root: str, number: int, text: str) -> None:
    fs, path = _fs(spark, f"{root.rstrip('/')}/manifests/v{number:012d}")
    stream = fs.create(path, False)  # fails if another writer has the number
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def publish(df: DataFrame, root: str, validate: Callable[[DataFrame], bool] | None = None, compression: str = "snappy") -> int:
    """Write a new version and make it current; return its number. An empty or refused output leaves the old version current."""
    spark = df.sparkSession
    before = max(_numbers(spark, root), default=0)
    place = f"data/{uuid.uuid4()}"
    path = f"{root.rstrip('/')}/{place}"
    df.write.option("compression", compression).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    rows = written.count()
    if rows == 0 or (validate is not None and not validate(written)):
        raise StagedWriteError(f"output for {root} failed validation; kept at {path}")
    _put_manifest(spark, root, before + 1, _sealed({"path": place, "rows": rows, "schema": df.schema.json()}))
    return before + 1


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest whole version, or the given one."""
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no such version of {root}")
    facts = known[max(known) if version is None else version]
    return spark.read.schema(StructType.fromJson(json.loads(facts["schema"]))).parquet(f"{root.rstrip('/')}/{facts['path']}")


def retire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete the data of all but the newest ``keep`` versions, manifests first; return the numbers deleted."""
    known = versions(spark, root)
    old = sorted(known)[: max(len(known) - max(keep, 1), 0)]
    for number in old:
        for name in (f"manifests/v{number:012d}", known[number]["path"]):
            fs, path = _fs(spark, f"{root.rstrip('/')}/{name}")
            fs.delete(path, True)
    return old
