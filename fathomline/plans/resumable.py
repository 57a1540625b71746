"""Flows that go on where a failed run stopped.

Every step's result is a Parquet folder, and a small entry beside it says what it was made from: a fingerprint of the
input files, of the steps before it and of its own name and version. A later run with the same fingerprints reads the
folder back instead of computing it. The entry is published after the folder is complete, so a killed run leaves none.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fathomline.plans.flow import Transform
from fathomline.sinks.single import Folder


@dataclass(frozen=True)
class Step:
    """A named transform. Whoever changes what it computes raises ``version``; code is not looked into."""

    name: str
    transform: Transform
    version: str = "1"


@dataclass(frozen=True)
class Outcome:
    """The stored result of a step and whether this run read it back."""

    name: str
    path: str
    reused: bool


def _digest(*parts: str) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def files_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Of the names, lengths and times of change of all files below the paths; their content is not read.

    The sum of hashes does not depend on the order in which files are listed, and is taken on the executors.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load(list(paths)).select("path", "length", "modificationTime")
    hashes = [F.sum(F.xxhash64(F.lit(seed), *files.columns).cast("decimal(38,0)")) for seed in (0, 1)]
    n, low, high = files.agg(F.count(F.lit(1)), *hashes).first()
    return _digest(str(n), str(low), str(high))


class ResumableFlow:
    """Steps over files, with results kept below ``folder``, which all executors can reach."""

    def __init__(self, read: Callable[[SparkSession], DataFrame], inputs: Sequence[str], steps: Sequence[Step], folder: str):
        names = [step.name for step in steps]
        if len(set(names)) < len(names) or not names:
            raise ValueError("steps need names of their own")
        self.read, self.inputs, self.steps, self.folder = read, list(inputs), list(steps), folder.rstrip("/")
        self.outcomes: list[Outcome] = []

    def fingerprints(self, spark: SparkSession) -> list[str]:
        """One per step; a changed file, step or version changes its own and all that follow."""
        found, last = [], files_fingerprint(spark, *self.inputs)
        for step in self.steps:
            last = _digest(last, step.name, step.version)
            found.append(last)
        return found

    def run(self, spark: SparkSession) -> DataFrame:
        """The last step's stored result. Steps before the last stored one are not even looked at."""
        place, marks = Folder(spark, self.folder), self.fingerprints(spark)
        entries = [f"{self.folder}/{step.name}/{mark}.json" for step, mark in zip(self.steps, marks, strict=True)]
        done = max((i + 1 for i, entry in enumerate(entries) if self._complete(place, entry)), default=0)
        self.outcomes = []
        if done:
            frame = self._stored(spark, place, entries[done - 1], self.steps[done - 1].name, True)
        else:
            frame = self.read(spark)
        for step, entry in zip(self.steps[done:], entries[done:], strict=True):
            result = frame.transform(step.transform)
            path = f"{self.folder}/{step.name}/{uuid.uuid4().hex}"
            result.write.parquet(path)
            text = json.dumps({"path": path, "schema": result.schema.json()})
            if not place.publish(text, entry) and not self._complete(place, entry):
                place.delete(entry)  # names a folder that is gone
                place.publish(text, entry)
            frame = self._stored(spark, place, entry, step.name, False)
        return frame

    def _complete(self, place: Folder, entry: str) -> bool:
        return place.exists(entry) and place.exists(json.loads(place.read(entry))["path"] + "/_SUCCESS")

    def _stored(self, spark: SparkSession, place: Folder, entry: str, name: str, reused: bool) -> DataFrame:
        kept = json.loads(place.read(entry))
        self.outcomes.append(Outcome(name, kept["path"], reused))
        return spark.read.schema(StructType.fromJson(json.loads(kept["schema"]))).parquet(kept["path"])
