"""One file from an ordered result, without one task that writes it.

The rows are written as ordered part files. Their lengths, one number per part, give every part its offset in the
whole; the parts are then joined where they lie. On a file system that every machine has mounted, tasks copy pieces of
the parts to their offsets in the new file; elsewhere the file system joins the parts itself, as HDFS does without
moving a block. Either way the file appears under its name by one rename, when it is complete; a failed run leaves
nothing there, and a repeated task writes the same bytes to the same place.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from itertools import accumulate
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession

PIECE = 64 << 20  # bytes copied by one row of the copying tasks
_CHUNK = 4 << 20


class Folder:
    """The Hadoop file system of a path, as the session configures it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.mounted = self.system.getScheme() == "file"

    def path(self, name: str):
        return self._path(name)

    def exists(self, name: str) -> bool:
        return self.system.exists(self.path(name))

    def parts(self, folder: str) -> list[tuple[str, int]]:
        """Address and length of the part files of a folder that hold something, in order."""
        found = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in self.system.listStatus(self.path(folder))]
        kept = [x for x in found if x[0].startswith("part-") and x[2]]
        return [(address, size) for name, address, size in sorted(kept, key=lambda x: (int(x[0].split("-")[1]), x[0]))]

    def rename(self, source: str, target: str) -> None:
        if not self.system.rename(self.path(source), self.path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def create(self, name: str) -> None:
        self.system.create(self.path(name), True).close()

    def concat(self, target: str, sources: Sequence[str]) -> None:
        """Append files to an existing one by the file system's own means."""
        paths = self.spark._sc._gateway.new_array(self._path, len(sources))
        for i, source in enumerate(sources):
            paths[i] = self.path(source)
        self.system.concat(self.path(target), paths)

    def publish(self, text: str, name: str) -> bool:
        """Give a small file its name, complete and only if the name is free; says whether it did.

        The text is written beside it first. A mounted file system links it, another one renames it; both refuse a
        name that is taken (as HDFS does; a store whose rename replaces files is not meant).
        """
        draft = f"{name}.{uuid.uuid4().hex}.draft"
        out = self.system.create(self.path(draft), False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.mounted:
                try:
                    os.link(_local(draft), _local(name))
                except FileExistsError:
                    return False
                return True
            return not self.exists(name) and self.system.rename(self.path(draft), self.path(name))
        finally:
            self.delete(draft)

    def read(self, name: str) -> str:
        """The text of a small file."""
        source = self.system.open(self.path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def pieces_of(parts: Sequence[tuple[str, int]], most: int = PIECE) -> list[tuple[str, int, int, int]]:
    """``(part, start in it, offset in the whole, bytes)`` of pieces that cover all parts side by side."""
    offsets = [0, *accumulate(size for _, size in parts)]
    return [(part, start, offset + start, min(most, size - start))
            for (part, size), offset in zip(parts, offsets) for start in range(0, size, most)]


def _local(address: str) -> str:
    return unquote(urlparse(address).path)


def _copy(batches: Iterator[pa.RecordBatch], target: str) -> Iterator[pa.RecordBatch]:
    out = os.open(target, os.O_WRONLY | os.O_CREAT, 0o644)
    try:
        for batch in batches:
            for piece in batch.to_pylist():
                with open(_local(piece["part"]), "rb") as source:
                    source.seek(piece["start"])
                    at, left = piece["at"], piece["size"]
                    while left:
                        data = source.read(min(left, _CHUNK))
                        if not data:
                            raise OSError(f"{piece['part']} is shorter than it was")
                        written = os.pwrite(out, data, at)
                        if written < len(data):
                            source.seek(written - len(data), os.SEEK_CUR)
                        at, left = at + written, left - written
            os.fsync(out)
            yield pa.record_batch([batch.column("size")], ["size"])
    finally:
        os.close(out)


def _join_at_offsets(spark: SparkSession, parts: list[tuple[str, int]], target: str) -> None:
    pieces = pieces_of(parts)
    rows = spark.createDataFrame(pieces, "part string, start long, at long, size long").repartition(len(pieces))
    place = _local(target)
    written = rows.mapInArrow(lambda batches: _copy(batches, place), "size long").agg({"size": "sum"}).first()[0]
    if written != sum(size for _, size in parts):
        raise OSError(f"{written} bytes written of {sum(size for _, size in parts)}")


def write_single_csv(df: DataFrame, path: str, order: Sequence[Column | str] = (), header: bool = True,
                     overwrite: bool = False) -> None:
    """One CSV file at ``path``, in the order of ``order`` or of the frame's partitions.

    Fails if the path exists, unless it is to be replaced. No task holds more than a part of the rows.
    """
    spark = df.sparkSession
    folder = Folder(spark, path)
    if folder.exists(path) and not overwrite:
        raise FileExistsError(path)
    staging = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        ordered = df.orderBy(*order) if order else df
        ordered.write.option("header", False).csv(f"{staging}/rows")
        parts = folder.parts(f"{staging}/rows")
        if header:
            names = spark.createDataFrame([tuple(df.columns)], ", ".join(f"c{i} string" for i in range(len(df.columns))))
            names.coalesce(1).write.csv(f"{staging}/head")
            parts = folder.parts(f"{staging}/head") + parts
        whole = f"{staging}/whole.csv"
        if not parts:
            folder.create(whole)
        elif folder.mounted:
            _join_at_offsets(spark, parts, whole)
        else:
            whole = parts[0][0]
            if len(parts) > 1:
                folder.concat(whole, [part for part, _ in parts[1:]])
        if overwrite:
            folder.delete(path)
        folder.rename(whole, path)
    finally:
        folder.delete(staging)
