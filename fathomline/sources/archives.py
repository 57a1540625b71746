"""Zip archives of any size, read by ranges of their members.

An archive's directory at its end tells where each member lies. It is read once per archive, without the members, and
cut into ranges of about equal compressed size; a task opens the archive at its own members only. So a large archive is
read by many tasks, of which none holds more than a batch of small members or one large member.
"""

from __future__ import annotations

import bz2
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fathomline.sinks.single import Folder

SCHEMA = "archive string, name string, text string"
RANGE = 128 << 20  # compressed bytes of one partition
_BATCH = 8_000_000  # characters handed to Spark at once
_HEADERS = 100  # what a member costs besides its content
_CHUNK = 1 << 20

# Length and mark of a member's header, and the bit that says it is encrypted.
_HEADER_LENGTH = 30
_HEADER_MARK = b"PK\x03\x04"
_ENCRYPTED = 1


@dataclass(frozen=True)
class Member:
    """Where a member lies and how it is stored."""

    name: str
    start: int
    size: int
    method: int
    flags: int
    crc: int


@dataclass
class MemberRange(InputPartition):
    """Neighbouring members of one archive."""

    archive: str
    members: list[Member]


def _open(address: str) -> BinaryIO:
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def _directory(address: str) -> list[Member]:
    """Members in the order in which they lie; a file that is no archive has none."""
    try:
        with _open(address) as file, zipfile.ZipFile(file) as archive:
            found = [Member(i.filename, i.header_offset, i.compress_size, i.compress_type, i.flag_bits, i.CRC)
                     for i in archive.infolist() if not i.is_dir()]
    except (zipfile.BadZipFile, FileNotFoundError, pa.ArrowInvalid):  # the last: sought before the start of a tiny file
        return []
    return sorted(found, key=lambda member: member.start)


def ranges_of(members: Sequence[Member], most: int) -> list[list[Member]]:
    """Runs of members of at most ``most`` compressed bytes with their headers, or of one larger member."""
    runs: list[list[Member]] = []
    held = most + 1
    for member in members:
        cost = member.size + _HEADERS
        if held + cost > most:
            runs.append([])
            held = 0
        runs[-1].append(member)
        held += cost
    return runs


def _expander(method: int):
    if method == zipfile.ZIP_DEFLATED:
        return zlib.decompressobj(-zlib.MAX_WBITS)
    if method == zipfile.ZIP_BZIP2:
        return bz2.BZ2Decompressor()
    raise NotImplementedError(f"method {method}")


def _content(file: BinaryIO, member: Member) -> bytes:
    """A member's bytes. Raises if it is damaged, encrypted or stored by another method."""
    if member.flags & _ENCRYPTED:
        raise RuntimeError("encrypted")
    file.seek(member.start)
    header = file.read(_HEADER_LENGTH)
    if len(header) < _HEADER_LENGTH or header[:4] != _HEADER_MARK:
        raise zipfile.BadZipFile(member.name)
    file.seek(sum(struct.unpack("<HH", header[26:])), 1)  # the name and the extra fields
    expander = None if member.method == zipfile.ZIP_STORED else _expander(member.method)
    out, left = bytearray(), member.size
    while left:
        chunk = file.read(min(left, _CHUNK))
        if not chunk:
            raise EOFError(member.name)
        left -= len(chunk)
        out += chunk if expander is None else expander.decompress(chunk)
    if expander is not None and hasattr(expander, "flush"):
        out += expander.flush()
    if zlib.crc32(out) != member.crc:
        raise zipfile.BadZipFile(member.name)
    return bytes(out)


class ZipMembersReader(DataSourceReader):
    def __init__(self, options: dict):
        self.archives = json.loads(options["archives"])
        self.most = int(options.get("range_bytes", RANGE))
        self.encoding = options.get("text_encoding", "utf-8")
        if self.most < 1:
            raise ValueError("range_bytes must be positive")

    def partitions(self) -> list[MemberRange]:
        found = [MemberRange(a, run) for a in self.archives for run in ranges_of(_directory(a), self.most)]
        return found or [MemberRange("", [])]

    def read(self, partition: MemberRange) -> Iterator[pa.RecordBatch]:
        if not partition.members:
            return
        names, texts, held = [], [], 0

        def batch() -> pa.RecordBatch:
            archive = pa.array([partition.archive] * len(names), pa.string())
            return pa.record_batch([archive, pa.array(names, pa.string()), pa.array(texts, pa.string())],
                                   ["archive", "name", "text"])

        with _open(partition.archive) as file:
            for member in partition.members:
                try:
                    text = _content(file, member).decode(self.encoding, "replace")
                except (zipfile.BadZipFile, zlib.error, RuntimeError, EOFError, OSError):
                    continue  # damaged, encrypted or of an unknown method
                if names and held + len(text) > _BATCH:
                    yield batch()
                    names, texts, held = [], [], 0
                names.append(member.name)
                texts.append(text)
                held += len(text)
        if names:
            yield batch()


class ZipMembers(DataSource):
    """Format ``zip_members``; option ``archives`` is a JSON list of addresses."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipMembersReader:
        return ZipMembersReader(self.options)


def read_zip_members(spark: SparkSession, paths: str | Sequence[str], range_bytes: int = RANGE,
                     encoding: str = "utf-8") -> DataFrame:
    """``(archive, name, text)``, one row per member of the archives that the paths (or patterns) name.

    Files that are no archives, and members that are damaged, encrypted or of an unknown method, give no rows; folders
    inside an archive are no members. A member's text must fit a string (2 GB). The directory of one archive, some
    hundred bytes a member, is held by one process; a path that no file matches gives no rows.
    """
    addresses: list[str] = []
    for path in [paths] if isinstance(paths, str) else paths:
        place = Folder(spark, path)
        for status in place.system.globStatus(place.path(path)) or []:
            inside = place.system.listStatus(status.getPath()) if status.isDirectory() else [status]
            addresses += [s.getPath().toUri().toString() for s in inside if s.isFile()]
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("archives", json.dumps(sorted(set(addresses))))
    return reader.option("range_bytes", str(range_bytes)).option("text_encoding", encoding).load()
