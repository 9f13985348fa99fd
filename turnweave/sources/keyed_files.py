"""One file for each key: texts and WAV files, as a data source that commits whole jobs.

A task writes its files to a folder of its own attempt under ``_staging`` of the target, each under its
final name.  When all tasks have succeeded, the driver moves the files of the attempts that
Spark committed to their places, one rename each, and removes the staging folder; an
attempt that failed, was killed or ran twice leaves nothing.  A file that exists is
replaced by its rename, so a reader sees the old or the new one.

Rows of one file come together and in order, so a file can be much larger than a task's memory: texts are
written part by part, and a WAV file's header is filled in when its last part is written.
The target must be a folder that the driver and all executors have in their file systems.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions import audio as A
from ..shipping import ship

STAGING = "_staging"


def local_path(path: str) -> str:
    """The path in the file system; only ``file:`` and plain paths are."""
    head, sep, rest = path.partition(":")
    if sep and "/" not in head:
        if head != "file":
            raise ValueError(f"one file for each key needs a mounted folder, not {head}:")
        path = "/" + rest.lstrip("/")
    return path


@dataclass
class Attempt(WriterCommitMessage):
    folder: str
    files: int


class _Text:
    def __init__(self, path: str, options: dict[str, str]) -> None:
        self.file = open(path, "w", encoding="utf-8", newline="")

    def add(self, row: Row) -> None:
        self.file.write(row["text"] or "")

    def close(self) -> None:
        self.file.close()


class _Wav:
    """16-bit stereo, or mono where ``right`` is null."""

    def __init__(self, path: str, options: dict[str, str]) -> None:
        self.file, self.rate = open(path, "wb"), int(options.get("rate", 24_000))
        self.frames, self.channels = 0, None
        self.file.write(A.file_header(0, self.rate, 1))

    def add(self, row: Row) -> None:
        x = [np.frombuffer(c, np.float32) for c in (row["left"], row["right"]) if c is not None]
        if not x:
            return
        if self.channels not in (None, len(x)):
            raise ValueError("a file's parts differ in channels")
        self.channels = len(x)
        self.file.write(A.to_pcm(np.stack(x)))
        self.frames += len(x[0])

    def close(self) -> None:
        self.file.seek(0)
        self.file.write(A.file_header(self.frames, self.rate, self.channels or 1))
        self.file.close()


_KINDS = {"text": _Text, "wav": _Wav}


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = dict(options)
        self.root = local_path(self.options["path"])
        self.staging = os.path.join(self.root, STAGING, uuid.uuid4().hex)

    def write(self, iterator: Iterator[Row]) -> Attempt:
        folder = os.path.join(self.staging, uuid.uuid4().hex)
        make, name, out, files = _KINDS[self.options["kind"]], None, None, 0
        for row in iterator:
            if row["name"] != name:
                if out:
                    out.close()
                name = row["name"]
                path = os.path.normpath(os.path.join(folder, name))
                if not path.startswith(folder + os.sep):
                    raise ValueError(f"not a name inside the folder: {name}")
                os.makedirs(os.path.dirname(path), exist_ok=True)
                out, files = make(path, self.options), files + 1
            out.add(row)
        if out:
            out.close()
        return Attempt(folder, files)

    def commit(self, messages: list[Attempt | None]) -> None:
        for m in messages:
            for at, _, names in os.walk(m.folder) if m else ():
                to = os.path.join(self.root, os.path.relpath(at, m.folder))
                os.makedirs(to, exist_ok=True)
                for n in names:
                    os.replace(os.path.join(at, n), os.path.join(to, n))
        self._clear()

    def abort(self, messages: list[Attempt | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)
        try:
            os.rmdir(os.path.dirname(self.staging))
        except OSError:  # another job's attempts are there
            pass


class KeyedFiles(DataSource):
    """Format ``keyed_files``: options ``path``, ``kind`` (text or wav) and ``rate``."""

    @classmethod
    def name(cls) -> str:
        return "keyed_files"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def _write(rows: DataFrame, path: str, kind: str, **options: str) -> None:
    spark = rows.sparkSession
    ship(spark)
    spark.dataSource.register(KeyedFiles)
    # all parts of a file go to one task, in order
    rows.repartition("name").sortWithinPartitions("name", "part").write.format("keyed_files").options(path=path, kind=kind, **options).mode("append").save()


def write_named_texts(rows: DataFrame, path: str) -> None:
    """``name, text`` and perhaps ``part``: one UTF-8 file for each name under ``path``, its parts in order.  Null
    names are an error; a null text is an empty part."""
    named = rows.withColumn("name", F.coalesce("name", F.raise_error(F.lit("a file without a name")).cast("string")))
    part = F.col("part") if "part" in rows.columns else F.lit(0)
    _write(named.select("name", part.cast("long").alias("part"), "text"), path, "text")


def write_wavs(rows: DataFrame, path: str, rate: int = 24_000) -> None:
    """``name, part, left, right`` (32-bit floats): one 16-bit WAV file for each name, mono where ``right`` is null."""
    named = rows.withColumn("name", F.coalesce("name", F.raise_error(F.lit("a file without a name")).cast("string")))
    _write(named.select("name", F.col("part").cast("long").alias("part"), "left", "right"), path, "wav", rate=str(rate))
