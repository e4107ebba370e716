"""A code tree on disk as a Spark source and sink (S4): ``spark.read.format("checkout").load(folder)``.

Spark's own file sources hide names that begin with ``_`` or ``.``, which code
trees are full of.  Here the driver walks the folders and counts their entries,
no more; a partition is a slice of the files of one large folder or the files of several
small ones, and tasks list, read and decode them.  The folder must be one that
all machines see (a mounted or shared one), as a checkout is.

A row is a file: path (from the folder, with /), blob_sha (the id that Git
gives its content), n_bytes and text.  Files that aren't UTF-8 are left out
(P5), unless the option ``binary`` is ``true``: then their text is NULL.  A symbolic link is a
blob that holds its target, and is never followed.  The folder ``.git`` is no part of the tree.
Options: ``suffixes`` (comma-separated), ``files`` (most files of a partition).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators.ranking import prefix_within
from ..session import cut_lineage

FORMAT = "checkout"
SCHEMA = "path string, blob_sha string, n_bytes bigint, text string"
#: Files that one task reads.
MOST_FILES = 1000


def local_folder(path: str) -> str:
    """The folder that a plain path or a file: URL names."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        raise ValueError(f"a checkout is a folder that machines mount, not {path}")
    return path


def blob_id(content: bytes) -> str:
    """The id of a blob: SHA-1 of its header and content."""
    return hashlib.sha1(b"blob %d\0" % len(content) + content).hexdigest()


@dataclass
class FileSlice(InputPartition):
    """Files of some folders, by the checksum of their names modulo ``parts``."""

    folders: tuple[str, ...]
    part: int = 0
    parts: int = 1


class CheckoutReader(DataSourceReader):
    def __init__(self, options: dict):
        self.top = local_folder(options["path"])
        self.suffixes = tuple(s for s in options.get("suffixes", "").split(",") if s)
        self.binary = options.get("binary", "false").lower() == "true"
        self.most = int(options.get("files", MOST_FILES))

    def partitions(self) -> list[InputPartition]:
        out, small, held = [], [], 0
        todo = [""]
        while todo:
            folder, n = todo.pop(), 0
            with os.scandir(os.path.join(self.top, folder)) as entries:
                for e in entries:
                    if not e.is_dir(follow_symlinks=False):
                        n += 1
                    elif folder or e.name != ".git":
                        todo.append(os.path.join(folder, e.name))
            if n > self.most:
                parts = -(-n // self.most)
                out += [FileSlice((folder,), k, parts) for k in range(parts)]
            elif n:
                if held + n > self.most:
                    out.append(FileSlice(tuple(small)))
                    small, held = [], 0
                small.append(folder)
                held += n
        return [*out, FileSlice(tuple(small))]

    def read(self, partition: FileSlice) -> Iterator[tuple]:
        for folder in partition.folders:
            with os.scandir(os.path.join(self.top, folder)) as entries:
                for e in entries:
                    if partition.parts > 1 and crc32(os.fsencode(e.name)) % partition.parts != partition.part:
                        continue
                    if e.is_dir(follow_symlinks=False) or not (e.is_file(follow_symlinks=False) or e.is_symlink()):
                        continue
                    if self.suffixes and not e.name.endswith(self.suffixes):
                        continue
                    if e.is_symlink():
                        content = os.fsencode(os.readlink(e.path))
                    else:
                        with open(e.path, "rb") as f:
                            content = f.read()
                    try:
                        text = content.decode()
                    except UnicodeDecodeError:
                        if not self.binary:
                            continue
                        text = None
                    yield os.path.join(folder, e.name), blob_id(content), len(content), text


@dataclass
class Written(WriterCommitMessage):
    files: int


class CheckoutWriter(DataSourceWriter):
    """Writes rows (path, text) as files; a file is put in place whole, so a task that runs again does no harm."""

    def __init__(self, options: dict, schema):
        self.top = local_folder(options["path"])
        self.at = schema.fieldNames().index("path"), schema.fieldNames().index("text")

    def write(self, rows) -> Written:
        n = 0
        for row in rows:
            path, text = (row[k] for k in self.at)
            name = os.path.normpath(os.path.join(self.top, path))
            if not name.startswith(os.path.join(self.top, "")):
                raise ValueError(f"{path} leads out of the folder")
            os.makedirs(os.path.dirname(name), exist_ok=True)
            draft = os.path.join(self.top, f".draft-{os.getpid()}-{crc32(path.encode())}")
            with open(draft, "wb") as f:
                f.write((text or "").encode())
            os.replace(draft, name)
            n += 1
        return Written(n)


class Checkout(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CheckoutReader:
        return CheckoutReader(self.options)

    def writer(self, schema, overwrite: bool) -> CheckoutWriter:
        if overwrite:
            raise ValueError("a checkout is only added to")
        return CheckoutWriter(self.options, schema)


def read_checkout(spark: SparkSession, folder: str, suffixes=(), **options: str) -> DataFrame:
    """The files of a code tree on disk (columns of :data:`SCHEMA`)."""
    spark.dataSource.register(Checkout)
    return spark.read.format(FORMAT).options(suffixes=",".join(suffixes), **options).load(folder)


def write_checkout(files: DataFrame, folder: str) -> None:
    """Rows (path, text) as files below ``folder``."""
    files.sparkSession.dataSource.register(Checkout)
    os.makedirs(local_folder(folder), exist_ok=True)
    files.select("path", "text").write.format(FORMAT).mode("append").save(folder)


def scan_checkout(spark: SparkSession, folder: str, snapshot_sha: str, suffixes=()) -> tuple[DataFrame, DataFrame]:
    """S4 tables of a checkout: ``snapshot_files`` (with the traversal's ``seq``) and ``blobs``, one row per distinct content.

    The folder is read once, into a table of the shared folder.
    """
    files = cut_lineage(read_checkout(spark, folder, suffixes))
    depth = F.size(F.split("path", "/"))
    placed = prefix_within(files.select("path", "blob_sha", depth.alias("_depth")), [], ["_depth", "path"], "seq")
    entries = placed.select(F.lit(snapshot_sha).alias("snapshot_sha"), "path", (F.col("seq") + 1).alias("seq"),
                            F.lit("blob").alias("entry_type"), "blob_sha")
    blobs = files.select("blob_sha", F.encode("text", "UTF-8").alias("content")).dropDuplicates(["blob_sha"])
    return entries, blobs
