"""The ledger of a stored table: which folders are live, and which source
files they hold.

Data is written to a new folder ``load=<name>`` first; then one small file
``_ledger/<name>.json`` makes it live, and takes the folders that it replaces out
in the same step.  A write that fails leaves no such file, so readers never
see it, and the folders it was to replace stay.  Folder names follow from what
they hold, so a repeated attempt overwrites its own remains and nothing else.

``_ledger/files/<name>`` lists the source files of a folder with size and time.
A load reads only files that no live folder has, whatever path or glob they were
asked for by; a file that changed is taken out of the folder that held it.

Next to the data, ``_aggregates/<kind>/<name>`` may hold partial aggregates of
a folder that add up over folders.  A table without a ledger (written by an
earlier version) is read as it is.

One writer at a time: two loads that run at once do not see each other's files.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete

FILES = "file string, size bigint, time timestamp"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def bytes_of(spark: SparkSession, path: str) -> int:
    p, fs = _path(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A file that is there whole or not at all."""
    tmp, fs = _path(spark, path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    final, _ = _path(spark, path)
    fs.delete(final, False)
    if not fs.rename(tmp, final):
        raise OSError(f"cannot write {path}")


def digest(*parts) -> str:
    return hashlib.md5(json.dumps(parts, default=str).encode()).hexdigest()[:16]


@dataclass
class Folder:
    name: str
    load: str
    bytes: int = 0
    removes: list[str] = field(default_factory=list)


class Ledger:
    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.location = spark, location.rstrip("/")
        self.root = f"{self.location}/_ledger"

    def exists(self) -> bool:
        return exists(self.spark, self.root)

    def data(self, name: str) -> str:
        return f"{self.location}/load={name}"

    def aggregate(self, kind: str, name: str) -> str:
        return f"{self.location}/_aggregates/{kind}/{name}"

    def entries(self) -> list[Folder]:
        """All folders that were ever live: a row each comes to the driver."""
        entries = []
        if any(n.endswith(".json") for n in children(self.spark, self.root)):
            rows = self.spark.read.schema("name string, load string, bytes bigint, removes array<string>").json(
                f"{self.root}/*.json").collect()
            entries = [Folder(r.name, r.load, r.bytes, list(r.removes or [])) for r in rows]
        return entries

    def live(self) -> list[Folder]:
        """The folders that count."""
        entries = self.entries()
        gone = {n for e in entries for n in e.removes}
        return sorted((e for e in entries if e.name not in gone), key=lambda e: e.name)

    def fresh(self, name: str) -> str:
        """``name``, or one made from it if a folder of that name was live
        already: those are never written again."""
        taken = {e.name for e in self.entries()}
        while name in taken:
            name = f"{name[:80]}-{digest(name)}"
        return name

    def files(self, folders: list[Folder] | None = None) -> DataFrame:
        """``(file, size, time, name)`` of the live folders' source files."""
        folders = self.live() if folders is None else folders
        paths = [f"{self.root}/files/name={f.name}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], f"{FILES}, name string")
        return self.spark.read.option("basePath", f"{self.root}/files").schema(f"{FILES}, name string").parquet(*paths)

    def commit(self, name: str, load: str, files: DataFrame, removes: list[str] = ()) -> None:
        """Makes the written folder live and takes others out, in one step."""
        files.select("file", "size", "time").write.mode("overwrite").parquet(f"{self.root}/files/name={name}")
        entry = {"name": name, "load": load, "bytes": bytes_of(self.spark, self.data(name)), "removes": list(removes)}
        _put(self.spark, f"{self.root}/{name}.json", json.dumps(entry))

    def read(self, folders: list[Folder] | None = None) -> DataFrame | None:
        """The rows of the live folders, with ``load``; None if there are none."""
        folders = self.live() if folders is None else folders
        paths = [self.data(f.name) for f in folders]
        return self.spark.read.option("basePath", self.location).parquet(*paths) if paths else None

    def aggregates(self, kind: str, schema: str) -> DataFrame:
        """The partial aggregates of all live folders, not yet added up."""
        paths = [self.aggregate(kind, f.name) for f in self.live()]
        lacking = [p for p in paths if not exists(self.spark, p)]
        if lacking:
            raise ValueError(f"no aggregates for {lacking[0]}: load it with aggregates=True")
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self) -> list[str]:
        """Deletes folders that are not live; no reader may still use them."""
        alive = {f.name for f in self.live()}
        gone = [n.split("=", 1)[1] for n in children(self.spark, self.location) if n.startswith("load=")]
        gone = [n for n in gone if n not in alive]
        for n in gone:
            delete(self.spark, self.data(n))
            for kind in children(self.spark, f"{self.location}/_aggregates"):
                delete(self.spark, self.aggregate(kind, n))
        return gone


def listing(spark: SparkSession, path: str | list[str], path_glob_filter: str | None = None) -> DataFrame:
    """``(path, file, size, time)`` of the files under a path or glob: their
    contents are not read.  ``file`` is the full address, one for every way to
    ask for it."""
    reader = spark.read.format("binaryFile")
    if path_glob_filter:
        reader = reader.option("pathGlobFilter", path_glob_filter)
    return reader.load(path).select("path", F.col("_metadata.file_path").alias("file"),
                                    F.col("_metadata.file_size").alias("size"),
                                    F.col("_metadata.file_modification_time").alias("time"))


def literal(path: str) -> str:
    """A path in which no character is a wildcard."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
