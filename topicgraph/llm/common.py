"""Helpers that several of the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space as a character class of both regex engines.
SPACE = r"[\x20\x09-\x0D]"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: its
    lineage ends there, and what is not deterministic (row numbers) is fixed."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def slices(batches, rows: int = 1024):
    """Arrow batches in parts of so many rows: what a task makes of a part is
    passed on before the next one, so it never holds a whole batch twice."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def fold(doc_id: Column, k: int) -> Column:
    """``crc32`` of the id as text, modulo ``k``; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(k))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
