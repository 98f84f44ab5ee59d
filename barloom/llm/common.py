"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import named

# Space, tab, line feed, vertical tab, form feed and carriage return end a word. Fixed value.
WORD = r"[^\x20\x09-\x0D]+"


_shipped_to: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, where it need not be installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="barloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped_to.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where that is unset."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="barloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, its lineage cut.

    A lost executor costs nothing that was computed before. Spark removes the files once the
    frame is no longer in use (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(kept: DataFrame, limit: int = 16 << 20) -> DataFrame:
    """``kept``, a durable frame, marked for broadcast if its values take ``limit`` bytes at most.

    A larger frame is left as it is, for a join by shuffle.
    """
    texts = [f.name for f in kept.schema if f.dataType.simpleString() in ("string", "binary")]
    others = [f.name for f in kept.schema if f.dataType.simpleString().startswith(("array", "map", "struct"))]
    row = F.lit(8 * (len(kept.columns) + 1))
    for name in texts:
        row = row + F.coalesce(F.octet_length(named(name)), F.lit(0))
    for name in others:
        row = row + F.octet_length(F.coalesce(F.to_json(F.struct(named(name))), F.lit("")))
    size = kept.agg(F.sum(row)).first()[0] or 0
    return F.broadcast(kept) if size <= limit else kept


def crc_part(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; NULL for a NULL id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever its case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while f"_{name}" in taken:
            name = f"_{name}"
        taken.add(f"_{name}")
        out.append(f"_{name}")
    return out


class Numbering(dict):
    """Numbers words from 0 as they come; each is looked up once without leaving C."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))
