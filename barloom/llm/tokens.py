"""Token counts kept up to date by deltas.

A rollup folder holds, for each batch of changes, a ledger of signed rows per document and the
totals they add to each source, language and tokenizer version. A change inserts, revises or deletes
the count of a document under a version; whatever the ledger says of it so far is taken back by a
row of sign -1, and the new count is a row of sign +1. Totals are sums, so no batch rewrites another.

A batch is committed by a marker that is written last; readers see marked batches only, a batch that
has its marker is not applied again, and one that broke off is overwritten when it is retried. A
batch must be retried with its own changes; batches are applied one after the other.

Shuffles carry ids and counts, never texts, and totals combine before the shuffle, so a source with
a third of all documents is no hot spot.

Edge cases: a NULL or empty text has 0 tokens and is a document. NULL source or language is a group
of its own. Of several changes of a document in a batch the last by ``seq`` counts, of equal seq the
deletion, then the largest count. A document without doc_id can only be inserted, each row once.
Deleting or revising an unknown document deletes nothing, or inserts it. Extra columns are ignored;
an empty batch is committed and changes nothing.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import durable, word_count

# How byte-level BPE vocabularies of this kind part a text before merging. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes a vocabulary file may have to be sent to every executor.
MAX_VOCABULARY = 64 << 20
# Words whose count a worker remembers: some 20 MB.
REMEMBERED = 1 << 17
TWO_SPACES = re.compile(r"\s\s")
KEYS = ["source", "lang", "version"]


class BpeCounter:
    """Counts tokens with a ranks file of base64 tokens and numbers."""

    def __init__(self, ranks: bytes):
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        """Number of tokens. Where no two white spaces meet, the pattern never joins what a blank
        parts, and the counts of the words add up; they are remembered."""
        if not text:
            return 0
        if TWO_SPACES.search(text):
            return len(self.encoding.encode_ordinary(text))
        first, *rest = text.split(" ")
        total = len(self.encoding.encode_ordinary(first))
        known = self.known
        for word in rest:
            n = known.get(word)
            if n is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = known[word] = len(self.encoding.encode_ordinary(" " + word))
            total += n
        return total


@functools.lru_cache(maxsize=1)
def _counter(ranks: bytes) -> BpeCounter:
    """One counter for all tasks of a worker."""
    return BpeCounter(ranks)


def bpe_counts(docs: DataFrame, path: str, version: str) -> DataFrame:
    """``(doc_id, source, lang, version, tokens)`` of every row, by the ranks file at ``path``.

    The file is read on the driver, its size checked, and sent to the executors.
    """
    ranks = Path(path).read_bytes()
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{path} has {len(ranks)} bytes; a vocabulary may have {MAX_VOCABULARY}")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            counts = pa.array([counter.count(t.as_py()) for t in batch.column(3)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], counts], names=["doc_id", "source", "lang", "tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    counted = rows.mapInArrow(run, f"doc_id {kind}, source string, lang string, tokens long")
    return counted.select("doc_id", "source", "lang", F.lit(version).alias("version"), "tokens")


def word_counts(docs: DataFrame, version: str = "words") -> DataFrame:
    """The same for words between white space, as the version of that name."""
    return docs.select("doc_id", "source", "lang", F.lit(version).alias("version"), word_count("text").alias("tokens"))


class Rollup:
    """Totals of token counts in ``folder``, changed batch by batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _store(self, path: str):
        name = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return name.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), name

    def committed(self) -> list[str]:
        """Batches that have their marker, in order of name."""
        store, path = self._store(f"{self.folder}/commits")
        if not store.exists(path):
            return []
        names = [s.getPath().getName() for s in store.listStatus(path)]
        return sorted(n for n in names if store.exists(self._store(f"{self.folder}/commits/{n}/_SUCCESS")[1]))

    def _batches(self, kind: str) -> DataFrame | None:
        paths = [f"{self.folder}/{kind}/{b}" for b in self.committed()]
        return self.spark.read.parquet(*paths) if paths else None

    def ledger(self) -> DataFrame | None:
        """Documents as they stand: ``(doc_id, source, lang, version, tokens)``, ids not NULL."""
        rows = self._batches("ledger")
        if rows is None:
            return None
        net = rows.filter("doc_id is not null").groupBy("doc_id", *KEYS, "tokens").agg(F.sum("sign").alias("sign"))
        return net.filter("sign > 0").select("doc_id", *KEYS, "tokens")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Applies ``changes`` (op insert, revise or delete, doc_id, source, lang, version, tokens,
        seq) as ``batch`` and commits it; False if it was committed before."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", batch):
            raise ValueError(f"{batch!r} is no name of a batch")
        if batch in self.committed():
            return False
        # Counted once: what follows reads the changes several times.
        changes = durable(changes.select("op", "doc_id", *KEYS, "tokens", "seq"))
        rank = F.struct("seq", F.col("op") == "delete", "tokens", "source", "lang")
        last = (
            changes.filter("doc_id is not null")
            .groupBy("doc_id", "version")
            .agg(F.max_by(F.struct("op", "source", "lang", "tokens"), rank).alias("c"))
            .select("doc_id", "version", "c.*")
        )
        unnamed = changes.filter("doc_id is null and op = 'insert'")
        added = last.filter("op != 'delete'").unionByName(unnamed.select(last.columns))
        signed = added.select("doc_id", *KEYS, "tokens", F.lit(1).alias("sign"))
        before = self.ledger()
        if before is not None:
            gone = before.join(last.select("doc_id", "version"), ["doc_id", "version"], "left_semi")
            signed = signed.unionByName(gone.select("doc_id", *KEYS, "tokens", F.lit(-1).alias("sign")))
        signed.write.mode("overwrite").parquet(f"{self.folder}/ledger/{batch}")
        written = self.spark.read.schema(signed.schema).parquet(f"{self.folder}/ledger/{batch}")
        deltas = written.groupBy(*KEYS).agg(F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.folder}/totals/{batch}")
        marker = self.spark.range(1).select(F.lit(batch).alias("batch"))
        marker.write.mode("overwrite").parquet(f"{self.folder}/commits/{batch}")
        return True

    def totals(self) -> DataFrame:
        """``(source, lang, version, docs, tokens)`` over all committed batches, empty groups left out."""
        rows = self._batches("totals")
        if rows is None:
            return self.spark.createDataFrame([], "source string, lang string, version string, docs long, tokens long")
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs != 0 or tokens != 0")


def changes(counts: DataFrame, op: str, seq: int = 0) -> DataFrame:
    """``counts`` as changes of one kind."""
    return counts.withColumns({"op": F.lit(op), "seq": F.lit(seq)})


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with every line of a text kept once, in order of first appearance."""
    return docs.withColumn("text", F.array_join(F.array_distinct(F.split("text", "\n")), "\n"))
