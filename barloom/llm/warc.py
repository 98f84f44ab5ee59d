"""Deterministic sharded WARC archives: write, commit, read back.

Records are sorted by URL, page_id and digest over all pages. The place of a record in that order,
in bytes, gives its shard: running sums per range partition are offset by the sums of the partitions
before, so shards are cut at the same records whatever the partitioning. One task writes a shard,
rolling to a new file once the compressed size passes ``roll_bytes``. Headers, record ids and digests
are made anew from the content, so equal input gives equal files, byte for byte.

Files are written under temporary names, one folder for each attempt of a task; only names that a
finished task reports are moved to their final place, and the manifest, written last, is the commit:
readers see the files that it lists. An executor lost on the way costs its tasks, nothing else.

Of records with equal payloads of ``least_bytes`` or more the largest page_id is a response and the
others are revisits, which carry headers but no payload. Bodies of revisits are not even shuffled.

Edge cases: a NULL html is an empty payload, a NULL URL gets a urn of its page_id. Rows that repeat
a page_id are records each; those that repeat the response's are responses too. A row without
page_id revisits the others, and is a response where it has only its like. Extra columns are ignored;
no pages give no files and an empty manifest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import durable, sized

# Payload bytes of a shard, compressed bytes after which a file is closed, payload of a revisit.
SHARD_BYTES, ROLL_BYTES, LEAST_BYTES = 64 << 20, 16 << 20, 1000
# Bytes that a record has besides its payload, for cutting shards.
OVERHEAD = 700
# What WARC/1.1 names a revisit of an equal payload. Fixed value.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BATCH = 8 << 20


def records(pages: DataFrame, shard_bytes: int = SHARD_BYTES, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``(page_id, url, digest, bytes, shard, refers_to, refers_url, refers_digest)`` of every different record."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    small = durable(
        pages.select("page_id", "url", F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("bytes"))
        .repartitionByRange("url", "page_id", "digest")
        .withColumn("_part", F.spark_partition_id())
    )
    groups = (
        small.filter(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("_first"), F.max_by("url", F.struct("page_id", "url")).alias("_first_url"), F.count("*").alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    size = F.col("bytes") + OVERHEAD
    sums = small.groupBy("_part").agg(F.sum(size).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("url", "page_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        small.withColumn("_at", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(offsets, "_part")
        .withColumn("shard", F.floor((F.col("_before") + F.col("_at")) / shard_bytes).cast("int"))
    )
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return (
        placed.groupBy("page_id", "url", "digest", "bytes")
        .agg(F.min("shard").alias("shard"))
        .join(groups, ["digest", "bytes"], "left")
        .select(
            "page_id",
            "url",
            "digest",
            "bytes",
            "shard",
            F.when(revisit, F.col("_first")).alias("refers_to"),
            F.when(revisit, F.col("_first_url")).alias("refers_url"),
            revisit.alias("revisit"),
        )
    )


def _uri(page_id: int | None, url: str | None) -> str:
    text = f"urn:page:{page_id}" if url is None else url
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in text)


def _record_id(page_id: int | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {_uri(page_id, url)} {digest}')}>"


def _label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _block(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)
    head += f"WARC-Block-Digest: {_label(block)}\r\nContent-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n", mtime=0)


def _member(row: dict, payload: bytes, date: str) -> bytes:
    """One record, a gzip member of its own."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if row["revisit"] else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], row["url"], row["digest"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(row["page_id"], row["url"])),
        ("WARC-Payload-Digest", digest),
    ]
    if row["page_id"] is not None:
        fields.append(("WARC-Page-ID", str(row["page_id"])))
    if row["revisit"]:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(row["refers_to"], row["refers_url"], row["digest"])),
            ("WARC-Refers-To-Target-URI", _uri(row["refers_to"], row["refers_url"])),
            ("WARC-Refers-To-Page-ID", str(row["refers_to"])),
        ]
    return _block([*fields, ("Content-Type", "application/http; msgtype=response")], http + payload)


class _Shard:
    """Files of one shard, written one after the other under temporary names."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.roll, self.date = shard, roll_bytes, date
        self.attempt = f"{self.root}/_temporary/{shard:06d}-{uuid.uuid4().hex}"
        self.store.create_dir(self.attempt, recursive=True)
        self.out, self.part, self.done = None, 0, []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.part:04d}.warc.gz"
            self.out = self.store.open_output_stream(f"{self.attempt}/{self.name}", compression=None)
            self.sum, self.size, self.count = hashlib.sha1(), 0, 0
            about = f"software: barloom\r\nformat: WARC File Format 1.1\r\nisPartOf: shard {self.shard}\r\n".encode()
            info_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.name)}>"
            fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", info_id), ("WARC-Date", self.date), ("WARC-Filename", self.name)]
            self._put(_block([*fields, ("Content-Type", "application/warc-fields")], about))
            self.count = 0
        self._put(member)
        if self.size >= self.roll:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sum.update(data)
        self.size += len(data)
        self.count += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.name, f"{self.attempt}/{self.name}", self.count, self.size, self.sum.hexdigest()))
            self.out, self.part = None, self.part + 1


def write(
    pages: DataFrame,
    folder: str,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    least_bytes: int = LEAST_BYTES,
    date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Writes the archives under ``folder``, a URI that pyarrow can open on every executor.

    Gives the manifest (shard, name, records, bytes, sha1), which is also at ``folder``/manifest.
    A folder that has a manifest is complete and is read, not written again.
    """
    spark = pages.sparkSession
    if _committed(folder):
        return manifest(spark, folder)
    plan = durable(records(pages, shard_bytes, least_bytes))
    shards = (plan.agg(F.max("shard")).first()[0] or 0) + 1
    html = F.coalesce(F.col("html"), F.lit(""))
    bodies = pages.select(F.col("page_id").alias("_id"), F.col("url").alias("_url"), html.alias("html"), F.sha1(html.cast("binary")).alias("_digest"))
    side = sized(plan)
    same = F.col("_id").eqNullSafe(F.col("page_id")) & F.col("_url").eqNullSafe(F.col("url")) & (F.col("_digest") == F.col("digest"))
    rows = (
        bodies.join(side, same)
        .select(*plan.columns, F.when(~F.col("revisit"), F.col("html")).cast("binary").alias("html"))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "url", "page_id", "digest")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            heads = batch.select(plan_columns).to_pylist()
            for row, body in zip(heads, batch.column(len(plan_columns)), strict=True):
                if shard is None or row["shard"] != shard.shard:
                    if shard is not None:
                        shard.close()
                        yield _listed(shard.done)
                    shard = _Shard(folder, row["shard"], roll_bytes, date)
                shard.add(_member(row, body.as_py() or b"", date))
        if shard is not None:
            shard.close()
            yield _listed(shard.done)

    plan_columns = plan.columns
    written = durable(rows.mapInArrow(run, "shard int, name string, temporary string, records long, bytes long, sha1 string"))
    commit(written, folder)
    return manifest(spark, folder)


def _listed(done: list[tuple]) -> pa.RecordBatch:
    names = ["shard", "name", "temporary", "records", "bytes", "sha1"]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], kind) for k, kind in enumerate(kinds)], names=names)


def commit(written: DataFrame, folder: str) -> None:
    """Moves the listed files to their final names, then writes the manifest.

    May be run again after it broke off: a file already moved is left in place.
    """

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if store.get_file_info(temporary).type != fs.FileType.NotFound:
                    store.move(temporary, f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(temporary)
            yield batch

    moved = written.mapInArrow(move, written.schema)
    moved.select("shard", "name", "records", "bytes", "sha1").write.mode("overwrite").parquet(f"{folder}/manifest")
    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(f"{root}/_temporary").type != fs.FileType.NotFound:
        store.delete_dir(f"{root}/_temporary")


def _committed(folder: str) -> bool:
    store, root = fs.FileSystem.from_uri(folder)
    return store.get_file_info(f"{root}/manifest/_SUCCESS").type == fs.FileType.File


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("shard int, name string, records long, bytes long, sha1 string").parquet(f"{folder}/manifest")


def _fields(lines: list[str]) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _head(stream) -> list[str] | None:
    lines = []
    while line := stream.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            if lines:
                return [x.decode("utf-8", "surrogatepass") for x in lines]
            continue
        lines.append(line)
    return None


def parse(stream) -> Iterator[dict]:
    """Records of an uncompressed WARC stream as (type, fields, http, payload), warcinfo left out."""
    while (lines := _head(stream)) is not None:
        fields = _fields(lines[1:])
        block = stream.read(int(fields["content-length"]))
        if fields["warc-type"] == "warcinfo":
            continue
        if _label(block) != fields["warc-block-digest"]:
            raise ValueError(f"block digest of {fields['warc-record-id']} differs")
        body = io.BytesIO(block)
        http = _fields((_head(body) or [""])[1:])
        yield {"type": fields["warc-type"], "fields": fields, "http": http, "payload": body.read()}


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to)`` of all archives.

    Digest and size of a response are taken from its payload, those of a revisit from its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_file(f"{root}/{name}") as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for found in parse(io.BufferedReader(stream)):
                        rows.append(_row(found))
                        held += len(found["payload"])
                        if held >= READ_BATCH:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary())]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())]
    )
    names = manifest(spark, folder).select("name")
    # A number of its own keeps Spark from joining these few rows into one task.
    return names.repartitionByRange(max(1, names.count()), "name").mapInArrow(
        run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long"
    )


def _row(found: dict) -> dict:
    fields, payload, revisit = found["fields"], found["payload"], found["type"] == "revisit"
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload digest of {fields['warc-record-id']} differs")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("warc-page-id"),
        "url": fields["warc-target-uri"],
        "record_type": found["type"],
        "payload": None if revisit else payload,
        "payload_bytes": int(found["http"]["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "refers_to": number("warc-refers-to-page-id"),
    }
