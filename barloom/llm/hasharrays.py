"""Sorted hash arrays: tables of counted keys, built by Spark and memory-mapped by its workers.

A key is a row of one or more unsigned 64-bit numbers; its hash puts it into a shard by its top bits.
Tasks count keys in sorted arrays and hand them on as compressed blocks, one for each shard
(``blocks``); one task then adds up the blocks of a shard (``merged``) and may write the shard as
plain arrays sorted by hash (``write_shard``). Hashes are even, so shards are, whatever keys are
frequent: a frequent key is one entry of a block. ``Arrays`` finds keys in the written shards, which
local and mounted folders map into memory and other stores hand out shard by shard.

Files get their final name when they are whole, and equal input writes equal files, so a task may
be run again at any time.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = "shard int, n int, data binary"
# Distinct keys that a task holds before it hands them on: tens of megabytes.
HELD = 3_000_000
# Multipliers of the mixing steps. Fixed values.
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

Counted = tuple[np.ndarray, np.ndarray]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_2)
    return x ^ (x >> np.uint64(31))


def hashed(keys: np.ndarray) -> np.ndarray:
    """Hash of each row of ``keys`` (n, k); of one column it is a bijection."""
    out = mixed(keys[:, 0])
    for k in range(1, keys.shape[1]):
        out = mixed(out * np.uint64(MIX_2) + keys[:, k])
    return out


def shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> Counted:
    """Each different row of ``keys`` (n, k) in order, with the sums of its ``counts`` (n, m)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys[:, 0], kind="stable") if keys.shape[1] == 1 else np.lexsort(keys.T[::-1])
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
    return keys[first], np.add.reduceat(counts, first, axis=0)


def encode(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Rows in order as bytes: differences in the first column, bytes of like weight together, zstd."""
    columns = np.concatenate([keys, counts], axis=1).astype("<u8").T.copy()
    columns[0, 1:] -= columns[0, :-1].copy()
    planes = columns.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def decode(data: bytes, n: int, keys: int, counts: int) -> Counted:
    width = keys + counts
    raw = pa.Codec("zstd").decompress(data, decompressed_size=8 * n * width, asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(width, 8, n).transpose(0, 2, 1)
    columns = np.ascontiguousarray(planes).view("<u8").reshape(width, n).astype(np.uint64)
    columns[0] = np.cumsum(columns[0], dtype=np.uint64)
    return columns[:keys].T.copy(), columns[keys:].T.copy()


def cut(keys: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes]]:
    """``(shard, n, data)`` for each shard that has some of the rows, which are in order."""
    shards = shard_of(hashed(keys), bits)
    order = np.argsort(shards, kind="stable")
    ends = np.searchsorted(shards[order], np.arange((1 << bits) + 1))
    for shard in np.flatnonzero(np.diff(ends)).tolist():
        rows = order[ends[shard] : ends[shard + 1]]
        yield shard, len(rows), encode(keys[rows], counts[rows])


def counted(parts: Iterable[Counted], held: int = HELD) -> Iterator[Counted]:
    """Adds up ``parts``, handing on what was added whenever more than ``held`` keys are different."""
    waiting, size = [], 0
    for part in parts:
        waiting.append(part)
        size += len(part[0])
        if size > held:
            whole = summed(*(np.concatenate(x) for x in zip(*waiting)))
            waiting, size = [whole], len(whole[0])
            if 2 * size > held:
                yield whole
                waiting, size = [], 0
    if size:
        yield summed(*(np.concatenate(x) for x in zip(*waiting)))


def as_batches(rows: Iterable[tuple], names: list[str], types: list[pa.DataType], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as record batches; the last column is binary and bounds the size of a batch."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if size > most:
            yield _batch(held, names, types)
            held, size = [], 0
    if held:
        yield _batch(held, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def blocks(df: DataFrame, produce: Callable[[Iterator[pa.RecordBatch]], Iterable[Counted]], bits: int) -> DataFrame:
    """``(shard, n, data)``: the counted keys that ``produce`` makes of the batches of ``df``, added up in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for part in counted(produce(batches)) for row in cut(*part, bits))
        yield from as_batches(rows, ["shard", "n", "data"], [pa.int32(), pa.int32(), pa.binary()])

    return df.mapInArrow(run, BLOCKS)


def merged(
    rows: DataFrame, bits: int, keys: int, counts: int, use: Callable[[int, np.ndarray, np.ndarray], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Adds up the blocks of each shard, in one task for a shard, and hands them to ``use``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[Counted]] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            for shard, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                own = waiting.setdefault(shard, [])
                own.append(decode(data, n, keys, counts))
                sizes[shard] = sizes.get(shard, 0) + n
                if sizes[shard] > HELD and sizes[shard] > 2 * len(own[0][0]):
                    own[:] = [summed(*(np.concatenate(x) for x in zip(*own)))]
                    sizes[shard] = len(own[0][0])
        for shard in sorted(waiting):
            yield from use(shard, *summed(*(np.concatenate(x) for x in zip(*waiting.pop(shard)))))

    return rows.select("shard", "n", "data").repartitionById(1 << bits, F.col("shard")).mapInArrow(run, schema)


def write_shard(folder: str, shard: int, hashes: np.ndarray, columns: dict[str, np.ndarray]) -> None:
    """Writes one shard, sorted by hash; values take the least number of bytes that holds them."""
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    order = np.argsort(hashes, kind="stable")
    for name, values in {"hash": hashes, **columns}.items():
        if name != "hash":
            values = values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)
        own, final = f"{root}/_{shard:06d}-{uuid.uuid4().hex}", f"{root}/{shard:06d}.{name}.npy"
        buffer = io.BytesIO()
        np.save(buffer, values[order])
        with store.open_output_stream(own, compression=None) as out:
            out.write(buffer.getbuffer())
        store.move(own, final)


def store(df: DataFrame, folder: str, bits: int) -> Arrays:
    """Writes a table of unique keys, first column a long, the others counts or numbers from 0 on."""
    names = tuple(df.columns[1:])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Counted]:
        for batch in batches:
            key, *values = (c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in batch.columns)
            yield key[:, None].copy(), np.stack(values, axis=1)

    def keep(shard: int, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        write_shard(folder, shard, hashed(keys), {name: values[:, k] for k, name in enumerate(names)})
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32())], names=["shard"])

    merged(blocks(df, rows, bits), bits, 1, len(names), keep, "shard int").agg(F.count("*")).collect()
    return Arrays(folder, bits, names)


def remove(folder: str) -> None:
    """Removes a folder of written shards, if it is there."""
    store, root = fs.FileSystem.from_uri(folder)
    if store.get_file_info(root).type == fs.FileType.Directory:
        store.delete_dir(root)


@dataclass
class Arrays:
    """Written shards of a table: ``columns`` beside the hashes."""

    folder: str
    bits: int
    columns: tuple[str, ...]

    @staticmethod
    def _open(store: fs.FileSystem, path: str) -> np.ndarray | None:
        if isinstance(store, fs.LocalFileSystem):
            try:
                return np.load(path, mmap_mode="r")
            except FileNotFoundError:
                return None
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_file(path) as file:
            return np.load(io.BytesIO(file.read()))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """For each hash its shard and place in it, -1 where there is none, and its values, 0 there.

        Hashes are looked up in order, so that one shard at a time is in use.
        """
        store, root = fs.FileSystem.from_uri(self.folder)
        order = np.argsort(hashes)
        wanted = hashes[order]
        shards = shard_of(wanted, self.bits)
        place = np.full(len(hashes), -1, np.int64)
        values = {name: np.zeros(len(hashes), np.int64) for name in self.columns}
        starts = np.flatnonzero(np.concatenate([[True], shards[1:] != shards[:-1]])) if len(hashes) else []
        for start, end in zip(starts, [*starts[1:], len(hashes)]):
            shard = int(shards[start])
            table = self._open(store, f"{root}/{shard:06d}.hash.npy")
            if table is None:
                continue
            at = np.searchsorted(table, wanted[start:end])
            here = at < len(table)
            here[here] = table[at[here]] == wanted[start:end][here]
            rows = order[start:end][here]
            place[rows] = at[here]
            for name in self.columns:
                values[name][rows] = self._open(store, f"{root}/{shard:06d}.{name}.npy")[at[here]]
        found = np.empty(len(hashes), np.int64)
        found[order] = shards
        return found, place, values
