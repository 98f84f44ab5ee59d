"""Near-duplicate embeddings by cross-polytope hashing.

A vector is rotated at random (three rounds of sign flips and fast Hadamard transforms); its hash is
the axis, with sign, that it then lies closest to. ``hashes`` such hashes make the cell of one of
``tables`` independent tables. A vector is at home in one cell of each table and is also probed in
the ``probes`` cells that it nearly fell into. Vectors meet where one is at home and the other at
home or probed, and every such pair is verified by its cosine in double precision, tile by tile
(``tiles``), so a cell that a third of all vectors share spreads over many tasks. Equal vectors are
collapsed first. Links are counted inside the tiles, each pair in the first cell it shares, and
leave them as counts and spanning forests, never as all pairs.

No pair below the threshold is ever linked. A pair above it is missed only if it meets in no table;
with the default parameters pairs at cosine 0.9 in 64 dimensions meet with probability over 0.99.
Vectors travel packed, in
the precision they came in. Use 3 hashes instead of 2 from some hundred million vectors on, so that cells stay small.

Edge cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components link with
nothing, nor do vectors of different length or rows without vec_id. Rows that repeat a vector are
each other's links. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable
from barloom.llm.components import connected_components
from barloom.llm.simhash import forest
from barloom.llm.tiles import tile_units

SEED = 42


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def cells(x: np.ndarray, tables: int, hashes: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (n, tables) and probed cells (n, tables, probes) of the rows of ``x``."""
    n, width = x.shape
    d = 1 << max(1, (width - 1).bit_length())
    x = np.pad(x / np.linalg.norm(x, axis=1, keepdims=True), ((0, 0), (0, d - width)))
    home = np.zeros((n, tables), np.int64)
    probed = np.zeros((n, tables, probes), np.int64)
    per_hash = min(probes, 2 * d - 1)
    rows = np.arange(n)[:, None]
    for table in range(tables):
        best, gaps, moves = np.zeros(n, np.int64), [], []
        for k in range(hashes):
            y = x
            for turn in range(3):
                signs = np.random.default_rng([SEED, table, k, turn, d]).choice([-1.0, 1.0], d)
                y = hadamard(y * signs)
            both = np.concatenate([y, -y], axis=1)
            order = np.argpartition(-both, per_hash, axis=1)[:, : per_hash + 1]
            order = np.take_along_axis(order, np.argsort(-both[rows, order], axis=1, kind="stable"), axis=1)
            value = both[rows, order]
            place = (2 * d) ** (hashes - 1 - k)
            best += order[:, 0] * place
            gaps.append(value[:, :1] - value[:, 1:])
            moves.append((order[:, 1:] - order[:, :1]) * place)
        gaps, moves = np.concatenate(gaps, axis=1), np.concatenate(moves, axis=1)
        nearest = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
        home[:, table] = best
        probed[:, table] = best[:, None] + moves[rows, nearest]
    return home, probed


def usable(vector: str) -> F.Column:
    """True for vectors that can have a cosine."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _packed(x: np.ndarray) -> pa.Array:
    """The rows of ``x`` as binary values."""
    data = np.ascontiguousarray(x)
    size = data[0].nbytes
    offsets = np.arange(0, data.nbytes + 1, size, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _hashed(vectors: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """Vectors as ``(node, weight, dim, data, codes, home, probed)``; data and codes are packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, weights, column = batch.columns
            sizes = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for width in np.unique(sizes):
                here = np.flatnonzero(sizes == width)
                x = flat[starts[here][:, None] + np.arange(width)[None, :]]
                home, probed = cells(x.astype(np.float64), tables, hashes, probes)
                both = np.concatenate([home, probed.reshape(len(x), -1)], axis=1)
                step = np.arange(0, home.size * max(1, probes) + 1, dtype=np.int32)
                lists = [pa.ListArray.from_arrays(step[: a.size + 1 : a[0].size], a.reshape(-1)) for a in (home, probed)]
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(here), weights.take(here), pa.array(np.full(len(x), width, np.int32)), _packed(x), _packed(both), *lists],
                    names=["node", "weight", "dim", "data", "codes", "home", "probed"],
                )

    shape = "node long, weight long, dim int, data binary, codes binary, home array<long>, probed array<long>"
    return vectors.mapInArrow(run, shape)


def link_vectors(vectors: DataFrame, least: float = 0.9, tables: int = 6, hashes: int = 2, probes: int = 2) -> DataFrame:
    """Links among distinct ``(node long, weight long, vector array<float or double>)``.

    Gives rows ``(src, dst, links)``: a spanning link where ``dst`` is set, else a part of the sum
    of the weights of the vectors linked with ``src``.
    """
    number = np.float32 if vectors.schema["vector"].dataType.elementType.simpleString() == "float" else np.float64
    hashed = durable(_hashed(vectors.select("node", "weight", "vector"), tables, hashes, probes))
    carried = ["node", "weight", "dim", "data", "codes"]
    at_home = hashed.select(*carried, F.posexplode("home").alias("table", "cell")).withColumn("is_home", F.lit(True))
    nearby = (
        hashed.select(*carried, F.posexplode("probed").alias("at", "cell"))
        .withColumn("table", F.floor(F.col("at") / max(1, probes)).cast("int"))
        .withColumn("is_home", F.lit(False))
        .drop("at")
    )
    rows = at_home.unionByName(nearby).withColumn("band", F.lit(0))
    payload = ["is_home", "node", "weight", "data", "codes"]
    units = tile_units(rows, ["dim", "table", "cell"], payload, F.xxhash64("node"), 0, tile=1024)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, places, codes = (batch.column(c).to_pylist() for c in ("dim", "table", "cell"))
            sides = [_flat(batch.column(c), tables, probes, number) for c in ("left", "right")]
            out: list[tuple[np.ndarray, np.ndarray]] = []
            counts: list[tuple[np.ndarray, np.ndarray]] = []
            for at in range(len(batch)):
                found = _verify(sides, at, dims[at], places[at], codes[at], least)
                if found is not None:
                    counts.append(found[:2])
                    out.append(found[2:])
            if out:
                src = np.concatenate([x for x, _ in counts] + [x for x, _ in out])
                links = np.concatenate([x for _, x in counts])
                dst = np.concatenate([x for _, x in out])
                pad_dst = pa.concat_arrays([pa.nulls(len(links), pa.int64()), pa.array(dst, pa.int64())])
                pad_links = pa.concat_arrays([pa.array(links, pa.int64()), pa.nulls(len(dst), pa.int64())])
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pad_dst, pad_links], names=["src", "dst", "links"])

    return units.select("dim", "table", "cell", "left", "right").mapInArrow(run, "src long, dst long, links long")


def _flat(column: pa.ListArray, tables: int, probes: int, number: type) -> dict:
    """The items of a column of lists as numpy arrays, with the start of each list."""
    items = column.flatten()
    sizes = np.array([len(x) if x.is_valid else 0 for x in column], dtype=np.int64)
    data, codes = items.field("data"), items.field("codes")
    codes = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.int64).reshape(len(items), tables * (1 + probes))
    widths = np.array([len(x) for x in data.to_pylist()], dtype=np.int64) // np.dtype(number).itemsize
    return {
        "starts": np.concatenate([[0], np.cumsum(sizes)]),
        "at": np.concatenate([[0], np.cumsum(widths)]),
        "is_home": items.field("is_home").to_numpy(zero_copy_only=False).astype(bool),
        "node": items.field("node").to_numpy(zero_copy_only=False),
        "weight": items.field("weight").to_numpy(zero_copy_only=False),
        "vector": np.frombuffer(b"".join(data.to_pylist()), dtype=number),
        "home": codes[:, :tables],
        "probed": codes[:, tables:].reshape(-1, tables, probes),
    }


def _verify(sides: list[dict], at: int, dim: int, table: int, cell: int, least: float):
    """Nodes, sums of linked weights and forest edges of one unit; None if nothing links."""
    picked = []
    for side in sides:
        low, high = side["starts"][at], side["starts"][at + 1]
        if high > low:
            x = side["vector"][side["at"][low] : side["at"][high]].reshape(-1, dim).astype(np.float64)
            picked.append((side, slice(low, high), x, np.sqrt(np.einsum("ij,ij->i", x, x))))
    (one, i_rows, x, x_norm), (two, j_rows, y, y_norm) = picked[0], picked[-1]
    close = x @ y.T >= least * x_norm[:, None] * y_norm[None, :]
    close &= one["is_home"][i_rows][:, None] | two["is_home"][j_rows][None, :]
    if len(picked) == 1:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    if not len(i):
        return None
    i, j = i + i_rows.start, j + j_rows.start
    new = np.zeros(len(i), bool)
    for k in range(0, len(i), 1 << 15):
        part = slice(k, k + (1 << 15))
        new[part] = _first_meeting(one, two, i[part], j[part], table, cell)
    i, j = i[new], j[new]
    if not len(i):
        return None
    a, b = one["node"][i], two["node"][j]
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    sums = np.bincount(place, weights=np.concatenate([two["weight"][j], one["weight"][i]])).astype(np.int64)
    edges = np.array(forest(len(nodes), iter([(place[: len(a)], place[len(a) :])])))
    return nodes, sums, nodes[edges[:, 0]], nodes[edges[:, 1]]


def _first_meeting(one: dict, two: dict, i: np.ndarray, j: np.ndarray, table: int, cell: int) -> np.ndarray:
    """True for pairs that share no cell of an earlier table, and no smaller one of this table."""
    home_i, home_j = one["home"][i], two["home"][j]
    same = home_i == home_j
    i_in_j = (home_i[:, :, None] == two["probed"][j]).any(axis=2)
    j_in_i = (home_j[:, :, None] == one["probed"][i]).any(axis=2)
    meet = same | i_in_j | j_in_i
    first = np.argmax(meet, axis=1) == table
    h_i, h_j, in_j, in_i = home_i[:, table], home_j[:, table], i_in_j[:, table], j_in_i[:, table]
    chosen = np.where(same[:, table] | (in_j & ~in_i), h_i, np.where(in_i & ~in_j, h_j, np.minimum(h_i, h_j)))
    return first & (chosen == cell)


def near_duplicate_vectors(
    rows: DataFrame, least: float = 0.9, tables: int = 6, hashes: int = 2, probes: int = 2, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    n_links counts the other rows linked directly, component_id is the smallest vec_id reachable,
    kept marks the row that stands for its component. A row without vec_id has no links, no
    component, and is not kept.
    """
    every = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    fit = usable("vector") & F.col("vec_id").isNotNull()
    good = every.filter(fit)
    classes = durable(good.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")))
    found = durable(link_vectors(classes, least, tables, hashes, probes))
    sums = found.filter("dst is null").groupBy(F.col("src").alias("node")).agg(F.sum("links").alias("links"))
    linked = connected_components(found.filter("dst is not null"))
    named = (
        classes.join(sums, "node", "left")
        .join(linked, "node", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    done = good.join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = every.filter(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
