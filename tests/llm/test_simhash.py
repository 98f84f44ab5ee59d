import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm import simhash
from barloom.llm.components import connected_components
from barloom.llm.queries import op4_simhash
from tests.llm.conftest import LONG, SF, edge_rows, union_find


def brute_fingerprint(text):
    import xxhash

    table = {c: c + 32 for c in range(65, 91)}
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(table)) if w]
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(rows, radius=2):
    """{doc_id: (fingerprint, smallest doc_id reachable)} for rows (doc_id, text) in order of id."""
    fps = np.array([brute_fingerprint(t) for _, t in rows], dtype=np.uint64)
    pairs = [(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps[: i + 1] ^ fps[i]) <= radius)]
    roots = union_find(len(fps), pairs)
    return {d: (f"{int(f):016x}", rows[r][0]) for (d, _), f, r in zip(rows, fps, roots)}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash(spark, SF).collect()}
    assert got == brute_groups([tuple(r) for r in rows])


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB \t\u000b é.", max_size=60))
def test_fingerprint_of_any_text(text):
    assert int(simhash.fingerprint(simhash.shingle_hashes(text, 3))) == brute_fingerprint(text)


@pytest.mark.parametrize("tile", [4, 2048])
def test_links_are_exact_also_in_crowded_cells(spark, monkeypatch, tile):
    random = np.random.default_rng(5)
    base = int(random.integers(0, 2**63))
    near = [base ^ sum(1 << int(b) for b in random.choice(64, k, replace=False)) for k in random.integers(0, 5, 60)]
    values = np.array(sorted(set(near) | set(int(v) for v in random.integers(0, 2**63, 60))), dtype=np.uint64)
    monkeypatch.setattr(simhash, "tile_units", lambda *a, f=simhash.tile_units: f(*a, tile=tile))
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = simhash.link_fingerprints(fps, 2).collect()
    assert len(links) < 4 * len(values)  # forests, not all pairs
    order = {int(v): i for i, v in enumerate(values.view(np.int64))}
    got = union_find(len(values), [(order[r.src], order[r.dst]) for r in links])
    want = union_find(len(values), [(i, j) for i in range(len(values)) for j in range(i) if np.bitwise_count(values[i] ^ values[j]) <= 2])
    assert got == want


def test_edge_cases(spark, edge, empty):
    got = {}
    for r in simhash.near_duplicate_fingerprints(edge).collect():
        got.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert len(got[1]) == 2 and got[1][0] == got[1][1]
    assert got[2] == got[3] == got[5] == [(0, 2)]  # blank texts are linked
    assert (0, 2) in got[None] and len(got[None]) == 2
    assert any(c is None for _, c in got[None])  # a text of its own without id names no component
    assert got[4][0][1] == 4
    assert simhash.near_duplicate_fingerprints(empty).collect() == []
    assert simhash.keep_one_each(empty).columns == empty.columns and simhash.keep_one_each(empty).count() == 0


def test_one_of_each_group_stays_with_its_columns(spark, edge):
    kept = simhash.keep_one_each(edge)
    rows = kept.collect()
    assert kept.columns == edge.columns and {r.score for r in rows} == {"x"}
    ids = [r.doc_id for r in rows]
    assert sorted(x for x in ids if x is not None) == [1, 2, 4, 6, 7] and ids.count(None) == 1
    assert next(r.text for r in rows if r.doc_id == 4) == LONG
    assert len(rows) < len(edge_rows())


def test_keeps_one_row_of_every_brute_force_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    want = {component for _, component in brute_groups([tuple(r) for r in rows]).values()}
    assert sorted(r.doc_id for r in simhash.keep_one_each(docs).select("doc_id").collect()) == sorted(want)


def test_names_of_further_columns_do_not_matter(spark):
    columns = ["_id", "_key", "__key", "_again", "_drop", "group", "kept", "text_key", "copies", "fp", "component"]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in columns)
    rows = [(k, t, *columns) for k, t in ((1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (3, "x y z"), (None, "x y z"), (None, "u"), (None, "u"))]
    kept = simhash.keep_one_each(spark.createDataFrame(rows, schema)).collect()
    assert sorted(tuple(r) for r in kept if r.doc_id) == sorted([rows[0], rows[3]])
    assert [tuple(r) for r in kept if r.doc_id is None] == [rows[5]]


def test_components_of_a_long_path_and_of_strings(spark):
    edges = [(k, k + 1) for k in range(100)] + [(500, 501), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {k: 0 for k in range(101)} | {500: 500, 501: 500}
    text = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "b")], "src string, dst string")
    assert {tuple(r) for r in connected_components(text).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []
