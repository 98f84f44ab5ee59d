"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, memory-mapped for scoring.

Words are numbered by their place in the sorted array of all training words' hashes. Tasks count
n-grams of these numbers; the n-grams of an order are added up by shards of their hash
(``hasharrays``). The highest order has raw counts, each order below counts the different words seen
before an n-gram, and n-grams that begin a text, which nothing comes before, keep their raw counts.
Each order gives three discounts, from how many n-grams have counts 1 to 4, and for every context the
sum of its counts and how many followers it has with counts 1, 2 and more.

All of it lies in sorted hash arrays in the shared folder: numbers and counts of words, counts of
n-grams, sums of contexts. Workers map them into memory and look up a block of texts at a time, in
order of hash. A word's probability is the discounted count over the sum of its context plus the mass
that the discounts left, times the probability at the order below; below the first order lies an
even share for each training word and for the unknown word. Words that training lacks are unknown;
contexts that it lacks leave the order below as it is.

Nothing is cut: every n-gram of every training text counts, and every word of every text is scored.
What training reads, keeps and maps grows with the corpus; the driver sees one row for each shard.

Edge cases: a NULL or blank text is its end alone. Very long texts are read in pieces and scored with
their history. No training text gives a model that knows no word, and scores 0. Repeated rows
count once each, rows without doc_id are rows like any other, extra columns are ignored, an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import hasharrays
from barloom.llm.common import Numbering, durable
from barloom.llm.hasharrays import Arrays, Counted

SEED = 42
# What ends a text: no word has a space.
END = b" "
# Tokens counted or scored at once, bytes of a text split at once, bytes of text for each shard.
BLOCK, PIECE, SHARD_BYTES = 1 << 20, 4 << 20, 24 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
UNKNOWN = -1
# Discounts of an order whose counts of 1 to 4 are too few to give some. Fixed values.
DISCOUNTS = (0.5, 1.0, 1.5)
# What is kept of a context: the sum of its counts, and its followers with counts 1, 2 and more.
CONTEXT = ("total", "ones", "twos", "more")
WORDS = pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("total", pa.int64())])
SCORES = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes that cut no word."""
    at = 0
    while at < len(text):
        end = at + size
        found = SPACE.search(text, end) if end < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


@dataclass
class Block:
    """Tokens of some texts in a row: hashes of the different words, and for each token the number of
    its word, of which text it is, how many tokens of that text come before it, its beginning included,
    and whether it is to be scored or only history."""

    hashes: np.ndarray
    words: np.ndarray
    text: np.ndarray
    before: np.ndarray
    scored: np.ndarray


def tokens(texts: Iterable[bytes | None], history: int, size: int = BLOCK) -> Iterator[Block]:
    """Blocks of about ``size`` tokens; a text that goes on in the next one takes ``history`` along.

    The beginning of a text is a token of its own, number -1, that is never scored.
    """
    numbers, parts, held = Numbering(), [], 0

    def block() -> Block:
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in numbers), np.uint64, len(numbers))
        return Block(hashes, *(np.concatenate(x) for x in zip(*parts)))

    for which, text in enumerate(texts):
        tail, done = [None], 1
        rest = pieces((text or b"").lower())
        piece = next(rest, b"")
        while piece is not None:
            following = next(rest, None)
            words = piece.split()
            if following is None:
                words.append(END)
            for at in range(0, len(words), size):
                part = words[at : at + size]
                old, n = len(tail), len(tail) + len(part)
                again = np.array([-1 if w is None else numbers[w] for w in tail], np.int64)
                place = np.arange(n)
                parts.append((np.concatenate([again, numbers.of(part)]), np.full(n, which), place + (done - old), place >= old))
                done += len(part)
                tail = (tail + part)[-history:]
                held += n
                if held >= size:
                    yield block()
                    numbers, parts, held = Numbering(), [], 0
            piece = following
    if parts:
        yield block()


@dataclass
class Model:
    """A fitted model: where its arrays are, and what is known of each order."""

    folder: str
    order: int
    bits: int
    bases: np.ndarray
    train_tokens: int
    discounts: list[tuple[float, float, float]]
    unigrams: tuple[int, int, int, int]

    @property
    def vocabulary(self) -> int:
        return int(self.bases[-1])

    def words(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Number and training count of every token: ``UNKNOWN`` and 0 for words that training lacks,
        and the number after the last for the beginning of a text."""
        shard, place, values = Arrays(f"{self.folder}/words", self.bits, ("count",)).find(hasharrays.mixed(block.hashes))
        number = np.where(place >= 0, self.bases[shard] + place, UNKNOWN)
        number, count = np.append(number, self.vocabulary), np.append(values["count"], 0)
        return number[block.words], count[block.words]

    def ids_in_a_key(self) -> int:
        return 2 if self.vocabulary < 2**32 - 1 else 1

    def keys(self, ids: list[np.ndarray]) -> np.ndarray:
        """Rows of ``ids`` as rows of 64-bit numbers, two ids in one where they are small enough."""
        return packed(ids, self.ids_in_a_key())


def packed(ids: list[np.ndarray], each: int) -> np.ndarray:
    columns = [c.astype(np.uint64) for c in ids]
    if each == 2:
        columns = [np.bitwise_or(columns[k] << np.uint64(32), columns[k + 1]) if k + 1 < len(columns) else columns[k] for k in range(0, len(columns), 2)]
    return np.stack(columns, axis=1)


def unpacked(keys: np.ndarray, n: int, each: int) -> list[np.ndarray]:
    """The ``n`` columns of ids that ``keys`` were packed from."""
    if each == 1:
        return list(keys.T)
    out = []
    for k in range(keys.shape[1]):
        if 2 * k + 1 < n:
            out += [keys[:, k] >> np.uint64(32), keys[:, k] & np.uint64(0xFFFFFFFF)]
        else:
            out.append(keys[:, k])
    return out


def width(n: int, each: int) -> int:
    return -(-n // each)


def grams(block: Block, number: np.ndarray, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The ids of each n-gram of the block that ends in a scored token, and where it ends."""
    ends = np.flatnonzero(block.scored & (block.before >= n - 1))
    return [number[ends - n + 1 + k] for k in range(n)], ends


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes | None]:
    for batch in batches:
        for value in batch.column(0):
            yield value.as_py()


def _sums(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum, and numbers of ones, twos and more, of the counts between ``first`` and the next."""
    marks = np.stack([counts, counts == 1, counts == 2, counts >= 3], axis=1).astype(np.uint64)
    return np.add.reduceat(marks, first, axis=0)


def fit(texts: DataFrame, folder: str, order: int = 2, text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> Model:
    """Learns from every row of ``texts`` and writes the arrays under ``folder``, a shared one."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    source = texts.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(int(size // shard_bytes), 0).bit_length()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[Counted]:
        for block in tokens(_texts(batches), 1):
            counts = np.bincount(block.words[block.scored], minlength=len(block.hashes))
            yield block.hashes[counts > 0, None], counts[counts > 0, None].astype(np.uint64)

    def keep_words(shard: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        hasharrays.write_shard(f"{folder}/words", shard, hasharrays.hashed(keys), {"count": counts[:, 0]})
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n": [len(keys)], "total": [int(counts.sum())]}, schema=WORDS)

    found = hasharrays.merged(hasharrays.blocks(source, words, bits), bits, 1, 1, keep_words, "shard int, n long, total long")
    sizes = np.zeros(1 << bits, np.int64)
    train_tokens = 0
    for row in found.collect():
        sizes[row.shard] = row.n
        train_tokens += row.total
    model = Model(folder, order, bits, np.concatenate([[0], np.cumsum(sizes)]), train_tokens, [], (0, 0, 0, 0))
    each = model.ids_in_a_key()

    def count(n: int, starts: bool):
        def produce(batches: Iterator[pa.RecordBatch]) -> Iterator[Counted]:
            for block in tokens(_texts(batches), order - 1):
                number, _ = model.words(block)
                ids, ends = grams(block, number, n)
                if starts:
                    at = block.before[ends] == n - 1
                    ids = [c[at] for c in ids]
                keys = packed(ids, each)
                yield hasharrays.summed(keys, np.ones((len(keys), 1), np.uint64))

        return produce

    def use(n: int):
        def keep(shard: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            amounts = counts[:, 0]
            hasharrays.write_shard(f"{folder}/grams{n}", shard, hasharrays.hashed(keys), {"count": amounts})
            ids = unpacked(keys, n, each)
            rows = []
            if n > 1:
                context = packed(ids[:-1], each)
                first = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]).any(1)]))
                rows += [("context", *row) for row in hasharrays.cut(context[first], _sums(amounts, first), bits)]
                rest = hasharrays.summed(packed(ids[1:], each), np.ones((len(keys), 1), np.uint64))
                rows += [("rest", *row) for row in hasharrays.cut(*rest, bits)]
            seen = [int(amounts.sum()), *(int((amounts == k).sum()) for k in range(1, 5)), int((amounts >= 3).sum())]
            rows.append(("seen", shard, 0, np.array(seen, "<i8").tobytes()))
            yield from hasharrays.as_batches(rows, ["kind", "shard", "n", "data"], [pa.string(), pa.int32(), pa.int32(), pa.binary()])

        return keep

    def keep_contexts(n: int):
        def keep(shard: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            columns = {name: counts[:, k] for k, name in enumerate(CONTEXT)}
            hasharrays.write_shard(f"{folder}/contexts{n}", shard, hasharrays.hashed(keys), columns)
            yield pa.RecordBatch.from_pydict({"shard": [shard]}, schema=pa.schema([("shard", pa.int32())]))

        return keep

    rows = hasharrays.blocks(source, count(order, False), bits)
    for n in range(order, 0, -1):
        level = durable(hasharrays.merged(rows, bits, width(n, each), 1, use(n), f"kind string, {hasharrays.BLOCKS}"))
        seen = np.zeros(6, np.int64)
        for row in level.filter("kind = 'seen'").select("data").collect():
            seen += np.frombuffer(row.data, "<i8")
        model.discounts.insert(0, discounts(*seen[1:5].tolist()))
        if n == 1:
            model.unigrams = (int(seen[0]), int(seen[1]), int(seen[2]), int(seen[5]))
            break
        contexts = hasharrays.merged(level.filter("kind = 'context'"), bits, width(n - 1, each), len(CONTEXT), keep_contexts(n), "shard int")
        contexts.agg(F.count("*")).collect()
        rows = level.filter("kind = 'rest'").select("shard", "n", "data")
        if n - 1 > 1:
            rows = rows.unionByName(hasharrays.blocks(source, count(n - 1, True), bits))
    return model


def discounts(one: int, two: int, three: int, four: int) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2 and more, from how many n-grams have counts 1 to 4."""
    if not (one and two and three and four):
        return DISCOUNTS
    share = one / (one + 2 * two)
    found = (1 - 2 * share * two / one, 2 - 3 * share * three / two, 3 - 4 * share * four / three)
    return found if all(0 < d <= k for k, d in enumerate(found, 1)) else DISCOUNTS


def _discounted(counts: np.ndarray, off: tuple[float, float, float]) -> np.ndarray:
    taken = np.array([0.0, *off])[np.minimum(counts, 3)]
    return np.maximum(counts - taken, 0.0)


def _left(sums: dict[str, np.ndarray], off: tuple[float, float, float]) -> np.ndarray:
    return off[0] * sums["ones"] + off[1] * sums["twos"] + off[2] * sums["more"]


def _unique_find(arrays: Arrays, keys: np.ndarray) -> dict[str, np.ndarray]:
    """Values of every row of ``keys``, each different one looked up once; 0 where there is none."""
    hashes, back = np.unique(hasharrays.hashed(keys), return_inverse=True)
    _, _, values = arrays.find(hashes)
    return {name: value[back] for name, value in values.items()}


def probabilities(model: Model, block: Block, number: np.ndarray) -> np.ndarray:
    """Probability of every token of the block after the ones before it; 1 for beginnings."""
    total, ones, twos, more = model.unigrams
    off = model.discounts[0]
    known = block.scored & (number != UNKNOWN)
    share = (off[0] * ones + off[1] * twos + off[2] * more) / total if total else 1.0
    found = np.full(len(number), share / (model.vocabulary + 1))
    if known.any():
        counts = _unique_find(Arrays(f"{model.folder}/grams1", model.bits, ("count",)), model.keys([number[known]]))["count"]
        found[known] += _discounted(counts, off) / total
    for n in range(2, model.order + 1):
        ids, ends = grams(block, number, n)
        off = model.discounts[n - 1]
        sure = np.all([c != UNKNOWN for c in ids[:-1]], axis=0) if len(ends) else np.zeros(0, bool)
        ids, ends = [c[sure] for c in ids], ends[sure]
        if not len(ends):
            continue
        sums = _unique_find(Arrays(f"{model.folder}/contexts{n}", model.bits, CONTEXT), model.keys(ids[:-1]))
        seen = sums["total"] > 0
        ids, ends, sums = [c[seen] for c in ids], ends[seen], {name: value[seen] for name, value in sums.items()}
        counts = np.zeros(len(ends), np.int64)
        last = ids[-1] != UNKNOWN
        if last.any():
            counts[last] = _unique_find(Arrays(f"{model.folder}/grams{n}", model.bits, ("count",)), model.keys([c[last] for c in ids]))["count"]
        found[ends] = (_discounted(counts, off) + _left(sums, off) * found[ends]) / sums["total"]
    found[~block.scored] = 1.0
    return found


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity)`` for every row of ``docs``.

    ``score`` is the log10 probability of the text and its end under the model, ``perplexity`` that for
    each token; ``base_score`` that of the words alone with one added to every count.
    """
    total, below = model.train_tokens, model.train_tokens + model.vocabulary + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            texts = (value.as_py() for value in batch.column(1))
            sizes, knowns = np.zeros(n, np.int64), np.zeros(n, np.int64)
            base, found = np.zeros(n), np.zeros(n)
            for block in tokens(texts, model.order - 1):
                number, count = model.words(block)
                at = block.text[block.scored]
                count = count[block.scored]
                chances = probabilities(model, block, number)[block.scored]
                sizes += np.bincount(at, minlength=n)
                knowns += np.bincount(at, weights=count > 0, minlength=n).astype(np.int64)
                base += np.bincount(at, weights=np.log10((count + 1) / below), minlength=n)
                found += np.bincount(at, weights=np.log10(chances), minlength=n)
            columns = [sizes, knowns, np.full(n, total), base, found, 10.0 ** (-found / np.maximum(sizes, 1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", *SCORES])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    schema = "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return source.mapInArrow(run, f"doc_id {kind}, {schema}")
