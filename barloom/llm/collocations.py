"""Phrase collocations by direct-address tiling of word pairs.

Words that are frequent enough get ids by frequency, and pairs of neighbouring words become cells of
a square cut into tiles. Common words have small ids, so the first tiles are crowded: a task counts
those in dense arrays, addressed directly by ``bincount``. Cells of the other tiles are kept as sorted
coordinates with counts. What tasks have counted is added up by shards of the cells (``hasharrays``).
Frequent pairs are then ranked by frequency themselves, and a pair and the word after it are a cell of
the next square, and so on for longer phrases: a phrase can be frequent only if its first and its last
words are, so that each square holds only cells between frequent phrases and frequent words.

Ids are found through sorted hash arrays, mapped into memory by the workers. A word's key is a 64-bit
hash of language and word; a seed is taken for which no two words of the corpus share one, so counts
are exact. Ids, counts and scores are whole numbers throughout; scores are divided in 38 digits.

Edge cases: a NULL or blank text has no words, a NULL language is ``und``. A very long text is split
whole. Repeated rows count once each; ids and extra columns are ignored; no words give no rows.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import hasharrays
from barloom.llm.common import Numbering, durable, sized
from barloom.llm.hasharrays import Arrays, Counted

UNKNOWN_LANGUAGE = "und"
# What parts a text into pieces; no phrase goes beyond. Fixed value.
BREAKS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\n"
LOWER = bytes(BREAK[0] if c in BREAKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
SEED = 42
# Words held by a task at once, different words counted at once, text bytes for each shard of cells, rows for each shard of ids.
BLOCK, HELD, SHARD_BYTES, SHARD_ROWS = 1 << 20, 500_000, 24 << 20, 1 << 20
# Ids on each side of a tile; tiles on each side that may be dense, 16 arrays of 8 MB at most; least cells hit for that.
SIDE, CROWDED, FILLED = 1024, 4, 1024 * 1024 // 64


def split(text: bytes | None) -> list[bytes]:
    """The words of a text in lower case, with a ``BREAK`` after each piece."""
    words: list[bytes] = []
    for piece in (text or b"").translate(LOWER).split(BREAK):
        words += piece.split()
        words.append(BREAK)
    return words


def _source(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANGUAGE))
    return docs.select(lang.alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))


def word_counts(source: DataFrame) -> DataFrame:
    """``(lang, word, n)`` of every word of ``source`` (lang, text), added up in each task first."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, own in counts.items() for _ in own]
        words = pa.array([w for own in counts.values() for w in own], pa.binary()).cast(pa.string())
        n = pa.array([k for own in counts.values() for k in own.values()], pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), words, n], names=["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                own = counts.setdefault(lang.as_py(), Counter())
                own.update(split(text.as_py()))
                del own[BREAK]
            if sum(map(len, counts.values())) > HELD:
                yield rows(counts)
                counts = {}
        if counts:
            yield rows(counts)

    found = source.mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Adds ``id``, the place of each row in ``order``, from 0: sorted by ranges, not in one task."""
    placed = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").withColumn("id", F.col("offset") + F.col("at")).drop("part", "at", "offset")


def _word_key(seed: int, lang: Column, word: Column) -> Column:
    return F.xxhash64(F.lit(str(seed)), lang, word)


def _seed_without_collisions(words: DataFrame) -> int:
    """A seed for which all words of ``words`` (lang, word) have different keys."""
    for seed in range(8):
        keys = words.select(_word_key(seed, F.col("lang"), F.col("word")).alias("key"))
        if keys.groupBy("key").count().filter("count > 1").isEmpty():
            return seed
    raise ValueError("no seed gives different keys to all words")


class Texts:
    """Words of texts as ids, language by language, in blocks of about ``BLOCK`` words."""

    def __init__(self, seed: int, words: Arrays):
        self.seed, self.words = seed, words

    def blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        """Ids of the words of many texts in a row; -1 for breaks and words that are not frequent."""
        held: dict[str, tuple[Numbering, list[np.ndarray]]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                numbers, parts = held.setdefault(lang.as_py(), (Numbering(), []))
                parts.append(numbers.of(split(text.as_py())))
                size += len(parts[-1])
                if size >= BLOCK:
                    yield from self._ids(held)
                    held, size = {}, 0
        yield from self._ids(held)

    def _ids(self, held: dict[str, tuple[Numbering, list[np.ndarray]]]) -> Iterator[np.ndarray]:
        start = xxhash.xxh64_intdigest(str(self.seed), SEED)
        for lang, (numbers, parts) in held.items():
            own = xxhash.xxh64_intdigest(lang, start)
            keys = np.fromiter((xxhash.xxh64_intdigest(w, own) for w in numbers), np.uint64, len(numbers))
            _, place, values = self.words.find(hasharrays.mixed(keys))
            ids = np.where(place >= 0, values["id"], -1)
            yield ids[np.concatenate(parts)]


def cells(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


class Tiles:
    """Counts of cells (row, column): crowded tiles in dense arrays, others as sorted coordinates."""

    def __init__(self):
        self.dense: dict[tuple[int, int], np.ndarray] = {}

    def add(self, left: np.ndarray, right: np.ndarray) -> Counted:
        """Counts the cells of crowded tiles here, and gives the others in order with their counts."""
        edge = SIDE * CROWDED
        inner = (left < edge) & (right < edge)
        tile = (left // SIDE) * CROWDED + right // SIDE
        hits = np.bincount(tile[inner], minlength=CROWDED * CROWDED)
        rest = np.ones(len(left), bool)
        for number in np.flatnonzero(hits).tolist():
            place = divmod(number, CROWDED)
            if place not in self.dense and hits[number] < FILLED:
                continue
            here = inner & (tile == number)
            rest &= ~here
            cell = (left[here] % SIDE) * SIDE + right[here] % SIDE
            counts = np.bincount(cell, minlength=SIDE * SIDE)
            if place in self.dense:
                self.dense[place] += counts
            else:
                self.dense[place] = counts
        keys = cells(left[rest], right[rest])[:, None]
        return hasharrays.summed(keys, np.ones(keys.shape, np.uint64))

    def counted(self) -> Iterator[Counted]:
        """The cells of the crowded tiles."""
        for (row, column), counts in self.dense.items():
            at = np.flatnonzero(counts)
            keys = cells(row * SIDE + at // SIDE, column * SIDE + at % SIDE)
            order = np.argsort(keys)
            yield keys[order, None], counts[at][order, None].astype(np.uint64)


def phrases_in(ids: np.ndarray, longer: list[Arrays]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the phrases one word longer than the last of ``longer``: id of the first words, id of the last.

    ``longer`` finds the ids of two-word phrases by their cells, then of three-word phrases, and so on.
    """
    known = ids
    for words, arrays in enumerate(longer, 2):
        left, right, at = _neighbours(known, ids, words)
        keys, back = np.unique(hasharrays.mixed(cells(left, right)), return_inverse=True)
        _, place, values = arrays.find(keys)
        known = np.full(len(ids), -1, np.int64)
        known[at] = np.where(place >= 0, values["id"], -1)[back]
    left, right, _ = _neighbours(known, ids, len(longer) + 2)
    return left, right


def _neighbours(known: np.ndarray, ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of ``words`` words whose first and last ``words - 1`` words are frequent: id of the
    first, id of the last word, place."""
    n = max(len(ids) - words + 1, 0)
    at = np.flatnonzero((known[:n] >= 0) & (known[1 : n + 1] >= 0 if words > 2 else ids[words - 1 :][:n] >= 0))
    return known[at], ids[at + words - 1], at


def phrase_counts(source: DataFrame, texts: Texts, longer: list[Arrays], least: int, bits: int) -> DataFrame:
    """``(left, right, n)`` of every phrase one word longer than ``longer`` that occurs ``least`` times or more."""

    def produce(batches: Iterator[pa.RecordBatch]) -> Iterable[Counted]:
        tiles = Tiles()
        for ids in texts.blocks(batches):
            yield tiles.add(*phrases_in(ids, longer))
        yield from tiles.counted()

    def frequent(shard: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        enough = counts[:, 0] >= least
        key, n = keys[enough, 0], counts[enough, 0]
        columns = [key >> np.uint64(32), key & np.uint64(0xFFFFFFFF), n]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["left", "right", "n"])

    return hasharrays.merged(hasharrays.blocks(source, produce, bits), bits, 1, 1, frequent, "left long, right long, n long")


def _bits(amount: int, each: int) -> int:
    return max(int(amount // each), 0).bit_length()


def frequent_phrases(docs: DataFrame, folder: str, most_words: int, least: int, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """All words, and the frequent phrases of 1, 2, ... words, each ``(words array<long>, n, id)``.

    The words table is ``(lang, word, n, id)``, with an id where a word is frequent. Ids of phrases
    are found through arrays under ``folder``, a shared one.
    """
    source = _source(docs, lang_col, text_col)
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bits(size, SHARD_BYTES)
    words = durable(word_counts(source))
    common = durable(ranked(words.filter(F.col("n") >= least), F.desc("n"), F.asc("lang"), F.asc("word")))
    seed = _seed_without_collisions(words)
    n_common = common.count()
    if n_common >= 1 << 32:
        raise ValueError("more frequent words than 32-bit ids")
    keyed = common.select(_word_key(seed, F.col("lang"), F.col("word")).alias("key"), "id")
    texts = Texts(seed, hasharrays.store(keyed, f"{folder}/words", _bits(n_common, SHARD_ROWS)))
    levels = [common.select(F.array("id").alias("words"), "n", "id")]
    longer: list[Arrays] = []
    for n_words in range(2, most_words + 1):
        found = durable(phrase_counts(source, texts, longer, least, bits))
        place = durable(ranked(found, F.desc("n"), F.asc("left"), F.asc("right")))
        if n_words == 2:
            levels.append(place.select(F.array("left", "right").alias("words"), "n", "id"))
        else:
            before = levels[-1].select(F.col("id").alias("left"), "words")
            levels.append(durable(place.join(before, "left").select(F.concat("words", F.array("right")).alias("words"), "n", "id")))
        if n_words < most_words:
            key = F.shiftleft("left", 32).bitwiseOR(F.col("right"))
            longer.append(hasharrays.store(place.select(key.alias("key"), "id"), f"{folder}/phrases{n_words}", _bits(place.count(), SHARD_ROWS)))
    return words.join(common.select("lang", "word", "id"), ["lang", "word"], "left"), levels


def _cut(level: DataFrame, levels: list[DataFrame], n_words: int, first: int) -> DataFrame:
    """``(words, n, cut)``: counts of the first words and of the rest, and the score for them."""
    left = levels[first - 1].select(F.col("words").alias("start"), F.col("n").alias("l"))
    right = levels[n_words - first - 1].select(F.col("words").alias("rest"), F.col("n").alias("r"))
    whole = level.select("words", "n", F.slice("words", 1, first).alias("start"), F.slice("words", first + 1, n_words - first).alias("rest"))
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(n as decimal(15,0)) * cast(n as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    cut = F.struct(score.alias("score"), F.lit(first).alias("first"), "l", "r")
    return whole.join(sized(left), "start").join(sized(right), "rest").select("words", "n", cut.alias("cut"))


def scored(levels: list[DataFrame], covered_percent: int = 50) -> DataFrame:
    """``(words, a, l, r, score)`` of all phrases of two words or more, at their lowest-scoring cut.

    Left out are phrases inside a longer frequent one that has ``covered_percent`` of their
    occurrences or more. A longer phrase occurs no more often than any part of it, so it is enough to
    look at those one word longer.
    """
    parts = []
    for n_words in range(2, len(levels) + 1):
        level = levels[n_words - 1]
        cuts = functools.reduce(DataFrame.unionByName, (_cut(level, levels, n_words, k) for k in range(1, n_words)))
        best = cuts.groupBy("words").agg(F.first("n").alias("a"), F.min("cut").alias("cut"))
        if n_words < len(levels):
            inner = F.explode(F.array(F.slice("words", 1, n_words), F.slice("words", 2, n_words))).alias("words")
            around = levels[n_words].select(inner, "n").groupBy("words").agg(F.max("n").alias("around"))
            best = best.join(around, "words", "left").filter(F.coalesce(100 * F.col("around") < covered_percent * F.col("a"), F.lit(True)))
        parts.append(best.select("words", "a", "cut.l", "cut.r", "cut.score"))
    return functools.reduce(DataFrame.unionByName, parts)


def collocations(
    docs: DataFrame,
    folder: str,
    most_words: int = 3,
    least: int = 10,
    covered_percent: int = 50,
    top: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` its two parts, ``n`` all words of the
    language. Arrays are written under ``folder``, a shared one, and removed in the end.
    """
    if most_words < 2:
        raise ValueError("a phrase has two words at least")
    words, levels = frequent_phrases(docs, folder, most_words, least, lang_col, text_col)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    names = words.filter("id is not null").select("id", "lang", "word")
    found = scored(levels, covered_percent).withColumn("id", F.col("words")[0]).join(sized(names.select("id", "lang")), "id").drop("id")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # Ties at the end stay until their phrases are known.
    near = durable(found.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place"))
    spelled = (
        near.select("words", F.posexplode("words").alias("at", "id"))
        .join(names.select("id", "word"), "id")
        .groupBy("words")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    )
    whole = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    out = durable(
        near.join(spelled, "words")
        .withColumn("rank", F.row_number().over(whole).cast("long"))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
    hasharrays.remove(folder)
    return out
