"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose spans: strict ones, which are always kept, and loose ones. Five labelers vote on
each proposal, for, against or not at all: validity of the form (regular expressions and checksums),
a gazetteer, words before it, its surroundings, and its layout. Expectation-maximisation over the
counts of vote patterns estimates, for each kind, how reliable each labeler is, and with it the
probability of every pattern. On these probabilities a span classifier is trained (naive Bayes over
features of the span, one table of log odds), and loose spans that it accepts are added.

The text is scanned once. Votes and features take few values, so all training works on a table of
their combinations, a few thousand rows at most, whatever the corpus; only its sums, a row for each
kind, and the finished log odds come to the driver.

Spans are code points, end exclusive. Edge cases: a NULL text counts as empty and has no span; a very
long one is searched whole, in time about in proportion to its spans. Overlapping spans of different kinds are all
reported, and redacted as one. Rows with NULL or
repeated doc_id are rows like any other; extra columns are ignored, or carried by ``redacted``; an
empty table gives an empty result, and without loose spans there is nothing to train on or to add.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import durable

KINDS = ("email", "ip", "card", "phone")

# Strict patterns. Equal in effect to the plain forms without look-behind, minimum counts and
# possessive quantifiers, which here only keep the matcher from trying what cannot match.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Loose patterns: written-out or bracketed signs, and numbers without a country code.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\bat\b)\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\bdot\b)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\bdot\b)\x20?[0-9]{1,3}){3}(?![0-9])",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
}
# Gazetteers: ends of mail domains, first digits of cards, area or country codes. Fixed values.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[\])]?\x20?)(?:com|org|net|edu|gov|io|info|biz|de|fr|es|it|uk|eu|ch|at|nl)$",
    "ip": r"^(?!0+\b|127\b|255\b)",
    "card": r"^(?:4|5[1-5]|3[47]|6011|65|2[2-7])",
    "phone": r"^(?:\+(?:1|33|34|44|49)\b|\(?[2-9][0-9]{2}\)?)",
}
# Words before a span that speak for its kind, and for something else. Fixed values.
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write|from|to)\W*$",
    "ip": r"(?i)(?:ip|address|host|server|login|from)\W*$",
    "card": r"(?i)(?:card|visa|credit|payment|karte|carte|tarjeta)\W*(?:no|number)?\W*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|whatsapp)\W*$",
}
AGAINST = r"(?i)(?:version|release|order|invoice|isbn|token|hash|section|build|serial)\W*(?:no|number)?\W*$"
VOTES = ("form", "gazetteer", "context", "edges", "layout")
# Code points of context before and after a span.
WINDOW = 24
SPAN = "struct<start:int,end:int,value:string>"
# Items of a chunk of running sums, code points of a block of text.
CHUNK, BLOCK = 128, 1024
# Beyond every place.
BEYOND = (1 << 31) - 1


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches as (gap, value): length of the text between the one before and this one, and the
    match; ``hint`` is a cheap pattern any text with one contains."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)), found, lambda g, f: F.struct(F.length(g).alias("gap"), f.alias("value"))
    )
    return F.when(text.rlike(hint), pairs).otherwise(F.array().cast("array<struct<gap:int,value:string>>"))


def running(items: str, term: str, zero: int, join: str) -> str:
    """SQL: for each of the column ``items`` the terms of those before it, joined.

    ``term`` is SQL of an item ``x``, ``join`` of terms ``{a}`` and ``{b}``. In chunks, first their totals and then
    inside: an array grows by copying, and so none grows long.
    """

    def before(terms: str, start: str) -> str:
        state = f"struct({start} as at, cast(array() as array<int>) as out)"
        grown = f"struct({join.format(a='s.at', b='b')} as at, concat(s.out, array(s.at)) as out)"
        return f"aggregate({terms}, {state}, (s, b) -> {grown}, s -> s.out)"

    chunks = f"transform(sequence(0, cast(floor(greatest(size({items}) - 1, 0) / {CHUNK}) as int)), c -> transform(slice({items}, c * {CHUNK} + 1, {CHUNK}), x -> {term}))"
    totals = f"transform({chunks}, chunk -> aggregate(chunk, {zero}, (a, b) -> {join.format(a='a', b='b')}))"
    return f"flatten(zip_with({chunks}, {before(totals, str(zero))}, (chunk, start) -> {before('chunk', 'start')}))"


# How running terms are joined.
SUM, MOST, LEAST = "{a} + {b}", "greatest({a}, {b})", "least({a}, {b})"


def placed(pairs: str) -> Column:
    """Matches (gap, value) of a column as (start, end, value)."""
    before = running(pairs, "x.gap + length(x.value)", 0, SUM)
    span = "(p, at) -> struct(at + p.gap as start, at + p.gap + length(p.value) as end, p.value as value)"
    return F.expr(f"if(size({pairs}) > 0, zip_with({pairs}, {before}, {span}), cast(array() as array<{SPAN}>))")


def blocks(text: Column) -> Column:
    """``text`` in blocks of ``BLOCK`` code points: a place in it is then found without counting from the start."""
    return F.when(F.length(text) <= BLOCK, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))


def piece(text_blocks: Column, low: Column, high: Column) -> Column:
    """The text between two places."""
    first = F.floor(low / BLOCK).cast("int")
    last = F.floor((F.greatest(high, low + 1) - 1) / BLOCK).cast("int")
    return F.substring(F.array_join(F.slice(text_blocks, first + 1, last - first + 1), ""), low - first * BLOCK + 1, high - low)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if the digits pass the checksum of card numbers."""
    n = F.length(number)
    doubled = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(number, n - i, F.lit(1)).cast("int") * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


# A number from 0 to 255, leading zeros or not.
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def valid(kind: str, value: Column) -> Column:
    """Whether a strict match counts."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(f"^(?:{PART}[.]){{3}}{PART}$")
    n = F.length(digits(value))
    if kind == "card":
        return n.between(13, 19) & luhn(F.when(n.between(13, 19), digits(value)).otherwise(F.lit("0")))
    return n.between(9, 15)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(kind: str, text_blocks: Column, span: Column, strict: bool) -> Column:
    """A proposal with its votes and features."""
    start, end, value = span["start"], span["end"], span["value"]
    low = F.greatest(start - WINDOW, F.lit(0))
    before = piece(text_blocks, low, start)
    after = piece(text_blocks, end, end + 1)
    n = F.length(digits(value))
    whole = ~before.rlike("[A-Za-z0-9_]$") & ~after.rlike("^[A-Za-z0-9_]")
    layout = {
        "email": _vote(F.length(value).between(6, 64), F.length(value) > 128),
        "ip": _vote(~value.rlike(r"(?:^|\D)0[0-9]"), value.rlike(r"(?:^|\D)0[0-9]")),
        "card": _vote((n == 16) & value.rlike(r"^(?:[0-9]{16}|(?:[0-9]{4}[\x20-]){3}[0-9]{4})$"), ~n.between(15, 16)),
        "phone": _vote(n.between(10, 12), n > 13),
    }[kind]
    form = F.lit(1) if strict else (F.lit(-1) if kind == "card" else F.lit(0))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        start.alias("start"),
        end.alias("end"),
        F.lit(strict).alias("strict"),
        form.alias("form"),
        _vote(value.rlike(GAZETTEER[kind]), ~value.rlike(GAZETTEER[kind])).alias("gazetteer"),
        _vote(before.rlike(CONTEXT[kind]), before.rlike(AGAINST)).alias("context"),
        _vote(whole, ~whole).alias("edges"),
        layout.alias("layout"),
        # Features of the classifier: counts in classes, kinds of neighbours and separators.
        F.least(n, F.lit(20)).cast("int").alias("digits"),
        F.least(F.floor(F.length(value) / 4), F.lit(16)).cast("int").alias("length"),
        F.when(value.rlike(r"[()\[\]]"), 2).when(value.rlike(r"[\x20-]"), 1).otherwise(0).alias("separators"),
        F.when(before == "", 0).when(before.rlike(r"\s$"), 1).when(before.rlike(r"[\p{L}0-9]$"), 2).otherwise(3).alias("left"),
        F.when(after == "", 0).when(after.rlike(r"^\s"), 1).when(after.rlike(r"^[\p{L}0-9]"), 2).otherwise(3).alias("right"),
    )


FEATURES = ("digits", "length", "separators", "left", "right", "gazetteer", "context")


def with_proposals(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__text``, never NULL, ``__blocks`` of it, and ``__proposals``: all strict and loose
    spans, judged, strict ones first within a kind.

    In steps, so that nothing that is used twice, by every loose span say, is matched twice.
    """
    hints = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][0-9 -]{11}", "phone": r"\+[0-9]"}
    loose_hints = {"email": r"(?i)dot", "ip": r"(?i)[0-9]\x20?(?:[\[(]\.|dot)", "phone": r"[0-9]{3}[.\x20-][0-9]{4}"}
    text = F.col("__text")
    found = {f"__{kind}": matches(text, STRICT[kind], hints[kind]) for kind in KINDS}
    found |= {f"__more_{kind}": matches(text, LOOSE[kind], loose_hints[kind]) for kind in LOOSE}
    any_found = reduce(lambda a, b: a | b, (F.size(name) > 0 for name in found))

    def loose(kind: str) -> Column:
        if kind == "card":
            return F.filter("__card", lambda s: F.length(digits(s["value"])).between(13, 19) & ~valid(kind, s["value"]))
        return F.when((F.size(f"__more_{kind}") > 0) & (F.size(f"__strict_{kind}") > 0), apart(f"__mixed_{kind}")).otherwise(F.col(f"__more_{kind}"))

    def judge(kind: str, spans: str, strict: bool) -> Column:
        return F.transform(spans, lambda s: _judged(kind, F.col("__blocks"), s, strict))

    judged = [judge(kind, f"__{how}_{kind}", how == "strict") for kind in KINDS for how in ("strict", "loose")]
    steps = [
        {"__text": F.coalesce(F.col("text").cast("string"), F.lit(""))},
        found,
        {name: placed(name) for name in found} | {"__blocks": F.when(any_found, blocks(text)).otherwise(F.array(F.lit("")))},
        {f"__strict_{kind}": F.filter(f"__{kind}", lambda s: valid(kind, s["value"])) for kind in KINDS},
        {f"__mixed_{kind}": mixed(f"__strict_{kind}", f"__more_{kind}") for kind in LOOSE},
        {f"__loose_{kind}": loose(kind) for kind in KINDS},
        {"__proposals": F.concat(*judged)},
    ]
    out = reduce(DataFrame.withColumns, steps, docs)
    return out.select(*docs.columns, "__text", "__blocks", "__proposals")


def mixed(strict: str, loose: str) -> Column:
    """Strict and loose spans of two columns in one array, in order of their starts."""
    sides = (f"transform({name}, x -> struct(x.start as start, {flag} as loose, x.end as end, x.value as value))" for name, flag in ((strict, "false"), (loose, "true")))
    return F.expr(f"array_sort(concat({', '.join(sides)}))")


def apart(spans: str) -> Column:
    """The loose spans of the column ``spans``, made by ``mixed``, that no strict one overlaps: those
    before it end and those after it begin outside."""
    end_before = running(spans, "if(x.loose, 0, x.end)", 0, MOST)
    start_after = running(f"reverse({spans})", f"if(x.loose, {BEYOND}, x.start)", BEYOND, LEAST)
    sides = f"zip_with({end_before}, reverse({start_after}), (a, b) -> struct(a as before, b as after))"
    both = f"zip_with({spans}, {sides}, (s, x) -> struct(s as s, x as x))"
    alone = f"filter({both}, p -> p.s.loose and p.x.before <= p.s.start and p.x.after >= p.s.end)"
    return F.expr(f"transform({alone}, p -> struct(p.s.start as start, p.s.end as end, p.s.value as value))")


def estimate(patterns: DataFrame, rounds: int = 12) -> DataFrame:
    """``patterns`` (kind, votes, n, ...) with ``p``, the probability that such a span is real.

    Each round reads the sums by kind that the last one left: the share of real spans, and how often
    each labeler casts each vote on real and on other spans.
    """
    votes = [F.col(v) for v in VOTES]
    p = F.when(sum(votes, F.lit(0)) > 0, 0.9).otherwise(0.1)
    for _ in range(rounds):
        sums = patterns.withColumn("p", p).groupBy("kind").agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.col("p")).alias("real"),
            *(F.sum(F.when(F.col(v) == vote, F.col("n") * F.col("p")).otherwise(0.0)).alias(f"{v}{vote}") for v in VOTES for vote in (-1, 0, 1)),
            *(F.sum(F.when(F.col(v) == vote, F.col("n")).otherwise(0)).alias(f"all_{v}{vote}") for v in VOTES for vote in (-1, 0, 1)),
        )
        odds = F.lit(0.0)
        for row in sums.collect():
            real, other = row.real, row.n - row.real
            terms = F.lit(math.log((real + 1) / (other + 1)))
            for v in VOTES:
                for vote in (-1, 0, 1):
                    on_real = (row[f"{v}{vote}"] + 1) / (real + 3)
                    on_other = (row[f"all_{v}{vote}"] - row[f"{v}{vote}"] + 1) / (other + 3)
                    terms = terms + F.when(F.col(v) == vote, math.log(max(on_real, 1e-9) / max(on_other, 1e-9))).otherwise(0.0)
            odds = F.when(F.col("kind") == row.kind, terms).otherwise(odds)
        p = 1 / (1 + F.exp(-odds))
    return patterns.withColumn("p", p)


def train(judged: DataFrame, rounds: int = 12) -> dict:
    """Log odds of every feature value by kind, from the column ``__proposals`` of judged spans."""
    columns = list(dict.fromkeys(["kind", *VOTES, *FEATURES]))
    # The outer form: for the inner one Spark would first ask of every text, by matching it all again, whether it has spans.
    spans = judged.select(F.explode_outer("__proposals").alias("s")).filter("s is not null")
    patterns = durable(spans.select(*(F.col(f"s.{c}").alias(c) for c in columns)).groupBy(*columns).agg(F.count("*").alias("n")))
    weighed = durable(estimate(patterns, rounds))
    values = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES)))
    table = weighed.select("kind", "n", "p", values.alias("f")).groupBy("kind", "f.feature", "f.value").agg(
        F.sum(F.col("n") * F.col("p")).alias("real"), F.sum(F.col("n") * (1 - F.col("p"))).alias("other")
    )
    prior = weighed.groupBy("kind").agg(F.sum(F.col("n") * F.col("p")).alias("real"), F.sum(F.col("n") * (1 - F.col("p"))).alias("other"))
    totals = {row.kind: (row.real, row.other) for row in prior.collect()}
    odds = {}
    for row in table.collect():
        real, other = totals[row.kind]
        odds[row.kind, row.feature, row.value] = math.log((row.real + 1) / (real + 22)) - math.log((row.other + 1) / (other + 22))
    return {"prior": {k: math.log((a + 1) / (b + 1)) for k, (a, b) in totals.items()}, "odds": odds}


def accepts(span: Column, model: dict, least: float) -> Column:
    """Whether the classifier gives the judged span a probability of ``least`` or more."""
    if not model["prior"]:
        return F.lit(False)

    def table(entries: dict) -> Column:
        return F.create_map(*(F.lit(x) for pair in entries.items() for x in pair))

    keys = {f"{k}:{f}:{v}": w for (k, f, v), w in sorted(model["odds"].items())}
    known = table(keys)
    terms = [F.coalesce(F.try_element_at(table(model["prior"]), span["kind"]), F.lit(-20.0))]
    for f in FEATURES:
        key = F.concat_ws(":", span["kind"].cast("string"), F.lit(f), span[f].cast("string"))
        terms.append(F.coalesce(F.try_element_at(known, key), F.lit(0.0)))
    return reduce(lambda a, b: a + b, terms) >= math.log(least / (1 - least))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", parts)


def detect(docs: DataFrame, least: float = 0.5, rounds: int = 12) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` for every row.

    The counts and the digest are of strict spans; spans lists all, as kind:start:end.
    """
    judged = durable(with_proposals(docs.select("doc_id", "text")).select("doc_id", "__proposals"))
    model = train(judged, rounds)
    strict = F.filter("__proposals", lambda s: s["strict"])
    kept = F.array_sort(
        F.transform(
            F.filter("__proposals", lambda s: s["strict"] | accepts(s, model, least)),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )
    )

    def count(kind: str) -> Column:
        return F.size(F.filter(strict, lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = map(count, KINDS)
    return judged.select("doc_id", *counts, F.sha2(_joined(strict), 256).alias("base_sha256"), _joined(kept).alias("spans"))


def redacted(docs: DataFrame, least: float = 0.5, rounds: int = 12) -> DataFrame:
    """``docs``, all columns, with every span of the text replaced by its kind in angle brackets."""
    model = train(with_proposals(docs.select("text")), rounds)
    # All columns travel in one, so that their names do not meet those used here.
    packed = docs.select(F.struct("*").alias("row"), "text")
    names, text_blocks = F.array(*map(F.lit, KINDS)), F.col("__blocks")
    found = F.array_sort(
        F.transform(
            F.filter("__proposals", lambda s: s["strict"] | accepts(s, model, least)),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    # Where the text that is already replaced ends.
    done = F.expr(running("__spans", "x.end", 0, MOST))

    def replaced(span: Column, at: Column) -> Column:
        tag = F.concat(F.lit("<"), F.element_at(names, span["kind"] + 1), F.lit(">"))
        # A span that begins inside what is already replaced only lengthens it.
        return F.when(span["start"] >= at, F.concat(piece(text_blocks, at, span["start"]), tag)).otherwise("")

    rest = piece(text_blocks, F.array_max(F.transform("__spans", lambda s: s["end"])), F.length("__text"))
    whole = F.concat(F.array_join(F.zip_with("__spans", done, replaced), ""), rest)
    # Always true, but not a function of the row: a condition that a user puts on the text is then not
    # worked out below this point, by matching every text again.
    once = F.monotonically_increasing_id() >= 0
    changed = F.col("__once") & F.col("text").isNotNull() & (F.size("__spans") > 0)
    clean = F.when(changed, whole).otherwise(F.col("text"))
    columns = [clean.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return with_proposals(packed).withColumns({"__spans": found, "__once": once}).select(columns)
