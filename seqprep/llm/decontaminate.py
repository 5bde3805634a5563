"""Benchmark decontamination by templates, which also finds re-parameterised questions.

A text becomes a sequence of tokens. In its template, numbers, names and units are
typed placeholders, neighbours of one type a single one. Windows of tokens, literal and
of the template, are hashed and joined with the benchmark's windows. Matches of a
document and an item are gathered by their diagonal (the shift between the two). On a
diagonal of template windows the fillings must be consistent: each filling of the item
goes with one filling of the document and the other way round. Of pairs of fillings that
contradict each other the one in more windows holds (ties: the smaller hashes), and
windows with another one do not count. One such slip, or one in five pairs, is put up
with if it is of numbers; a diagonal with more, or whose names or units contradict each
other (roles are swapped, say), is no re-parameterised question. A document is
contaminated by an item if consistent windows cover enough of the item.

A number is a token with a digit or a listed number word. A unit is a listed word after a number. A name is a
word with a capital first letter and a small second one that does not open a sentence.
A word that opens one may be a name or not, so a text has a second template in which
such words, but for the listed ones, are names as well.

Documents' windows meet a filter of fixed size over the benchmark's windows before
anything is shuffled; what passes by chance finds no partner in the join.

Cases: null and empty texts have no windows. An item shorter than a window is one
window of its own length. Repeated documents are one per id; repeated items are one
per id. Very long texts are read whole, in chunks of texts; a text alone may exceed a chunk. An
empty table of documents or items has an empty result. Rows without an id are kept apart from none: null is an id like others. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.arrays import U64, SliceHash, chunks, edges, flat, mix
from seqprep.llm.shared import bit_filter, materialise, passes, quoted, small_batches, table

#: Tokens of a window, and the share of an item's windows that makes a contamination.
WIDTH = 5
COVERAGE = 0.5
#: A template window holds at least so many tokens that are not placeholders.
LEAST_WORDS = 2
FILTER_BITS = 1 << 25
#: Pairs of numbers that may contradict others on a diagonal: one, or one of so many.
SLIP_PAIRS = 5
#: Words that are numbers; of several in a row one placeholder is made.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
    "million billion dozen"
).split()
#: Units that turn into a placeholder after a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec second seconds min minute minutes h hr "
    "hour hours day days week weeks month months year years percent cent cents dollar dollars euro euros "
    "pound pounds meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet "
    "inch inches gram grams kilogram kilograms liter liters litre litres mph kmh kph hz khz mhz ghz v w kw "
    "kwh j kj pa kpa c f k"
).split()
#: Words that open a sentence and are no names.
OPENERS = (
    "a an the this that these those it its he she they we you i his her their our your my there here what which "
    "who whom whose when where why how if in on at by for from to of with without and or but so as is are was "
    "were do does did can could should would has have had not no each every all some any both after before "
    "during while then since until because although however given let find suppose"
).split()
NUMBER, UNIT, NAME, OPENER = 1, 2, 3, 4

Batches = Iterator[pa.RecordBatch]


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and the accented capitals of Latin-1 in lower case, byte by byte."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] |= 32
    if len(data):
        second = np.append(False, data[:-1] == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
        out[second] |= 32
    return out


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, type, first token of each text) of runs of letters and digits."""
    inside = (data >= 128) | ((data >= 48) & (data <= 57)) | ((data | 32) >= 97) & ((data | 32) <= 122)
    # general punctuation and the signs of Latin-1 are not letters
    for lead, size in ((0xC2, 2), (0xE2, 3)):
        at = np.flatnonzero(data[: max(0, len(data) - size + 1)] == lead)
        if lead == 0xE2:
            at = at[data[at + 1] == 0x80]
        for k in range(size):
            inside[at + k] = False
    start, end = edges(inside, offsets)
    first = np.searchsorted(start, offsets)
    low = _lowered(data)
    word = SliceHash(low)(start, end)
    kind = np.zeros(len(start), np.int8)
    if not len(start):
        return word, kind, first
    digits = np.append(0, np.cumsum((data >= 48) & (data <= 57)))
    kind[(digits[end] > digits[start]) | listed(word, NUMBERS)] = NUMBER
    opens = np.zeros(len(start), bool)
    opens[first[:-1][first[:-1] < len(start)]] = True
    kind[1:][listed(word, UNITS)[1:] & (kind[:-1] == NUMBER) & ~opens[1:]] = UNIT
    stops = np.append(0, np.cumsum(np.isin(data, np.frombuffer(b".!?:;\n\r\"", np.uint8))))
    same = np.append(False, stops[start[1:]] == stops[end[:-1]]) & ~opens
    capital = low[start] != data[start]
    accented = np.minimum(start + 1, len(data) - 1)
    capital |= (data[start] == 0xC3) & (low[accented] != data[accented])
    second = np.minimum(start + 1 + (data[start] >= 128), len(data) - 1)
    small = (end - start > 1) & (low[second] == data[second])
    named = capital & small & (kind == 0)
    kind[same & named] = NAME
    kind[~same & named & ~listed(word, OPENERS)] = OPENER
    return word, kind, first


def word_list(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return SliceHash(data)(np.append(0, ends[:-1]), ends)


def listed(word: np.ndarray, words: list[str]) -> np.ndarray:
    """Which of the hashes are those of ``words``."""
    known = np.sort(word_list(words))
    at = np.searchsorted(known, word)
    at[at == len(known)] = 0
    return known[at] == word


def _template(word: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token or placeholder, filling or 0) with neighbours of one type joined.

    The last three bits of a filling are its type.
    """
    new = np.append(True, (kind[1:] == 0) | (kind[1:] != kind[:-1]))
    at = np.flatnonzero(new)
    filling = np.add.reduceat(mix(word, 5) * (np.arange(len(word), dtype=U64) - np.repeat(at, np.diff(np.append(at, len(word)))).astype(U64) + U64(1)), at)
    slot = kind[at]
    return np.where(slot == 0, word[at], slot.astype(U64)), np.where(slot == 0, U64(0), filling >> U64(3) << U64(3) | slot.astype(U64))


def _templates(word: np.ndarray, kind: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(form, *template): 1 with names inside sentences only, 2 with those that open one."""
    opens = kind == OPENER
    plain = np.where(opens, 0, kind)
    if plain.any():
        yield (1, *_template(word, plain))
    if opens.any():
        token, filling = _template(word, np.where(opens, NAME, kind))
        # in less than a window, hardly a word is left beside the name
        if len(token) >= WIDTH:
            yield 2, token, filling


def windows(token: np.ndarray, width: int, seed: int) -> np.ndarray:
    n = max(0, len(token) - width + 1)
    weights = mix(np.arange(1, width + 1, dtype=U64), 13) | U64(1)
    total = np.zeros(n, U64)
    for k in range(width):
        total += mix(token[k : k + n], 3) * weights[k]
    return mix(total, 100 * width + seed)


FIELDS = "kind byte, hash long, pos int, total int, slots array<long>"


def _windowing(widths: list[int] | None, known) -> Callable[[Batches], Batches]:
    """Rows for the windows of each text: literal (kind 0) and of the templates (1 and 2).

    ``total`` counts the text's windows of the kind, of a template those with enough words.

    Without ``widths`` a text has windows of ``WIDTH``, or one of its own length if it
    is shorter. ``known`` is the filter that windows pass.
    """

    def of_text(word: np.ndarray, kind: np.ndarray) -> Iterator[tuple]:
        blank = np.zeros(len(word), U64)
        for form, token, filling in [(0, word, blank), *_templates(word, kind)]:
            for width in (widths if form < 2 else [WIDTH]) if widths else [min(WIDTH, len(token))]:
                hashes = windows(token, width, 0)
                usable = np.ones(len(hashes), bool)
                if form and len(hashes):
                    held = np.append(0, np.cumsum(filling != 0))
                    slots = held[width:] - held[:-width]
                    usable = width - slots >= min(LEAST_WORDS, width)
                total = int(usable.sum())
                keep = usable & passes(known.value, hashes, FILTER_BITS) if known is not None else usable
                for p in np.flatnonzero(keep).tolist():
                    inner = filling[p : p + width]
                    yield form, hashes[p], p, total, inner[inner != 0].view(np.int64).tolist()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in chunks(batch, "text"):
                word, kind, first = tokens_of(*flat(part.column("text")))
                owner, rows = [], []
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    if b > a:
                        found = list(of_text(word[a:b], kind[a:b]))
                        owner += [i] * len(found)
                        rows += found
                if rows:
                    form, hashes, pos, total, slots = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("id").take(pa.array(owner)),
                            pa.array(form, pa.int8()),
                            pa.array(np.array(hashes, U64).view(np.int64)),
                            pa.array(pos, pa.int32()),
                            pa.array(total, pa.int32()),
                            pa.array(slots, pa.list_(pa.int64())),
                        ],
                        ["id", "kind", "hash", "pos", "total", "slots"],
                    )

    return run


def consistent_places(met: Column) -> Column:
    """The places of a diagonal's windows whose fillings agree; none if there are too many slips.

    ``met`` is an array of (pos, same), ``same`` the window's pairs (a, b) of fillings. Only
    a diagonal that holds a contradiction is looked at pair by pair.
    """
    pairs = F.array_distinct(F.flatten(met["same"]))
    one_to_one = (F.size(pairs) == F.size(F.array_distinct(pairs["a"]))) & (
        F.size(pairs) == F.size(F.array_distinct(pairs["b"]))
    )

    def better(t: Column, s: Column) -> Column:
        first = (t["a"] < s["a"]) | (t["a"] == s["a"]) & (t["b"] < s["b"])
        return (t["n"] > s["n"]) | (t["n"] == s["n"]) & first

    def rivals(t: Column, s: Column) -> Column:
        return (t["a"] == s["a"]) != (t["b"] == s["b"])

    def holding(pair: Column) -> Column:
        return F.size(F.filter(met, lambda w: F.array_contains(w["same"], pair)))

    scored = F.transform(pairs, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), holding(p).alias("n")))
    held = F.filter(scored, lambda s: ~F.exists(scored, lambda t: rivals(t, s) & better(t, s)))
    agreed = F.transform(held, lambda s: F.struct(s["a"].alias("a"), s["b"].alias("b")))
    kept = F.filter(met, lambda w: F.size(F.array_except(w["same"], agreed)) == 0)
    slips = F.array_except(pairs, agreed)
    few = F.size(slips) <= F.greatest(F.lit(1), F.floor(F.size(pairs) / SLIP_PAIRS))
    bearable = few & F.forall(slips, lambda p: p["a"].bitwiseAND(F.lit(7)) == NUMBER)
    return F.when(one_to_one, met["pos"]).when(bearable, kept["pos"]).otherwise(F.array().cast("array<int>"))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, item_id, coverage, kind) for every item that contaminates a document.

    ``kind`` is ``literal`` or ``template``; coverage is the better one's.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(quoted(item_id)).alias("id"), F.col(quoted(item_text)).alias("text"))
    asked = asked.groupBy("id").agg(F.min("text").alias("text"))
    item_type = asked.schema["id"].dataType.simpleString()
    theirs = materialise(asked.mapInArrow(_windowing(None, None), f"id {item_type}, {FIELDS}"))
    known = spark.sparkContext.broadcast(bit_filter(theirs, "hash", FILTER_BITS))
    # only items shorter than a window have other widths; there are at most WIDTH of them
    short = asked.mapInArrow(_lengths, "n int").distinct().collect()
    widths = sorted({WIDTH, *(r.n for r in short)})
    texts = small_batches(docs).select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"))
    doc_type = texts.schema["id"].dataType.simpleString()
    ours = texts.mapInArrow(_windowing(widths, known), f"id {doc_type}, {FIELDS}")
    left = ours.select(F.col("id").alias("doc"), "kind", "hash", F.col("pos").alias("at"), F.col("slots").alias("own"))
    right = theirs.select(F.col("id").alias("item"), "kind", "hash", "pos", "total", "slots")
    pair = F.arrays_zip(F.col("slots").alias("a"), F.col("own").alias("b"))
    lines = (
        left.join(right, ["kind", "hash"])
        .withColumn("same", F.when(F.size("slots") == F.size("own"), pair))
        .where("same IS NOT NULL")
        .groupBy("doc", "item", "kind", (F.col("at") - F.col("pos")).alias("shift"))
        .agg(F.collect_set(F.struct("pos", "same")).alias("met"), F.max("total").alias("total"))
    )
    covered = (
        lines.withColumn("places", consistent_places(F.col("met")))
        .groupBy("doc", "item", "kind")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("n"), F.max("total").alias("total"))
        .select("doc", "item", "kind", (F.col("n") / F.col("total")).alias("coverage"))
    )
    best = covered.groupBy("doc", "item").agg(F.max(F.struct("coverage", -F.col("kind"))).alias("best"))
    return best.select(
        F.col("doc").alias(doc_id),
        F.col("item").alias(item_id),
        F.col("best.coverage").alias("coverage"),
        F.when(F.col("best.col2") == 0, "literal").otherwise("template").alias("kind"),
    ).where(F.col("coverage") >= coverage)


def _lengths(batches: Batches) -> Batches:
    for batch in batches:
        for part in chunks(batch, "text"):
            word, kind, first = tokens_of(*flat(part.column("text")))
            n = set()
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                if b > a:
                    n |= {b - a, *(len(token) for _, token, _ in _templates(word[a:b], kind[a:b]))}
            yield pa.RecordBatch.from_arrays([pa.array([x for x in n if x < WIDTH], pa.int32())], ["n"])


# --- query ---------------------------------------------------------------------------


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark``, literally or with other fillings."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
