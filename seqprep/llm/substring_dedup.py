"""Repeated passages by compact windows.

A text is a sequence of five-word shingles. Under a hash function, the subsequences of
``least`` shingles that have the same minimum form compact windows: the nodes of the
sequence's Cartesian tree that are wide enough. Their minima are the sliding minima of
the sequence, which block-wise prefix and suffix minima give for all positions at
once. A signature is the minimum of one hash function that a run of subsequences
shares. So a passage is met if one of the functions agrees on it: all that a join of
overlapping windows of two functions meets, and more. One repeated word for word has the
same signatures wherever it occurs; of passages of ``least`` words at a similarity of
0.8, one function misses a fifth, and all four 0.2 per cent.

Texts are grouped by signature. Of the shingles of a passage nearly all occur in a second
text, inside windows that share a signature: 41 of 46 at the least. So the shingles of all grouped
windows are counted, and a window stays open only if its minimum lies in 46 shingles of
which 41 occur in several texts. That loses no pair, and texts that share a phrase and
nothing around it are not compared at all. At first all windows of a group are compared with
a few of them, its heads. A window is closed once a verified passage of its text covers the
minimum that put it into the group. For those that stay open it is counted how many texts of
the group have each shingle around them. A window closes if no 46 shingles in a row have 41 that
others have; else any partner has one of the rarest, and if these are in few texts, the window is
compared with all of them, and is done. The others are compared with some of these texts, in each
next round with more, until they have met all. A window whose shingles repeat themselves asks, and is
compared with, the whole texts of its group, as far as they were cut out.
Else pairs are compared on the stretches their windows cover: a passage counts where
every ``least`` shingles in a row share enough with the other text for a similarity
of 0.8, on both sides.

Texts with equal word sequences are one text from the start, and repeat as a whole.

Cases: null, empty and short texts have no passages. An empty table has none. A very long text
is read whole; only the stretches to be compared, and half as much around them, leave it. Repeated rows are copies of each
other. Rows with a null id are grouped like others; their id is null in the result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqprep.llm.arrays import U64, chunks, flat, gather, mix, word_hashes
from seqprep.llm.bpe import binary
from seqprep.llm.shared import bit_filter, materialise, passes, quoted, small_batches, table

SHINGLE = 5
LEAST_WORDS = 50
SIMILARITY = 0.8
#: Hash functions; each makes signatures of its own.
HASHES = 4
#: Heads of a group in the first round, and how many times more texts a window may meet in each next one.
HEADS, GROWTH = 2, 8
FILTER_BITS = 1 << 23
#: How a shingle is named with a group: it is beside a text's window in that group, or anywhere beside windows.
NEAR, ANYWHERE = 62, 63
#: Texts that a task knows again as copies; later ones are dropped after the shuffle.
MOST_SEEN = 1 << 20
#: Longest run of subsequences in one window.
LONGEST_RUN = 1 << 12
#: Most bits of the filter of shingles that several texts have: 32 MB, whatever the input.
MOST_BITS = 1 << 28

#: Shingles of pairs that are compared at once, at least one pair's.
MOST_COMPARED = 1 << 19
#: Parts of the shingles by their first bits, each of them counted in one task.
PARTS = 1 << 10

Batches = Iterator[pa.RecordBatch]


def sequence(words: np.ndarray) -> np.ndarray:
    """The shingles of a text in order."""
    n = max(0, len(words) - SHINGLE + 1)
    weights = mix(np.arange(1, SHINGLE + 1, dtype=U64), 11) | U64(1)
    total = np.zeros(n, U64)
    for k in range(SHINGLE):
        total += words[k : k + n] * weights[k]
    return mix(total)


def text_nodes(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The signed 64-bit names of word sequences of one word or more."""
    if not len(first):
        return np.zeros(0, np.int64)
    at = gather(first, sizes)
    place = mix(np.arange(sizes.max(), dtype=U64), 91) | U64(1)
    total = np.add.reduceat(mix(words[at], 92) * place[at - np.repeat(first, sizes)], np.cumsum(sizes) - sizes)
    return mix(total ^ sizes.astype(U64) * U64(0xD1B54A32D192ED03)).view(np.int64)


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, U64)
    padded[:n] = values
    square = padded.reshape(blocks, width)
    up_to = np.minimum.accumulate(square, axis=1).ravel()
    from_on = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_on[: n - width + 1], up_to[width - 1 : n])


def signatures(shingles: np.ndarray, width: int, first: np.ndarray | None = None, sizes: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(signature, first, end, place of the minimum) of the runs of subsequences with equal minima.

    ``first`` and ``sizes`` say where the texts' shingles are, ``width`` of them or more each; else all are one text's.
    """
    if first is None or sizes is None:
        first, sizes = np.zeros(1, np.int64), np.array([len(shingles)])
    if not len(first):
        return np.zeros(0, U64), *[np.zeros(0, np.int64)] * 3
    many = sizes - width + 1
    at_all = gather(first, many)
    offset = at_all - np.repeat(first, many)
    out = []
    for k in range(HASHES):
        values = mix(shingles, 101 + k)
        low = sliding_minima(values, width)[at_all]
        # a run is cut now and then, so that its length has few bits
        begins = np.flatnonzero(np.append(True, low[1:] != low[:-1]) | (offset % LONGEST_RUN == 0))
        start = at_all[begins]
        inner = np.lib.stride_tricks.sliding_window_view(values, width)[start]
        at = start + np.argmax(inner == low[begins, None], axis=1)
        # a text begins a run, so no run reaches beyond its text
        end = at_all[np.append(begins[1:], len(low)) - 1] + width
        out.append((mix(low[begins], 200 + k), start, end, at))
    return tuple(np.concatenate(x) for x in zip(*out))


def _texts(batches: Batches, least: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, words, first word and number of words of each text, the texts with ``least`` words)."""
    for batch in batches:
        for part in chunks(batch, "text"):
            words, first = word_hashes(*flat(part.column("text")))
            sizes = np.diff(first)
            yield part, words, first[:-1], sizes, np.flatnonzero(sizes >= least)


class _Once:
    """Which texts come for the first time in a task, as far as ``MOST_SEEN`` texts go."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, nodes: np.ndarray) -> np.ndarray:
        new = []
        for i, node in enumerate(nodes.tolist()):
            if node not in self.seen:
                new.append(i)
                if len(self.seen) < MOST_SEEN:
                    self.seen.add(node)
        return np.array(new, np.int64)


def _describing(least: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for part, words, first, sizes, long in _texts(batches, least):
            nodes = np.zeros(len(sizes), np.int64)
            nodes[long] = text_nodes(words, first[long], sizes[long])
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(nodes, pa.int64(), mask=sizes < least), pa.array(sizes.astype(np.int64))],
                ["key", "node", "n_words"],
            )

    return run


def _windowing(least: int) -> Callable[[Batches], Batches]:
    """(sig, node, place): the stretches of shingles and their minima, each text once a task.

    ``place`` packs the first shingle, the length and the minimum's distance from the first.
    """
    width = least - SHINGLE + 1

    def run(batches: Batches) -> Batches:
        once = _Once()
        for _, words, first, sizes, long in _texts(batches, least):
            nodes = text_nodes(words, first[long], sizes[long])
            new = once(nodes)
            if len(new):
                starts = first[long[new]]
                sig, lo, hi, at = signatures(sequence(words), width, starts, sizes[long[new]] - SHINGLE + 1)
                text = np.searchsorted(starts, lo, side="right") - 1
                place = lo - starts[text] | (hi - lo) << 32 | (at - lo) << 48
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (sig.view(np.int64), nodes[new][text], place)], ["sig", "node", "place"])

    return run


def _sequences(least: int, bits) -> Callable[[Batches], Batches]:
    """(node, shingles as 32-bit numbers) of the texts that pass the filter, once a task."""

    def run(batches: Batches) -> Batches:
        once = _Once()
        for _, words, first, sizes, long in _texts(batches, least):
            nodes = text_nodes(words, first[long], sizes[long])
            asked = np.flatnonzero(passes(bits.value, nodes, FILTER_BITS))
            new = asked[once(nodes[asked])]
            if len(new):
                many = sizes[long[new]] - SHINGLE + 1
                kept = (sequence(words)[gather(first[long[new]], many)] >> U64(32)).astype(np.uint32)
                ends = np.append(0, np.cumsum(many)) * 4
                yield pa.RecordBatch.from_arrays([pa.array(nodes[new]), binary(kept.view(np.uint8), ends)], ["node", "seq"])

    return run


def passages(
    own: np.ndarray, first: np.ndarray, other: np.ndarray, other_first: np.ndarray, width: int, needed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, lo, hi): where each ``width`` shingles of a pair's ``own`` have ``needed`` in common with its ``other``.

    ``first`` and ``other_first`` say where the pairs' shingles begin, and where the last ones end.
    """

    def named(shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(ends) - 1, dtype=U64) << U64(32), np.diff(ends)) | shingles

    mine, theirs = named(own, first), np.sort(named(other, other_first))
    common = own != 0
    if len(theirs):
        common &= theirs[np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)] == mine
    else:
        common[:] = False
    dense = dense_places(common, first, width, needed)
    pair = np.searchsorted(first, dense, side="right") - 1
    if not len(dense):
        return pair, dense, dense
    breaks = np.flatnonzero((np.diff(dense) > width) | (np.diff(pair) > 0))
    begins, ends = np.append(0, breaks + 1), np.append(breaks, len(dense) - 1)
    hits = np.flatnonzero(common)
    lo = hits[np.searchsorted(hits, dense[begins])]
    hi = hits[np.searchsorted(hits, dense[ends] + width) - 1] + 1
    pair = pair[begins]
    return pair, lo - first[pair], hi - first[pair]


def dense_places(marked: np.ndarray, first: np.ndarray, width: int, needed: int) -> np.ndarray:
    """Where ``width`` places of a text with ``needed`` marked ones begin; ``first`` as in ``passages``."""
    sums = np.append(0, np.cumsum(marked))
    inside = gather(first[:-1], np.maximum(np.diff(first) - width + 1, 0))
    return inside[sums[inside + width] - sums[inside] >= needed]


def _verifying(least: int, similarity: float) -> Callable[[Batches], Batches]:
    """(node, other, lo, hi) in words, for both texts of each pair."""
    width = least - SHINGLE + 1
    needed = needed_of(width, similarity)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            (own, ends), (theirs, their_ends) = (shingles_of(batch.column(c)) for c in ("own", "theirs"))
            x, y, lo, ylo = (batch.column(c).to_numpy() for c in ("x", "y", "lo", "ylo"))
            out = []
            # some pairs at a time, however long their stretches are
            for part in _parts(ends[1:] + their_ends[1:]) if len(batch) else ():
                a, b = part[0], part[-1] + 1
                mine = own[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
                others = theirs[their_ends[a] : their_ends[b]], their_ends[a : b + 1] - their_ends[a]
                of, *spans = passages(*mine, *others, width, needed)
                their_of, *their_spans = passages(*others, *mine, width, needed)
                for node, other, at, pair, (start, end), met in (
                    (x, y, lo, of + a, spans, np.isin(of, their_of)),
                    (y, x, ylo, their_of + a, their_spans, np.isin(their_of, of)),
                ):
                    pair = pair[met]
                    out.append((node[pair], other[pair], start[met] + at[pair], end[met] + at[pair] + SHINGLE - 1))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["node", "other", "lo", "hi"]
                )

    return run


def shingles_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit shingles, offsets) of a binary column."""
    data, ends = flat(column)
    return data.view(np.uint32), ends // 4


def needed_of(width: int, similarity: float) -> int:
    """How many of ``width`` shingles two passages of that similarity have in common."""
    return int(np.ceil(2 * similarity * width / (1 + similarity) - 1e-9))


def _spans(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """The union of some stretches."""
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    first = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    return list(zip(lo[first].tolist(), reach[np.append(first[1:], len(lo)) - 1].tolist()))


HELD = (
    "node long, cut binary, starts array<int>, froms array<int>, windows array<struct<sig:bigint,lo:int,hi:int,at:int>>"
)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ``HELD``, the windows as arrays of sig, lo, hi and at."""

    def lists(parts: list[np.ndarray], values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in parts])).astype(np.int32)), values)

    node, cut, starts, froms, sig, lo, hi, at = zip(*rows)
    columns = [pa.array(np.concatenate(x)) for x in (sig, lo, hi, at)]
    windows = pa.StructArray.from_arrays(columns, ["sig", "lo", "hi", "at"])
    ends = np.append(0, np.cumsum([len(x) for x in cut])) * 4
    return pa.RecordBatch.from_arrays(
        [
            pa.array(node, pa.int64()),
            binary(np.concatenate(cut).view(np.uint8), ends),
            *(lists(x, pa.array(np.concatenate(x))) for x in (starts, froms)),
            lists(sig, windows),
        ],
        ["node", "cut", "starts", "froms", "windows"],
    )


def _cutting(around: int) -> Callable[[Batches], Batches]:
    """Rows of ``HELD``: of each text the stretches of its windows and ``around`` shingles beside them.

    Zeros part the stretches; ``starts`` are their places in ``cut``, ``froms`` those in the text.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            seq, windows = batch.column("seq"), batch.column("windows")
            ends = windows.offsets.to_numpy()
            sigs, places = (windows.values.field(c).to_numpy() for c in ("sig", "place"))
            for i, node in enumerate(batch.column("node").to_pylist()):
                own = np.maximum(np.frombuffer(seq[i].as_buffer(), np.uint32), 1)  # zero is no shingle
                sig, place = sigs[ends[i] : ends[i + 1]], places[ends[i] : ends[i + 1]]
                lo = place & 0xFFFFFFFF
                hi, at = lo + (place >> 32 & 0xFFFF), lo + (place >> 48)
                spans = _spans(np.maximum(lo - around, 0), np.minimum(hi + around, len(own)))
                froms = np.array([a for a, _ in spans])
                sizes = np.array([b - a for a, b in spans])
                starts = np.cumsum(sizes + around) - sizes - around
                cut = np.zeros(int(starts[-1] + sizes[-1]), np.uint32)
                for to, (a, b) in zip(starts.tolist(), spans):
                    cut[to : to + b - a] = own[a:b]
                shift = (starts - froms)[np.searchsorted(froms, lo, side="right") - 1]
                rows.append(
                    (node, cut, *((x).astype(np.int32) for x in (starts, froms)), sig, *((x + shift).astype(np.int32) for x in (lo, hi, at)))
                )
            if rows:
                yield _packed(rows)

    return run


def _covered(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """(shingles of all texts, where the texts begin, windows with their places among all shingles) of rows of ``HELD``."""
    seq, first = shingles_of(batch.column("cut"))
    windows = batch.column("windows")
    shift = np.repeat(first[:-1], np.diff(windows.offsets.to_numpy()))
    values = windows.flatten()
    return seq, first, {c: values.field(c).to_numpy() + shift for c in ("lo", "hi", "at")}


def _union(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places some stretches cover."""
    return np.cumsum(np.bincount(lo, minlength=n + 1) - np.bincount(hi, minlength=n + 1))[:n] > 0


def _shingles(batches: Batches) -> Batches:
    """(part, shingles): the shingles of all windows in order, each once for a text but at most twice a batch."""
    for batch in batches:
        seq, first, at = _covered(batch)
        places = np.flatnonzero(_union(at["lo"], at["hi"], len(seq)))
        text = np.repeat(np.arange(len(first) - 1, dtype=U64), np.diff(first))[places]
        # a shingle and a text as one number
        found = (np.unique(seq[places].astype(U64) << U64(32) | text) >> U64(32)).astype(np.uint32)
        found = found[np.append([True, True], found[2:] != found[:-2])[: len(found)]]
        part = found // np.uint32((1 << 32) // PARTS)
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
        ends = np.append(begins, len(found)) * 4
        yield pa.RecordBatch.from_arrays([pa.array(part[begins].astype(np.int32)), binary(found.view(np.uint8), ends)], ["part", "shingles"])


def _repeated(batches: Batches) -> Batches:
    """The shingles that come twice or more, of all rows of the task."""
    found = [shingles_of(batch.column("shingles"))[0] for batch in batches]
    if found:
        found = np.sort(np.concatenate(found))
        again = np.unique(found[1:][found[1:] == found[:-1]])
        for a in range(0, len(again), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(again[a : a + (1 << 16)].astype(np.int64))], ["shingle"])


def _answered(bits, n_bits: int, width: int, needed: int) -> Callable[[Batches], Batches]:
    """Rows of ``HELD`` with the windows whose minimum lies in ``width`` shingles of which ``needed`` occur in several texts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            seq, first, at = _covered(batch)
            again = passes(bits.value, seq.astype(np.int64), n_bits) & (seq != 0)
            dense = dense_places(again, first, width, needed)
            stays = _union(dense, dense + width, len(seq))[at["at"]]
            windows = batch.column("windows")
            of = np.repeat(np.arange(len(batch)), np.diff(windows.offsets.to_numpy()))
            many = np.bincount(of[stays], minlength=len(batch))
            lists = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), windows.flatten().filter(pa.array(stays))
            )
            kept = pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], batch.schema.names)
            yield kept.filter(pa.array(many > 0))

    return run


def _sequences_of(texts: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """(node, seq) of the given nodes' texts and, by chance, of some more."""
    bits = texts.sparkSession.sparkContext.broadcast(bit_filter(nodes, "node", FILTER_BITS))
    return texts.mapInArrow(_sequences(least, bits), "node long, seq binary").dropDuplicates(["node"])


def _in_groups(rows: DataFrame) -> DataFrame:
    """The windows whose signature another text has as well."""
    group = Window.partitionBy("sig")
    return (
        rows.withColumn("least", F.min("node").over(group))
        .withColumn("most", F.max("node").over(group))
        .where("least <> most")
        .drop("least", "most")
    )


def _pruned(held: DataFrame, least: int, similarity: float) -> DataFrame:
    """``held`` without windows that cannot be part of any repeated passage.

    Of the shingles of a repeated passage nearly all occur in a second text, inside a window
    that shares a signature with it. So texts that share a common phrase, and nothing else
    around it, are never compared, however many they are.
    """
    width = least - SHINGLE + 1
    repeated = materialise(
        held.mapInArrow(_shingles, "part int, shingles binary").repartition("part").mapInArrow(_repeated, "shingle long")
    )
    n_bits = min(max(1 << 20, 1 << (8 * repeated.count()).bit_length()), MOST_BITS)
    bits = held.sparkSession.sparkContext.broadcast(bit_filter(repeated, "shingle", n_bits))
    return held.mapInArrow(_answered(bits, n_bits, width, needed_of(width, similarity)), HELD)


def _in_texts(found: DataFrame, held: DataFrame) -> DataFrame:
    """``found`` with the places in the whole texts."""
    spans = held.select("node", "starts", "froms")
    of = F.size(F.filter("starts", lambda x: x <= F.col("lo"))) - 1
    shift = F.get("froms", of) - F.get("starts", of)
    return found.join(spans, "node").select(
        "node", "other", (F.col("lo") + shift).alias("lo"), (F.col("hi") + shift).alias("hi")
    )


def _with_heads(active: DataFrame) -> DataFrame:
    """``active`` with a mark on the heads of each group, and on the windows that will have met the whole group."""
    order = Window.partitionBy("sig").orderBy(F.xxhash64("node", F.lit(0)), "node", "lo", "hi")
    met = F.expr("head") | (F.count(F.lit(1)).over(Window.partitionBy("sig")) <= HEADS)
    return active.withColumn("head", F.row_number().over(order) <= HEADS).withColumn("met", met)


def _pairs(placed: DataFrame, around: int) -> DataFrame:
    """(x, y, lo, hi, ylo, yhi): the groups' open windows with the groups' heads, once each.

    ``around`` shingles on both sides come along, so that a passage is seen to its ends.
    """
    group = Window.partitionBy("sig")
    heads = F.collect_list(F.when(F.col("head"), F.struct("node", "lo", "hi", "open"))).over(group)
    met = (
        placed.withColumn("heads", heads)
        .where("open")
        .select("node", "lo", "hi", "head", F.explode("heads").alias("y"))
        .where("y.node <> node AND NOT (head AND y.open AND node < y.node)")
    )
    return _hulls(met.selectExpr("node AS x", "y.node AS y", "lo", "hi", "y.lo AS ylo", "y.hi AS yhi"), around)


def _hulls(met: DataFrame, around: int) -> DataFrame:
    """The pairs of ``met`` once each, with ``around`` shingles on both sides."""
    return (
        met.groupBy("x", "y")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("ylo").alias("ylo"), F.max("yhi").alias("yhi"))
        .select(
            "x",
            "y",
            *[F.greatest(F.col(c) - around, F.lit(0)).alias(c) for c in ("lo", "ylo")],
            *[(F.col(c) + around).alias(c) for c in ("hi", "yhi")],
        )
    )


def _compare(seqs: DataFrame, pairs: DataFrame, least: int, similarity: float) -> DataFrame:
    """The verified passages of ``pairs``."""

    def cut(lo: str, hi: str):
        return F.expr(f"substring(seq, cast({lo} * 4 + 1 as int), cast(({hi} - {lo}) * 4 as int))")

    # a text that many others are compared with is sent once, over all its stretches
    heads = pairs.groupBy("y").agg(F.min("ylo").alias("ylo"), F.max("yhi").alias("yhi"))
    theirs = seqs.join(heads, F.col("node") == F.col("y")).select("y", "ylo", cut("ylo", "yhi").alias("theirs"))
    own = seqs.join(pairs.select("x", "y", "lo", "hi"), F.col("node") == F.col("x")).select("x", "y", "lo", cut("lo", "hi").alias("own"))
    return own.join(theirs, "y").mapInArrow(_verifying(least, similarity), "node long, other long, lo long, hi long")


def _merged(spans: DataFrame) -> DataFrame:
    """(node, lo, hi, other): spans that touch each other as one, with the first one's other."""
    before = Window.partitionBy("node").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    return (
        spans.groupBy("node", "lo", "hi")
        .agg(F.min("other").alias("other"))
        .withColumn("reach", F.max("hi").over(before))
        .withColumn("new", F.expr("int(reach IS NULL OR lo > reach)"))
        .withColumn("run", F.sum("new").over(Window.partitionBy("node").orderBy("lo", "hi")))
        .groupBy("node", "run")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min_by("other", F.struct("lo", "hi")).alias("other"))
    )


def _left_open(placed: DataFrame, found: DataFrame) -> DataFrame:
    """The groups that still have open windows."""
    held = _merged(found).select(F.col("node").alias("held"), F.col("lo").alias("from"), F.col("hi").alias("to"))
    covered = F.expr(f"node = held AND `from` <= at AND at + {SHINGLE} <= `to`")
    return (
        placed.join(held, covered, "left")
        .withColumn("open", F.expr("open AND NOT met AND held IS NULL"))
        .withColumn("any", F.max("open").over(Window.partitionBy("sig")))
        .where("any")
        .select("sig", "node", "lo", "hi", "at", "open")
    )


class _Windows:
    """The texts of a batch of (node, seq, windows) and their windows, with places among the shingles of all texts."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        self.seq, first = shingles_of(batch.column("seq"))
        windows = batch.column("windows")
        self.text = np.repeat(np.arange(len(batch)), np.diff(windows.offsets.to_numpy()))
        self.node = batch.column("node").to_numpy()[self.text]
        values = windows.flatten()
        self.sig, self.lo, self.hi, self.at, self.open = (
            values.field(c).to_numpy(zero_copy_only=False) for c in ("sig", "lo", "hi", "at", "open")
        )
        self.first, self.end = first[self.text], first[self.text + 1]
        # ``width`` shingles beside a window belong to it
        self.near = np.maximum(self.lo - width, 0) + self.first
        self.far = np.minimum(self.hi + width + self.first, self.end)


def _named(sig: np.ndarray, shingles: np.ndarray, seed: int) -> np.ndarray:
    """Shingles together with their groups; zeros, which part the stretches, as all texts of a group."""
    return mix(sig.view(U64) ^ mix(shingles.astype(U64), 61), seed)


#: The bits of a broadcast filter and their number.
Filter = tuple[Broadcast, int]


def _asked(w: _Windows, width: int, groups: Filter, named: Filter) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(window, key, whether the whole text is meant): the shingles that texts have in their groups, of those that ``named`` lets through.

    ``groups`` says in which groups a window repeats itself.
    """
    sizes = w.far - w.near

    def asked(keys: np.ndarray) -> np.ndarray:
        return passes(named[0].value, keys, named[1])

    def beside(of: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        row = np.repeat(of, sizes[of])
        keys = _named(w.sig[row], w.seq[gather(w.near[of], sizes[of])], seed)
        hits = np.flatnonzero(asked(keys))
        return row[hits], keys[hits]

    for of in _parts(np.cumsum(sizes)):
        yield *beside(of, NEAR), False
    every = _named(w.sig, np.zeros(len(w.sig)), ANYWHERE)
    marked = np.flatnonzero(passes(groups[0].value, every, groups[1]))
    for of in np.split(marked, np.flatnonzero(np.diff(w.text[marked])) + 1) if len(marked) else []:
        own = np.unique(w.seq[w.first[of[0]] : w.end[of[0]]])
        own = own[own != 0]
        if len(of) * len(own) > MOST_COMPARED:  # a long text names what its windows ask, and is compared without being asked
            hits = np.flatnonzero(asked(every[of]))
            yield of[hits], every[of[hits]], True
            for part in _parts(np.cumsum(sizes[of])):
                yield *beside(of[part], ANYWHERE), True
        else:
            row = np.repeat(of, len(own))
            keys = _named(w.sig[row], np.resize(own, len(row)), ANYWHERE)
            hits = np.flatnonzero(asked(keys))
            yield row[hits], keys[hits], True


def _parts(ends: np.ndarray) -> Iterator[np.ndarray]:
    """The numbers of some rows at a time, so that they hold about ``MOST_COMPARED``; ``ends`` sums up what they hold."""
    cuts = np.flatnonzero(np.diff(ends // MOST_COMPARED)) + 1
    return iter(np.split(np.arange(len(ends)), cuts))


def _counts(width: int, groups: Filter) -> Callable[[Batches], Batches]:
    """(key, n): how many texts of the batch have the shingles that pass the filter, each named with its group."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            w = _Windows(batch, width)
            found = [(keys, w.text[of]) for of, keys, _ in _asked(w, width, groups, groups)]
            keys, text = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((text, keys))
            keys, text = keys[order], text[order]
            new = np.append(True, (keys[1:] != keys[:-1]) | (text[1:] != text[:-1]))[: len(keys)]
            keys, n = np.unique(keys[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    return run


def _members(width: int, groups: Filter, named: Filter, most: int) -> Callable[[Batches], Batches]:
    """(key, turn, node, lo, hi): the texts that have the shingles that pass the filter, and the stretches to be compared.

    Only the first ``most`` of a key by turn are wanted, so no more of them leave a batch.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            w = _Windows(batch, width)
            found = []
            for of, keys, whole in _asked(w, width, groups, named):
                lo, hi = (np.zeros(len(of), np.int32), (w.end - w.first)[of].astype(np.int32)) if whole else (w.lo[of], w.hi[of])
                found.append((keys.view(np.int64), w.node[of], lo, hi))
            key, node, lo, hi = (np.concatenate(x) for x in zip(*found))
            turn = mix(node.view(U64), most).view(np.int64)
            order = np.lexsort((turn, key))
            key, turn, node, lo, hi = (x[order] for x in (key, turn, node, lo, hi))
            begins = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (turn[1:] != turn[:-1]))[: len(key)])
            if len(begins):
                lo, hi = np.minimum.reduceat(lo, begins), np.maximum.reduceat(hi, begins)
                key, turn, node = key[begins], turn[begins], node[begins]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                place = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
                columns = (pa.array(x[place < most]) for x in (key, turn, node, lo, hi))
                yield pa.RecordBatch.from_arrays(list(columns), ["key", "turn", "node", "lo", "hi"])

    return run


def _asking(width: int, needed: int) -> Callable[[Batches], Batches]:
    """(sig, node, at, lo, hi, place, key): the shingles that ``width`` shingles with the minimum among them can hold.

    A window that repeats itself asks whole texts, and is one. Place -1 is the key of texts too long to name their shingles for each group.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            w = _Windows(batch, width)
            for of in np.array_split(opened := np.flatnonzero(w.open), -(-len(opened) // 1000) or 1):
                places = (w.at + w.first)[of][:, None] + np.arange(1 - width, width)
                inside = (places >= w.first[of][:, None]) & (places < w.end[of][:, None])
                shingles = np.where(inside, w.seq[np.where(inside, places, 0)], 0) if len(of) else np.zeros(places.shape, np.uint32)
                again = np.array([repetitive(row, width, needed) for row in shingles], bool)
                sig = np.repeat(w.sig[of], 2 * width - 1).reshape(places.shape)
                keys = np.where(again[:, None], _named(sig, shingles, ANYWHERE), _named(sig, shingles, NEAR))
                window, place = np.nonzero(shingles)
                keys = np.append(keys[window, place], _named(w.sig[of[again]], np.zeros(again.sum()), ANYWHERE))
                place = np.append(place, np.full(again.sum(), -1)).astype(np.int32)
                lo = np.where(again, 0, w.lo[of]).astype(np.int32)
                hi = np.where(again, (w.end - w.first)[of], w.hi[of]).astype(np.int32)
                window = np.append(window, np.flatnonzero(again))
                row = of[window]
                columns = (w.sig[row], w.node[row], w.at[row], lo[window], hi[window], place, keys.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "node", "at", "lo", "hi", "place", "key"])

    return run


def rarest(others: np.ndarray, width: int, needed: int) -> np.ndarray:
    """Places of which any text that has ``needed`` of some ``width`` neighbours has one at least.

    ``others`` says how many other texts have each. Of any ``width`` neighbours, all but
    ``needed`` and one more are taken, those that no text has first, then the rarest.
    """
    rows = np.lib.stride_tricks.sliding_window_view(others, width)
    order = np.argsort(rows, axis=1, kind="stable")[:, : width - needed + 1]
    counts = np.take_along_axis(rows, order, axis=1)
    can = counts[:, -1] > 0  # else too many are in no other text
    taken = (order + np.arange(len(rows))[:, None])[can][counts[can] > 0]
    return np.unique(taken)


def repetitive(keys: np.ndarray, width: int, needed: int) -> bool:
    """Whether some ``width`` neighbours have fewer than ``needed`` different keys (0: all different)."""
    _, same = np.unique(keys, return_inverse=True)
    order = np.argsort(same, kind="stable")
    before = np.full(len(keys), -1)
    again = np.flatnonzero(same[order[1:]] == same[order[:-1]])
    before[order[again + 1]] = order[again]
    before[keys == 0] = -1
    rows = np.lib.stride_tricks.sliding_window_view(before, width)
    return bool(((rows < np.arange(len(rows))[:, None]).sum(axis=1) < needed).any())


def _choosing(width: int, needed: int, most: int) -> Callable[[Batches], Batches]:
    """(sig, node, at, lo, hi, key, cost): the keys of the rarest shingles of each window and the number of texts that have them.

    Of a window that costs more than ``most``, the rarest one only.
    """
    names = ["sig", "node", "at", "lo", "hi"]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            held = batch.column("held")
            ends = held.offsets.to_numpy()
            place, key, n = (held.values.field(c).to_numpy() for c in ("place", "key", "n"))
            of, keys, cost = [], [], []
            for i in range(len(batch)):
                own = np.arange(ends[i], ends[i + 1])
                long, own = own[place[own] < 0], own[place[own] >= 0]
                others, named = np.zeros(2 * width - 1, np.int64), np.zeros(2 * width - 1, np.int64)
                others[place[own]], named[place[own]] = n[own] - 1, key[own]
                taken = rarest(others, width, needed)
                taken = taken[np.unique(named[taken], return_index=True)[1]]  # a shingle that repeats itself counts once
                chosen = np.append(named[taken], key[long])
                texts = np.append(others[taken], n[long])
                price = texts.sum()
                if price > most:
                    chosen = chosen[[np.argmin(texts)]]
                of.append(np.full(len(chosen), i))
                keys.append(chosen)
                cost.append(np.full(len(chosen), price))
            if of:
                of = np.concatenate(of)
                columns = [batch.column(c).take(pa.array(of)) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *(pa.array(np.concatenate(x)) for x in (keys, cost))], [*names, "key", "cost"]
                )

    return run


def _by_rarest(active: DataFrame, seqs: DataFrame, width: int, needed: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(``active`` with fewer open windows, pairs of texts).

    A text that shares ``needed`` of ``width`` shingles with a window lacks few of them, so it
    has one at least of the rarest. Windows that no text of their group can complete are
    closed. Those whose rarest shingles are in ``most`` texts of the group at most are compared
    with these texts, and are closed as well; the others with about ``most`` of those that have the rarest.
    """
    spark = active.sparkSession
    windows = active.groupBy("node").agg(
        F.collect_list(F.struct("sig", "lo", "hi", "at", "open")).alias("windows"), F.min("sig").alias("group")
    )
    # texts of a group meet in a few tasks, and are counted there before the shuffle
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = materialise(
        seqs.join(windows, "node")
        .repartition(n_parts, F.col("group"), F.expr("pmod(xxhash64(node), 8)"))
        .select("node", "seq", "windows")
    )
    asked = texts.mapInArrow(_asking(width, needed), "sig long, node long, at int, lo int, hi int, place int, key long")

    def filtering(keys: DataFrame, n: int) -> Filter:
        n_bits = min(max(FILTER_BITS, 1 << (8 * n).bit_length()), MOST_BITS)
        return spark.sparkContext.broadcast(bit_filter(keys, "key", n_bits)), n_bits

    groups = filtering(asked, 2 * width * active.where("open").count())
    counted = texts.mapInArrow(_counts(width, groups), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    chosen = materialise(
        asked.join(counted, "key")
        .where("n > 1 OR place < 0")
        .groupBy("sig", "node", "at", "lo", "hi")
        .agg(F.collect_list(F.struct("place", "key", "n")).alias("held"))
        .mapInArrow(_choosing(width, needed, most), "sig long, node long, at int, lo int, hi int, key long, cost long")
    )
    # a key whose other texts are ``most`` has the window's own as well
    wanted = _members(width, groups, filtering(chosen, chosen.count()), most + 1)
    theirs = (
        texts.mapInArrow(wanted, "key long, turn long, node long, lo int, hi int")
        .join(chosen.select("key").distinct(), "key", "left_semi")
        .withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("turn")))
        .where(f"rank <= {most + 1}")
        .select("key", F.col("node").alias("y"), F.col("lo").alias("ylo"), F.col("hi").alias("yhi"))
    )
    # each pair once, the smaller text first
    swapped = {"x": ("node", "y"), "y": ("y", "node"), "lo": ("lo", "ylo"), "hi": ("hi", "yhi"), "ylo": ("ylo", "lo"), "yhi": ("yhi", "hi")}
    both = chosen.join(theirs, "key").where("node <> y")
    pairs = _hulls(both.select(*[F.expr(f"IF(node < y, {a}, {b})").alias(c) for c, (a, b) in swapped.items()]), width)
    still = chosen.where(f"cost > {most}").select("sig", "node", "at", F.lit(True).alias("still")).distinct()
    left = active.join(still, ["sig", "node", "at"], "left").withColumn("open", F.expr("open AND still IS NOT NULL"))
    return left.withColumn("met", F.lit(False)), pairs


def repeated_passages(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(key, start_word, end_word, other): passages of ``least`` words or more that another row has.

    ``other`` is the least key of a row with the passage that is not this one.
    """
    rows = small_batches(df).select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    texts = rows.select("text")
    described = materialise(rows.mapInArrow(_describing(least), f"key {kind}, node long, n_words long"))
    docs = described.where("node IS NOT NULL")
    classes = docs.groupBy("node").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"), F.max("n_words").alias("n_words"))
    width = least - SHINGLE + 1
    grouped = materialise(
        # most windows are in no group, so copies are dropped among the others
        _in_groups(texts.mapInArrow(_windowing(least), "sig long, node long, place long")).dropDuplicates(["sig", "node", "place"])
    )
    windows = grouped.groupBy("node").agg(F.collect_list(F.struct("sig", "place")).alias("windows"))
    whole = _sequences_of(texts, grouped.select("node").distinct(), least)
    held = materialise(whole.join(windows, "node").select("node", "seq", "windows").mapInArrow(_cutting(width), HELD))
    held = materialise(_pruned(held, least, similarity))
    seqs = held.select("node", F.col("cut").alias("seq"))
    active = materialise(_in_groups(held.select("node", F.inline("windows"))).withColumn("open", F.lit(True)))
    needed = needed_of(width, similarity)
    placed = _with_heads(active)
    found = materialise(_compare(seqs, materialise(_pairs(placed, width)), least, similarity))
    active = materialise(_left_open(placed, found))
    most = HEADS
    while not active.isEmpty():
        most *= GROWTH
        left, pairs = _by_rarest(active, seqs, width, needed, most)
        found = found.union(materialise(_compare(seqs, materialise(pairs), least, similarity)))
        active = materialise(_left_open(left, found))
    copies = classes.where("copies > 1").select(
        "node", F.col("node").alias("other"), F.lit(0).cast("long").alias("lo"), F.col("n_words").alias("hi")
    )
    runs = _merged(_in_texts(found, held).union(copies))
    # within a class of copies the other row is the class's first or, for that one, the next
    seconds = docs.join(classes.select("node", "first"), "node").where("key <> first").groupBy("node").agg(F.min("key").alias("second"))
    named = runs.join(classes.select(F.col("node").alias("other"), F.col("first").alias("other_key")), "other")
    return (
        docs.join(named, "node")
        .join(seconds, "node", "left")
        .select(
            F.col("key").alias(key),
            F.col("lo").alias("start_word"),
            F.col("hi").alias("end_word"),
            F.when(F.col("other_key") == F.col("key"), F.col("second")).otherwise(F.col("other_key")).alias("other"),
        )
    )


# --- query ---------------------------------------------------------------------------


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more of ``documents`` that other documents repeat."""
    found = repeated_passages(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("other", "other_doc_id")
