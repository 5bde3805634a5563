"""Periodic runs of words by a sparse dynamic programme over diagonals.

Diagonal d of a text pairs every word with the one d words before it. Its match length grows
by one where the two words are the same and falls to zero where they are not; a run of
period d and length m + d ends where a diagonal of match length m does. Few of all pairs
can matter, as a run needs m >= d: a diagonal d from 2b to 4b is first looked at in steps of
b words. A block of b words (b a power of two) that begins at a multiple of b is looked up
among the earlier occurrences of the same b words, at most 4b words back; each occurrence
makes its diagonal's match length grow by a block, and a diagonal whose next block does not
match has ended. Those that can have sufficient length get their ends word by word: by
halving steps, as the words of both sides are compared over b/2, b/4, ... 1 words. Diagonals
below 16 are followed word by word from the start. So a text of n words costs n log n, also
one that repeats a single word throughout. All texts of a chunk go together, as arrays.

The period of a stretch is its smallest: of diagonals with the same stretch the least one
stays. Words are compared as numbers that stand for their bytes exactly; blocks by hashes, and
each run found is compared word by word.

Cases: a null or empty text, or one of white space, has no words and no runs. An empty table gives
an empty result. Repeated rows have the same result each. Runs may overlap or contain each other; ties
are the caller's. A very long text is a chunk of its own; its arrays hold about 8 bytes for each
word and level, some 200 bytes a word for a million words. Columns of the input may have
any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.arrays import U64, chunks, flat, gather, mix, slice_classes, word_spans
from seqprep.llm.shared import beside_text, fields, kept, table

#: Shortest run, in words; and how often a period has to fit into it.
LEAST, TIMES = 12, 2
#: Diagonals below this are followed word by word.
DENSE = 16
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"

Stretches = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _dense(words: np.ndarray, pos: np.ndarray, lags: range) -> Stretches:
    """(first word, length, lag) of the stretches on some short diagonals."""
    out = []
    for d in lags:
        at = np.flatnonzero(words[d:] == words[:-d]) + d
        at = at[pos[at] >= d]
        if not len(at):
            continue
        opens = np.flatnonzero(np.append(True, at[1:] != at[:-1] + 1))
        size = np.diff(np.append(opens, len(at)))
        long = (size >= (TIMES - 1) * d) & (size + d >= LEAST)
        start = at[opens[long]] - d
        out.append((start, size[long] + d, np.full(len(start), d)))
    return out


class Levels:
    """Hashes of the stretches of 1, 2, 4, ... words that begin at each word."""

    def __init__(self, words: np.ndarray):
        self.found = [mix(words.astype(U64), 21)]

    def __call__(self, level: int) -> np.ndarray:
        while len(self.found) <= level:
            last, half = self.found[-1], 1 << len(self.found) - 1
            new = np.zeros(len(last), U64)
            new[: len(last) - half] = mix((mix(last[: len(last) - half], 22) + last[half:]), 23)
            self.found.append(new)
        return self.found[level]


def _blocks(hashes: np.ndarray, at: np.ndarray, text: np.ndarray, pos: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, lag) of the blocks that occur again 2b to 4b - 1 words before. ``at``: all places of b words."""
    key = mix(hashes[at] ^ mix(text[at].astype(U64), 24), 25)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    group = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
    place, wide = at[order], int(at[-1]) + 1 if len(at) else 1
    ranked = group * wide + place  # ascending
    ask = np.flatnonzero(pos[place] % b == 0)
    low = np.searchsorted(ranked, group[ask] * wide + np.maximum(place[ask] - 4 * b + 1, 0))
    high = np.searchsorted(ranked, group[ask] * wide + np.maximum(place[ask] - 2 * b + 1, 0))
    block = np.repeat(place[ask], high - low)
    return block, block - place[gather(low, high - low)]


def _sparse(words: np.ndarray, pos: np.ndarray, left: np.ndarray, text: np.ndarray) -> Stretches:
    """(first word, length, lag) of the stretches on the diagonals from ``DENSE`` on.

    ``pos``: words before a word in its text, ``left``: words from it to the end.
    """
    out, levels, level = [], Levels(words), (DENSE // 2).bit_length() - 1
    total = pos + left
    while True:
        b = 1 << level
        at = np.flatnonzero((total >= TIMES * 2 * b) & (left >= b))
        if not len(at):
            return out
        block, lag = _blocks(levels(level), at, text, pos, b)
        order = np.lexsort((block, lag))
        block, lag = block[order], lag[order]
        opens = np.flatnonzero(np.append(True, (lag[1:] != lag[:-1]) | (block[1:] != block[:-1] + b))[: len(block)])
        first, lag = block[opens], lag[opens]
        last = first + np.diff(np.append(opens, len(block))) * b
        near = last - first + 2 * (b - 1) >= (TIMES - 1) * lag
        first, last, lag = first[near], last[near], lag[near]
        for k in range(level - 1, -1, -1):
            step, same = 1 << k, levels(k)
            back = pos[np.maximum(first - 1, 0)] + 1
            ok = np.flatnonzero((pos[first] >= step + lag) & (back >= step))
            ok = ok[same[first[ok] - step] == same[first[ok] - step - lag[ok]]]
            first[ok] -= step
            end = np.minimum(last, len(words) - 1)
            ok = np.flatnonzero((last < len(words)) & (text[end] == text[first]) & (left[end] >= step))
            ok = ok[same[last[ok]] == same[last[ok] - lag[ok]]]
            last[ok] += step
        long = (last - first >= (TIMES - 1) * lag) & (last - first + lag >= LEAST)
        out.append((first[long] - lag[long], (last - first + lag)[long], lag[long]))
        level += 1


def runs_of(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, length, period) of all runs, by text, first word and period.

    ``words``: numbers of the words of all texts; ``first``: the first word of each text.
    """
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(words)) - first[:-1][text]
    found = _dense(words, pos, range(1, DENSE)) + _sparse(words, pos, sizes[text] - pos, text)
    start, length, period = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in range(3))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[: len(start)]
    start, length, period = start[new], length[new], period[new]
    sure = [
        np.array_equal(words[s + p : s + n], words[s : s + n - p])
        for s, n, p in zip(start.tolist(), length.tolist(), period.tolist())
    ]
    start, length, period = start[sure], length[sure], period[sure]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    owner = text[start] if len(start) else np.zeros(0, np.int64)
    return owner, start - first[owner], length, period


def collapsed(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, stays: np.ndarray) -> pa.Array:
    """The words that stay of each text, joined by one space."""
    before = np.append(0, np.cumsum(stays))[first]
    size = (end - start)[stays]
    to = np.cumsum(size + 1) - size - 1
    bytes_out = np.full(int(size.sum()) + len(size), 32, np.uint8)
    bytes_out[gather(to, size)] = data[gather(start[stays], size)]
    ends = np.append(to, len(bytes_out))
    # a text's last space goes
    opens, closes = ends[before[:-1]], np.maximum(ends[before[1:]] - 1, ends[before[:-1]])
    held = closes - opens
    packed = bytes_out[gather(opens, held)]
    offsets = np.append(0, np.cumsum(held))
    kind, width = (pa.string(), np.int32) if len(packed) < 1 << 31 else (pa.large_string(), np.int64)
    return pa.Array.from_buffers(kind, len(held), [None, pa.py_buffer(offsets.astype(width)), pa.py_buffer(packed)])


def _finding(hold_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                data, offsets = flat(part.column("text"))
                start, end, first = word_spans(data, offsets)
                _, words = slice_classes(data, start, end)
                text, at, length, period = runs_of(words, first)
                # a word goes if it lies behind the first period of any run
                change = np.zeros(len(start) + 1, np.int64)
                np.add.at(change, first[text] + at + period, 1)
                np.add.at(change, first[text] + at + length, -1)
                stays = np.cumsum(change)[:-1] == 0
                ends = pa.array(np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32))
                runs = pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in (at, length, period)], ["start", "length", "period"])
                held = kept(part, hold_text)
                yield pa.RecordBatch.from_arrays(
                    [
                        *held.columns,
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.ListArray.from_arrays(ends, runs),
                        collapsed(data, start, end, first, stays),
                    ],
                    [*held.schema.names, "n_words", "runs", "collapsed"],
                )

    return run


def periodic_runs(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """(``keep``, n_words, runs, collapsed) of every row.

    ``runs``: (start, length, period) of each run in words, by start, then period.
    ``collapsed``: the text's words without those behind the first period of any run.
    """
    rows = beside_text(df, keep, text)
    kind = fields(rows, text in keep, "n_words long", f"runs {RUN}", "collapsed string")
    return rows.mapInArrow(_finding(text in keep), kind).toDF(*keep, "n_words", "runs", "collapsed")


# --- query ---------------------------------------------------------------------------


def damaged(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the ids get their words with a repeated stretch from some word on.

    What each word's place is looked up in stands in columns, computed once a row.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(crc % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)")))
    rows = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), chosen.alias("words"))
    rows = rows.withColumn("a", F.when(F.size("words") > 0, F.pmod("g", F.size("words")).cast("int")))
    rows = rows.withColumn("p", (F.lit(1) + F.floor((F.size("words") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    place = lambda i: F.col("a") + F.pmod(i - F.col("a"), F.col("p"))
    repeated = F.transform("words", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("words", place(i))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every whole text of ``documents``, after the query's repeats."""
    docs = table(spark, sf_dir, "documents")
    found = periodic_runs(damaged(docs), ["doc_id"])
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # greatest length first, then least start, then least period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    ranked = found.withColumn("best", best)
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return ranked.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
