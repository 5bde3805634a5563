"""Byte-level BPE encoding and decoding over whole texts.

The pre-tokeniser uses no regular expression. Every code point gets a class (letter,
number, white space, other); a text is then a string of classes. The pattern's
automaton has only two kinds of transition per code point: keep the state, or set it
to a value that does not depend on what it was. Such functions compose associatively
to "the last one that set it", so a running maximum over positions gives the state at
every code point, for all texts of a chunk at once. Pieces of equal bytes are merged once,
all new ones of a chunk together, behind a bounded cache, and gathered for all places.

Cases: a null or empty text has no ids. Repeated rows and keys are encoded each. An
empty table gives none. A very long text is a chunk of its own: about 80 bytes of arrays
for each of its bytes at the peak, and n log n for a piece without bound. Only the named columns are read; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.arrays import U64, chunks, flat, gather, mix, slice_classes
from seqprep.llm.shared import beside_text, fields, kept, quoted, table

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: What may follow an apostrophe as one piece.
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]
#: Pieces of a generation of the cache; a worker keeps two.
CACHE_PIECES = 50_000
#: Stands for a pair that makes up no token.
NO_PAIR = 1 << 30
#: From this length on a piece is merged with a heap.
LONG_PIECE = 48


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    # all code points but the surrogates, which are no text
    every = np.delete(np.arange(0x110000, dtype="<u4"), np.s_[0xD800:0xE000]).tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            a, b = (x + 0x800 * (x >= 0xD800) for x in found.span())
            out[a:b] = kind
    return out


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids of a rank file: base64 and id on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def piece_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Positions where a piece begins. ``firsts``: the first code point of each text."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    at = np.arange(n)
    kind = classes()[points]
    head = np.zeros(n + 1, bool)
    head[firsts] = True
    head[n] = True
    tail = head[1:]  # the last code point of a text
    turn = head[:n].copy()
    turn[1:] |= kind[1:] != kind[:-1]
    run = np.maximum.accumulate(np.where(turn, at, 0))  # where the run of this class began
    space = kind == SPACE
    blank = points == 32
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~head[:n]
    begins = turn & (space | ~after_blank)
    # the last white space before other text stands apart from those before it
    ends_run = np.append(turn[1:], True)
    begins |= space & ends_run & ~tail
    # apostrophe and suffix: one piece, whatever letters follow
    lone = (points == 39) & turn & ends_run & ~tail & ~after_blank
    place = np.flatnonzero(lone)
    if len(place):
        text_end = np.append(firsts[1:], n)
        limit = text_end[np.searchsorted(firsts, place, side="right") - 1]
        done = np.zeros(len(place), bool)
        padded = np.append(points, [0, 0, 0])
        for suffix in SUFFIXES:
            fits = ~done & (place + len(suffix) < limit)
            for k, letter in enumerate(suffix):
                fits &= padded[place + 1 + k] == ord(letter)
            done |= fits
            begins[place[fits] + 1] = False
            after = place[fits] + 1 + len(suffix)
            begins[after[after < n]] = True
    return np.flatnonzero(begins)


class Pairs:
    """The rank of every pair of tokens that make up a token: an open hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := ranks.get(token[:k])) is not None and (right := ranks.get(token[k:])) is not None
        ]
        pairs, values = np.array(found, np.int64).reshape(-1, 2).T
        self.bits = max(8, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NO_PAIR, np.int64)
        slot, todo = self.slots(pairs), np.arange(len(pairs))
        while len(todo):
            free = self.keys[slot[todo]] < 0
            self.keys[slot[todo[free]]] = pairs[todo[free]]  # of several, one stays
            held = self.keys[slot[todo]] == pairs[todo]
            self.values[slot[todo[held]]] = values[todo[held]]
            todo = todo[~held]
            slot[todo] = (slot[todo] + 1) & (1 << self.bits) - 1

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        return (mix(pairs.view(U64)) >> U64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        slot = self.slots(pairs)
        out = self.values[slot]
        todo = np.flatnonzero((self.keys[slot] != pairs) & (self.keys[slot] >= 0))
        out[self.keys[slot] != pairs] = NO_PAIR
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (1 << self.bits) - 1
            key = self.keys[slot[todo]]
            hit = key == pairs[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (key >= 0)]
        return out


def merge_all(pieces: list[bytes], letters: np.ndarray, pairs: Pairs) -> list[bytes]:
    """The packed ids of each piece: in each, the leftmost pair of least rank is merged first.

    A round merges one pair in every piece that has one, and drops the finished pieces.
    ``letters`` holds the id of each byte.
    """
    out = [b""] * len(pieces)
    which = np.array([i for i, x in enumerate(pieces) if x], np.int64)
    ids = letters[np.frombuffer(b"".join(pieces), np.uint8)]
    starts = np.cumsum([0, *(len(pieces[i]) for i in which.tolist())])[:-1]
    rank = np.append(pairs(ids[:-1], ids[1:]), NO_PAIR)
    rank[starts[1:] - 1] = NO_PAIR
    while len(which):
        ends = np.append(starts[1:], len(ids))
        least = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), starts)
        going = least >> 32 < NO_PAIR
        packed = ids.astype("<u4").tobytes()
        for i, a, b in zip(which[~going].tolist(), (4 * starts[~going]).tolist(), (4 * ends[~going]).tolist()):
            out[i] = packed[a:b]
        at = least[going] & (1 << 32) - 1
        ids[at] = least[going] >> 32
        keep = np.repeat(going, ends - starts)
        keep[at + 1] = False
        last = at + 2 == ends[going]
        opening = at == starts[going]
        shift = np.cumsum(keep) - 1
        at, starts, which = shift[at], shift[starts[going]], which[going]
        ids, rank = ids[keep], rank[keep]
        rank[at[last]] = NO_PAIR
        place = at[~last]
        rank[place] = pairs(ids[place], ids[place + 1])
        place = at[~opening]
        rank[place - 1] = pairs(ids[place - 1], ids[place])
    return out


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece in n log n: a heap of pairs over a linked list of parts."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it is merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Ranks and merged pieces of one worker process, for all its tasks.

    The cache has two generations: a piece met again moves to the younger one, and when
    that is full the older one goes. It holds at most twice ``CACHE_PIECES`` pieces.
    """

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        self.pairs = Pairs(self.ranks)
        self.letters = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of each piece."""
        found = list(map(self.young.get, pieces))
        missed = [i for i, x in enumerate(found) if x is None]
        short = []
        for i in missed:
            if (again := self.old.get(pieces[i])) is not None:
                found[i] = again
            elif (whole := self.ranks.get(pieces[i])) is not None:
                found[i] = whole.to_bytes(4, "little")
            elif len(pieces[i]) >= LONG_PIECE:
                found[i] = np.array(merge_long(pieces[i], self.ranks), "<u4").tobytes()
            else:
                short.append(i)
        merged = merge_all([pieces[i] for i in short], self.letters, self.pairs)
        for i, ids in zip(short, merged):
            found[i] = ids
        if len(self.young) + len(missed) > CACHE_PIECES:
            self.young, self.old = {}, self.young
        for i in missed:
            if len(pieces[i]) < LONG_PIECE:
                self.young[pieces[i]] = found[i]
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids before each text)."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        heads = (data & 0xC0) != 0x80
        before = np.append(0, np.cumsum(heads))
        where = np.append(np.flatnonzero(heads), len(data))  # byte of each code point
        firsts = before[offsets[:-1]]
        starts = where[piece_starts(points, np.unique(firsts[firsts < len(points)]))]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        one, place = slice_classes(data, starts, ends)
        raw = data.tobytes()
        merged = self.ids([raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())])
        sizes = np.fromiter(map(len, merged), np.int64, len(merged)) // 4
        pool = np.frombuffer(b"".join(merged), "<u4")
        base = np.cumsum(sizes) - sizes
        ids = pool[gather(base[place], sizes[place])]
        so_far = np.append(0, np.cumsum(sizes[place]))
        return ids, so_far[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process, so that its cache outlives a task."""
    return Encoder(path)


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Slices of bytes as an Arrow binary column."""
    kind = pa.binary() if len(data) < 1 << 31 else pa.large_binary()
    ends = offsets.astype(np.int32 if len(data) < 1 << 31 else np.int64)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _encoding(path: str, hold_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, ends = encoder.encode(*flat(part.column("text")))
                packed = binary(ids.astype("<u4").view(np.uint8), ends * 4)
                held = kept(part, hold_text)
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(np.diff(ends)), packed], [*held.schema.names, "n_tokens", "ids"]
                )
                del part, held, packed  # a batch goes before the next one comes
            del batch

    return run


def encode(df: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``n_tokens`` and ``ids``: little-endian unsigned 32-bit numbers.

    ``path`` is a rank file that every worker can read. Each match of the pattern is
    encoded apart, without special tokens.
    """
    rows = beside_text(df, keep, text)
    kind = fields(rows, text in keep, "n_tokens long", "ids binary")
    return rows.mapInArrow(_encoding(path, text in keep), kind).toDF(*keep, "n_tokens", "ids")


def _decoding(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        pool = np.frombuffer(b"".join(tokens), np.uint8)
        sizes = np.array([len(x) for x in tokens], np.int64)
        starts = np.cumsum(sizes) - sizes
        for batch in batches:
            for part in chunks(batch, "ids"):
                raw, offsets = flat(part.column("ids"))
                ids = np.frombuffer(raw.tobytes(), "<u4").astype(np.int64)
                ends = np.append(0, np.cumsum(sizes[ids]))
                data = pool[gather(starts[ids], sizes[ids])]
                names = part.schema.names
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, binary(data, ends[offsets // 4])], [*names, "decoded"]
                )

    return run


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with the bytes that its packed ``ids`` stand for, as ``decoded``."""
    others = [c for c in df.columns if c != ids]
    rows = df.select(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(others)], F.col(quoted(ids)).alias("ids"))
    kind = fields(rows, True, "decoded binary")
    return rows.mapInArrow(_decoding(path), kind).toDF(*others, ids, "decoded")


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- query ---------------------------------------------------------------------------


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again."""
    path = default_ranks()
    docs = table(spark, sf_dir, "documents")
    return decode(encode(docs, path, ["doc_id"]), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
