"""N-gram Jaccard self-join with filters under several global token orders.

A text's set holds the hashes of its word shingles. Two sets of similarity t or more
share k tokens among the first n - ceil(t n) + k tokens of each, whatever the global
order of tokens. So a pair is a candidate only if it shares that many prefix tokens
under each of several orders. Every order puts tokens that are frequent in the corpus
last, by its own scale, and orders equal ones by its own hash; how frequent a token is
comes from a sketch of fixed size over all texts, which affects speed, never the result.

Exact copies are one node from the start. A prefix token held by few nodes gives its
pairs, and the pairs of all orders are intersected. One held by many nodes, as in a
large group of near copies, is linked to its least node only, so rows stay linear.
The candidate graph's components are then verified exactly: every node's set is sent
once, to its component's task, and large components are cut into blocks whose pairs
are tasks of their own. Components of the verified links are the classes.

Cases: a null text, or one without words, has no shingles and links with nothing. A
text with fewer words than the width has its whole sequence as its one shingle.
Repeated rows are copies of each other. Rows with a null key are grouped like others;
a component of only such rows has no name (null). Extra columns are ignored.

Sets are told apart by 64-bit hashes, and tokens, where sets are verified, by 48 bits.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqprep.llm.arrays import chunks, flat, mix, shingles, word_hashes
from seqprep.llm.bpe import binary, gather
from seqprep.llm.graph import components
from seqprep.llm.shared import bit_filter, materialise, quoted, small, small_batches, table

U64 = np.uint64
#: Slots of the frequency sketch (one byte each) and slots in one of its blocks.
SKETCH = 1 << 25
BLOCK = 1 << 19
#: Token orders: the rank of each count (0 to 255) in the sketch. A hash of the order's
#: own decides between tokens of the same rank.
RANKS = [np.arange(256), np.floor(np.log2(np.maximum(np.arange(256), 1)))]
#: Prefix tokens that a candidate pair shares under each order.
SHARED = 5
#: A prefix token held by more nodes than this is linked as a star.
LIGHT = 12
#: Bytes of a token where sets are verified: its upper 48 bits.
TOKEN_BYTES = 6
#: Tokens in one verification block.
VERIFY_TOKENS = 2_000_000
#: Bits of the filter that spares texts outside the candidate graph a third pass.
FILTER_BITS = 1 << 23

Batches = Iterator[pa.RecordBatch]


def _sets(batches: Batches, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in chunks(batch, "text"):
            yield part, shingles(*word_hashes(*flat(part.column("text"))), width)


def node_of(tokens: np.ndarray) -> int:
    """The signed 64-bit name of a set."""
    total = mix(mix(tokens, 21).sum(dtype=U64, keepdims=True), len(tokens))
    return int(total.view(np.int64)[0])


def slots(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens, 31) & U64(SKETCH - 1)).astype(np.int64)


def _describing(width: int) -> Callable[[Batches], Batches]:
    """A row for each text, and at a task's end rows for the blocks of its sketch."""

    def rows(key: pa.Array, n: list, nodes: list) -> pa.RecordBatch:
        blank = [pa.nulls(len(n), t) for t in (pa.int32(), pa.int32(), pa.binary())]
        return pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), *blank], NAMES)

    def run(batches: Batches) -> Batches:
        counts = np.zeros(SKETCH, np.uint8)
        kind = None
        for part, sets in _sets(batches, width):
            hit, n = np.unique(slots(np.concatenate(sets)), return_counts=True)
            counts[hit] = np.minimum(counts[hit] + n, 255)
            kind = part.column("key").type
            yield rows(part.column("key"), [len(s) for s in sets], [node_of(s) if len(s) else None for s in sets])
        task = TaskContext.get().partitionId() % 64
        for i in range(SKETCH // BLOCK if kind is not None else 0):
            block = counts[i * BLOCK : (i + 1) * BLOCK]
            if block.any():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(1, kind),
                        pa.nulls(1, pa.int64()),
                        pa.nulls(1, pa.int64()),
                        pa.array([i], pa.int32()),
                        pa.array([task], pa.int32()),
                        pa.array([zlib.compress(block.tobytes(), 1)], pa.binary()),
                    ],
                    NAMES,
                )

    return run


NAMES = ["key", "n_shingles", "node", "block", "part", "packed"]


def _add_blocks(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, np.uint16)
    for packed in frame["packed"]:
        total = np.minimum(total + np.frombuffer(zlib.decompress(packed), np.uint8), 255).astype(np.uint16)
    done = zlib.compress(total.astype(np.uint8).tobytes(), 1)
    return pd.DataFrame({"block": frame["block"].iloc[:1], "part": 0, "packed": [done]})


def merged_sketch(parts: DataFrame) -> np.ndarray:
    """How many texts hold the tokens of each slot, at most 255; 32 MB at any input size."""
    kind = "block int, part int, packed binary"
    half = parts.groupBy("block", "part").applyInPandas(_add_blocks, kind)
    whole = half.groupBy("block").applyInPandas(_add_blocks, kind)
    counts = np.zeros(SKETCH, np.uint8)
    for row in whole.toLocalIterator():
        counts[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(row.packed), np.uint8)
    return counts


def _prefixes(width: int, percent: int, sketch) -> Callable[[Batches], Batches]:
    """(token, order, node, need) of the prefixes, each node once a task.

    ``need`` is how many prefix tokens a similar set shares at least. A set of n has
    t = ceil(percent n) tokens in common with such a set, and the first ``SHARED`` of
    them are among its first n - t + ``SHARED``.
    """

    def run(batches: Batches) -> Batches:
        counts = sketch.value
        seen: set[int] = set()
        ranks = [r.astype(U64) << U64(56) for r in RANKS]
        for _, sets in _sets(batches, width):
            tokens, nodes = [], []
            for s in sets:
                if not len(s) or (node := node_of(s)) in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add(node)
                n = len(s)
                common = -(-percent * n // 100)
                keep, need = min(n, n - common + SHARED), min(SHARED, common)
                held = counts[slots(s)]
                for order, rank in enumerate(ranks):
                    key = mix(s, 41 + order)
                    if keep < n:
                        key = key[np.argpartition(rank[held] | (key >> U64(8)), keep - 1)[:keep]]
                    tokens.append(key)
                    nodes.append((node, keep, order, need))
            if tokens:
                sizes = np.array([x[1] for x in nodes])
                columns = [np.array([x[i] for x in nodes], t) for i, t in ((2, np.int8), (0, np.int64), (3, np.int8))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), *(pa.array(np.repeat(c, sizes)) for c in columns)],
                    ["token", "ord", "node", "need"],
                )

    return run


def _set_rows(width: int, bits) -> Callable[[Batches], Batches]:
    """(node, n, tokens) of the texts whose node passes the filter, each node once a task."""

    def run(batches: Batches) -> Batches:
        table = bits.value
        seen: set[int] = set()
        for part, sets in _sets(batches, width):
            nodes, kept = [], []
            for s in sets:
                if len(s):
                    node = node_of(s)
                    at = node & (FILTER_BITS - 1)
                    if table[at >> 3] >> (at & 7) & 1 and node not in seen:
                        if len(seen) < 1 << 20:
                            seen.add(node)
                        nodes.append(node)
                        kept.append(s)
            if nodes:
                sizes = np.array([len(s) for s in kept], np.int64)
                high = np.concatenate(kept).view(np.uint8).reshape(-1, 8)[:, 2:]
                packed = binary(np.ascontiguousarray(high).ravel(), np.append(0, np.cumsum(sizes)) * TOKEN_BYTES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.array(sizes), packed], ["node", "n", "tokens"]
                )

    return run


def _linking(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links within a block, or between the two blocks of a pair, as (node, least, links).

    ``least`` is the least node of the node's component in this task. Shared tokens are
    counted through posting lists.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        cross = bool(frame["i"].iloc[0] != frame["j"].iloc[0])
        frame = frame.drop_duplicates("node").sort_values("node")
        nodes = frame["node"].to_numpy()
        side = frame["block"].to_numpy()
        if cross and side.min() == side.max():
            # the other block is empty, and this one's own links are another task's
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("node", "least", "links")})
        sets = frame["tokens"].to_numpy()
        sizes = np.array([len(s) // TOKEN_BYTES for s in sets])
        wide = np.zeros((sizes.sum(), 8), np.uint8)
        wide[:, 2:] = np.frombuffer(b"".join(sets), np.uint8).reshape(-1, TOKEN_BYTES)
        tokens = wide.view(U64).ravel()
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        ranked = tokens[order]
        new = np.append(True, ranked[1:] != ranked[:-1])
        first = np.flatnonzero(new)
        lengths = np.diff(np.append(first, len(ranked)))
        which = np.empty(len(tokens), np.int64)
        which[order] = np.cumsum(new) - 1
        posts = owner[order]
        ends = np.cumsum(sizes)
        parent = np.arange(len(sets))
        links = np.zeros(len(sets), np.int64)

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x in range(len(sets)):
            t = which[ends[x] - sizes[x] : ends[x]]
            t = t[lengths[t] > 1]
            if not len(t):
                continue
            near = posts[gather(first[t], lengths[t])]
            shared = np.bincount(near, minlength=len(sets))
            linked = 100 * shared >= percent * (sizes + sizes[x] - shared)
            linked[x] = False
            if cross:
                linked &= side != side[x]
            links[x] = linked.sum()
            for y in np.flatnonzero(linked[:x]):
                a, b = root(x), root(int(y))
                if a != b:
                    parent[max(a, b)] = min(a, b)
        least = np.array([nodes[root(x)] for x in range(len(sets))])
        keep = links > 0
        return pd.DataFrame({"node": nodes[keep], "least": least[keep], "links": links[keep]})

    return run


def candidates(texts: DataFrame, sketch: Broadcast, width: int, percent: int) -> DataFrame:
    """(u, v): pairs of nodes that pass every order, and stars of the heavy tokens.

    A pair passes an order if the light tokens it shares, and the heavy ones that it may
    share, are as many as it needs. One that shares heavy tokens only is in a star.
    """
    kind = "token long, ord byte, node long, need byte"
    one = Window.partitionBy("token")
    shared = materialise(
        texts.mapInArrow(_prefixes(width, percent, sketch), kind)
        .repartition("token")
        .dropDuplicates(["token", "node"])
        .withColumn("held", F.count(F.lit(1)).over(one))
        .where("held > 1")
        .withColumn("least", F.min("node").over(one))
    )
    orders = range(len(RANKS))
    heavy = shared.where(F.col("held") > LIGHT)
    hot = heavy.groupBy("node").agg(*[F.count_if(F.col("ord") == o).alias(f"hot{o}") for o in orders])
    # needs and heavy tokens in one number, four bits each: more than SHARED make no difference
    packed = F.col("need").cast("int")
    for o in orders:
        packed += F.least(F.coalesce(f"hot{o}", F.lit(0)), F.lit(15)).cast("int") * 16 ** (o + 1)
    side = F.struct("node", packed.alias("facts"))
    lists = (
        shared.where(F.col("held") <= LIGHT)
        .join(small(hot), "node", "left")
        .groupBy("token", "ord")
        .agg(F.sort_array(F.collect_list(side)).alias("nodes"))
    )
    pairs = lists.select("ord", "nodes", F.posexplode("nodes").alias("i", "u")).select(
        "ord", "u", F.explode(F.slice("nodes", F.col("i") + 2, LIGHT)).alias("v")
    )
    counted = pairs.groupBy("u", "v").agg(*[F.count_if(F.col("ord") == o).alias(f"n{o}") for o in orders])


    def fact(which: str, place: int) -> Column:
        return F.shiftright(f"{which}.facts", 4 * place).bitwiseAND(15)

    need = F.greatest(fact("u", 0), fact("v", 0))
    for o in orders:
        counted = counted.where(F.col(f"n{o}") + F.least(fact("u", o + 1), fact("v", o + 1)) >= need)
    kept = counted.select(F.col("u.node").alias("u"), F.col("v.node").alias("v"))
    stars = heavy.where("ord = 0 AND node <> least").select(F.col("least").alias("u"), F.col("node").alias("v"))
    return kept.union(stars).distinct()


def jaccard_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """(key, n_shingles, component_id, n_links) of every row.

    Sets link if 100 * intersection >= ``percent`` * union. ``component_id`` is the
    least key that links reach, ``n_links`` the number of different sets that the row's
    set links with.
    """
    if not 1 <= percent <= 100:
        raise ValueError("percent is from 1 to 100")
    texts = small_batches(df).select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    kind = texts.schema["key"].dataType.simpleString()
    only_text = texts.select("text")
    schema = f"key {kind}, n_shingles long, node long, block int, part int, packed binary"
    described = materialise(texts.mapInArrow(_describing(width), schema))
    rows = described.where("n_shingles IS NOT NULL").select("key", "n_shingles", "node")
    blocks = described.where("packed IS NOT NULL").select("block", "part", "packed")
    sketch = df.sparkSession.sparkContext.broadcast(merged_sketch(blocks))
    groups = materialise(components(candidates(only_text, sketch, width, percent)))
    bits = df.sparkSession.sparkContext.broadcast(bit_filter(groups, "node", FILTER_BITS))
    # a hot copy comes once a task
    sets = only_text.mapInArrow(_set_rows(width, bits), "node long, n long, tokens binary").dropDuplicates(["node"])
    sizes = rows.groupBy("node").agg(F.max("n_shingles").alias("n"))
    volume = groups.join(sizes, "node").groupBy("component").agg(F.sum("n").alias("volume"))
    parts = groups.join(volume, "component").withColumn(
        "blocks", F.ceil(F.col("volume") / VERIFY_TOKENS).cast("int")
    ).withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
    # each node goes to the pairs of its block with every block; one block is one pair
    placed = parts.select(
        "node", "component", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).select("node", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    found = materialise(
        sets.join(placed, "node")
        .groupBy("component", "i", "j")
        .applyInPandas(_linking(percent), "node long, least long, links long")
    )
    classes = components(found, "node", "least")
    linked = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    # a name for every class of nodes: the least key of its rows
    keys = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("key").alias("key"))
    named = keys.join(classes, "node", "left").select("node", "key", F.coalesce("component", "node").alias("class"))
    least = named.groupBy("class").agg(F.min("key").alias("component_id"))
    names = named.join(least, "class").join(linked, "node", "left").select("node", "component_id", "n_links")
    return rows.join(names, "node", "left").select(
        F.col("key").alias(key),
        "n_shingles",
        F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


# --- query ---------------------------------------------------------------------------


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of ``documents`` under four-word shingles and 85 per cent."""
    return jaccard_components(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct([array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)])) END AS g FROM d),
c AS (SELECT g, min(doc_id) AS node, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
e AS (SELECT node, n, unnest(g) AS t FROM c),
p AS (
  SELECT a.node AS u, b.node AS v FROM e a JOIN e b ON a.t = b.t AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r AS (SELECT node, node AS m FROM c UNION SELECT p.v, r.m FROM r JOIN p ON p.u = r.node),
k AS (SELECT node, min(m) AS component FROM r GROUP BY node),
l AS (SELECT u, count(*) AS n FROM p GROUP BY u)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, coalesce(k.component, s.doc_id) AS component_id,
  coalesce(l.n, 0)::BIGINT AS n_links
FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN k ON k.node = c.node LEFT JOIN l ON l.u = c.node
"""
