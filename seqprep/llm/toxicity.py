"""Toxicity by the nearest labelled examples: exact TF-IDF cosine, weighted votes.

The examples are a bounded sample of the labelled texts, each label sampled apart and
each text taken once, however many copies it has. Their vectors hold the terms (words,
and the first four and five letters of longer words) that mark toxic examples off from
the others: all terms that pass a ratio and a likelihood-ratio test, however many those
are. Other terms count neither in the product nor in the norm; with them neighbours go
by subject and are much worse (README).

The examples' vectors form an inverted index: posting lists in blocks of examples. For each
term and block the largest weight is kept, so a block whose bound is below the k-th
best cosine so far is passed over, and the neighbours found are exactly the nearest.

The neighbours vote with the square of their cosine, times the number of texts that an
example of their label stands for, beside a prior vote. Votes are turned into scores by
isotonic regression over the examples' own votes, each without itself. The neighbours
are returned as evidence.

Cases: a text that is null, empty or without any of the terms has no neighbours; its
score is the share of toxic ones among such examples. Very long texts count whole. Without
labelled examples every score is 0, and an empty table has an empty result. Examples with
several labels count as toxic if one says so, under their least id; null labels are passed
over. Ties between neighbours go to the example first in the index, ties in the sample
are cut by a 128-bit hash of the text. Repeated rows each get a score. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.arrays import U64, SliceHash, chunks, edges, flat, mix
from seqprep.llm.bpe import LETTER, classes
from seqprep.llm.language import fold, lower_case
from seqprep.llm.shared import beside_text, fields, kept, materialise, quoted, table

#: Labelled texts that are learnt from at most, half of them for each label.
EXAMPLES = 8_000
#: A term must be in this many toxic examples, be so many times more frequent among
#: them, and reach this likelihood ratio (G squared of its fourfold table).
LEAST_TEXTS = 3
LEAST_RATIO = 4.0
LEAST_G = 20.0
NEIGHBOURS = 15
BLOCK = 64
#: Weight of the prior vote.
PRIOR = 0.25
#: Lengths of the word beginnings that are terms.
STEMS = (4, 5)

Batches = Iterator[pa.RecordBatch]


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every term of the texts of a chunk."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    cuts = before[offsets]
    start, end = edges(classes()[points] == LETTER, cuts)
    if not len(start):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    hashed = SliceHash(lower_case()[points].astype("<u4").view(np.uint8))
    owner = np.searchsorted(cuts, start, side="right") - 1
    hashes, owners = [mix(hashed(4 * start, 4 * end), 80)], [owner]
    for n in STEMS:
        long = end - start > n
        s = start[long]
        hashes.append(mix(hashed(4 * s, 4 * (s + n)), 80 + n))
        owners.append(owner[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _counting() -> Callable[[Batches], Batches]:
    """(term, toxic texts, other texts) over each chunk."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in chunks(batch, "text"):
                hashes, owner = terms_of(*flat(part.column("text")))
                label = part.column("label").to_numpy()
                _, first = np.unique(mix(hashes ^ mix(owner.astype(U64), 71)), return_index=True)
                terms, place = np.unique(hashes[first], return_inverse=True)
                toxic = np.bincount(place, weights=label[owner[first]], minlength=len(terms)).astype(np.int64)
                every = np.bincount(place, minlength=len(terms))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(terms.view(np.int64)), pa.array(toxic), pa.array(every - toxic)], ["term", "toxic", "other"]
                )

    return run


class Vectors:
    """Turns texts into unit TF-IDF vectors over the chosen terms."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray):
        order = np.argsort(terms)
        self.terms, self.idf = terms[order], idf[order]
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.terms & U64(0xFFFF)).astype(np.int64)] = True

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first entry of each text, term, weight)."""
        n = len(offsets) - 1
        hashes, owner = terms_of(data, offsets)
        maybe = self.gate[(hashes & U64(0xFFFF)).astype(np.int64)] if len(self.terms) else np.zeros(len(hashes), bool)
        hashes, owner = hashes[maybe], owner[maybe]
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == hashes if len(self.terms) else maybe[:0]
        cell, times = np.unique(owner[known] * max(1, len(self.terms)) + at[known], return_counts=True)
        text, term = np.divmod(cell, max(1, len(self.terms)))
        weight = (1 + np.log(times)) * self.idf[term]
        norm = np.sqrt(np.bincount(text, weights=weight * weight, minlength=n))
        return np.searchsorted(text, np.arange(n + 1)), term, weight / np.maximum(norm[text], 1e-300)


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers from each start to its end, which range each is of)."""
    count = end - start
    which = np.repeat(np.arange(len(count)), count)
    return np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + start[which], which


class Index:
    """Posting lists of the examples' vectors, in blocks with the largest weight of each term.

    A posting is an example and its weight. The postings of a term stand by example; those
    of one block of examples are an entry. ``entry`` holds each term's first entry,
    ``post`` each entry's first posting.
    """

    def __init__(self, first: np.ndarray, term: np.ndarray, weight: np.ndarray, label: np.ndarray, ids: np.ndarray, terms: int):
        some = np.flatnonzero(np.diff(first) > 0)
        # examples with the same heaviest term share blocks, which makes the bounds tight
        heaviest = np.array([term[first[i] : first[i + 1]][weight[first[i] : first[i + 1]].argmax()] for i in some], np.int64)
        some = some[np.argsort(heaviest, kind="stable")]
        self.order, self.label, self.ids = some, label[some].astype(float), ids[some]
        self.blocks = -(-len(some) // BLOCK)
        at, row = ranges(first[some], first[some + 1])
        by = np.lexsort((row, term[at]))
        at, self.row = at[by], row[by]
        self.weight = weight[at]
        cell = term[at] * max(1, self.blocks) + self.row // BLOCK
        entries, start = np.unique(cell, return_index=True)
        self.post = np.append(start, len(cell))
        self.block = entries % max(1, self.blocks)
        self.most = np.maximum.reduceat(self.weight, start) if len(start) else np.zeros(0)
        self.entry = np.searchsorted(entries, np.arange(terms + 1) * max(1, self.blocks))

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the ``k`` nearest examples with a cosine above 0."""
        entry, which = ranges(self.entry[term], self.entry[term + 1])
        asked, block = weight[which], self.block[entry]
        # a little more than the sum, as sums of the same numbers differ in their last digits
        bound = np.bincount(block, asked * self.most[entry], minlength=self.blocks) * (1 + 1e-9)
        by = np.argsort(-bound, kind="stable")
        by = by[: np.count_nonzero(bound > 0)]
        place = np.empty(self.blocks, np.int64)
        place[by] = np.arange(len(by))
        turn = np.argsort(place[block], kind="stable")
        entry, asked = entry[turn], asked[turn]
        cut = np.searchsorted(place[block][turn], np.arange(len(by) + 1))
        rows, values = np.zeros(0, np.int64), np.zeros(0)
        done, many = 0, 2
        while done < len(by) and not (len(rows) == k and bound[by[done]] < values[-1]):
            upto = min(done + many, len(by))
            these = slice(cut[done], cut[upto])
            post, of = ranges(self.post[entry[these]], self.post[entry[these] + 1])
            hit, place_ = np.unique(self.row[post], return_inverse=True)
            cosine = np.bincount(place_, self.weight[post] * asked[these][of], minlength=len(hit))
            other = hit != without
            rows, values = np.append(rows, hit[other]), np.append(values, cosine[other])
            best = np.lexsort((rows, -values))[:k]
            rows, values = rows[best], values[best]
            done, many = upto, 2 * many
        return rows, values


class Model:
    """Vectors, index and calibration. ``share`` is how many texts an example of either label stands for."""

    def __init__(self, vectors: Vectors, index: Index, base: float, prior: float, share: np.ndarray):
        self.vectors, self.index, self.base, self.prior = vectors, index, base, prior
        self.share = share[index.label.astype(np.int64)]
        self.at, self.value = np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        power = cosines * cosines * self.share[rows]
        return float((power @ self.index.label[rows] + PRIOR * self.prior) / (power.sum() + PRIOR))

    def calibrate(self, votes: np.ndarray, label: np.ndarray) -> None:
        """Isotonic regression of the label on the vote: pool adjacent violators."""
        if not len(votes):
            return
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []
        for vote, y, n in zip(votes[order], label[order], self.share[order]):
            pools.append([vote, y * n, n])
            while len(pools) > 1 and (pools[-1][0] == pools[-2][0] or pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]):
                vote_, y_, n_ = pools.pop()
                pools[-1] = [(pools[-1][0] * pools[-1][2] + vote_ * n_) / (pools[-1][2] + n_), pools[-1][1] + y_, pools[-1][2] + n_]
        # half a count each way keeps scores off 0 and 1; the vote itself breaks ties
        self.at = np.array([p[0] for p in pools])
        self.value = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])

    def score(self, vote: float) -> float:
        return float(0.99 * np.interp(vote, self.at, self.value) + 0.01 * vote)


def text_hash(text: str) -> list[Column]:
    """128 bits of a text; a null one is empty."""
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    return [F.xxhash64(whole).alias("h"), F.xxhash64(F.lit(1), whole).alias("g")]


def examples_of(
    df: DataFrame, text: str, label: str, name: str, labels: DataFrame | None, most: int
) -> tuple[DataFrame, dict[int, int]]:
    """((text, label, id) of at most ``most`` texts, half for each label; different texts of each label).

    Until the texts are picked only hashes are shuffled, and copies are counted once.
    """
    rows = df.select(
        *text_hash(text),
        F.col(quoted(name)).cast("long").alias("id"),
        *([] if labels is not None else [F.col(quoted(label)).alias("mark")]),
    )
    if labels is not None:
        marks = labels.select(F.col(quoted(name)).cast("long").alias("id"), F.col(quoted(label)).alias("mark"))
        rows = rows.join(marks.groupBy("id").agg(F.max("mark").alias("mark")), "id")
    texts = materialise(
        rows.where("mark IS NOT NULL")
        .groupBy("h", "g")
        .agg(F.max((F.col("mark") > 0).cast("int")).alias("label"), F.min("id").alias("id"))
    )
    sizes = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picks = [texts.where(F.col("label") == y).orderBy("h", "g").limit(most // 2) for y in (0, 1)]
    picked = F.broadcast(materialise(picks[0].unionByName(picks[1])))
    found = df.select(F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"), *text_hash(text))
    sample = found.join(picked, ["h", "g"]).groupBy("h", "g", "label", "id").agg(F.min("text").alias("text"))
    return materialise(sample.drop("h", "g")), sizes


def g_squared(toxic: int, other: int) -> Column:
    """The likelihood ratio of columns ``toxic`` and ``other`` out of so many examples."""
    a, b, n = F.col("toxic"), F.col("other"), max(1, toxic + other)

    def part(x: Column, of: Column, share: float) -> Column:
        return F.when(x > 0, x * F.log(x / (of * share))).otherwise(0.0)

    held, lacking = a + b, F.lit(toxic + other) - a - b
    yes, no = toxic / n, other / n
    return 2 * (part(a, held, yes) + part(b, held, no) + part(toxic - a, lacking, yes) + part(other - b, lacking, no))


def learn(
    df: DataFrame,
    text: str = "text",
    label: str = "toxic",
    name: str = "doc_id",
    examples: int = EXAMPLES,
    labels: DataFrame | None = None,
) -> Model:
    """A model from labelled rows, or from texts and a table of labels with the same ids.

    The driver gets at most ``examples`` sparse vectors and their terms.
    """
    sample, sizes = examples_of(df, text, label, name, labels, examples)
    toxic, other = (min(sizes.get(y, 0), examples // 2) for y in (1, 0))
    share = np.array([sizes.get(0, 0) / max(1, other), sizes.get(1, 0) / max(1, toxic)])
    ratio = ((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("other") + 0.5) / (other + 1))
    chosen = (
        sample.mapInArrow(_counting(), "term long, toxic long, other long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= LEAST_TEXTS) & (ratio >= LEAST_RATIO) & (g_squared(toxic, other) >= LEAST_G))
        .toPandas()
    )
    held = (chosen["toxic"] + chosen["other"]).to_numpy(float)
    vectors = Vectors(chosen["term"].to_numpy(np.int64).view(U64), np.log((1 + toxic + other) / (1 + held)) + 1)
    shared = df.sparkSession.sparkContext.broadcast(vectors)
    got = sample.mapInArrow(_vectorising(shared), "id long, label int, term array<int>, weight array<double>").toPandas()
    got = got.sort_values(["id", "label"], na_position="last", kind="stable")
    count = np.array([len(t) for t in got["term"]], np.int64)
    first = np.append(0, np.cumsum(count))
    term = np.concatenate([*got["term"], np.zeros(0, np.int64)]).astype(np.int64)
    weight = np.concatenate([*got["weight"], np.zeros(0)])
    y = got["label"].to_numpy(float)
    ids = got["id"].fillna(-1).to_numpy(np.int64)
    blank = count == 0
    stands = share[y.astype(np.int64)]
    base, prior = (
        float(((y * stands)[some].sum() + 0.5) / (stands[some].sum() + 1)) if len(y) else 0.0 for some in (blank, ~blank)
    )
    model = Model(vectors, Index(first, term, weight, y, ids, len(vectors.terms)), base, prior, share)
    votes, kept = [], []
    for row, i in enumerate(model.index.order):
        found = model.index.nearest(term[first[i] : first[i + 1]], weight[first[i] : first[i + 1]], NEIGHBOURS, row)
        votes.append(model.vote(*found))
        kept.append(y[i])
    model.calibrate(np.array(votes), np.array(kept))
    return model


def _vectorising(shared) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in chunks(batch, "text"):
                first, term, weight = shared.value(*flat(part.column("text")))
                ends = pa.array(first.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("label"),
                        pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                    ],
                    ["id", "label", "term", "weight"],
                )

    return run


EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))


def _scoring(shared, hold_text: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        model: Model = shared.value
        index = model.index
        for batch in batches:
            for part in chunks(batch, "text"):
                first, term, weight = model.vectors(*flat(part.column("text")))
                scores, evidence = [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    rows, cosines = index.nearest(term[a:b], weight[a:b], NEIGHBOURS) if b > a else ((), ())
                    scores.append(model.score(model.vote(rows, cosines)) if len(rows) else model.base)
                    evidence.append(
                        [
                            {"doc_id": int(index.ids[r]), "cosine": float(c), "label": int(index.label[r])}
                            for r, c in zip(rows[:3], cosines[:3])
                        ]
                    )
                held = kept(part, hold_text)
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(scores, pa.float64()), pa.array(evidence, EVIDENCE)],
                    [*held.schema.names, "score", "evidence"],
                )

    return run


def score_toxicity(df: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``score`` and ``evidence``: the three nearest examples."""
    rows = beside_text(df, keep, text)
    shared = df.sparkSession.sparkContext.broadcast(model)
    evidence = "evidence array<struct<doc_id:long,cosine:double,label:int>>"
    kind = fields(rows, text in keep, "score double", evidence)
    return rows.mapInArrow(_scoring(shared, text in keep), kind).toDF(*keep, "score", "evidence")


# --- query ---------------------------------------------------------------------------


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every text of ``documents``, learnt from the labels of three folds of four."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold() != 2)
    marked = docs.select("doc_id", "text", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"))
    scored = score_toxicity(marked, learn(docs, labels=labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
