"""Language ID by a bit-sliced Bloom filter: a slot holds one bit for every language.

The n-grams are every letter with its two neighbours and every whole word, in lower
case. An n-gram belongs to the languages in which it is not much rarer than in the
language where it is most frequent. Its k slots get those languages' bits, so that a
text's n-gram is looked up once for all languages: the AND of k slots. A language's
hits, less what its share of set bits makes by chance, decide.

The filter has a fixed size. It is learnt from a bounded sample: about
``per_language`` labelled texts of each language, chosen by a hash of their content.

Cases: a text that is null or has no letter is ``und`` with score 0, as is every text
if no language was learnt. Texts without a label are predicted, not learnt from. Ties
go to the language first in order. Repeated rows each get a result. Very long texts
are read whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.llm.arrays import U64, SliceHash, chunks, edges, flat, mix
from seqprep.llm.bpe import LETTER, classes
from seqprep.llm.shared import beside_text, fields, kept, materialise, quoted, table

#: Slots of the filter and slots of an n-gram.
SLOTS = 1 << 20
HASHES = 3
#: Texts of a language that are learnt from, and texts that must hold an n-gram.
PER_LANGUAGE = 2000
LEAST_TEXTS = 3
#: An n-gram belongs to a language where its rate is at least this share of its highest.
SHARE = 0.25
UNKNOWN = "und"

Batches = Iterator[pa.RecordBatch]


@lru_cache(maxsize=1)
def lower_case() -> np.ndarray:
    """Every code point in lower case, where that is one code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and chr(c).isupper() and len(low := chr(c).lower()) == 1:
            out[c] = ord(low)
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every n-gram of the texts of a chunk."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    cuts = before[offsets]
    letter = classes()[points] == LETTER
    start, end = edges(letter, cuts)
    low = lower_case()[points].astype(U64)
    at = np.flatnonzero(letter)
    if not len(at):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    left = np.append(U64(0), low[:-1])
    left[start] = 0
    right = np.append(low[1:], U64(0))
    right[end - 1] = 0
    three = mix((left[at] << U64(42)) | (low[at] << U64(21)) | right[at], 51)
    words = mix(SliceHash(low.astype("<u4").view(np.uint8))(4 * start, 4 * end), 53)
    owner = np.searchsorted(cuts, np.append(at, start), side="right") - 1
    return np.append(three, words), owner


def _counting() -> Callable[[Batches], Batches]:
    """(gram, label, rows, n) of the sample, summed over each chunk."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in chunks(batch, "text"):
                hashes, owner = grams(*flat(part.column("text")))
                labels = part.column("label").to_numpy(zero_copy_only=False)[owner]
                # once for each text, then over the texts of a label
                each = mix(hashes ^ mix(owner.astype(U64), 71))
                _, first, times = np.unique(each, return_index=True, return_counts=True)
                of, label = hashes[first], labels[first]
                pair = mix(of ^ mix(label.astype(U64), 72))
                _, one, place = np.unique(pair, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(of[one].view(np.int64)),
                        pa.array(label[one].astype(np.int32)),
                        pa.array(np.bincount(place, minlength=len(one)).astype(np.int64)),
                        pa.array(np.bincount(place, weights=times, minlength=len(one)).astype(np.int64)),
                    ],
                    ["gram", "label", "rows", "n"],
                )

    return run


class Filter:
    """The bit-sliced filter: for each slot the languages as bits of one or more words."""

    def __init__(self, languages: list[str], bits: np.ndarray):
        self.languages = languages
        self.bits = bits
        fill = np.array([np.mean((bits[:, i // 64] >> U64(i % 64)) & U64(1)) for i in range(len(languages))])
        self.chance = fill**HASHES

    def held(self, hashes: np.ndarray) -> np.ndarray:
        """The languages of each n-gram, as bits."""
        found = self.bits[(hashes & U64(SLOTS - 1)).astype(np.int64)]
        for k in range(1, HASHES):
            found = found & self.bits[(mix(hashes, 60 + k) & U64(SLOTS - 1)).astype(np.int64)]
        return found

    def shares(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams of each text, share of them in each language corrected for chance)."""
        total = np.bincount(owner, minlength=n)
        found = self.held(hashes)
        hits = np.stack(
            [
                np.bincount(owner, weights=(found[:, i // 64] >> U64(i % 64)) & U64(1), minlength=n)
                for i in range(len(self.languages))
            ],
            axis=1,
        )
        share = hits / np.maximum(total, 1)[:, None]
        return total, np.clip((share - self.chance) / (1 - np.minimum(self.chance, 0.999)), 0, 1)


def learn(df: DataFrame, text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE) -> Filter:
    """The filter of the labelled rows of ``df``.

    To the driver come one row for each language and one for each slot that is set.
    """
    rows = df.select(F.col(quoted(text)).alias("text"), F.col(quoted(label)).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()
    languages = [r.lang for r in sizes]
    if not languages:
        return Filter([], np.zeros((SLOTS, 1), U64))
    spark = df.sparkSession
    known = spark.createDataFrame(
        [(r.lang, i, per_language / r.n) for i, r in enumerate(sizes)], "lang string, label int, part double"
    )
    dice = (F.xxhash64("text").bitwiseAND(0xFFFFFFFF)) / float(1 << 32)
    sample = rows.join(F.broadcast(known), "lang").where(dice < F.col("part")).select("text", "label")
    counts = materialise(
        sample.mapInArrow(_counting(), "gram long, label int, rows long, n long")
        .groupBy("gram", "label")
        .agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"))
    )
    totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
    rated = counts.join(F.broadcast(totals), "label").withColumn("rate", F.col("n") / F.col("total"))
    top = rated.groupBy("gram").agg(
        F.max("rate").alias("top"), F.collect_list(F.struct("label", "rate", "rows")).alias("each")
    )
    kept = top.select(
        "gram",
        F.filter("each", lambda x: (x["rate"] >= SHARE * F.col("top")) & (x["rows"] >= LEAST_TEXTS))["label"].alias("labels"),
    ).where(F.size("labels") > 0)
    placed = kept.mapInArrow(_placing(len(languages)), "slot int, word int, mask long")
    slots = placed.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toPandas()
    bits = np.zeros((SLOTS, -(-len(languages) // 64)), U64)
    bits[slots["slot"], slots["word"]] = slots["mask"].to_numpy(np.int64).view(U64)
    return Filter(languages, bits)


def _placing(languages: int) -> Callable[[Batches], Batches]:
    """The slots of every n-gram with its languages' bits, merged over each batch."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            grams = batch.column("gram").to_numpy().view(U64)
            lists = batch.column("labels")
            owner = np.repeat(np.arange(len(grams)), pc.list_value_length(lists).to_numpy())
            labels = lists.flatten().to_numpy()
            slot = np.stack(
                [(grams if k == 0 else mix(grams, 60 + k)) & U64(SLOTS - 1) for k in range(HASHES)], axis=1
            )[owner].astype(np.int64)
            for word in range(-(-languages // 64)):
                mine = labels // 64 == word
                masks = np.zeros(SLOTS, U64)
                np.bitwise_or.at(
                    masks, slot[mine].ravel(), np.repeat(U64(1) << (labels[mine] % 64).astype(U64), HASHES)
                )
                hit = np.flatnonzero(masks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hit.astype(np.int32)),
                        pa.array(np.full(len(hit), word, np.int32)),
                        pa.array(masks[hit].view(np.int64)),
                    ],
                    ["slot", "word", "mask"],
                )

    return run


def _predicting(model, hold_text: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        learnt: Filter = model.value
        names = np.array([*learnt.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in chunks(batch, "text"):
                n = part.num_rows
                best, score, fit = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n)
                hashes, owner = grams(*flat(part.column("text")))
                if learnt.languages and len(hashes):
                    total, share = learnt.shares(hashes, owner, n)
                    some = total > 0
                    best[some] = share[some].argmax(axis=1)
                    fit[some] = share[some].max(axis=1)
                    # the best share against the next one: even shares give a half
                    rest = np.sort(share, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(n)
                    score[some] = ((fit + 1e-3) / (fit + rest + 2e-3))[some]
                held = kept(part, hold_text)
                yield pa.RecordBatch.from_arrays(
                    [*held.columns, pa.array(names[best], pa.string()), pa.array(score), pa.array(fit)],
                    [*held.schema.names, "lang_pred", "score", "fit"],
                )
                del part, held  # a batch goes before the next one comes
            del batch

    return run


def predict(df: DataFrame, model: Filter, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep``, ``lang_pred``, ``score`` (best against next language, 0 to 1)
    and ``fit`` (share of the text's n-grams that the language holds)."""
    rows = beside_text(df, keep, text)
    shared = df.sparkSession.sparkContext.broadcast(model)
    more = ["lang_pred", "score", "fit"]
    kind = fields(rows, text in keep, "lang_pred string", "score double", "fit double")
    return rows.mapInArrow(_predicting(shared, text in keep), kind).toDF(*keep, *more)


def fold(key: str = "doc_id") -> Column:
    """The remainder by which rows are held out: those with 2."""
    return F.crc32(F.col(quoted(key)).cast("string").cast("binary")) % 4


# --- query ---------------------------------------------------------------------------


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``, learnt from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(fold() != 2))
    marked = docs.select("doc_id", "text", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"))
    return predict(marked, model, ["doc_id", "held_out"])
