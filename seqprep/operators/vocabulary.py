"""From a vocabulary to a key table with one row per match key.

Matching rules, which are this package's own choice:

1. A key is ``lower(trim(text))``, or the text as it is with ``exact=True``.
2. The keys of a concept are its name and all its labels.
3. A name beats a label. A key that still points at several concepts matches
   none; ``ambiguous_keys`` lists those.
4. With ``languages``, labels of these languages count, and a key belongs to the first
   of them in which any concept has it; names come before all. A key that several
   concepts have in that language matches none.
5. Lineage runs from the root down and leaves out the concept itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqprep.operators.limits import LookupLimits, text_bytes
from seqprep.sources.tables import materialise
from seqprep.sources.vocabulary import Vocabulary


def match_key(text: Column, exact: bool = False) -> Column:
    return text if exact else F.lower(F.trim(text))


def concept_lineage(
    concepts: DataFrame, limits: LookupLimits = LookupLimits()
) -> DataFrame:
    """``(id, name, lineage)``: each concept with the names above it.

    Raises ``ValueError`` for missing or repeated ids, unknown parents and cycles.
    """
    return _lineage(concepts, limits)[0]


def _lineage(concepts: DataFrame, limits: LookupLimits) -> tuple[DataFrame, int, int]:
    """The lineage table, its rows and its text bytes.

    Every round doubles how far up all concepts have looked, by a join of the
    table with itself, so a tree of depth d takes about log2(d) rounds. Only
    counts reach the driver.
    """
    # up: the next ancestor to ask; lineage: the names between it and the concept.
    walk = concepts.select(
        "id",
        "name",
        F.col("parent_id").alias("up"),
        F.array().cast("array<string>").alias("lineage"),
    )
    rows, ids, distinct, climbing, size = walk.select(
        F.count(F.lit(1)), F.count("id"), F.count_distinct("id"), *_progress()[1:]
    ).first()
    if ids < rows or distinct < ids:
        raise ValueError("concept ids must be present and unique")
    while climbing:
        before = climbing
        walk = materialise(_climb(walk, limits.allow(rows, size)))
        lost, climbing, size = walk.select(*_progress()).first()
        if lost:
            raise ValueError(f"{lost} concepts hang off an unknown parent")
        if climbing == before:
            # in a forest some concept reaches its root in every round
            raise ValueError(f"{climbing} concepts hang off a cycle of parents")
    return walk.select("id", "name", "lineage"), rows, size


def _progress() -> list[Column]:
    """Concepts that lost their way, those still climbing, and the table's size."""
    return [
        F.count_if(F.col("lineage").isNull()),
        F.count_if(F.col("up").isNotNull()),
        text_bytes(["id", "name", "up"], ["lineage"]),
    ]


def _climb(walk: DataFrame, small: bool) -> DataFrame:
    """Put what the ancestor in ``up`` knows in front of each lineage."""
    above = walk.select(
        F.col("id").alias("above_id"),
        F.col("up").alias("above_up"),
        F.concat("lineage", F.array("name")).alias("above_lineage"),
    )
    up = F.col("up")
    # A concept at the top joins on its own id, which spreads such rows over
    # the tasks, and the second condition keeps it from matching itself.
    joined = walk.join(
        F.broadcast(above) if small else above,
        (F.coalesce(up, F.col("id")) == F.col("above_id")) & up.isNotNull(),
        "left",
    )
    longer = F.concat("above_lineage", "lineage")
    return joined.select(
        "id",
        "name",
        F.col("above_up").alias("up"),
        F.when(up.isNull(), F.col("lineage")).otherwise(longer).alias("lineage"),
    )


def vocabulary_keys(
    vocabulary: Vocabulary,
    exact: bool = False,
    limits: LookupLimits = LookupLimits(),
    languages: Sequence[str] | None = None,
) -> DataFrame:
    """``(key, concept, lineage)``, unique by key, computed once.

    The table to look terms up in. Save it to share it between jobs. ``languages``:
    those of the labels that count, best first (the label table's ``language``).
    """
    owner = _key_owners(vocabulary, exact, languages).where(F.col("concept_id").isNotNull())
    tree, rows, size = _lineage(vocabulary.concepts, limits)
    known = F.broadcast(tree) if limits.allow(rows, size) else tree
    return materialise(
        owner.join(known, F.col("concept_id") == F.col("id")).select(
            "key", F.col("name").alias("concept"), "lineage"
        )
    )


def ambiguous_keys(vocabulary: Vocabulary, exact: bool = False) -> DataFrame:
    """``(key, concepts)``: keys left unmatched and how many concepts claim each."""
    claims = _claims(vocabulary, exact).distinct()
    counted = claims.groupBy("key").agg(
        F.count_if("by_name").alias("names"),
        F.count_if(~F.col("by_name")).alias("labels"),
    )
    rivals = F.when(F.col("names") > 0, F.col("names")).otherwise(F.col("labels"))
    return counted.select("key", rivals.alias("concepts")).where("concepts > 1")


def ambiguous_labels(vocabulary: Vocabulary, exact: bool = False) -> DataFrame:
    """``(key, language, concepts)``: keys that several concepts have as labels of one language."""
    labels = vocabulary.labels.select(match_key(F.col("label"), exact).alias("key"), "language", "concept_id")
    counted = labels.where("key IS NOT NULL").distinct().groupBy("key", "language").agg(F.count("concept_id").alias("concepts"))
    return counted.where("concepts > 1")


def _claims(vocabulary: Vocabulary, exact: bool) -> DataFrame:
    """``(key, concept_id, by_name)``: every spelling of every concept."""
    claims = vocabulary.concepts.select(
        match_key(F.col("name"), exact).alias("key"),
        F.col("id").alias("concept_id"),
        F.lit(True).alias("by_name"),
    )
    if vocabulary.labels is not None:
        claims = claims.unionByName(
            vocabulary.labels.select(
                match_key(F.col("label"), exact).alias("key"),
                "concept_id",
                F.lit(False).alias("by_name"),
            )
        )
    return claims.where(F.col("key").isNotNull())


def _ranked_owners(vocabulary: Vocabulary, exact: bool, languages: Sequence[str]) -> DataFrame:
    """``(key, concept_id)``: the owner of each key in its best language, null where ambiguous.

    The least of (rank, concept) and the least of rank with the greatest concept are two
    buffers per key, combined before the shuffle.
    """
    if vocabulary.labels is None or "language" not in vocabulary.labels.columns:
        raise ValueError("the label table has no column language")
    names = vocabulary.concepts.select(
        match_key(F.col("name"), exact).alias("key"), F.lit(0).alias("rank"), F.col("id").alias("concept_id")
    )
    order = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("language")).cast("int")
    labels = vocabulary.labels.select(match_key(F.col("label"), exact).alias("key"), order.alias("rank"), "concept_id")
    claims = names.unionByName(labels.where("rank > 0")).where("key IS NOT NULL")
    best = claims.groupBy("key").agg(
        F.min(F.struct("rank", "concept_id")).alias("first"),
        F.max(F.struct((-F.col("rank")).alias("rank"), "concept_id")).alias("last"),
    )
    owner = F.when(F.col("first.concept_id") == F.col("last.concept_id"), F.col("first.concept_id"))
    return best.select("key", owner.alias("concept_id"))


def _key_owners(vocabulary: Vocabulary, exact: bool, languages: Sequence[str] | None = None) -> DataFrame:
    """``(key, concept_id)``: the owner of each key, null where ambiguous.

    Smallest and largest claimant agree only if there is one. Four fixed-size
    buffers per key, so a key with many claimants combines before the shuffle.
    """
    if languages is not None:
        return _ranked_owners(vocabulary, exact, languages)
    named, labelled = F.col("by_name"), ~F.col("by_name")
    claimant = F.col("concept_id")
    bounds = (
        _claims(vocabulary, exact)
        .groupBy("key")
        .agg(
            F.min(F.when(named, claimant)).alias("first_name"),
            F.max(F.when(named, claimant)).alias("last_name"),
            F.min(F.when(labelled, claimant)).alias("first_label"),
            F.max(F.when(labelled, claimant)).alias("last_label"),
        )
    )
    owner = F.when(
        F.col("first_name").isNotNull(),
        F.when(F.col("first_name") == F.col("last_name"), F.col("first_name")),
    ).when(F.col("first_label") == F.col("last_label"), F.col("first_label"))
    return bounds.select("key", owner.alias("concept_id"))
