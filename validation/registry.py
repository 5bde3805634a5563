"""One query per operator, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep import (
    CleanOptions,
    LookupLimits,
    Vocabulary,
    ambiguous_keys,
    ambiguous_labels,
    clean_columns,
    clean_sequences,
    concept_lineage,
    lookup_terms,
    process_sequences,
    read_vocabulary,
    register_lookup,
    register_lookup_lineage,
    register_lookup_view,
    register_sql,
    vocabulary_keys,
)
from seqprep.functions import stages as S
from seqprep.operators.clean import RESULT_TYPE
from seqprep.plans.reports import (
    catalogue,
    catalogue_state,
    dataset_averages,
    dataset_quality,
    distinct_sequences,
    length_quantiles,
    length_sketches,
    merge_catalogues,
    merge_sketches,
    unmatched_terms,
)
from seqprep.sources.tables import materialise, read_table, shared_folder, write_table
from seqprep.streaming.clean import process_new_sequences
from seqprep.streaming.lookup import lookup_new_terms, read_found
from validation.inputs import CONCEPTS, LABELS, LANGUAGE_LABELS, SEQUENCES, SKEWED_TERMS, TERMS, derive, vocabulary

Query = Callable[[SparkSession, str], DataFrame]

OPT = CleanOptions()
RESULT_FIELDS = [name for name in RESULT_TYPE.names if name not in ("seqId", "rawSequence")]


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, SEQUENCES)


# --- scans and sinks ---------------------------------------------------------


def scan_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences(spark, sf_dir).createOrReplaceTempView("seqprep_sequences")
    table = read_table(spark, "seqprep_sequences")
    return table.select("datasetkey", "gbifid", "v_dnasequence")


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-replace sink: a managed table written twice, read back and dropped."""
    cleaned = process_sequences(sequences(spark, sf_dir))
    table = f"seqprep_roundtrip_{uuid.uuid4().hex}"
    try:
        write_table(cleaned.select("datasetkey", "gbifid"), table)
        write_table(cleaned, table)
        return materialise(read_table(spark, table))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def ctas_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SELECT of a CREATE TABLE ... AS over the SQL function."""
    register_sql(spark)
    return spark.sql(CTAS_SELECT, occurrences=sequences(spark, sf_dir))


CTAS_SELECT = """
WITH cleaned AS (
  SELECT datasetkey, gbifid, processSequence(v_dnasequence) AS got FROM {occurrences}
)
SELECT datasetkey, gbifid, got.nFraction, got.sequenceLength, got.endsTrimmed, got.sequence
FROM cleaned WHERE got IS NOT NULL
"""


def vocab_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    derive(spark, sf_dir, CONCEPTS).createOrReplaceTempView("seqprep_concept")
    derive(spark, sf_dir, LABELS).createOrReplaceTempView("seqprep_label")
    found = read_vocabulary(spark, "seqprep_concept", "seqprep_label")
    concepts = found.concepts.select(
        F.lit("concept").alias("kind"), "id", F.col("name").alias("text"), "parent_id"
    )
    labels = found.labels.select(
        F.lit("label").alias("kind"),
        F.col("concept_id").alias("id"),
        F.col("label").alias("text"),
        F.lit(None).cast("string").alias("parent_id"),
    )
    return concepts.unionByName(labels)


# --- projections and predicates ----------------------------------------------


def filter_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(spark, sf_dir).where(F.col("v_dnasequence").isNotNull())


def null_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_sequences(sequences(spark, sf_dir), "v_dnasequence")
    metrics = [F.col(f"result.{name}") for name in RESULT_FIELDS if name != "sequence"]
    return cleaned.select(
        "datasetkey",
        "gbifid",
        F.col("result").isNull().alias("null_result"),
        F.col("result.rawSequence"),
        *metrics,
    )


# --- single stages -----------------------------------------------------------


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts between the stages, one column each; unused ones are pruned."""
    c = F.col
    return (
        sequences(spark, sf_dir)
        .withColumn("raw", c("v_dnasequence"))
        .withColumn("packed", S.strip_whitespace(c("raw")))
        .withColumn("upper", S.uppercase(c("packed")))
        .withColumn("ungapped", S.remove_gaps(c("upper"), OPT.gap_regex))
        .withColumn("dna", S.rna_to_dna(c("ungapped")))
        .withColumn("known", S.unknown_to_n(c("dna")))
        .withColumn("trimmed", S.trim_to_anchors(c("known"), OPT.anchor_chars, OPT.anchor_minrun))
        .withColumn("has_run", S.holds_run(c("trimmed"), OPT.nrun_cap_from))
        .withColumn(
            "final", S.cap_runs(c("trimmed"), c("has_run"), OPT.nrun_cap_from, OPT.nrun_cap_to)
        )
        .withColumn("no_gc", S.without_gc(c("final")))
        .withColumn("left", S.leftover(c("no_gc")))
        .withColumn("length", S.sequence_length(c("final"), c("left")))
    )


def stage(value: Callable[[], Column]) -> Query:
    """``value`` is built when the query runs, since Columns need a session."""
    return lambda spark, sf_dir: staged(spark, sf_dir).select(
        "datasetkey", "gbifid", value().alias("value")
    )


def result_field(name: str) -> Query:
    return lambda spark, sf_dir: clean_columns(
        sequences(spark, sf_dir),
        "v_dnasequence",
        keep=["datasetkey", "gbifid"],
        fields=[name],
        rename={name: "value"},
    )


def text(name: str) -> Query:
    return stage(lambda: F.col(name))


def n_fraction() -> Column:
    return S.ratio(S.count_n(F.col("no_gc")), F.col("length"))


def non_acgtn_fraction() -> Column:
    return S.ratio(S.count_non_acgtn(F.col("left")), F.col("length"))


def non_iupac_fraction() -> Column:
    foreign = S.count_non_iupac(F.col("final"), F.col("left"), OPT.iupac_dna)
    return S.ratio(foreign, F.col("length"))


def gc_content() -> Column:
    final, no_gc = F.col("final"), F.col("no_gc")
    acgt = S.count_acgt(final, F.col("left"), S.count_n(no_gc))
    return S.ratio(S.count_gc(final, no_gc), acgt)


STAGE_QUERIES: dict[str, Query] = {
    "ws_flag": stage(lambda: S.shortened(F.col("packed"), F.col("raw"))),
    "strip_whitespace": text("packed"),
    "uppercase": text("upper"),
    "natural_language": stage(
        lambda: S.natural_language(F.col("upper"), OPT.natural_language_regex)
    ),
    "gap_flag": stage(lambda: S.gap_found(F.col("upper"), F.col("ungapped"), OPT.gap_regex)),
    "remove_gaps": text("ungapped"),
    "gaps_or_ws_flag": result_field("gapsOrWhitespaceRemoved"),
    "rna_to_dna": text("dna"),
    "question_to_n": text("known"),
    "trim_front": stage(
        lambda: S.trim_front(F.col("known"), OPT.anchor_chars, OPT.anchor_minrun)
    ),
    "trim_to_anchors": text("trimmed"),
    "ends_trimmed": stage(lambda: S.shortened(F.col("trimmed"), F.col("known"))),
    "n_runs_capped": stage(
        lambda: S.capped_runs(F.col("trimmed"), F.col("has_run"), OPT.nrun_cap_from)
    ),
    "cap_n_runs": text("final"),
    "sequence_length": text("length"),
    "n_fraction": stage(n_fraction),
    "non_acgtn_fraction": stage(non_acgtn_fraction),
    "non_iupac_fraction": stage(non_iupac_fraction),
    "gc_content": stage(gc_content),
    "sequence_id": stage(lambda: S.sequence_id(F.col("final"))),
    "invalid_flag": result_field("invalid"),
}


# --- the pipeline and its options --------------------------------------------


def clean_with(options: Callable[[], object]) -> Query:
    return lambda spark, sf_dir: process_sequences(
        sequences(spark, sf_dir), options=options()
    )


def text_map(**values: str) -> Column:
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def clean_per_row_opts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options that differ from row to row."""
    third = F.col("gbifid") % 3
    options = (
        F.when(third == 0, text_map(nrunCapFrom="3", nrunCapTo="2"))
        .when(third == 1, text_map(anchorMinrun="4", iupacDna="ACGTNX"))
        .otherwise(text_map(gapRegex=r"[-\.X]", naturalLanguageRegex="PRIMER"))
    )
    return clean_columns(
        sequences(spark, sf_dir),
        "v_dnasequence",
        options,
        keep=["datasetkey", "gbifid"],
        fields=RESULT_FIELDS,
        rename={"sequence": "cleaned_sequence"},
    )


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prose texts, with anchors short enough to occur in words."""
    return clean_columns(
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
        "text",
        CleanOptions(anchor_minrun=2),
        keep=["doc_id"],
        fields=RESULT_FIELDS,
        rename={"sequence": "cleaned_sequence"},
    )


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of rows that the cleaning job observes while it writes."""
    table = f"seqprep_counted_{uuid.uuid4().hex}"
    try:
        rows = write_table(process_sequences(sequences(spark, sf_dir)), table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return spark.sql(f"SELECT {rows}L AS rows")


def sql_process_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql(spark)
    return spark.sql(
        """
        SELECT datasetkey, gbifid, result.* FROM (
          SELECT datasetkey, gbifid, processSequence(v_dnasequence, null) AS result FROM {seqs})
        """,
        seqs=sequences(spark, sf_dir),
    )


# --- vocabulary and lookup ---------------------------------------------------


def flat_lineage(df: DataFrame) -> DataFrame:
    """The struct column as text, so that the result has plain columns."""
    others = [name for name in df.columns if name != "found"]
    return df.select(
        *others,
        F.col("found.concept").alias("lineage_concept"),
        F.array_join("found.lineage", "|").alias("lineage"),
        F.col("found").isNull().alias("unmatched"),
    )


def lookup_query(
    concept: bool, lineage: bool, terms: str = TERMS, exact: bool = False, **options: object
) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = lookup_terms(
            derive(spark, sf_dir, terms),
            vocabulary_keys(vocabulary(spark, sf_dir), exact),
            "v_targetgene",
            "target_gene" if concept else None,
            "found" if lineage else None,
            exact=exact,
            **options,
        )
        return flat_lineage(found) if lineage else found

    return run


def lookup_empty_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = derive(spark, sf_dir, TERMS)
    return flat_lineage(
        lookup_terms(terms, None, "v_targetgene", "target_gene", "found", on_missing="null")
    )


def concept_lineage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concept_lineage(derive(spark, sf_dir, CONCEPTS)).select(
        "id", "name", F.array_join("lineage", "|").alias("lineage"), F.size("lineage").alias("depth")
    )


def vocab_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = vocabulary_keys(vocabulary(spark, sf_dir))
    return keys.select("key", "concept", F.array_join("lineage", "|").alias("lineage"))


def vocab_ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ambiguous_keys(vocabulary(spark, sf_dir))


def with_lookup_functions(spark: SparkSession, sf_dir: str) -> None:
    vocabulary_keys(vocabulary(spark, sf_dir)).createOrReplaceTempView("seqprep_keys")
    register_lookup(spark, "vocabLookup", "seqprep_keys")
    register_lookup_lineage(spark, "vocabLookupLineage", "seqprep_keys")


def sql_lookup_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_lookup_functions(spark, sf_dir)
    return spark.sql(
        """
        SELECT datasetkey, gbifid, v_targetgene AS raw_v_targetgene,
               vocabLookup(v_targetgene) AS target_gene FROM {terms}
        """,
        terms=derive(spark, sf_dir, TERMS),
    )


def sql_lookup_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_lookup_functions(spark, sf_dir)
    return flat_lineage(
        spark.sql(
            """
            SELECT datasetkey, gbifid, v_targetgene AS raw_v_targetgene,
                   vocabLookupLineage(v_targetgene) AS found FROM {terms}
            """,
            terms=derive(spark, sf_dir, TERMS),
        )
    )


def sql_lookup_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a vocabulary that is too large to broadcast, and terms a third of which are one."""
    vocabulary_keys(vocabulary(spark, sf_dir)).createOrReplaceTempView("large_keys")
    derive(spark, sf_dir, SKEWED_TERMS).createOrReplaceTempView("skewed_terms")
    register_lookup_view(
        spark,
        "skewed_found",
        "skewed_terms",
        "v_targetgene",
        "large_keys",
        concept_as="target_gene",
        struct_as="found",
        limits=LookupLimits(broadcast_rows=0, rows_per_slice=5_000),
    )
    return flat_lineage(
        spark.sql(
            "SELECT datasetkey, gbifid, v_targetgene AS raw_v_targetgene, target_gene, found FROM skewed_found"
        )
    )


def lineage_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Struct field and array subscript; an empty lineage gives null."""
    found = lookup_terms(
        derive(spark, sf_dir, TERMS),
        vocabulary_keys(vocabulary(spark, sf_dir)),
        "v_targetgene",
        result_concept_column="found",
    )
    return found.select(
        "datasetkey",
        "gbifid",
        "raw_v_targetgene",
        F.col("found.concept").alias("matched_concept"),
        F.get("found.lineage", F.lit(0)).alias("top_lineage_element"),
    )


# --- reports and streaming ---------------------------------------------------


def distinct_sequences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_sequences(process_sequences(sequences(spark, sf_dir)))


def dataset_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_quality(process_sequences(sequences(spark, sf_dir)))


def dataset_averages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_averages(process_sequences(sequences(spark, sf_dir)))


def batches_of(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The cleaned sequences as three batches, which together are all."""
    cleaned = process_sequences(sequences(spark, sf_dir))
    return [cleaned.where(F.pmod("gbifid", F.lit(3)) == b) for b in range(3)]


def length_quantiles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of each dataset's lengths, from the merged sketches of three batches."""
    return length_quantiles(merge_sketches([length_sketches(b) for b in batches_of(spark, sf_dir)]))


def catalogue_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue of distinct sequences from the merged states of three batches."""
    return catalogue(merge_catalogues([catalogue_state(b) for b in batches_of(spark, sf_dir)]))


def language_vocabulary(spark: SparkSession, sf_dir: str) -> Vocabulary:
    return Vocabulary(derive(spark, sf_dir, CONCEPTS), derive(spark, sf_dir, LANGUAGE_LABELS))


def vocab_language_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys by German labels, else by English ones."""
    return vocabulary_keys(language_vocabulary(spark, sf_dir), languages=["de", "en"]).select(
        "key", "concept", F.array_join("lineage", "|").alias("lineage")
    )


def vocab_ambiguous_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ambiguous_labels(language_vocabulary(spark, sf_dir))


def unmatched_terms_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = vocabulary_keys(vocabulary(spark, sf_dir))
    return unmatched_terms(derive(spark, sf_dir, SKEWED_TERMS), "v_targetgene", keys)


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of ``documents`` cleaned by a stream that ends with the files there are."""
    path = f"{sf_dir}/documents.parquet"
    schema = spark.read.parquet(path).schema
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    # a pattern, as the table may be one file or a folder of files
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
    options = CleanOptions(anchor_minrun=2)
    process_new_sequences(stream, f"{base}/out", f"{base}/progress", "parquet", "text", ["doc_id"], options)
    return spark.read.parquet(f"{base}/out")


def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms looked up as they arrive: the derived terms, written once, are the stream's files."""
    base = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    derive(spark, sf_dir, SKEWED_TERMS).write.parquet(f"{base}/terms")
    schema = spark.read.parquet(f"{base}/terms").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(f"{base}/terms")
    lookup_new_terms(
        stream,
        f"{base}/out",
        f"{base}/progress",
        lambda session: vocabulary_keys(vocabulary(session, sf_dir)),
        "v_targetgene",
        "target_gene",
        "found",
    )
    return flat_lineage(read_found(spark, f"{base}/out"))


def queries() -> dict[str, Query]:
    return {
        "distinct_sequences": distinct_sequences_query,
        "dataset_quality": dataset_quality_query,
        "dataset_averages": dataset_averages_query,
        "length_quantiles": length_quantiles_query,
        "catalogue_merged": catalogue_merged,
        "vocab_language_keys": vocab_language_keys,
        "vocab_ambiguous_labels": vocab_ambiguous_labels,
        "unmatched_terms": unmatched_terms_query,
        "stream_documents": stream_documents,
        "scan_sequences": scan_sequences,
        "sink_roundtrip": sink_roundtrip,
        "ctas_shape": ctas_shape,
        "vocab_scan": vocab_scan,
        "filter_non_null": filter_non_null,
        "null_propagation": null_propagation,
        **STAGE_QUERIES,
        "process_sequences": clean_with(lambda: None),
        "sql_process_sequence": sql_process_sequence,
        "clean_default_opts": clean_with(dict),
        "clean_custom_opts": clean_with(
            lambda: {
                "anchorChars": "ACGT",
                "anchorMinrun": "4",
                "gapRegex": r"[-\.X]",
                "naturalLanguageRegex": "PRIMER",
                "iupacDna": "ACGTRN",
                "nrunCapFrom": "3",
                "nrunCapTo": "2",
                "unknown": "ignored",
            }
        ),
        "clean_bad_int_opts": clean_with(
            lambda: text_map(nrunCapFrom="abc", nrunCapTo="", anchorMinrun=" 3")
        ),
        "clean_per_row_opts": clean_per_row_opts,
        "clean_documents": clean_documents,
        "row_count": row_count,
        "concept_lineage": concept_lineage_query,
        "vocab_keys": vocab_keys,
        "vocab_ambiguous_keys": vocab_ambiguous_keys,
        "lookup_concept": lookup_query(True, False),
        "lookup_lineage": lookup_query(False, True),
        "lookup_both": lookup_query(True, True),
        "lookup_exact": lookup_query(True, False, exact=True),
        "lookup_empty_vocab": lookup_empty_vocab,
        "lineage_access": lineage_access,
        "lookup_skewed": lookup_query(True, True, SKEWED_TERMS),
        "lookup_shuffled": lookup_query(
            True,
            True,
            SKEWED_TERMS,
            limits=LookupLimits(broadcast_rows=0, rows_per_slice=5_000),
        ),
        "sql_lookup_concept": sql_lookup_concept,
        "sql_lookup_lineage": sql_lookup_lineage,
        "sql_lookup_shuffled": sql_lookup_shuffled,
        "stream_lookup": stream_lookup,
    }
