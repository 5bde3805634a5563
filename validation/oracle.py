"""DuckDB SQL for every registered query, written apart from the Spark plans."""

from __future__ import annotations

from validation.inputs import CONCEPTS, LABELS, LANGUAGE_LABELS, SEQUENCES, SKEWED_TERMS, TERMS, duckdb_text

SEQS = f"seqs AS ({duckdb_text(SEQUENCES)})"

DEFAULT = dict(
    anchor="ACGTU", minrun=8, gap="[-.]", language="UNMERGED", iupac="ACGTRYSWKMBDHVN", cap=6, to=5
)


def cleaning(source: str = "seqs", column: str = "v_dnasequence", where: str = "", **options) -> str:
    """CTEs s0 ... clean over ``source``; RE2 has no \\x0B in \\s."""
    o = {**DEFAULT, **options}
    run = f"[{o['anchor']}]{{{o['minrun']}}}"
    cap = f"N{{{o['cap']},}}"
    return rf"""
    s0 AS (SELECT *, {column} AS raw,
                  regexp_replace({column}, '[ \t\n\x0B\f\r]+', '', 'g') AS packed FROM {source} {where}),
    s1 AS (SELECT *, upper(replace(packed, 'ß', 'SS')) AS upper_text FROM s0),
    s2 AS (SELECT *, regexp_matches(upper_text, '{o['language']}') AS language,
                  regexp_matches(upper_text, '{o['gap']}') AS gap,
                  regexp_matches(raw, '[ \t\n\x0B\f\r]') AS blank,
                  regexp_replace(upper_text, '{o['gap']}', '', 'g') AS ungapped FROM s1),
    s3 AS (SELECT *, replace(ungapped, 'U', 'T') AS dna FROM s2),
    s4 AS (SELECT *, replace(dna, '?', 'N') AS known FROM s3),
    s5 AS (SELECT *, CASE WHEN known IS NULL THEN NULL
                          WHEN regexp_matches(known, '{run}')
                          THEN regexp_replace(known, '^(?s:.*?)({run})', '\1') ELSE '' END AS front FROM s4),
    s6 AS (SELECT *, CASE WHEN front IS NULL THEN NULL WHEN front = '' THEN ''
                          ELSE regexp_extract(front, '^(?s:.*){run}[{o['anchor']}]*') END AS trimmed FROM s5),
    s7 AS (SELECT *, CAST(len(regexp_extract_all(trimmed, '{cap}')) AS INTEGER) AS runs,
                  regexp_replace(trimmed, '{cap}', repeat('N', {o['to']}), 'g') AS final FROM s6),
    s8 AS (SELECT *, length(final) + length(regexp_replace(final, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')) AS len,
                  length(final) - length(replace(final, 'N', '')) AS n,
                  length(regexp_replace(final, '[ACGTN]', '', 'g')) AS odd,
                  length(regexp_replace(final, '[{o['iupac']}]', '', 'g')) AS foreign_chars,
                  length(regexp_replace(final, '[^GC]', '', 'g')) AS gc,
                  length(regexp_replace(final, '[^ACGT]', '', 'g')) AS acgt FROM s7),
    s9 AS (SELECT *, CAST(len AS INTEGER) AS "sequenceLength",
                  CASE WHEN len > 0 THEN foreign_chars / len END AS "nonIupacFraction",
                  CASE WHEN len > 0 THEN odd / len END AS "nonACGTNFraction",
                  CASE WHEN len > 0 THEN n / len END AS "nFraction",
                  runs AS "nNrunsCapped",
                  CASE WHEN acgt > 0 THEN gc / acgt END AS "gcContent",
                  language AS "naturalLanguageDetected",
                  trimmed <> known AS "endsTrimmed",
                  blank OR gap AS "gapsOrWhitespaceRemoved" FROM s8),
    s10 AS (SELECT *, CASE WHEN raw IS NULL THEN NULL
                           ELSE coalesce("nonIupacFraction" > 0, FALSE) OR language END AS invalid FROM s9),
    clean AS (SELECT *, CASE WHEN NOT invalid THEN final END AS cleaned_sequence,
                     CASE WHEN final <> '' THEN md5(final) END AS id,
                     CASE WHEN NOT invalid AND final <> '' THEN md5(final) END AS "nucleotideSequenceID"
              FROM s10)"""


METRICS = """"sequenceLength", "nonIupacFraction", "nonACGTNFraction", "nFraction", "nNrunsCapped",
    "gcContent", "naturalLanguageDetected", "endsTrimmed", "gapsOrWhitespaceRemoved",
    "nucleotideSequenceID", invalid"""
RESULT = f"cleaned_sequence, {METRICS}"
KEYS = "datasetkey, gbifid"


def over_sequences(select: str, tail: str = "FROM clean", **options) -> str:
    return f"WITH {SEQS}, {cleaning(**options)} SELECT {select} {tail}"


def stage(value: str) -> str:
    return over_sequences(f"{KEYS}, {value} AS value")


TABLES = f"concept AS ({duckdb_text(CONCEPTS)}), label AS ({duckdb_text(LABELS)})"


def vocabulary(exact: bool = False) -> str:
    """Keys: names beat labels, and several claimants leave a key without owner."""
    key = (lambda text: text) if exact else (lambda text: f"lower(trim({text}))")
    return f"""{TABLES},
    tree AS (
      SELECT id, name, CAST([] AS VARCHAR[]) AS lineage FROM concept WHERE parent_id IS NULL
      UNION ALL
      SELECT c.id, c.name, list_append(t.lineage, t.name)
      FROM concept c JOIN tree t ON c.parent_id = t.id),
    claim AS (
      SELECT {key('name')} AS key, id AS concept_id, 0 AS rank FROM concept
      UNION SELECT {key('label')}, concept_id, 1 FROM label),
    best AS (SELECT *, min(rank) OVER (PARTITION BY key) AS top FROM claim),
    contest AS (SELECT key, count(DISTINCT concept_id) AS concepts, any_value(concept_id) AS concept_id
                FROM best WHERE rank = top AND key IS NOT NULL GROUP BY key),
    keys AS (SELECT key, name AS concept, lineage FROM contest JOIN tree ON id = concept_id
             WHERE concepts = 1)"""


def with_vocabulary(select: str) -> str:
    return f"WITH RECURSIVE {vocabulary()} {select}"


def with_languages(select: str) -> str:
    """Labels of two languages, the first one's before the second one's."""
    labels = duckdb_text(LANGUAGE_LABELS)
    given = vocabulary().replace(
        "concept_id, 1 FROM label", "concept_id, CASE language WHEN 'de' THEN 1 ELSE 2 END FROM label WHERE language IN ('de', 'en')"
    )
    return f"WITH RECURSIVE {given.replace(duckdb_text(LABELS), labels)} {select}"


def over_terms(values: str, terms: str = TERMS, exact: bool = False) -> str:
    key = "v_targetgene" if exact else "lower(trim(v_targetgene))"
    return f"""WITH RECURSIVE {vocabulary(exact)}, terms AS ({duckdb_text(terms)})
    SELECT datasetkey, gbifid, v_targetgene AS raw_v_targetgene, {values}
    FROM terms LEFT JOIN keys ON key = {key}"""


CONCEPT = "concept AS target_gene"
LINEAGE = """concept AS lineage_concept, array_to_string(lineage, '|') AS lineage,
    concept IS NULL AS unmatched"""

PER_ROW = "\nUNION ALL\n".join(
    f"""SELECT * FROM (WITH {SEQS}, {cleaning(where=f'WHERE gbifid % 3 = {part}', **options)}
    SELECT {KEYS}, {RESULT} FROM clean)"""
    for part, options in enumerate(
        [dict(cap=3, to=2), dict(minrun=4, iupac="ACGTNX"), dict(gap="[-.X]", language="PRIMER")]
    )
)

DOCUMENTS = f"""WITH {cleaning('documents', 'text', minrun=2)}
SELECT doc_id, {RESULT} FROM clean"""

ORACLE_SQL: dict[str, str] = {
    # reports and streaming
    "distinct_sequences": over_sequences(
        """"nucleotideSequenceID", min(cleaned_sequence) AS cleaned_sequence, count(*) AS occurrences,
        count(DISTINCT datasetkey) AS datasets""",
        """FROM clean WHERE "nucleotideSequenceID" IS NOT NULL GROUP BY "nucleotideSequenceID\"""",
    ),
    "dataset_quality": over_sequences(
        """datasetkey, count(*) AS rows, count("sequenceLength") AS with_sequence,
        count(*) FILTER (invalid) AS invalid, count(*) FILTER ("endsTrimmed") AS trimmed,
        count(*) FILTER ("naturalLanguageDetected") AS with_language,
        CAST(sum("sequenceLength") AS BIGINT) AS total_length, max("gcContent") AS max_gc_content""",
        "FROM clean GROUP BY datasetkey",
    ),
    "dataset_averages": over_sequences(
        """datasetkey, sum(len) / nullif(count(len), 0) AS mean_length,
        sum(gc) / nullif(sum(len - n - odd), 0) AS gc_content, sum(n) / nullif(sum(len), 0) AS n_fraction,
        sum(odd) / nullif(sum(len), 0) AS non_acgtn_fraction""",
        """FROM (SELECT *, CAST(round("gcContent" * (len - n - odd)) AS BIGINT) AS gc FROM (
          SELECT datasetkey, "gcContent", "sequenceLength" AS len, CAST(round("nFraction" * "sequenceLength") AS BIGINT) AS n,
          CAST(round("nonACGTNFraction" * "sequenceLength") AS BIGINT) AS odd FROM clean)) GROUP BY datasetkey""",
    ),
    "vocab_language_keys": with_languages("SELECT key, concept, array_to_string(lineage, '|') AS lineage FROM keys"),
    "vocab_ambiguous_labels": f"""WITH label AS ({duckdb_text(LANGUAGE_LABELS)})
    SELECT lower(trim(label)) AS key, language, count(DISTINCT concept_id) AS concepts FROM label
    GROUP BY 1, 2 HAVING count(DISTINCT concept_id) > 1""",
    "unmatched_terms": f"""WITH RECURSIVE {vocabulary()}, terms AS ({duckdb_text(SKEWED_TERMS)})
    SELECT lower(trim(v_targetgene)) AS term, count(*) AS rows FROM terms
    LEFT JOIN keys ON key = lower(trim(v_targetgene))
    WHERE v_targetgene IS NOT NULL AND concept IS NULL GROUP BY 1""",
    "stream_documents": DOCUMENTS,
    # scans and sinks
    "scan_sequences": f"WITH {SEQS} SELECT {KEYS}, v_dnasequence FROM seqs",
    "sink_roundtrip": over_sequences(f"{KEYS}, {RESULT}"),
    "ctas_shape": over_sequences(
        f"""{KEYS}, "nFraction", "sequenceLength", "endsTrimmed", cleaned_sequence AS sequence""",
        "FROM clean WHERE v_dnasequence IS NOT NULL",
    ),
    "vocab_scan": f"""WITH {TABLES}
    SELECT 'concept' AS kind, id, name AS text, parent_id FROM concept
    UNION ALL SELECT 'label', concept_id, label, NULL FROM label""",
    # projections and predicates
    "filter_non_null": f"WITH {SEQS} SELECT {KEYS}, v_dnasequence FROM seqs WHERE v_dnasequence IS NOT NULL",
    "null_propagation": over_sequences(
        f"""{KEYS}, raw IS NULL AS null_result, raw AS "rawSequence", {METRICS}"""
    ),
    "invalid_flag": stage("invalid"),
    # stages
    "ws_flag": stage("blank"),
    "strip_whitespace": stage("packed"),
    "uppercase": stage("upper_text"),
    "natural_language": stage("language"),
    "gap_flag": stage("gap"),
    "remove_gaps": stage("ungapped"),
    "gaps_or_ws_flag": stage('"gapsOrWhitespaceRemoved"'),
    "rna_to_dna": stage("dna"),
    "question_to_n": stage("known"),
    "trim_front": stage("front"),
    "trim_to_anchors": stage("trimmed"),
    "ends_trimmed": stage('"endsTrimmed"'),
    "n_runs_capped": stage("runs"),
    "cap_n_runs": stage("final"),
    "sequence_length": stage('"sequenceLength"'),
    "n_fraction": stage('"nFraction"'),
    "non_acgtn_fraction": stage('"nonACGTNFraction"'),
    "non_iupac_fraction": stage('"nonIupacFraction"'),
    "gc_content": stage('"gcContent"'),
    "sequence_id": stage("id"),
    # the pipeline
    "process_sequences": over_sequences(f"{KEYS}, {RESULT}"),
    "sql_process_sequence": over_sequences(
        f"""{KEYS}, CAST(NULL AS VARCHAR) AS "seqId", raw AS "rawSequence",
        cleaned_sequence AS sequence, {METRICS}"""
    ),
    "clean_default_opts": over_sequences(f"{KEYS}, {RESULT}"),
    "clean_custom_opts": over_sequences(
        f"{KEYS}, {RESULT}",
        anchor="ACGT", minrun=4, gap="[-.X]", language="PRIMER", iupac="ACGTRN", cap=3, to=2,
    ),
    "clean_bad_int_opts": over_sequences(f"{KEYS}, {RESULT}"),
    "clean_per_row_opts": PER_ROW,
    "clean_documents": DOCUMENTS,
    "row_count": over_sequences('count(*) AS "rows"'),
    # vocabulary
    "concept_lineage": with_vocabulary(
        "SELECT id, name, array_to_string(lineage, '|') AS lineage, CAST(len(lineage) AS INTEGER) AS depth FROM tree"
    ),
    "vocab_keys": with_vocabulary("SELECT key, concept, array_to_string(lineage, '|') AS lineage FROM keys"),
    "vocab_ambiguous_keys": with_vocabulary("SELECT key, concepts FROM contest WHERE concepts > 1"),
    "lookup_concept": over_terms(CONCEPT),
    "lookup_lineage": over_terms(LINEAGE),
    "lookup_both": over_terms(f"{CONCEPT}, {LINEAGE}"),
    "lookup_exact": over_terms(CONCEPT, exact=True),
    "lookup_empty_vocab": f"""WITH terms AS ({duckdb_text(TERMS)})
    SELECT datasetkey, gbifid, v_targetgene AS raw_v_targetgene, CAST(NULL AS VARCHAR) AS target_gene,
    CAST(NULL AS VARCHAR) AS lineage_concept, CAST(NULL AS VARCHAR) AS lineage, TRUE AS unmatched FROM terms""",
    "lineage_access": over_terms("concept AS matched_concept, lineage[1] AS top_lineage_element"),
    "lookup_skewed": over_terms(f"{CONCEPT}, {LINEAGE}", SKEWED_TERMS),
    "lookup_shuffled": over_terms(f"{CONCEPT}, {LINEAGE}", SKEWED_TERMS),
    "sql_lookup_shuffled": over_terms(f"{CONCEPT}, {LINEAGE}", SKEWED_TERMS),
    "stream_lookup": over_terms(f"{CONCEPT}, {LINEAGE}", SKEWED_TERMS),
    "sql_lookup_concept": over_terms(CONCEPT),
    "sql_lookup_lineage": over_terms(LINEAGE),
}

ORACLE_SQL["catalogue_merged"] = ORACLE_SQL["distinct_sequences"]
