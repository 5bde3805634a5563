"""The SQL surface: cleaning and lookup as temporary SQL functions.

Both are SQL functions, which the analyzer inlines: the plan holds built-in
expressions and joins, no opaque call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from seqprep.functions.options import DEFAULTS, INT_TEXT
from seqprep.functions.stages import PLAIN_ALPHABET, PLAIN_TEXT, SIMPLE_CLASS
from seqprep.operators.clean import RESULT_TYPE, quoted
from seqprep.operators.limits import LookupLimits, fits_broadcast
from seqprep.operators.lookup import lookup
from seqprep.sources.tables import materialise, read_table


def register_sql(spark: SparkSession, name: str = "processSequence") -> None:
    """Install ``processSequence(dna, opts)``.

    ``opts`` is a ``map<string,string>``, possibly per row, or null for the
    defaults; it may be left out. The result is the cleaning struct.
    """
    options = ",\n".join(f"{_option(key)} AS {key}" for key in DEFAULTS)
    # Array subscript instead of IF: the struct stays outside any branch, so
    # code generation shares the stages that many fields read. A null subscript
    # gives the null struct for a null text.
    spark.sql(
        rf"""
        CREATE OR REPLACE TEMPORARY FUNCTION {quoted(name)}(
          dna STRING, opts MAP<STRING, STRING> DEFAULT NULL)
        RETURNS {RESULT_TYPE.simpleString()}
        RETURN (
          SELECT get(array(named_struct(
            'seqId', CAST(NULL AS STRING),
            'rawSequence', dna,
            'sequence', IF(invalid, NULL, final),
            'sequenceLength', len,
            'nonIupacFraction', non_iupac,
            'nonACGTNFraction', IF(len > 0, length(rest) / len, NULL),
            'nFraction', IF(len > 0, n / len, NULL),
            'nNrunsCapped', CASE WHEN has_run AND trimmed != '' THEN regexp_count(trimmed, cap)
                                 WHEN has_run IS NOT NULL THEN 0 END,
            'gcContent', IF(acgt > 0, gc / acgt, NULL),
            'naturalLanguageDetected', language,
            'endsTrimmed', octet_length(trimmed) < octet_length(plain),
            'gapsOrWhitespaceRemoved', octet_length(packed) < octet_length(dna) OR has_gap,
            'nucleotideSequenceID', IF(invalid OR final = '', NULL, md5(final)),
            'invalid', invalid)), IF(dna IS NULL, NULL, 0))
          FROM (SELECT *, coalesce(non_iupac > 0, FALSE) OR language AS invalid
          FROM (SELECT *,
            IF(len > 0, CASE WHEN NOT rlike(iupacDna, r'{PLAIN_ALPHABET}')
                             THEN regexp_count(final, concat('[^', iupacDna, ']'))
                             WHEN rest = '' THEN 0
                             ELSE regexp_count(rest, concat('[^', iupacDna, ']')) END / len, NULL) AS non_iupac,
            octet_length(final) - octet_length(rest) - n AS acgt
          FROM (SELECT *,
            octet_length(final) - octet_length(rest)
              + shiftright(octet_length(encode(rest, 'UTF-16BE')), 1) AS len,
            octet_length(final) - octet_length(replace(final, 'N', '')) AS n,
            octet_length(final)
              - octet_length(replace(replace(final, 'G', ''), 'C', '')) AS gc
          FROM (SELECT *, regexp_replace(final, '[ACGTN]+', '') AS rest
          FROM (SELECT *,
            IF(has_run, regexp_replace(trimmed, cap, repeat('N', nrunCapTo)), trimmed) AS final
          FROM (SELECT *, contains(trimmed, repeat('N', nrunCapFrom)) AS has_run
          FROM (SELECT *, regexp_extract(plain, concat('(?s)', run, '(?:.*', run, ')?'), 0) AS trimmed
          FROM (SELECT *,
            replace(replace(ungapped, 'U', 'T'), '?', 'N') AS plain,
            IF(rlike(gapRegex, r'{SIMPLE_CLASS}'),
               octet_length(ungapped) < octet_length(upper_text),
               rlike(upper_text, gapRegex)) AS has_gap,
            IF(rlike(naturalLanguageRegex, r'{PLAIN_TEXT}'),
               contains(upper_text, naturalLanguageRegex),
               rlike(upper_text, naturalLanguageRegex)) AS language
          FROM (SELECT *, regexp_replace(upper_text, gapRegex, '') AS ungapped
          FROM (SELECT *, upper(packed) AS upper_text
          FROM (SELECT *,
            regexp_replace(dna, r'\s', '') AS packed,
            concat('[', anchorChars, ']{{', IF(least(anchorMinrun, nrunCapFrom, nrunCapTo) < 0,
              raise_error('anchorMinrun, nrunCapFrom and nrunCapTo must not be negative'),
              anchorMinrun), ',}}') AS run,
            concat('N{{', nrunCapFrom, ',}}') AS cap
          FROM (SELECT {options}))))))))))))
        )
        """
    )


def register_lookup(
    spark: SparkSession,
    name: str,
    keys: str,
    *,
    exact: bool = False,
    limits: LookupLimits = LookupLimits(),
) -> None:
    """Install ``name(term)``: the concept name in the key table or view ``keys``.

    The function is bound to the key table as it is now: a copy is made, measured
    and broadcast. A table beyond the limits or with a repeated key raises
    ``ValueError``; ``register_lookup_view`` serves SQL with larger ones.
    """
    _register_lookup(spark, name, keys, "STRING", "k.concept", ["concept"], exact, limits)


def register_lookup_lineage(
    spark: SparkSession,
    name: str,
    keys: str,
    *,
    exact: bool = False,
    limits: LookupLimits = LookupLimits(),
) -> None:
    """Install ``name(term)``: a ``(concept, lineage)`` struct, null if unmatched."""
    _register_lookup(
        spark,
        name,
        keys,
        "STRUCT<concept: STRING, lineage: ARRAY<STRING>>",
        "named_struct('concept', k.concept, 'lineage', k.lineage)",
        ["concept", "lineage"],
        exact,
        limits,
    )


def register_lookup_view(
    spark: SparkSession,
    name: str,
    source: str,
    column: str,
    keys: str,
    *,
    concept_as: str | None = None,
    struct_as: str | None = None,
    exact: bool = False,
    limits: LookupLimits = LookupLimits(),
) -> None:
    """Install the temporary view ``name``: table ``source`` with the lookup of ``column`` added.

    For SQL over vocabularies of any size. A function sees one term at a time, so it
    cannot know which terms are hot; the view sees the table. Key tables beyond the
    broadcast limits are joined on (key, slice), with hot terms cut and rows without a
    term spread. Bound to a copy of the key table as it is now, and to the terms that are
    hot now: later rows of ``source`` appear in the view, and more of them are merely in
    larger slices. Columns that a query does not name are not read.
    """
    columns = ["concept"] + (["lineage"] if struct_as is not None else [])
    copy = materialise(read_table(spark, keys).select("key", *columns))
    found = lookup(
        read_table(spark, source), column, copy, concept_as=concept_as, struct_as=struct_as, exact=exact, limits=limits
    )
    found.createOrReplaceTempView(name)


def _register_lookup(
    spark: SparkSession,
    name: str,
    keys: str,
    returns: str,
    value: str,
    columns: list[str],
    exact: bool,
    limits: LookupLimits,
) -> None:
    # The scalar subquery becomes a join that keeps every term. It reads a copy that
    # a later change of the table or view cannot outgrow.
    copy = materialise(spark.table(keys).select("key", *columns))
    if not fits_broadcast(copy, columns, limits):
        raise ValueError(f"{keys} is beyond the broadcast limits: use lookup() or register_lookup_view()")
    table = f"seqprep_keys_{uuid.uuid4().hex}"
    copy.createOrReplaceTempView(table)
    key = "term" if exact else "lower(trim(term))"
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {quoted(name)}(term STRING)
        RETURNS {returns}
        RETURN (SELECT /*+ BROADCAST(k) */ {value} FROM {table} k WHERE k.key = {key})
        """
    )


def _option(key: str) -> str:
    default = DEFAULTS[key]
    if isinstance(default, int):
        number = f"IF(rlike(opts['{key}'], r'{INT_TEXT}'), try_cast(opts['{key}'] AS INT), NULL)"
        return f"coalesce({number}, {default})"
    return f"coalesce(opts['{key}'], r'{default}')"
