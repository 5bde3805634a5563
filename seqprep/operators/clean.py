"""The whole cleaning pipeline over a DataFrame column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqprep.functions import stages as S
from seqprep.functions.options import CleanOptions

Options = CleanOptions | Mapping[str, str] | Column | None

# Names, order and types of the result fields.
RESULT_TYPE = T.StructType(
    [
        T.StructField("seqId", T.StringType()),
        T.StructField("rawSequence", T.StringType()),
        T.StructField("sequence", T.StringType()),
        T.StructField("sequenceLength", T.IntegerType()),
        T.StructField("nonIupacFraction", T.DoubleType()),
        T.StructField("nonACGTNFraction", T.DoubleType()),
        T.StructField("nFraction", T.DoubleType()),
        T.StructField("nNrunsCapped", T.IntegerType()),
        T.StructField("gcContent", T.DoubleType()),
        T.StructField("naturalLanguageDetected", T.BooleanType()),
        T.StructField("endsTrimmed", T.BooleanType()),
        T.StructField("gapsOrWhitespaceRemoved", T.BooleanType()),
        T.StructField("nucleotideSequenceID", T.StringType()),
        T.StructField("invalid", T.BooleanType()),
    ]
)

_TMP = "__seqprep_"


def clean_sequences(
    df: DataFrame,
    column: str | Column,
    options: Options = None,
    *,
    result: str = "result",
    seq_id: Column | None = None,
) -> DataFrame:
    """Add ``result``, a struct of :data:`RESULT_TYPE`; null text, null struct.

    ``options`` holds for all rows (``CleanOptions`` or a dict of text
    overrides) or is a ``map<string,string>`` Column that may differ by row.
    Stateless and narrow: no shuffle, and good for a streaming frame as well.
    """
    staged, fields = _stages(df, column, options, seq_id)
    # A required test on the raw text makes the struct null as a whole.
    raw = fields["rawSequence"]
    struct = F.when(
        raw.isNotNull(), F.struct(*[col.alias(name) for name, col in fields.items()])
    )
    return staged.select(*_own_columns(df), struct.alias(result))


def clean_columns(
    df: DataFrame,
    column: str | Column,
    options: Options = None,
    *,
    keep: list[str | Column] | None = None,
    rename: Mapping[str, str] | None = None,
    fields: list[str] | None = None,
    seq_id: Column | None = None,
) -> DataFrame:
    """``keep`` (default: all columns of ``df``), then the result fields flat.

    ``fields`` picks result fields; Catalyst prunes the stages no field needs.
    """
    staged, computed = _stages(df, column, options, seq_id)
    rename = rename or {}
    names = fields if fields is not None else list(computed)
    return staged.select(
        *(_own_columns(df) if keep is None else keep),
        *[computed[name].alias(rename.get(name, name)) for name in names],
    )


def _row_stages(
    df: DataFrame, raw: Column, options: Column, seq_id: Column | None
) -> tuple[DataFrame, dict[str, Column]]:
    """Options by row: the SQL function, whose generated code stays small enough to compile."""
    from seqprep.functions.sql import register_sql

    register_sql(df.sparkSession, "seqprep_by_row")
    given = df.withColumns({_TMP + "raw": raw, _TMP + "options": options})
    call = F.expr(f"seqprep_by_row({_TMP}raw, {_TMP}options)")
    out = given.withColumn(_TMP + "row", call)
    fields = {name: F.col(_TMP + "row")[name] for name in RESULT_TYPE.names}
    if seq_id is not None:
        fields["seqId"] = seq_id
    return out, fields


def _own_columns(df: DataFrame) -> list[Column]:
    return [F.col(quoted(name)) for name in df.columns]


def quoted(name: str) -> str:
    """A column name as an identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def _stages(
    df: DataFrame, column: str | Column, options: Options, seq_id: Column | None
) -> tuple[DataFrame, dict[str, Column]]:
    """Lay the stages over ``df``.

    Each step is its own projection, so a text that several later expressions
    read is computed once per row. All steps share one generated method, which
    the JVM stops compiling beyond 8,000 bytes; keep the expressions small.
    """

    def tmp(name: str) -> Column:
        return F.col(_TMP + name)

    def step(frame: DataFrame, **columns: Column) -> DataFrame:
        return frame.withColumns({_TMP + name: col for name, col in columns.items()})

    raw = F.col(quoted(column)) if isinstance(column, str) else column
    if isinstance(options, Column):
        return _row_stages(df, raw, options, seq_id)
    out = step(df, raw=raw)
    opt = options if isinstance(options, CleanOptions) else CleanOptions.from_map(options)

    out = step(out, packed=S.strip_whitespace(tmp("raw")))
    out = step(out, upper=S.uppercase(tmp("packed")))
    out = step(
        out,
        language=S.natural_language(tmp("upper"), opt.natural_language_regex),
        ungapped=S.remove_gaps(tmp("upper"), opt.gap_regex),
    )
    out = step(
        out,
        removed=S.shortened(tmp("packed"), tmp("raw"))
        | S.gap_found(tmp("upper"), tmp("ungapped"), opt.gap_regex),
        dna=S.unknown_to_n(S.rna_to_dna(tmp("ungapped"))),
    )
    out = step(out, trimmed=S.trim_to_anchors(tmp("dna"), opt.anchor_chars, opt.anchor_minrun))
    out = step(
        out,
        cut=S.shortened(tmp("trimmed"), tmp("dna")),
        has_run=S.holds_run(tmp("trimmed"), opt.nrun_cap_from),
    )
    out = step(
        out,
        runs=S.capped_runs(tmp("trimmed"), tmp("has_run"), opt.nrun_cap_from),
        final=S.cap_runs(tmp("trimmed"), tmp("has_run"), opt.nrun_cap_from, opt.nrun_cap_to),
    )
    out = step(out, no_gc=S.without_gc(tmp("final")))
    out = step(out, left=S.leftover(tmp("no_gc")), n=S.count_n(tmp("no_gc")))
    out = step(out, length=S.sequence_length(tmp("final"), tmp("left")))
    out = step(
        out,
        non_iupac=S.ratio(
            S.count_non_iupac(tmp("final"), tmp("left"), opt.iupac_dna), tmp("length")
        ),
        acgt=S.count_acgt(tmp("final"), tmp("left"), tmp("n")),
    )
    out = step(out, invalid=S.invalid_flag(tmp("non_iupac"), tmp("language")))

    valid = ~tmp("invalid")
    fields = {
        "seqId": F.lit(None).cast("string") if seq_id is None else seq_id,
        "rawSequence": tmp("raw"),
        "sequence": F.when(valid, tmp("final")),
        "sequenceLength": tmp("length"),
        "nonIupacFraction": tmp("non_iupac"),
        "nonACGTNFraction": S.ratio(S.count_non_acgtn(tmp("left")), tmp("length")),
        "nFraction": S.ratio(tmp("n"), tmp("length")),
        "nNrunsCapped": tmp("runs"),
        "gcContent": S.ratio(S.count_gc(tmp("final"), tmp("no_gc")), tmp("acgt")),
        "naturalLanguageDetected": tmp("language"),
        "endsTrimmed": tmp("cut"),
        "gapsOrWhitespaceRemoved": tmp("removed"),
        "nucleotideSequenceID": F.when(valid, S.sequence_id(tmp("final"))),
        "invalid": tmp("invalid"),
    }
    return out, fields
