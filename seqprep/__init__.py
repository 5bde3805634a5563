"""Clean nucleotide sequences and look up vocabulary terms, as Spark plans."""

from seqprep.functions.options import CleanOptions
from seqprep.functions.sql import register_lookup, register_lookup_lineage, register_lookup_view, register_sql
from seqprep.operators.clean import RESULT_TYPE, clean_columns, clean_sequences
from seqprep.operators.limits import LookupLimits
from seqprep.operators.lookup import LINEAGE_TYPE, lookup
from seqprep.operators.vocabulary import ambiguous_keys, ambiguous_labels, concept_lineage, vocabulary_keys
from seqprep.plans.process_sequences import process_sequences, process_sequences_job
from seqprep.plans.vocabulary_lookup import lookup_job, lookup_terms
from seqprep.sources.vocabulary import Vocabulary, read_vocabulary

__all__ = [
    "LINEAGE_TYPE",
    "RESULT_TYPE",
    "CleanOptions",
    "LookupLimits",
    "Vocabulary",
    "ambiguous_keys",
    "ambiguous_labels",
    "clean_columns",
    "clean_sequences",
    "concept_lineage",
    "lookup",
    "lookup_job",
    "lookup_terms",
    "process_sequences",
    "process_sequences_job",
    "read_vocabulary",
    "register_lookup",
    "register_lookup_lineage",
    "register_lookup_view",
    "register_sql",
    "vocabulary_keys",
]
