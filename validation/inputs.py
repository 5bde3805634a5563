"""Input relations derived from the given tables.

Each text runs unchanged in Spark SQL and DuckDB; ``{table}`` is a given table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from seqprep import Vocabulary

# One sequence per line item: primers, gaps, RNA, unknowns, N runs, foreign
# letters, natural language, empty and missing ones.
SEQUENCES = """
SELECT
  concat('ds-', CAST(l_suppkey % 7 AS VARCHAR(20))) AS datasetkey,
  l_orderkey * 10 + l_linenumber AS gbifid,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL
       WHEN l_orderkey % 13 = 1 THEN ''
       ELSE concat(
         CASE WHEN l_orderkey % 7 = 0 THEN 'Primer XX ' ELSE '' END,
         translate(md5(concat(CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20)))),
                   '0123456789abcdef', 'ACGTACGTACGTACGT'),
         CASE l_orderkey % 5 WHEN 0 THEN 'NNNNNNNNN' WHEN 1 THEN '--..' WHEN 2 THEN 'uu??' WHEN 3 THEN ' ' ELSE '' END,
         translate(md5(concat(CAST(l_partkey AS VARCHAR(20)), 'p')),
                   '0123456789abcdef', 'acgtacgtacgtacgr'),
         CASE l_orderkey % 11 WHEN 0 THEN 'UNMERGED' WHEN 1 THEN 'XZ' WHEN 2 THEN 'XACGTACGTACGT' ELSE '' END)
  END AS v_dnasequence
FROM {lineitem}
"""

# Three levels: supplier below nation below region.
CONCEPTS = """
SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))) AS id, r_name AS name, CAST(NULL AS VARCHAR(20)) AS parent_id FROM {region}
UNION ALL
SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))), n_name, concat('r', CAST(n_regionkey AS VARCHAR(20))) FROM {nation}
UNION ALL
SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))), s_name, concat('n', CAST(s_nationkey AS VARCHAR(20))) FROM {supplier}
"""

# Unique labels, one label that all regions share, and region labels that equal
# the name of a nation, which wins.
LABELS = """
SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))) AS concept_id, concat('Nation no. ', CAST(n_nationkey AS VARCHAR(20))) AS label FROM {nation}
UNION ALL
SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))), 'Shared label' FROM {region}
UNION ALL
SELECT concat('r', CAST(n_regionkey AS VARCHAR(20))), n_name FROM {nation}
"""

# Labels in three languages: one of a single concept in each, one that regions share in one
# language only, and nation names that a region has as a label.
LANGUAGE_LABELS = """
SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))) AS concept_id,
  concat(CASE n_nationkey % 3 WHEN 0 THEN 'Land ' WHEN 1 THEN 'Country ' ELSE 'Pays ' END, CAST(n_nationkey % 4 AS VARCHAR(20))) AS label,
  CASE n_nationkey % 3 WHEN 0 THEN 'de' WHEN 1 THEN 'en' ELSE 'fr' END AS language FROM {nation}
UNION ALL
SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))), 'Zone', CASE WHEN r_regionkey = 0 THEN 'de' ELSE 'en' END FROM {region}
UNION ALL
SELECT concat('r', CAST(n_regionkey AS VARCHAR(20))), n_name, 'de' FROM {nation}
UNION ALL
SELECT concat('s', CAST(s_suppkey AS VARCHAR(20))), concat('Firma ', CAST(s_suppkey % 5 AS VARCHAR(20))),
  CASE WHEN s_suppkey <= 5 THEN 'en' WHEN s_suppkey % 2 = 0 THEN 'de' ELSE NULL END FROM {supplier}
"""

TERMS = """
SELECT concat('ds-', CAST(c_nationkey AS VARCHAR(20))) AS datasetkey, c_custkey AS gbifid,
  CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN lower(n_name) WHEN 2 THEN concat('  ', n_name, ' ')
       WHEN 3 THEN 'no such term' WHEN 4 THEN s_name WHEN 5 THEN 'shared label'
       WHEN 6 THEN concat('nation NO. ', CAST(n_nationkey AS VARCHAR(20))) ELSE n_name END AS v_targetgene
FROM (SELECT *, c_custkey % (SELECT count(*) FROM {supplier}) + 1 AS pick FROM {customer}) c
JOIN {nation} ON c_nationkey = n_nationkey
JOIN {supplier} ON s_suppkey = pick
"""

# One term per line item: a third of the rows hold one term, a fifth hold none.
SKEWED_TERMS = """
SELECT concat('ds-', CAST(l_suppkey % 7 AS VARCHAR(20))) AS datasetkey,
  l_orderkey * 10 + l_linenumber AS gbifid,
  CASE WHEN l_orderkey % 3 = 0 THEN ' Asia'
       WHEN l_orderkey % 10 < 3 THEN NULL
       WHEN l_orderkey % 10 = 3 THEN concat('part ', CAST(l_partkey AS VARCHAR(20)))
       ELSE concat('supplier#', lpad(CAST(l_suppkey AS VARCHAR(20)), 9, '0')) END AS v_targetgene
FROM {lineitem}
"""

_TABLE = re.compile(r"\{(\w+)\}")


def derive(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """One of the relations above as a DataFrame over parquet files."""
    tables = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in set(_TABLE.findall(text))
    }
    return spark.sql(text, **tables)


def vocabulary(spark: SparkSession, sf_dir: str) -> Vocabulary:
    return Vocabulary(derive(spark, sf_dir, CONCEPTS), derive(spark, sf_dir, LABELS))


def duckdb_text(text: str) -> str:
    """The same relation over DuckDB views named like the tables."""
    return _TABLE.sub(r"\1", text)
