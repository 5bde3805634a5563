from __future__ import annotations

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from seqprep.plans import reports
from validation import registry

SF_DIR = "/root/testdata/sf0.001"


def cleaned(spark, rows):
    return spark.createDataFrame(
        rows,
        "datasetkey STRING, sequenceLength INT, nFraction DOUBLE, nonACGTNFraction DOUBLE, gcContent DOUBLE, "
        "nucleotideSequenceID STRING, cleaned_sequence STRING",
    )


def test_averages_weigh_bases(spark):
    rows = [("a", 10, 0.2, 0.1, 3 / 7, "x", "s"), ("a", 30, 0.0, 0.0, 0.5, "y", "t"), ("a", None, None, None, None, None, None)]
    rows += [("b", 0, None, None, None, None, ""), ("c", None, None, None, None, None, None)]
    got = {r.datasetkey: tuple(r)[1:] for r in reports.dataset_averages(cleaned(spark, rows)).collect()}
    assert got["a"] == (20.0, 18 / 37, 2 / 40, 1 / 40)
    assert got["b"] == (0.0, None, None, None) and got["c"] == (None, None, None, None)


def test_averages_do_not_depend_on_the_order(spark):
    rng = random.Random(1)
    rows = [("d", n := rng.randint(50, 900), rng.randint(0, 20) / n, 0.0, rng.random(), "x", "s") for _ in range(3000)]
    results = set()
    for parts in (1, 3, 17):
        rng.shuffle(rows)
        results.add(tuple(reports.dataset_averages(cleaned(spark, rows).repartition(parts)).first()))
    assert len(results) == 1


def test_sketches_of_batches_keep_their_ranks(spark):
    rng = random.Random(2)
    lengths = [int(rng.lognormvariate(6, 1)) for _ in range(40_000)]
    rows = [("d", n, 0.0, 0.0, 0.5, "x", "s") for n in lengths] + [("empty", None, None, None, None, None, None)]
    batches = [reports.length_sketches(cleaned(spark, rows[b::7])) for b in range(7)]
    (got,) = reports.length_quantiles(reports.merge_sketches(batches), (0.05, 0.5, 0.99)).collect()
    assert (got.datasetkey, got.n) == ("d", len(lengths))
    for rank, length in zip((0.05, 0.5, 0.99), got.quantiles):
        below, up_to = sum(n < length for n in lengths), sum(n <= length for n in lengths)
        assert below / len(lengths) - 0.02 <= rank <= up_to / len(lengths) + 0.02


def test_catalogues_merge_in_any_order(spark):
    rng = random.Random(3)
    rows = [(f"d{rng.randrange(4)}", 4, 0.0, 0.0, 0.5, rng.choice([None, *"pqrst"]), "s") for _ in range(300)]
    want = sorted(map(tuple, reports.distinct_sequences(cleaned(spark, rows)).collect()))
    states = [reports.catalogue_state(cleaned(spark, rows[b::3])) for b in range(3)]
    for order in itertools.permutations(range(3)):
        merged = reports.merge_catalogues([states[order[0]], states[order[1]]])
        got = reports.catalogue(reports.merge_catalogues([merged, states[order[2]]]))
        assert sorted(map(tuple, got.collect())) == want


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
def test_quantiles_of_the_given_tables(spark):
    got = {r.datasetkey: r for r in registry.queries()["length_quantiles"](spark, SF_DIR).collect()}
    exact = registry.process_sequences(registry.sequences(spark, SF_DIR)).where("sequenceLength IS NOT NULL")
    for key, n, low, high in exact.groupBy("datasetkey").agg(
        F.count(F.lit(1)), F.expr("percentile(sequenceLength, array(0.23, 0.48, 0.73))"), F.expr("percentile(sequenceLength, array(0.27, 0.52, 0.77))")
    ).collect():
        assert got[key].n == n
        assert all(a - 1 <= q <= b + 1 for a, q, b in zip(low, got[key].quantiles, high))


REPORTS = [(reports.distinct_sequences, 1), (reports.length_sketches, 3), (reports.catalogue_state, 1)]


@pytest.mark.parametrize("report, left", REPORTS)
def test_no_filter_repeats_the_cleaning(spark, report, left):
    rows = [("a", 1, "ACGTACGTACGTACGT"), ("a", 2, None), ("b", 3, ""), ("c", 4, None), ("d", 5, "ACGT-ACGTACGTUNMERGED")]
    given = spark.createDataFrame(rows, "datasetkey string, gbifid long, v_dnasequence string").where("gbifid > 0")
    got = report(registry.process_sequences(given))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp" in line]
    assert got.count() == left
