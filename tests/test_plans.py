"""Physical-plan invariants: no Cartesian products or row-at-a-time Python in the
registered queries, and Parquet scans read only the columns they need."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
BAD = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython")


def _plan(spark, name):
    """The query's plan, with the plans of all frames that it checkpoints on the way."""
    frame = type(spark.range(0))
    original, plans = frame.checkpoint, []
    text = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def spy(self, *a, **b):
        plans.append(text(self))
        return original(self, *a, **b)

    frame.checkpoint = spy
    try:
        plans.append(text(E.queries()[name](spark, SF)))
    finally:
        frame.checkpoint = original
    return "\n".join(plans)


@pytest.mark.parametrize("name", ["svmlight_lines", "phenotype", "top_events", "visit_sequences", "graph_edges",
                                  "jaccard_top10", "jaccard_all_pairs", "roc_curve", "weighted_sample",
                                  "padded_sequences", "feature_vectors", "ensemble_score", "lr_predict", "sampled_split",
                                  "vector_rows", "multilabel_indicators"])
def test_no_cartesian_or_row_udf(spark, name):
    assert not BAD.search(_plan(spark, name))


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = _plan(spark, "svmlight_lines")
    line_scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem\.parquet", plan)
    assert line_scans and all("l_shipdate" not in s and "l_tax" not in s for s in line_scans)
    cust = [m for m in re.findall(r"FileScan parquet [^\n]*customer\.parquet[^\n]*", plan)]
    assert any("c_acctbal" in s and "LessThan(c_acctbal" in s for s in cust)


def _tables(spark, d):
    """Orders of two patients (one deceased), some far before the window, one without lines; a line of an unknown part."""
    import datetime as dt

    day = lambda y, m: dt.datetime(y, m, 1)
    for name, schema, data in (
            ("customer", "c_custkey long, c_acctbal double, c_mktsegment string", [(1, 5.0, "a"), (2, -5.0, "b")]),
            ("orders", "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string",
             [(1, 1, day(2001, 1), 1.0, "x"), (2, 1, day(2020, 1), 1.0, "x"), (3, 1, day(2021, 6), 1.0, "x"), (4, 2, day(2020, 3), 1.0, "x"), (5, 2, day(2020, 5), 1.0, "x")]),
            ("lineitem", "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double",
             [(1, 1, 1, 2.0, 9.0), (2, 1, 1, 3.0, 8.0), (2, 2, 2, 4.0, 7.0), (4, 2, 1, 5.0, 6.0), (5, 1, 1, 6.0, 5.0), (5, 9, 2, 7.0, 4.0)]),
            ("part", "p_partkey long, p_type string, p_brand string, p_name string, p_size int", [(1, "t1", "B#1", "n1", 3), (2, "t2", "B#2", "n2", 4)])):
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")


def test_window_is_applied_before_the_lines_are_joined(spark, tmpdir_path):
    from cohortlens.operators import cohort
    from cohortlens.plans import QUERIES
    from cohortlens.plans import profile as P
    from conftest import rows
    _tables(spark, tmpdir_path)
    ev, m = P.events(spark, tmpdir_path), P.mortality(spark, tmpdir_path)
    idx = cohort.index_dates(ev, m, P.LEAD_DAYS)
    assert rows(P.index_dates(spark, tmpdir_path)) == rows(idx)
    found = P.filtered(spark, tmpdir_path)
    assert rows(found) == rows(cohort.window_filter(ev, idx, P.WINDOW_DAYS)) and found.count() == 9
    assert rows(P.labels(spark, tmpdir_path)) == rows(cohort.alive_dead_label(ev, m))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")  # the events are made last
    assert "parquet" not in P.normalized(spark, tmpdir_path)._jdf.queryExecution().optimizedPlan().toString()  # computed once
    dx, med, lab = P.pheno_inputs(spark, tmpdir_path)
    graph = QUERIES["load_graph_events"](spark, tmpdir_path)
    assert sorted((r.kind, r.patient_id, r.item, r.date) for r in graph.where("kind <> 'lab'").collect()) == sorted(
        [("diagnostic", r.patient_id, r.code, r.date) for r in dx.collect()] + [("medication", r.patient_id, r.medicine, r.date) for r in med.collect()])
    assert graph._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey") <= 4  # one read of the lines
