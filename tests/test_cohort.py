import datetime as dt

from conftest import rows
from cohortlens.operators import cohort, stats

D = dt.date


def _events(spark):
    data = [
        (1, "DIAG_A", D(2020, 1, 1), 1.0), (1, "DIAG_A", D(2020, 1, 5), 2.0), (1, "LAB_X", D(2014, 7, 14), 3.0),
        (2, "DRUG_B", D(2020, 3, 1), 1.0), (2, "DIAG_A", D(2020, 3, 31), None), (2, "LAB_X", D(2020, 4, 1), 5.0),
        (3, "LAB_X", D(2019, 1, 1), 2.0),
    ]
    return spark.createDataFrame(data, "patient_id long, event_id string, event_date date, value double")


def _mortality(spark):
    return spark.createDataFrame([(2, D(2020, 4, 30), 1), (9, D(2021, 1, 1), 1)],
                                 "patient_id long, death_date date, label int")


def test_alive_dead_split(spark):
    ev, m = _events(spark), _mortality(spark)
    assert {r.patient_id for r in cohort.alive_events(ev, m).collect()} == {1, 3}
    assert {r.patient_id for r in cohort.dead_events(ev, m).collect()} == {2}
    assert rows(cohort.alive_dead_label(ev, m)) == [(1, 0), (2, 1), (3, 0)]


def test_index_dates(spark):
    idx = cohort.index_dates(_events(spark), _mortality(spark), 30)
    # alive → last event; dead → death − 30 days, also for a deceased patient without events
    assert rows(idx) == [(1, D(2020, 1, 5)), (2, D(2020, 3, 31)), (3, D(2019, 1, 1)), (9, D(2020, 12, 2))]


def test_window_filter_bounds(spark):
    ev = _events(spark)
    idx = cohort.index_dates(ev, _mortality(spark), 30)
    out = cohort.window_filter(ev, idx, 2000, keep=("patient_id", "event_id", "event_date"))
    got = rows(out)
    # patient 1: 2014-07-14 is exactly 2001 days before 2020-01-05 → dropped; 2020-01-01 kept
    assert (1, "LAB_X", D(2014, 7, 14)) not in got
    assert (1, "DIAG_A", D(2020, 1, 1)) in got and (1, "DIAG_A", D(2020, 1, 5)) in got
    # patient 2: index 2020-03-31; 2020-04-01 is after the index date → dropped
    assert (2, "LAB_X", D(2020, 4, 1)) not in got and (2, "DIAG_A", D(2020, 3, 31)) in got
    out2000 = cohort.window_filter(ev, idx, 2001, keep=("patient_id", "event_id", "event_date"))
    assert (1, "LAB_X", D(2014, 7, 14)) in rows(out2000)


def test_time_difference(spark):
    ev, m = _events(spark), _mortality(spark)
    dead = rows(cohort.time_difference(ev, m, "dead"), "patient_id", "event_id", "label", "time_difference")
    assert dead == [(2, "DIAG_A", 1, 0), (2, "DRUG_B", 1, 30), (2, "LAB_X", 1, -1)]
    alive = rows(cohort.time_difference(ev, m, "alive"), "patient_id", "label", "time_difference")
    assert (1, 0, 0) in alive and (1, 0, 4) in alive and (3, 0, 0) in alive


def test_statistics(spark):
    ev, m = _events(spark), _mortality(spark)
    ec = {r.status: r for r in stats.event_count_metrics(ev, m).collect()}
    assert (ec["alive"].min_event_count, ec["alive"].max_event_count, ec["alive"].avg_event_count) == (1, 3, 2.0)
    assert (ec["dead"].min_event_count, ec["dead"].max_event_count) == (3, 3)
    enc = {r.status: r for r in stats.encounter_count_metrics(ev, m).collect()}
    assert enc["alive"].median_encounter_count == 2.0  # patients 1 (3 dates) and 3 (1 date)
    rl = {r.status: r for r in stats.record_length_metrics(ev, m).collect()}
    assert rl["dead"].max_record_length == 31 and rl["alive"].min_record_length == 0


def test_top_events_ties_by_id(spark):
    data = [(1, "DIAG_B", D(2020, 1, 1), 1.0), (1, "DIAG_A", D(2020, 1, 1), 1.0), (2, "DIAG_C", D(2020, 1, 1), 1.0),
            (2, "DIAG_C", D(2020, 1, 2), 1.0), (3, "LAB_X", D(2020, 1, 1), 1.0)]
    ev = spark.createDataFrame(data, "patient_id long, event_id string, event_date date, value double")
    m = spark.createDataFrame([], "patient_id long, death_date date, label int")
    top = rows(stats.top_events(ev, m, k=2), "event_class", "rank", "event_id", "event_count")
    assert top == [("DIAG", 1, "DIAG_C", 2), ("DIAG", 2, "DIAG_A", 1), ("LAB", 1, "LAB_X", 1)]


def test_status_ignores_duplicate_mortality_rows(spark):
    ev = _events(spark)
    m = _mortality(spark).unionByName(_mortality(spark))
    ec = {r.status: r.max_event_count for r in stats.event_count_metrics(ev, m).collect()}
    assert ec == {"alive": 3, "dead": 3}
    assert len(cohort.alive_dead_label(ev, m).collect()) == 3
