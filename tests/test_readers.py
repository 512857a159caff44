import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import rows
from cohortlens.sources import readers, sinks


def test_csv_drop_malformed_independent_of_selection(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "events.csv")
    with open(p, "w") as f:
        f.write("patient_id,event_id,event_description,event_date,value\n")
        f.write("1,DIAG1,d,2020-01-01,1.5\n")
        f.write("2,DIAG2,d,2020-01-02\n")           # short row
        f.write("3,DIAG3,d,2020-01-03,2.0,extra\n")  # long row
        f.write("x,DIAG4,d,2020-01-04,2.0\n")        # bad id
    df = readers.load_csv_as_view(spark, p, readers.EVENTS_SCHEMA)
    assert [r.patient_id for r in df.select("patient_id").collect()] == [1]
    assert spark.table("events").select("event_id").count() == 1
    assert readers.table_name_from_path("/a/b/lab_results.csv") == "lab_results"


def test_code_list_and_zoned_dates(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "codes.txt")
    with open(p, "w") as f:
        f.write("Lantus\n lantus \nV77.1\n\n")
    assert sorted(r.code for r in readers.code_list(spark, p).collect()) == ["lantus", "v77.1"]
    raw = spark.createDataFrame([("7", "2005-03-01T23:10:00Z", "HbA1c", "1,234.5"), ("8", "2005-03-01T00:00:00Z", "x", " ")],
                                "Member_ID string, Date_Resulted string, Result_Name string, Numeric_Result string")
    assert rows(readers.clean_lab_text(raw)) == [(7, dt.date(2005, 3, 1), "hba1c", 1234.5)]


def test_libsvm_and_svmlight_text(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "a.svm")
    with open(p, "w") as f:
        f.write("1 1:0.5 3:1.0\n0 2:2.0\n")
    lib = spark.read.format("libsvm").option("numFeatures", 3).load(p)
    assert lib.count() == 2 and readers.read_libsvm(spark, p, 3).first().features.size == 3
    p0 = os.path.join(tmpdir_path, "zero.svm")
    with open(p0, "w") as f:
        f.write("1 0:0.5 3:1.0\n")
    assert rows(readers.read_svmlight_text(spark, p0), "label", "feature_id", "feature_value") == [
        (1.0, 0, 0.5), (1.0, 3, 1.0)]


def test_image_listing(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "images_001", "images")
    os.makedirs(d)
    for n in ("a.png", "b.png", "c.txt"):
        with open(os.path.join(d, n), "wb") as f:
            f.write(b"x")
    got = sorted(r.image_index for r in readers.image_files(spark, tmpdir_path).collect())
    assert got == ["a.png", "b.png"]


def test_sinks(spark, tmpdir_path):
    rows_ = spark.createDataFrame([(2, "2 1 0:1.000000"), (1, "1 0 3:0.500000")], "patient_id long, line string")
    out = os.path.join(tmpdir_path, "svm")
    sinks.write_svmlight(rows_, out)
    text = [r.value for r in spark.read.text(out).collect()]
    assert sorted(text) == ["0 3:0.500000", "1 0:1.000000"]
    stats = spark.createDataFrame([("alive", 1.0, 2)], "status string, avg_x double, max_x long")
    sinks.write_statistics({"x": stats}, os.path.join(tmpdir_path, "stats"))
    st = spark.read.parquet(os.path.join(tmpdir_path, "stats"))
    assert rows(st) == [("x", "alive", "avg_x", 1.0), ("x", "alive", "max_x", 2.0)]
    sinks.write_submission(spark.createDataFrame([(1, 0)], "patient_id long, prediction int"),
                           os.path.join(tmpdir_path, "sub"))
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "sub")).first().prediction == "0"
    _ = F


def test_zoned_date_is_session_zone_independent(spark):
    df = spark.createDataFrame([("2005-03-01T00:00:00Z",), ("2005-03-01T23:30:00-05:00",)], "x string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [r.d for r in df.select(readers.parse_zoned_date("x", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("d")).collect()]
            assert got == [dt.date(2005, 3, 1), dt.date(2005, 3, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_sequence_and_csv_sinks(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 0, [[1, 2], [3]], "train"), (2, 1, [[4]], "test")],
                               "patient_id long, label int, seqs array<array<bigint>>, split string")
    sinks.write_sequences(df, os.path.join(tmpdir_path, "seq"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "seq"))
    assert {r.split for r in back.collect()} == {"train", "test"}
    assert back.filter("patient_id = 1").first().seqs == [[1, 2], [3]]
    sinks.write_csv(df.select("patient_id", "label"), os.path.join(tmpdir_path, "csv"), sep=";")
    assert spark.read.option("header", True).option("sep", ";").csv(os.path.join(tmpdir_path, "csv")).count() == 2


def test_wide_signal_csv(spark, tmpdir_path):
    import os
    from cohortlens.sources.readers import read_signals
    path = os.path.join(tmpdir_path, "signals.csv")
    with open(path, "w") as f:
        f.write(",X1,X2,X3,y\na,1,2.5,-3,1\nb,4,5,6,5\nc,7,8,1\nd,7,x,9,2\n")
    got = {r.row_name: (r.features, r.label) for r in read_signals(spark, path, n_features=3).collect()}
    assert got == {"a": ([1.0, 2.5, -3.0], 0), "b": ([4.0, 5.0, 6.0], 4)}


def test_malformed_rows_need_no_session_setting(spark, tmpdir_path):
    import os
    from cohortlens.sources.readers import FEATURE_MAP_SCHEMA, read_csv
    before = spark.conf.get("spark.sql.csv.parser.columnPruning.enabled")
    path = os.path.join(tmpdir_path, "map.csv")
    with open(path, "w") as f:
        f.write("idx,event_id\n1,a\n2\n3,b,c\n4,d\n")
    assert [r.event_id for r in read_csv(spark, path, FEATURE_MAP_SCHEMA, drop_malformed=True).select("event_id").collect()] == ["a", "d"]
    assert spark.conf.get("spark.sql.csv.parser.columnPruning.enabled") == before
