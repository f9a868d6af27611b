import datetime as dt

from pyspark.sql import functions as F

from venueweave.llm import survivors

ROWS = "venue_id bigint, raw_id bigint, website string, phone string, last_inspection string, cuisine string, fetched_at timestamp, score double, field string"


def test_latest_real_values(spark):
    at = lambda d: dt.datetime(2026, 1, d)
    data = [
        (1, 10, "HTTP://WWW.A.example/x", "555", "01/02/2020", "n/a", at(1), 0.5, "clash"),
        (1, 11, "TBD", "200-555-0100", "2099-01-01", " Dim_Sum ", at(2), None, "clash"),
        (1, 12, None, "2005550101", None, None, at(2), 0.9, "clash"),
        (2, 20, None, None, None, None, None, None, "clash"),
        (None, 30, "b.example", None, None, None, at(1), None, "clash"),
    ]
    frame = spark.createDataFrame(data, ROWS)
    found = {tuple(r) for r in survivors.best_values(frame, "venue_id", survivors.rec_fields(), F.col("fetched_at"), F.col("raw_id")).collect()}
    assert found == {(1, "website", "a.example"), (1, "phone", "2005550100"), (1, "last_inspection", "2020-01-02"), (1, "cuisine", "dim sum")}
    best = survivors.best_record(frame, "venue_id", survivors.rec_fields(), F.col("score"), F.col("fetched_at"), F.col("raw_id"))
    assert {(r["venue_id"], r["raw_id"], r["completeness"]) for r in best.collect()} == {(1, 10, 2), (2, 20, 0)}
    assert survivors.best_values(frame.limit(0), "venue_id", survivors.rec_fields(), F.col("fetched_at"), F.col("raw_id")).count() == 0
