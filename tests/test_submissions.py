"""Payloads of submissions are parsed once, whatever is filtered."""

from reviewloom.operators import submissions

SCHEMA = "Id bigint, Status string, DateSubmitted string, Ratings array<struct<Question:string,Rating:string>>"


def test_one_parse(spark):
    rows = [
        ('{"Id": 1, "Status": "Removed", "DateSubmitted": "2024-01-01T00:00:00"}', 1),
        ('{"Id": 2, "Status": "Published", "DateSubmitted": "2024-01-02T00:00:00", "Ratings": [{"Question": "10001", "Rating": "4"}]}', 2),
        ('{"Id": 3, "DateSubmitted": "never"}', 3),
        ("no payload", 4),
        (None, 5),
        ("", 6),
    ]
    df = spark.createDataFrame(rows, "Data string, n int")
    out = submissions.load_submissions(df, "Data", SCHEMA, keep=["n"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    got = {r["n"]: (r["Id"], r["Status"], r["Q_10001"]) for r in out.collect()}
    assert got == {2: (2, "Published", "4"), 3: (3, None, None), 4: (None,) * 3, 5: (None,) * 3, 6: (None,) * 3}
    assert submissions.load_submissions(df.limit(0), "Data", SCHEMA).count() == 0
