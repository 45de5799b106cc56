import datetime as dt

from pyspark.sql import functions as F

from conftest import post
from postscope.sources import posts as S


def test_happy_path(spark, write_posts):
    p = write_posts([post("2021-02-12", "a", "hi"), post("2021-02-13", "b", "yo")])
    df = S.scan_posts(spark, p)
    assert df.count() == 2
    assert dict(df.dtypes)["date"] == "string"


def test_corrupt_line_strict_and_dead_letter(spark, write_posts):
    p = write_posts([post("2021-02-12T10:00:00Z", "a"), '{"date": "2021-02-12T10:', post("2021-02-13T10:00:00Z", "b")])
    parsed = S.scan_posts_strict(spark, p)
    assert parsed.where(S.valid_for("q1")).count() == 2
    dl = S.dead_letter(parsed).collect()
    assert len(dl) == 1 and dl[0].reject_reason == S.REASON_MALFORMED and dl[0].raw.startswith('{"date"')
    # fixed-schema scan keeps the line as a row of nulls
    assert S.scan_posts(spark, p).where("date is not null").count() == 2


def test_empty_file(spark, write_posts):
    p = write_posts([])
    assert S.scan_posts(spark, p).count() == 0
    assert S.scan_posts_strict(spark, p).count() == 0


def test_null_values(spark, write_posts):
    p = write_posts([{"date": "2021-02-12", "content": None, "user": None}])
    r = S.scan_posts(spark, p).collect()[0]
    assert r.user is None and r.content is None


def test_blank_lines_skipped(spark, write_posts):
    p = write_posts([post("2021-02-12", "a"), "", "   ", "\t", post("2021-02-13", "b")])
    assert S.scan_posts_strict(spark, p).count() == 2


def test_malformed_rejected_whatever_is_selected_h1(spark, write_posts):
    p = write_posts(['{"date":"BROKEN ', "[1]", '{"date":5,"user":"str"}', post("2021-02-12T10:00:00Z", "ok")])
    parsed = S.scan_posts_strict(spark, p)
    assert parsed.where("reject_reason is not null").count() == 3
    assert parsed.where("reject_reason is not null").select("date").count() == 3
    assert parsed.where(S.valid_for("q1")).select(F.col("user.username")).collect()[0][0] == "ok"
    reasons = sorted(r.reject_reason for r in parsed.where("reject_reason is not null").collect())
    assert reasons == ["malformed_json", "not_an_object", "wrong_type"]


def test_validity_per_question_v13(spark, write_posts):
    p = write_posts([post("2021-02-12T10:00:00Z", "a", mentions=["x"])])
    parsed = S.scan_posts_strict(spark, p)
    assert parsed.where(S.valid_for("q1")).count() == 1
    assert parsed.where(S.valid_for("q3")).count() == 1
    assert parsed.where(S.valid_for("q2")).count() == 0


def test_records_variant(spark, write_posts):
    p = write_posts(['{"truncated": true, "x": 1}', "not json"])
    rec = S.scan_records(spark, p)
    assert rec.count() == 1
    assert rec.select(F.variant_get("v", "$.x", "int")).collect()[0][0] == 1


def test_result_to_json_and_output_path(spark):
    df = spark.createDataFrame([(dt.date(2021, 2, 12), 'u"\\', 7, None, 1.5)], "date date, top_user string, n long, m long, x double")
    assert S.result_to_json(df).collect()[0].json == '["2021-02-12","u\\"\\\\",7,null,1.5]'
    paths = {"b/input/x.json": "b/output/x.json", "input/sub/x.json": "output/sub/x.json", "b/y.json": "output/y.json",
             "gs://b/data/x.json": "gs://b/output/x.json", "gs://b/input/a/x.json": "gs://b/output/a/x.json"}
    df = spark.createDataFrame([(k,) for k in paths], "p string")
    assert {r.p: r.o for r in df.select("p", S.output_path_for(F.col("p")).alias("o")).collect()} == paths


def test_columnar_and_partition_pruning(spark, write_posts, tmp_path):
    from postscope.functions.days import post_day_utc

    p = write_posts([post(f"2021-02-{d:02d}T10:00:00Z", "a", "t") for d in (1, 1, 2, 3)])
    out = str(tmp_path / "by_day")
    S.partition_by_day(S.scan_posts(spark, p), post_day_utc("date"), out)
    back = spark.read.parquet(out).where("year = 2021 and month = 2 and day = 1")
    assert back.count() == 2
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    col = str(tmp_path / "col")
    S.to_columnar(S.scan_posts(spark, p), col, ["date", "user"])
    assert spark.read.parquet(col).columns == ["date", "user"]


def test_inferred_schema(spark, write_posts):
    p = write_posts([{"date": "x", "extra": 5}])
    assert "extra" in S.scan_posts_inferred(spark, p).columns


def test_on_error_fail_v12(spark, write_posts):
    import pytest

    p = write_posts([post("2021-02-12T10:00:00Z", "a"), '{"date": "2021-02-12T10:'])
    with pytest.raises(Exception, match="malformed_json"):
        S.scan_posts_strict(spark, p, on_error="fail").select("date").collect()
    ok = write_posts([post("2021-02-12T10:00:00Z", "a")])
    assert S.scan_posts_strict(spark, ok, on_error="fail").count() == 1


def test_standard_json_only(spark, write_posts):
    p = write_posts(["{'date': '2021-02-12T10:00:00Z', 'user': {'username': 'a'}}", '{"id": NaN}',
                     post("2021-02-12T10:00:00Z", "b")])
    parsed = S.scan_posts_strict(spark, p)
    assert sorted(r.reject_reason or "ok" for r in parsed.collect()) == ["malformed_json", "malformed_json", "ok"]
    fixed = S.scan_posts(spark, p)
    assert fixed.where("date is not null").count() == 1


def test_exact_types_v14(spark, write_posts):
    p = write_posts([
        '{"date": 5, "user": {"username": "a"}}',
        '{"date": "2021-02-12T10:00:00Z", "user": {"username": 7}}',
        '{"date": "2021-02-12T10:00:00Z", "mentionedUsers": [{"username": "x"}, {"username": 3}]}',
        '{"date": "2021-02-12T10:00:00Z", "content": null, "user": {"username": "ok"}, "mentionedUsers": null}',
    ])
    rows = S.scan_posts_strict(spark, p).collect()
    assert [r.reject_reason for r in rows] == ["wrong_type", "wrong_type", "wrong_type", None]
    assert rows[0].date is None and rows[0].user.username == "a"
    assert [tuple(r.valid) for r in rows] == [(False, False, False), (False, False, False), (False, False, False), (True, False, True)]


def test_repeated_key_takes_the_last_value(spark, write_posts):
    p = write_posts(['{"id": 1, "id": 2, "content": "a", "content": "b"}'])
    row = S.scan_posts_strict(spark, p).first()
    assert (row.id, row.content, row.reject_reason, row.valid.q2, row.valid.q1) == (2, "b", None, True, False)


def test_trailing_text_is_no_record(spark, write_posts):
    p = write_posts(['{"x": 1} more', '{"x": 1}{"x": 2}', '{"x": 1},{"x": 2}', ' {"x": 3} '])
    assert [r[0] for r in S.scan_records(spark, p).select(F.variant_get("v", "$.x", "int")).collect()] == [3]


def test_partition_by_day_bounds_files_and_splits_hot_days(spark, tmp_path):
    df = spark.range(0, 60000, 1, 16).select(
        "id", F.date_add(F.lit("2021-01-01").cast("date"), F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 20).cast("int")).alias("d"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, "64k")
        S.partition_by_day(df, F.col("d"), str(tmp_path / "days"))
    finally:
        spark.conf.set(key, old)
    back = spark.read.parquet(str(tmp_path / "days")).select("*", "_metadata.file_path")
    files = {tuple(r)[:3]: r.n for r in back.groupBy("year", "month", "day").agg(F.count_distinct("file_path").alias("n")).collect()}
    assert back.count() == 60000 and len(files) == 20
    assert max(files.values()) > 1 and sum(files.values()) < 16 * 20 / 2
