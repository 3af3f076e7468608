from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from leafmill.operators.timestamps import build_dictionary, found_instants, normalise_timestamps, parse_timestamp

US = 1_000_000


def at(*parts):
    return int(datetime(*parts, tzinfo=timezone.utc).timestamp()) * US


@pytest.mark.parametrize(
    ("text", "locale", "tz", "want"),
    [
        ("2024-01-02T03:04:05Z", "en_US", "Asia/Tokyo", at(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02 03:04:05 +0530", "en_US", "UTC", at(2024, 1, 1, 21, 34, 5)),
        ("12/09/2024 14:18", "en_GB", "Europe/London", at(2024, 9, 12, 13, 18)),
        ("12/09/2024 2:18 PM", "en_US", "America/New_York", at(2024, 12, 9, 19, 18)),
        ("2020年1月28日 上午12:05", "zh_CN", "UTC", at(2020, 1, 28, 0, 5)),
        ("2020年1月28日 下午12:05", "zh_CN", "UTC", at(2020, 1, 28, 12, 5)),
        ("２０２３－０７－１３ １９：２８", "zh_CN", "Asia/Shanghai", at(2023, 7, 13, 11, 28)),
        ("3. Oktober 2019, 05:41 Uhr", "de_DE", "Europe/Berlin", at(2019, 10, 3, 3, 41)),
        ("十二月 24, 2024", "zh_CN", "Asia/Shanghai", at(2024, 12, 23, 16)),
        ("last modified on November 28, 2020 5:26 PM", "en_GB", "Europe/London", at(2020, 11, 28, 17, 26)),
        ("2021-06-16 00:14:58 America/New_York", "en_US", "UTC", at(2021, 6, 16, 4, 14, 58)),
        ("2024-10-05T16:23:37+08:00[Asia/Shanghai]", "zh_CN", "UTC", at(2024, 10, 5, 8, 23, 37)),
        ("1685694504", "zh_CN", "UTC", 1685694504 * US),
        ("1727712823188", "zh_CN", "UTC", 1727712823188 * 1000),
        ("20190222T060531Z", "zh_CN", "UTC", at(2019, 2, 22, 6, 5, 31)),
        ("2023-03-20 18:48 CET", "de_DE", "Europe/Berlin", at(2023, 3, 20, 17, 48)),
        ("3rd November 2024 at 01:14", "en_US", "America/New_York", at(2024, 11, 3, 5, 14)),  # twice: the first
        ("2024-03-31 02:09:00", "de_DE", "Europe/Berlin", at(2024, 3, 31, 1, 9)),  # skipped: moves on by the gap
    ],
)
def test_instants(text, locale, tz, want):
    assert parse_timestamp(text, locale, tz) == ("instant", want, None)


def test_cut_beyond_microseconds():
    assert parse_timestamp("2016-07-06T12:42:56.343079633Z", None, None)[1] == at(2016, 7, 6, 12, 42, 56) + 343079


@pytest.mark.parametrize("text", [None, "", "  ", "unknown", "2023-13-05", "31/04/2020 09:15", "25:61", "2021-06-", "0000-00-00 00:00:00", "—", "x" * 5000, "2022-01-01 10:00 XYZ"])
def test_no_instant(text):
    assert parse_timestamp(text, "en_GB", "UTC")[0] == "none"


def test_rows_relative_texts_and_clashing_columns(spark):
    ref = datetime(2025, 3, 30, 12, 0, 0)
    rows = [
        (1, "昨天 05:30", "zh_CN", "Asia/Shanghai", ref, "a", 7), (2, "8 hours ago", "en_US", "UTC", ref, "b", 8), (3, None, None, None, ref, None, None), (4, "gestern um 02:30", "de_DE", "Europe/Berlin", datetime(2025, 3, 31, 12), "c", 1), (4, "gestern um 02:30", "de_DE", "Europe/Berlin", datetime(2025, 3, 31, 12), "c", 1),
        (5, "yesterday at 1:00 AM", "en_US", "No/Where", ref, None, 2), (6, "2024-01-01", "en_US", None, None, None, 3), (7, "vor 5 Minuten", "de_DE", "UTC", None, None, 3),
    ]
    df = spark.createDataFrame(rows, "meta_id long, raw string, locale string, tz string, at timestamp, kind string, epoch_us long")
    out = normalise_timestamps(df, "raw", "locale", "tz", "at")
    assert out.columns == ["meta_id", "raw", "locale", "tz", "at", "kind", "epoch_us"]
    got = sorted(((r.meta_id, r.epoch_us) for r in out.collect()), key=lambda r: r[0])
    assert got == [(1, at(2025, 3, 28, 21, 30)), (2, at(2025, 3, 30, 4)), (3, None), (4, at(2025, 3, 30, 1, 30)), (4, at(2025, 3, 30, 1, 30)), (5, at(2025, 3, 29, 1)), (6, at(2024, 1, 1)), (7, None)]


def test_empty_table_and_incremental_dictionary(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-02", "en_US", "UTC", None)], "meta_id long, raw string, locale string, tz string, at timestamp")
    assert normalise_timestamps(df.where("meta_id < 0"), "raw", "locale", "tz", "at").count() == 0
    path = str(tmp_path / "dictionary")
    for _ in range(2):
        assert normalise_timestamps(df, "raw", "locale", "tz", "at", path).first().epoch_us == at(2024, 1, 2)
    assert spark.read.option("recursiveFileLookup", "true").parquet(path).count() == 1


def test_hot_text(spark):
    df = spark.range(5000).selectExpr("id AS meta_id", "'tree' AS tree_id", "CASE WHEN id % 3 = 0 THEN concat('2024-01-01 00:00:', lpad(id % 60, 2, '0')) ELSE '2024-05-05' END AS last_modified", "current_timestamp() AS extracted_at")
    trees = spark.createDataFrame([("tree", "en_US", "UTC")], "tree_id string, locale string, tz string")
    got = found_instants(df, trees)
    assert got.count() == 5000
    assert got.where(f"epoch_us = {at(2024, 5, 5)}").count() == 5000 - len(range(0, 5000, 3))


def test_longer_and_rarer_forms(spark):
    cases = [
        ("1 Mar 24", "2024-03-01 00:00:00"), ("2024-W10-5", "2024-03-08 00:00:00"), ("1709287200.5", "2024-03-01 10:00:00.5"), ("2024/3/1 下午3点20分", "2024-03-01 15:20:00"), ("01.03.24 10:00", "2024-03-01 10:00:00"),
        ("2024-03-01T10:00:00Z [" + "x" * 300 + "]", "2024-03-01 10:00:00"), ("3 months ago", "2023-12-31 12:00:00"), ("vor 2 Jahren", "2022-03-31 12:00:00"), ("last week", "2024-03-24 12:00:00"), ("上个月", "2024-02-29 12:00:00"),
        ("2024-W60-5", None), ("99999999999999999 hours ago", None), ("99999999 years ago", None), ("31 Feb 24", None),
    ]
    df = spark.createDataFrame([(t, "en_US", "UTC") for t, _ in cases], "t string, l string, z string").withColumn("r", F.lit("2024-03-31 12:00:00").cast("timestamp"))
    got = {r.t: r.at for r in normalise_timestamps(df, "t", "l", "z", "r").select("t", F.timestamp_micros("epoch_us").cast("string").alias("at")).collect()}
    assert got == dict(cases)


def test_months_back_follow_the_zone_and_unknown_zones_give_no_instant(spark):
    rows = [("1 month ago", "Europe/Berlin"), ("1 month ago", "Mars/Base"), ("2024-03-01 10:00", "Mars/Base"), ("2024-03-01 10:00Z", "Mars/Base"), ("2024-03-01 10:00", None), ("2 hours ago", "Mars/Base")]
    df = spark.createDataFrame([(t, "en_US", z) for t, z in rows], "t string, l string, z string").withColumn("r", F.lit("2024-04-15 10:00:00").cast("timestamp"))
    got = {(r.t, r.z): r.at for r in normalise_timestamps(df, "t", "l", "z", "r", strict_zones=True).select("t", "z", F.timestamp_micros("epoch_us").cast("string").alias("at")).collect()}
    assert [got[k] for k in rows] == ["2024-03-15 11:00:00", None, None, "2024-03-01 10:00:00", "2024-03-01 10:00:00", "2024-04-15 08:00:00"]


def test_stored_dictionary_survives_repeated_and_overlapping_runs(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    make = lambda texts: spark.createDataFrame([(i, t, "en_US", "UTC") for i, t in enumerate(texts)], "i int, t string, l string, z string").withColumn("r", F.current_timestamp())
    run = lambda texts: sorted((r.i, r.epoch_us) for r in normalise_timestamps(make(texts), "t", "l", "z", "r", path).collect())
    first = run(["2024-03-01", "2024-03-02"])
    stored = spark.read.option("recursiveFileLookup", "true").parquet(path).count()
    assert run(["2024-03-01", "2024-03-02"]) == first and spark.read.option("recursiveFileLookup", "true").parquet(path).count() == stored == 2
    build_dictionary(make(["2024-03-01"]).selectExpr("t raw", "l locale", "z tz")).write.parquet(f"{path}/keys-another-run")
    assert run(["2024-03-01", "2024-03-02"]) == first and len(run(["2024-03-02", "2024-03-03", None])) == 3
