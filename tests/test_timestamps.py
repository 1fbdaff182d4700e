import datetime as dt
import zoneinfo

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from groundmill.operators import timestamps as T

OFFICES = [("BEL", "America/New_York", "MDY"), ("DUN", "Europe/London", "DMY"), ("GOR", "Asia/Kolkata", "DMY"), ("ELM", "America/Los_Angeles", "MDY"), ("XXX", None, None)]
OFFICE_SCHEMA = "office_code string, zone_name string, date_order string"

CASES = [
    ("BEL", "2024-01-05", "2024-01-05"),
    ("BEL", "  2024-01-05\n", "2024-01-05"),
    ("BEL", "2024-01-05 10:00:00", "2024-01-05T15:00:00.000000Z"),
    ("BEL", "2024-01-05T10:00", "2024-01-05T15:00:00.000000Z"),
    ("BEL", "2024-03-23 03:16:37,985", "2024-03-23T07:16:37.985000Z"),
    ("BEL", "2024-01-05T10:00:00.123456789Z", "2024-01-05T10:00:00.123456Z"),
    ("BEL", "2024-01-05T10:00:00-08:00[America/Los_Angeles]", "2024-01-05T18:00:00.000000Z"),
    ("BEL", "2022-05-22 01:47 America/Los_Angeles", "2022-05-22T08:47:00.000000Z"),
    ("BEL", "2024-01-05 10:00:00+00", "2024-01-05T10:00:00.000000Z"),
    ("BEL", "20240427T000733Z", "2024-04-27T00:07:33.000000Z"),
    ("BEL", "20241020143112", "2024-10-20T18:31:12.000000Z"),
    ("BEL", "20240712", "2024-07-12"),
    ("BEL", "1751820975", "2025-07-06T16:56:15.000000Z"),
    ("BEL", "1654332437871", "2022-06-04T08:47:17.871000Z"),
    ("BEL", "2024-W11-4", "2024-03-14"),
    ("BEL", "2024-366", "2024-12-31"),
    ("BEL", "2023-366", None),
    ("BEL", "3/9/25 2:57 a.m.", "2025-03-09T07:57:00.000000Z"),  # skipped: the offset before the change
    ("BEL", "11/2/2025 1:30 AM", "2025-11-02T05:30:00.000000Z"),  # twice: the earlier instant
    ("ELM", "11/6/2022 1:44 AM PST", "2022-11-06T09:44:00.000000Z"),
    ("DUN", "03/04/2023 12:10 AM", "2023-04-02T23:10:00.000000Z"),
    ("BEL", "03/04/2023 12:10 PM", "2023-03-04T17:10:00.000000Z"),
    ("DUN", "02/28/2023", None),
    ("BEL", "04.03.2023", "2023-03-04"),
    ("GOR", "1/1/2024 5:30 AM IST", "2024-01-01T00:00:00.000000Z"),
    ("GOR", "0230 hrs, 09-Mar-2025", "2025-03-08T21:00:00.000000Z"),
    ("BEL", "17-Oct-25", "2025-10-17"),
    ("BEL", "1er juillet 2024", "2024-07-01"),
    ("BEL", "24 de abril de 2025", "2025-04-24"),
    ("BEL", "Monday, 16th January 2023", "2023-01-16"),
    ("BEL", "15. August 2023, 14:55 Uhr (UTC-07:00)", "2023-08-15T21:55:00.000000Z"),
    ("BEL", "Thu, 24 Mar 2022 22:55:03 -0400", "2022-03-25T02:55:03.000000Z"),
    ("BEL", "28-FEB-2022 14:55:42.783 -08:00", "2022-02-28T22:55:42.783000Z"),
    ("BEL", "March 10, 2024 at 2:37 am", "2024-03-10T07:37:00.000000Z"),
    ("BEL", "nov 2024", "2024-11"),
    ("BEL", "03/2023", "2023-03"),
    ("BEL", "2023", "2023"),
    ("BEL", "2024-13-05", None),
    ("BEL", "2023-02-30", None),
    ("BEL", "0000-00-00", None),
    ("BEL", "25:61", None),
    ("BEL", "2024-01-05 25:00", None),
    ("BEL", "see note", None),
    ("BEL", "", None),
    ("BEL", None, None),
    (None, "2024-01-05 10:00", None),
    (None, "2024-01-05 10:00Z", "2024-01-05T10:00:00.000000Z"),
    ("XXX", "2024-01-05", "2024-01-05"),
    ("BEL", "9" * 5000, None),
]


def test_cases(spark):
    values = spark.createDataFrame([(i, o, v) for i, (o, v, _) in enumerate(CASES)], "i int, office string, event_date string")
    got = {r["i"]: r["event_norm"] for r in T.normalise_times(values, spark.createDataFrame(OFFICES, OFFICE_SCHEMA)).collect()}
    assert {i: got[i] for i in got} == {i: e for i, (_, _, e) in enumerate(CASES)}


def test_empty_repeated_and_clashing_columns(spark):
    offices = spark.createDataFrame(OFFICES, OFFICE_SCHEMA)
    schema = "office string, event_date string, event_norm string, _r int, precision int"
    assert T.normalise_times(spark.createDataFrame([], schema), offices).count() == 0
    rows = T.normalise_times(spark.createDataFrame([("BEL", "2023", "x", 1, 2)] * 3, schema), offices).collect()
    assert len(rows) == 3 and {r["event_norm"] for r in rows} == {"2023"} and rows[0]["_r"] == 1 and rows[0]["precision"] == "year"


def test_mixture_finds_an_undeclared_order(spark):
    offices = spark.createDataFrame([("A", "UTC", None), ("B", "UTC", None), ("C", "UTC", None)], OFFICE_SCHEMA)
    rows = [("A", f"{d}/3/2024") for d in range(1, 29)] + [("B", f"3/{d}/2024") for d in range(1, 29)] + [("C", "3/4/2024")]
    got = T.normalise_times(spark.createDataFrame(rows, "office string, event_date string"), offices, use_declared=False).collect()
    assert {r["event_norm"][5:7] for r in got if r["office"] in "AB"} == {"03"}
    assert [(r["event_norm"], r["ambiguity"]) for r in got if r["office"] == "C"] == [(None, "date_order")]


def test_ambiguity_is_marked(spark):
    offices = spark.createDataFrame(OFFICES, OFFICE_SCHEMA)
    rows = [("BEL", "2025-11-02 01:30"), ("BEL", "2025-03-09 02:30"), ("BEL", "2025-03-09 04:30")]
    got = {r["event_date"]: r["ambiguity"] for r in T.normalise_times(spark.createDataFrame(rows, "office string, event_date string"), offices).collect()}
    assert [got[v] for _, v in rows] == ["repeated_hour", "skipped_hour", "none"]


@settings(max_examples=200, deadline=None)
@given(st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2037, 1, 1)), st.sampled_from(["%Y-%m-%d %H:%M:%S", "%d %B %Y %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%b %d, %Y %I:%M:%S %p", "%Y%m%d%H%M%S"]))
def test_formats_round_trip(t, form):
    day, _, _, _, _, us, off, _, _ = T.read_value(t.strftime(form))
    assert dt.datetime(1970, 1, 1) + dt.timedelta(days=day, microseconds=us) == t.replace(microsecond=0) and off is None


def test_em_follows_a_declared_order():
    counts = pd.DataFrame({"source": "s", "shape": "9/9/9", "mdy": [True, True], "dmy": [True, False], "n": [10, 1000], "declared": "DMY"})
    out = T._em(counts)
    assert out["p_mdy"].tolist() == [0.0, 0.0] and out["readable"].tolist() == [True, False]


@pytest.mark.parametrize("zone", ["Europe/Berlin", "Australia/Adelaide"])
def test_zone_abbreviations(zone):
    got = T.zone_abbreviations([zone, "No/Where"])
    summer = dt.datetime(2024, 7, 1, tzinfo=zoneinfo.ZoneInfo(zone))
    assert got[f"{zone}|{summer.tzname()}"] == summer.utcoffset().total_seconds()


def test_the_mixture_reaches_its_fixed_point():
    # nearly all values are ambiguous: plain rounds would need thousands
    counts = pd.DataFrame({"source": "o", "shape": ["9/9/9", "99/9/9", "9/99/9"], "mdy": [True, False, True], "dmy": [True, True, False], "n": [1_000_000, 1, 12], "declared": None})
    out = T._em(counts)
    assert abs(out["theta_mdy"].iloc[0] - 12.5 / 14) < 1e-6 and abs(out["p_mdy"].iloc[0] - 12.5 / 14) < 1e-6
    only = T._em(counts.assign(declared="DMY"))
    assert only["p_mdy"].iloc[0] == 0 and not only["readable"].iloc[2]


def test_half_hours_and_long_shapes(spark):
    offices = spark.createDataFrame([("LHI", "Australia/Lord_Howe", "DMY")], OFFICE_SCHEMA)
    long = "1/2/2024 10:00:00." + "1" * 60
    rows = spark.createDataFrame([("2024-04-07 01:45", "LHI"), ("2024-04-07 03:00", "LHI"), (long, "LHI"), ("z" * 5000, "LHI")], "event_date string, office string")
    got = {r["event_date"]: r for r in T.normalise_times(rows, offices).collect()}
    assert got["2024-04-07 01:45"]["ambiguity"] == "repeated_hour" and got["2024-04-07 01:45"]["event_norm"] == "2024-04-06T14:45:00.000000Z"
    assert got["2024-04-07 03:00"]["ambiguity"] == "none" and got[long]["event_norm"] == "2024-01-31T23:00:00.111111Z" and got["z" * 5000]["event_norm"] is None
