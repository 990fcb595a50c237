"""Journeys (F1-F10): five calls over four page loads, hand-authored expectations."""

import datetime as dt

from pyspark.sql import functions as F

from clickpath.config import Config
from clickpath.operators.journeys import clean_params, journey_derived_rows, journey_events, params_over_limit

T0 = dt.datetime(2026, 7, 28, 10, 0, 0)


def _hits(spark):
    rows = [
        ("v1", "e1", T0, "page_view", "https://www.example.com/pricing?utm_source=google&utm_medium=cpc"
                                      "&utm_campaign=spring%20sale&gclid=g1"),
        ("v1", "e2", T0 + dt.timedelta(minutes=2), "page_view", "https://www.example.com/docs"),
        ("v1", "e3", T0 + dt.timedelta(minutes=4), "page_view", "https://www.example.com/signup"),
        ("v1", "e4", T0 + dt.timedelta(minutes=4, seconds=1), "signup_click", "https://www.example.com/signup"),
        ("v1", "e5", T0 + dt.timedelta(minutes=35, seconds=1), "page_view", "https://www.example.com/home"),
        ("v1", "e6", T0 + dt.timedelta(minutes=36), "Bad_Name", "https://www.example.com/home"),
    ]
    return spark.createDataFrame(rows, "anonymous_id string, event_id string, ts timestamp, event_name string, url string")


def test_journey(spark):
    j = {r.event_id: r for r in journey_events(_hits(spark), Config(chunks=3)).collect()}
    assert set(j) == {"e1", "e2", "e3", "e4", "e5"}          # F9 drops the bad name
    e1, e2, e3, e4, e5 = (j[k] for k in ("e1", "e2", "e3", "e4", "e5"))
    assert e1.attribution == "first_touch" and e1.gclid == "g1" and e1.prev_path is None
    assert (e1.utm_source, e1.utm_medium, e1.utm_campaign) == ("google", "cpc", "spring sale")
    assert e2.attribution == "last_touch" and e2.utm_source == "google" and e2.prev_path == "/pricing"
    assert e2.gclid is None
    assert e3.prev_path == "/docs" and e4.prev_path is None and e4.utm_campaign == "spring sale"
    assert e1.session_id == e4.session_id == str(int(T0.replace(tzinfo=dt.timezone.utc).timestamp()))
    assert e5.session_id != e1.session_id and e5.is_session_start and e5.prev_path is None
    assert e5.utm_source == "google"                          # last touch lives 180 days


def test_derived_rows(spark):
    rows = journey_derived_rows(journey_events(_hits(spark))).collect()
    kinds = sorted((r.event_name, r.event_id) for r in rows)
    assert kinds == [("first_visit", "e1"), ("session_start", "e1"), ("session_start", "e5")]


def test_clean_params(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"x": 1}, "c": [1], "d": "s", "e": null, "f": true}',)], "p string")
    assert df.select(clean_params(F.col("p")).alias("c")).first().c == '{"a":1,"d":"s","e":null,"f":true}'
    many = "{" + ", ".join(f'"k{i:02d}": {i}' for i in range(30)) + "}"
    out = (spark.createDataFrame([(many,), ('{"a": 1}',), (None,)], "p string")
           .select(clean_params(F.col("p")).alias("c"), params_over_limit(F.col("p")).alias("o")).collect())
    assert out[0].c.count(":") == 30 and out[0].o          # nothing is cut off, the excess is told
    assert not out[1].o and out[2].c is None and not out[2].o


def _calls(spark, rows):
    return spark.createDataFrame(rows, "anonymous_id string, event_id string, ts timestamp, event_name string, url string")


def test_rows_in_are_rows_out(spark):
    """Equal calls and calls without an id: one row each, one first visit, prev_path kept."""
    m = dt.timedelta(minutes=1)
    rows = [("v", "e1", T0, "page_view", "https://h/a")] * 2 + [("v", None, T0 + m, "page_view", "https://h/b"), ("v", None, T0 + 2 * m, "page_view", "https://h/c"),
            ("v", None, T0 + 3 * m, "click", "https://h/c"), (None, None, T0, "page_view", "https://h/z"), (None, None, T0 + m, "page_view", "https://h/y")]
    j = journey_events(_calls(spark, rows), Config(chunks=2)).collect()
    assert len(j) == len(rows)
    assert sum(r.is_first_visit for r in j if r.anonymous_id == "v") == 1 == sum(r.is_first_visit for r in j if r.anonymous_id is None)
    paths = {(r.page_path, r.event_name): r.prev_path for r in j if r.event_id is None}
    assert paths == {("/b", "page_view"): "/a", ("/c", "page_view"): "/b", ("/c", "click"): None, ("/z", "page_view"): None, ("/y", "page_view"): "/z"}


def test_ordinary_ad_urls_keep_their_campaign(spark):
    cases = {"https://h/x?utm_campaign=a|b&utm_source={src}": ("a|b", "{src}"), "https://h/?utm_campaign=50%off": ("50%off", None), "https://h/?utm_campaign=a%20b+c%7C#utm_source=no": ("a b c|", None),
             "https://h/?x=1&utm_source=&utm_campaign=first&utm_campaign=second": ("first", ""), "https://h/?utm_campaigner=no&utm_source=%zz%41": (None, "%zzA"), "https://h/utm_source=no": (None, None)}
    rows = [(u, "e", T0, "page_view", u) for u in cases]
    got = {r.anonymous_id: (r.utm_campaign, r.utm_source) for r in journey_events(_calls(spark, rows)).collect()}
    assert got == cases


def test_first_touch_expires(spark):
    years = dt.timedelta(days=365)
    rows = [("v", f"e{k}", T0 + k * years, "page_view", "https://h/?utm_source=s" if k == 0 else "https://h/") for k in (0, 1, 3)]
    got = {r.event_id: r.utm_source for r in journey_events(_calls(spark, rows)).collect()}
    assert got == {"e0": "s", "e1": "s", "e3": None}


def test_plan_is_one_pass(spark):
    plan = journey_events(_hits(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2 and plan.count("Exchange hashpartitioning") <= 4      # the stored pass, read for rows and summary
