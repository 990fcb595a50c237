"""Channel grouping (C7) and traffic-source inference (C11).

Own cases from the rules: each branch with a source or medium that takes it, one that only
just does not, and for neighbouring branches a pair that both would take, where the earlier
one wins.
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpath.config import Config
from clickpath.functions import channels as C

CHANNEL_CASES = [
    # taken, and nearly taken
    ("shop.bing", "PPC ", None, "Paid Search"), ("bingo-hall", "retargeting", None, "Paid Search"), ("bong", "ppc", None, "Paid Other"),
    ("ebay.example", "cpc", None, "Paid Shopping"), ("bay.example", "cpc", None, "Paid Other"), ("duckduckgo", None, None, "Organic Search"),
    ("instagram", "social", None, "Organic Social"), ("insta", "none-such", None, "Unassigned"), ("vimeo.example", "video", None, "Organic Video"),
    ("vim", "video", None, "Organic Video"), ("somewhere", "banner", None, "Display"), ("somewhere", "banners", None, "Unassigned"),
    ("perplexity.ai", "referral", None, "AI Assistant"), ("list", "e-mail", None, "Email"), ("list", "mailing", None, "Unassigned"),
    ("clubcard", "affiliate", None, "Affiliates"), ("clubcard", "affiliates", None, "Unassigned"), ("radio", "audio", None, "Audio"),
    ("sms", None, None, "SMS"), ("blast", "sms", None, "SMS"), ("phone", "mobile", None, "Mobile Push Notifications"),
    ("blog.example.net", "link", None, "Referral"), ("blog.example.net", "links", None, "Unassigned"),
    (None, "(none)", None, "Direct"), ("(direct)", "(not set)", "c", "Direct"), (" ", None, None, "Unassigned"), (None, "else", None, "Unassigned"),
    # earlier branch wins
    ("ebay", "cpc", "Summer Cross-Network 7", "Cross-network"), ("google shopping", "cpc", None, "Paid Search"), ("bing ebay", "cpc", None, "Paid Shopping"),
    ("bing.facebook", "cpc", None, "Paid Search"), ("facebook youtube", "cpc", None, "Paid Social"), ("youtube", "display", None, "Display"),
    ("ebay pinterest", None, None, "Organic Shopping"), ("facebook vimeo", None, None, "Organic Social"), ("yahoo youtube", None, None, "Organic Video"),
    ("chatgpt", "organic", None, "Organic Search"), ("chatgpt", "email", None, "AI Assistant"), ("email", "affiliate", None, "Email"),
    ("sms", "audio", None, "Audio"), ("sms", "push", None, "SMS"), ("mail.google.com", None, None, "Unassigned"),
]

INFERENCE_CASES = [
    # campaign parameters first; an ad click id outranks them
    ("bing", "email", "may", None, "https://www.ecosia.org/", "", ("bing", "email", "utm")),
    ("bing", None, None, "click-7", "https://shop.example.net/", "", ("google", "cpc", "click_id")),
    (None, None, "only-a-name", None, "https://www.ecosia.org/", "", (None, None, "utm")),
    # then the referrer: engines by name, whatever subdomain, country or case
    (" ", "", "", None, "https://search.yahoo.co.jp/q", "", ("yahoo", "organic", "referrer")),
    (None, None, None, "", "HTTP://DUCKDUCKGO.COM?q=1", "", ("duckduckgo", "organic", "referrer")),
    (None, None, None, None, "https://drive.google.com:443/file", "", ("drive.google.com", "referral", "referrer")),
    (None, None, None, None, "https://www.pinterest.example/pin#a", "", ("pinterest.example", "referral", "referrer")),
    (None, None, None, None, "android-app://org.reader.app/x", "", ("org.reader.app", "referral", "referrer")),
    # own domains are no source; a host that only ends alike is
    (None, None, None, None, "https://Shop.Own.example/cart", "other.test,own.example", (None, None, "none")),
    (None, None, None, None, "https://own.example", " own.example ", (None, None, "none")),
    (None, None, None, None, "https://myown.example/", "own.example", ("myown.example", "referral", "referrer")),
    (None, None, None, None, "", "own.example", (None, None, "none")),
]

COMPOSED = [
    ("https://uk.search.yahoo.com/", "Organic Search"),
    ("https://vimeo.com/9", "Organic Video"),
    ("https://www.reddit.com/r/x", "Organic Social"),
    ("https://gazette.example/", "Referral"),
]

S = T.StringType()


def test_channel_truth_table(spark):
    schema = T.StructType([T.StructField(n, S) for n in ("s", "m", "c", "want")])
    df = spark.createDataFrame(CHANNEL_CASES, schema)
    got = df.select("s", "m", "want", C.channel_group(F.col("s"), F.col("m"), F.col("c")).alias("got")).collect()
    wrong = [(r.s, r.m, r.got, r.want) for r in got if r.got != r.want]
    assert not wrong


@pytest.mark.parametrize("case", INFERENCE_CASES, ids=[str(i) for i in range(len(INFERENCE_CASES))])
def test_inference(spark, case):
    src, med, camp, cid, ref, internal, want = case
    schema = T.StructType([T.StructField(n, S) for n in ("s", "m", "c", "k", "r")])
    df = spark.createDataFrame([(src, med, camp, cid, ref)], schema)
    domains = Config(internal_domains=internal).internal_domain_list()
    r = df.select(C.infer_traffic_source(F.col("s"), F.col("m"), F.col("c"), F.col("k"), F.col("r"),
                                         domains).alias("i")).first().i
    assert (r.source, r.medium, r.attribution_from) == want


def test_inference_composes_with_channel(spark):
    df = spark.createDataFrame([(r,) for r, _ in COMPOSED], "r string")
    null = F.lit(None).cast("string")
    i = C.infer_traffic_source(null, null, null, null, F.col("r"), [])
    got = df.select(C.channel_group(i.source, i.medium, i.campaign).alias("ch")).collect()
    assert [g.ch for g in got] == [w for _, w in COMPOSED]


def test_predicates(spark):
    df = spark.createDataFrame([("mail.google.com",), ("www.google.com",), ("docs.google.com",),
                                ("netflix.com",), ("x.com",), ("yt",), ("shopee",)], "s string")
    r = {row.s: row for row in df.select(
        "s", C.is_engine_product(F.col("s")).alias("prod"), C.is_search_source(F.col("s")).alias("search"),
        C.is_social_source(F.col("s")).alias("social"), C.is_video_source(F.col("s")).alias("video"),
        C.is_shopping_source(F.col("s")).alias("shop")).collect()}
    assert r["mail.google.com"].prod and not r["mail.google.com"].search
    assert r["www.google.com"].search and not r["www.google.com"].prod
    assert r["docs.google.com"].prod
    assert not r["netflix.com"].social and r["x.com"].social
    assert r["yt"].video and r["shopee"].shop


def test_referrer_host_and_engine(spark):
    df = spark.createDataFrame([("https://user@Www.Google.com.br:443/x",), ("android-app://com.a.b",),
                                (None,), ("no scheme",)], "r string")
    rows = df.select(C.referrer_host(F.col("r")).alias("h")).collect()
    assert [x.h for x in rows] == ["user@www.google.com.br", "com.a.b", "", ""]
    e = spark.createDataFrame([("br.search.yahoo.com",)], "h string").select(C.engine_name(F.col("h")).alias("e"))
    assert e.first().e == "yahoo"
