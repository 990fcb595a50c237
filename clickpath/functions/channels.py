"""Traffic-source inference and default channel grouping.

All text inputs go through ``norm`` once.  The channel CASE is ordered: the order of the
branches is the algorithm (``cpm`` is both a paid medium and a display medium; it is
Display only because the paid branches are tested first).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickpath.functions.text import any_of, norm, whole_of

# ---- fixed values: source/medium token lists of the default channel rules -----------------
ENGINE_PRODUCT_LABELS = [
    "accounts", "mail", "docs", "keep", "drive", "calendar", "gemini", "notebooklm", "sites",
    "groups", "translate", "photos", "meet", "chat", "classroom", "myaccount", "support", "play",
    "store", "business", "partner", "script", "news", "maps", "books", "scholar", "analytics",
    "cloud", "developers", "firebase", "console", "admin", "forms", "contacts", "earth",
    "domains", "adsense",
]
ENGINE_PRODUCT_HOSTS = ["googleusercontent", "googleadservices", "googletagmanager"]
PAID_MEDIUM_PATTERN = r"^(.*cp.*|ppc|retargeting|paid.*)$"
SHOPPING_SOURCES = [
    "amazon", "ebay", "shopify", "etsy", "walmart", "mercadolivre", "mercadolibre", "shopee",
    "alibaba", "aliexpress",
]
SEARCH_SOURCES = [
    "google", "bing", "yahoo", "duckduckgo", "baidu", "yandex", "ecosia", "msn", "ask.com",
    "aol", "brave", "qwant", "startpage", "naver", "seznam",
]
SOCIAL_SOURCES = [
    "facebook", "instagram", "linkedin", "twitter", "tiktok", "pinterest", "reddit", "threads",
    "snapchat", "whatsapp", "telegram", "kwai", "tumblr", "quora",
]
SOCIAL_SHORT_NAMES = ["fb", "ig", "meta", "x", "x.com", "li", "tt", "wpp"]
VIDEO_SOURCES = ["youtube", "vimeo", "twitch", "dailymotion"]
VIDEO_SHORT_NAMES = ["yt"]
DISPLAY_MEDIUMS = ["display", "banner", "expandable", "interstitial", "cpm"]
SOCIAL_MEDIUMS = ["social", "social-network", "social-media", "sm", "social network", "social media"]
VIDEO_MEDIUM_PATTERN = "video"
AI_SOURCES = ["chatgpt", "openai", "perplexity", "copilot", "gemini", "claude.ai", "anthropic"]
AI_MEDIUM_PATTERN = r"(ai.?assistant|ai.?chat)"
EMAIL_SOURCES = ["email", "e-mail", "e_mail", "e mail"]
EMAIL_MEDIUMS = ["email", "e-mail", "e_mail", "e mail", "newsletter"]
PUSH_MEDIUM_PATTERN = r"(mobile|notification|push)"
REFERRAL_MEDIUMS = ["referral", "app", "link"]
DIRECT_SOURCE = "(direct)"
DIRECT_MEDIUMS = ["(not set)", "(none)"]
SCANNER_HOSTS = ["gtm-msr.appspot.com"]
# referrer host: scheme, then the run up to / : ? #
REFERRER_HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)"
# ---------------------------------------------------------------------------------------------

ENGINE_PRODUCT_PATTERN = r"(^|\.|//)" + any_of(ENGINE_PRODUCT_LABELS) + r"\."
ENGINE_PRODUCT_HOST_PATTERN = any_of(ENGINE_PRODUCT_HOSTS)
SHOPPING_PATTERN = any_of(SHOPPING_SOURCES)
SEARCH_PATTERN = any_of(SEARCH_SOURCES)
SOCIAL_PATTERN = any_of(SOCIAL_SOURCES)
VIDEO_PATTERN = any_of(VIDEO_SOURCES)
AI_SOURCE_PATTERN = any_of(AI_SOURCES)
EMAIL_SOURCE_PATTERN = whole_of(EMAIL_SOURCES)
EMAIL_MEDIUM_PATTERN = whole_of(EMAIL_MEDIUMS)


def is_engine_product(src: Column) -> Column:
    """The search engine operator's *other* products (mail, docs, ...) are not search."""
    s = norm(src)
    return s.rlike(ENGINE_PRODUCT_PATTERN) | s.rlike(ENGINE_PRODUCT_HOST_PATTERN)


def is_paid_medium(med: Column) -> Column:
    """C2."""
    return norm(med).rlike(PAID_MEDIUM_PATTERN)


def is_shopping_source(src: Column) -> Column:
    """C3."""
    return norm(src).rlike(SHOPPING_PATTERN)


def is_search_source(src: Column) -> Column:
    """C4: contains an engine name and is not one of the engine's other products."""
    return norm(src).rlike(SEARCH_PATTERN) & ~is_engine_product(src)


def is_social_source(src: Column) -> Column:
    """Long names as substrings, short names only as the whole value."""
    s = norm(src)
    return s.rlike(SOCIAL_PATTERN) | s.isin(SOCIAL_SHORT_NAMES)


def is_video_source(src: Column) -> Column:
    """C6."""
    s = norm(src)
    return s.rlike(VIDEO_PATTERN) | s.isin(VIDEO_SHORT_NAMES)


def channel_group(src: Column, med: Column, camp: Column) -> Column:
    """Ordered 20-way default channel group."""
    s, m, c = norm(src), norm(med), norm(camp)
    paid = m.rlike(PAID_MEDIUM_PATTERN)
    shopping = s.rlike(SHOPPING_PATTERN) | m.contains("shopping")
    search = is_search_source(src)
    social = is_social_source(src)
    video = is_video_source(src)
    direct = (F.coalesce(src, F.lit(DIRECT_SOURCE)) == DIRECT_SOURCE) & \
        F.coalesce(med, F.lit("(none)")).isin(DIRECT_MEDIUMS)
    return (
        F.when(c.contains("cross-network"), "Cross-network")
        .when(paid & shopping, "Paid Shopping")
        .when(paid & search, "Paid Search")
        .when(paid & social, "Paid Social")
        .when(paid & video, "Paid Video")
        .when(m.isin(DISPLAY_MEDIUMS), "Display")
        .when(paid, "Paid Other")
        .when(shopping, "Organic Shopping")
        .when(social | m.isin(SOCIAL_MEDIUMS), "Organic Social")
        .when(video | m.rlike(VIDEO_MEDIUM_PATTERN), "Organic Video")
        .when(search | (m == "organic"), "Organic Search")
        .when(s.rlike(AI_SOURCE_PATTERN) | m.rlike(AI_MEDIUM_PATTERN), "AI Assistant")
        .when(s.rlike(EMAIL_SOURCE_PATTERN) | m.rlike(EMAIL_MEDIUM_PATTERN), "Email")
        .when(m == "affiliate", "Affiliates")
        .when(m == "audio", "Audio")
        .when((s == "sms") | (m == "sms"), "SMS")
        .when(m.rlike(PUSH_MEDIUM_PATTERN), "Mobile Push Notifications")
        .when(m.isin(REFERRAL_MEDIUMS), "Referral")
        .when(direct, "Direct")
        .otherwise("Unassigned")
    )


def referrer_host(ref: Column) -> Column:
    """Host after ``scheme://`` up to ``/ : ? #``, lower-cased; '' when absent.

    A regex rather than ``parse_url`` so odd hosts (``android-app://``, userinfo) never
    raise or turn NULL."""
    return F.lower(F.regexp_extract(F.coalesce(ref, F.lit("")), REFERRER_HOST_PATTERN, 1))


def is_internal_host(host: Column, internal_domains: list[str]) -> Column:
    """Host equals an internal domain or ends with ``.`` + one (literal suffix test).

    The domain list is configuration, so it is folded into literals here rather than split
    per row."""
    cond = F.lit(False)
    for d in internal_domains:
        cond = cond | (host == d) | host.endswith("." + d)
    return cond


def engine_name(host: Column) -> Column:
    """Canonical engine name, the first engine token found in the host."""
    return F.regexp_extract(host, SEARCH_PATTERN, 1)


def infer_traffic_source(src: Column, med: Column, camp: Column, click_id: Column,
                         ref: Column, internal_domains: list[str]) -> Column:
    """C11: struct(source, medium, campaign, attribution_from).

    Precedence: click id > any UTM (verbatim) > external referrer > none.
    """
    host = referrer_host(ref)
    null = F.lit(None).cast("string")

    def ts(source, medium, campaign, origin):
        return F.struct(source.alias("source"), medium.alias("medium"),
                        campaign.alias("campaign"), F.lit(origin).alias("attribution_from"))

    def blank(c):
        return F.trim(F.coalesce(c, F.lit(""))) == ""

    has_utm = ~(blank(src) & blank(med) & blank(camp))
    app_ref = F.lower(F.coalesce(ref, F.lit(""))).startswith("android-app://") | host.startswith("com.")
    by_referrer = (
        F.when(app_ref, ts(host, F.lit("referral"), null, "referrer"))
        .when(is_search_source(host), ts(engine_name(host), F.lit("organic"), null, "referrer"))
        .otherwise(ts(F.regexp_replace(host, r"^www\.", ""), F.lit("referral"), null, "referrer"))
    )
    return (
        F.when(~blank(click_id), ts(F.lit("google"), F.lit("cpc"), camp, "click_id"))
        .when(has_utm, ts(src, med, camp, "utm"))
        .when((F.length(host) > 0) & ~is_internal_host(host, internal_domains), by_referrer)
        .otherwise(ts(null, null, null, "none"))
    )
