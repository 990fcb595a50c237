"""Operator 13, URL filters: pattern rules indexed by their rarest literal token.

A rule (``pattern``, ``verdict``, ``kind``) allows or blocks URLs:

* ``prefix`` - ``host/path``: the host itself and all its subdomains, if the URL's path starts
  with the rule's (case kept).  The longest such rule decides, before any other kind.
* ``host`` - a pattern searched in the host;
* ``url`` - a pattern searched in the whole URL.  Of both kinds one allowing rule outweighs
  all blocking ones.

In patterns ``*`` stands for any characters, ``^`` for one character that is no ASCII letter or
digit, or for either end of the text, ``|`` at the ends of a pattern for the ends of the text,
``||`` at the start of a ``url`` pattern for the start of the host or of one of its labels.
Everything else is literal; A-Z and a-z are the same.  Without any rule the verdict is "allow".

A literal token (a run of ASCII letters and digits that nothing in a matching URL can prolong)
must be a token of every URL that the rule matches.  The tokens of all URLs are counted by
Spark, for the tokens of the rules alone; each rule is filed under its rarest one.  In the scan
a URL's tokens fetch the rules filed under them, and only those run their regular expressions,
which are atomic at every ``*`` and so linear in the URL.  A rule without any literal token is
a candidate for every URL.

Rules come in blocks of a bounded number and size, and every block is one narrow pass over the
URLs: nothing but the token counts is shuffled, so a host or URL that a third of all rows
share is no hot key.

Defined results: a null URL, or one without ``://``, has an empty host and path and is matched
by ``url`` patterns only (null: by none); very long URLs are read whole; repeated rows are
judged each; an empty table gives no rows; no rules allow everything; a rule with a null
pattern, verdict or kind, or an empty pattern, is no rule; ties between rules of one length go
to the longer host, then to "allow", then to the smaller text; columns of any name are carried
in ``doc``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.llm.common import prepare
from clickpath.storage import stored

#: Rules, and characters of rules, that one pass over the URLs holds in every worker.
BLOCK_RULES, BLOCK_CHARS = 100_000, 8 << 20
RULES = "pattern string, verdict string, kind string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)
_TOKEN = re.compile("[a-z0-9]+")
_TOKEN_SQL = "[a-z0-9]+"
_SPLIT = re.compile(r".*?://([^/?#]*)([^?#]*)", re.DOTALL)
_EDGE = r"(?:[^A-Za-z0-9]|\A|\Z)"

# Fixed values of the stated rule set.
BASE_RULES = [("net/", "block", "prefix"), ("example.net/en/", "allow", "prefix"),
              ("example.com/de/", "block", "prefix"), ("org/fr/", "allow", "prefix")]
#: Kinds of sites and pages that are of no use as training text.
PATTERN_RULES = [
    *((f"^{word}^", "block", "host") for word in (
        "ads", "adserver", "adult", "banners", "bets", "betting", "casino", "click", "clicks", "doubleclick", "gambling",
        "malware", "phishing", "pills", "poker", "porn", "spam", "track", "tracker", "tracking", "viagra", "warez", "xxx")),
    *((f"^{words}^", "allow", "host") for words in ("adult-education", "adult-learning", "anti-spam", "fast-track", "spam-research")),
    *((f"||*/{page}^", "block", "url") for page in ("cart", "checkout", "login", "logout", "signin", "signup", "wp-admin", "wp-login")),
    *((f"||*.{suffix}|", "block", "url") for suffix in ("apk", "exe", "gif", "iso", "jpg", "mp3", "mp4", "png", "rar", "zip")),
]


class Prefix(NamedTuple):
    host: str
    path: str


def prefix_of(pattern: str) -> Prefix:
    """A prefix rule's host (A-Z folded) and path."""
    at = pattern.find("/")
    host, path = (pattern, "") if at < 0 else (pattern[:at], pattern[at:])
    return Prefix(host.translate(_FOLD), path)


def host_and_path(url: str | None) -> tuple[str, str]:
    """What follows the first ``://`` up to ``/ ? #``, A-Z folded, and then up to ``? #``."""
    found = _SPLIT.match(url or "")
    return (found[1].translate(_FOLD), found[2]) if found else ("", "")


def expression(pattern: str, kind: str) -> str:
    """The regular expression of a rule: a prefix rule's is matched at the start of
    ``host + "/" + path``, the others are searched from the start of their text."""
    if kind == "prefix":
        host, path = prefix_of(pattern)
        return rf"(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}"
    start, end = "", ""
    if kind == "url" and pattern.startswith("||"):
        start, pattern = r"\A(?:[^:/?#]*://)(?:[^/?#]*\.)?", pattern[2:]
    elif pattern.startswith("|"):
        start, pattern = r"\A", pattern[1:]
    if pattern.endswith("|"):
        end, pattern = r"\Z", pattern[:-1]
    pieces = ["".join(_EDGE if c == "^" else re.escape(c) for c in piece) for piece in pattern.split("*")]
    out = start + pieces[0] if start else f"(?>.*?{pieces[0]})"
    for k, piece in enumerate(pieces[1:], 1):
        last = k == len(pieces) - 1
        out += f".*{piece}{end}" if last and end else f"(?>.*?{piece})"
    if len(pieces) == 1 and end:
        out = f"{start}{pieces[0]}{end}" if start else f".*{pieces[0]}{end}"
    return out


def literal_tokens(pattern: str, kind: str) -> set[str]:
    """Tokens that every URL which the rule matches must hold whole."""
    folded = pattern.translate(_FOLD)
    if kind == "prefix":
        host, path = prefix_of(pattern)
        # A path may go on after the rule's; its last token is whole only before another character.
        return set(_TOKEN.findall(host)) | {m[0] for m in _TOKEN.finditer(path.translate(_FOLD)) if m.end() < len(path)}
    found = set()
    for m in _TOKEN.finditer(folded):
        before, after = folded[:m.start()], folded[m.end():]
        if before and before[-1] != "*" and (after and after[0] != "*"):
            found.add(m[0])
    return found


def rank(pattern: str, verdict: str, kind: str) -> tuple:
    """Of the rules of one kind that fit, the one with the largest rank decides."""
    if kind == "prefix":
        host, path = prefix_of(pattern)
        key: tuple = (len(host) + len(path), len(host))
    else:
        key = ()
    return (*key, verdict == "allow", *(-ord(c) for c in pattern), 1)


class Index:
    """Rules filed under their rarest literal token; expressions are compiled when first met."""

    def __init__(self, rules: list[tuple[str, str, str]], counts: dict[str, int]):
        self.rules, self.compiled = rules, {}
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for k, (pattern, _, kind) in enumerate(rules):
            tokens = literal_tokens(pattern, kind)
            if tokens:
                self.by_token.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(k)
            else:
                self.always.append(k)

    def __getstate__(self):
        return {**self.__dict__, "compiled": {}}

    def candidates(self, url: str) -> Iterator[int]:
        for token in set(_TOKEN.findall(url.translate(_FOLD))):
            yield from self.by_token.get(token, ())
        yield from self.always

    def fits(self, k: int, url: str, host: str, path: str) -> bool:
        pattern, _, kind = self.rules[k]
        if k not in self.compiled:
            flags = re.DOTALL if kind == "prefix" else re.DOTALL | re.IGNORECASE | re.ASCII
            self.compiled[k] = re.compile(expression(pattern, kind), flags)
        return self.compiled[k].match({"prefix": f"{host}/{path}", "host": host, "url": url}[kind]) is not None

    def best(self, url: str, host: str, path: str, rule: tuple | None, pattern: tuple | None) -> tuple:
        """The deciding prefix rule and pattern rule of this block and of earlier ones."""
        for k in self.candidates(url):
            if self.fits(k, url, host, path):
                found = self.rules[k]
                if found[2] == "prefix":
                    rule = max(rule or found, found, key=lambda r: rank(*r))
                else:
                    pattern = max(pattern or found, found, key=lambda r: rank(r[0], r[1], "url"))
        return rule, pattern


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """URLs that hold each of the given tokens (those of one block of rules)."""
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in sorted(tokens)], "token string")
    folded = F.translate("url", _UPPER, _LOWER)
    held = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(folded, F.lit(_TOKEN_SQL), F.lit(0)))).alias("token"))
    found = held.join(F.broadcast(wanted), "token").groupBy("token").count()
    return {r["token"]: r["count"] for r in found.collect()}


def _blocks(rules: DataFrame, most: int, chars: int) -> Iterator[list[tuple[str, str, str]]]:
    """The distinct rules, drawn through the driver one bounded block at a time."""
    rules = rules.select(*(F.col(c).cast("string").alias(c) for c in ("pattern", "verdict", "kind"))).filter(
        "pattern <> '' and verdict is not null and kind is not null").distinct()
    size = rules.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("pattern")), F.lit(0))).first()
    parts = max(1, -(-size[0] // most), -(-size[1] // chars))
    block: list[tuple[str, str, str]] = []
    held = 0
    for row in rules.repartition(parts).toLocalIterator():
        if row["kind"] not in ("prefix", "host", "url") or row["verdict"] not in ("allow", "block"):
            raise ValueError(f"no such kind or verdict of a rule: {tuple(row)}")
        if block and (len(block) >= most or held + len(row["pattern"]) > chars):
            yield block
            block, held = [], 0
        block.append(tuple(row))
        held += len(row["pattern"])
    yield block


_STATE = {"host": "string", "path": "string", "rule": "string", "rule_verdict": "string", "pattern": "string", "pattern_verdict": "string"}


def _pass(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Index = index.value
        for batch in batches:
            rows = []
            earlier = zip(*(batch.column(c).to_pylist() for c in ("url", "rule", "rule_verdict", "pattern", "pattern_verdict")), strict=True)
            for url, rule, rule_verdict, pattern, pattern_verdict in earlier:
                host, path = host_and_path(url)
                one, other = (rule, rule_verdict, "prefix") if rule else None, (pattern, pattern_verdict, "url") if pattern else None
                if url is not None:
                    one, other = held.best(url, host, path, one, other)
                rows.append((host, path, *(one[:2] if one else (None, None)), *(other[:2] if other else (None, None))))
            columns = [pa.array([r[k] for r in rows], pa.string()) for k in range(len(_STATE))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("url"), *columns], ["doc", "url", *_STATE])

    return run


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", block_rules: int = BLOCK_RULES, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc, host, path, rule, pattern, verdict)`` of every row of ``pages``.

    ``doc`` holds the row's columns, ``rule`` the deciding prefix rule, ``pattern`` the deciding
    other rule (both null without one).
    """
    spark = pages.sparkSession
    prepare(spark)
    urls = pages.select(F.col(url).cast("string").alias("url"))
    state = pages.select(F.struct(*pages.columns).alias("doc"), F.col(url).cast("string").alias("url"),
                         *(F.lit(None).cast(t).alias(c) for c, t in _STATE.items()))
    for k, block in enumerate(_blocks(rules, block_rules, block_chars)):
        tokens = set().union(*(literal_tokens(pattern, kind) for pattern, _, kind in block))
        index = spark.sparkContext.broadcast(Index(block, token_counts(urls, tokens) if tokens else {}))
        if k:
            state = stored(state, "url-rules")        # one block of rules in a worker at a time
        state = state.mapInArrow(_pass(index), state.schema)
    verdict = F.coalesce("rule_verdict", "pattern_verdict", F.lit("allow"))
    return state.select("doc", "host", "path", "rule", "pattern", verdict.alias("verdict"))


def stated_rules(spark: SparkSession) -> DataFrame:
    """The stated rules and the library's own patterns."""
    return spark.createDataFrame(BASE_RULES + PATTERN_RULES, RULES)
