"""URL filtering with pattern rules indexed by their rarest literal token.

A rule has a name, a verdict, a regular expression over ``host || path``, its literal tokens
(runs of letters and digits that any matching URL must contain as whole tokens) and a rank.
The index keeps each rule under that one of its tokens which occurs in the fewest distinct URLs of the
table.  URLs are split into distinct tokens; a join on the token fetches candidate rules, and
only those candidates run their regular expression.  Of the rules that match, the highest
(rank, length, name) decides.  Everything is DataFrame code.  The index is broadcast after a check of its
size; beyond the limit it is joined with salts, so that no token is one task's work.

Rules for site lists are ``host/path`` prefixes (:func:`host_rule`).  Pattern rules (:func:`pattern_rule`)
are literals with ``||`` (start of a host label), ``|`` (start or end), ``^`` (a separator or the end) and
``*``; ``@@`` in front makes an exception.  Rules without a sure token are tried on every distinct URL.

Null or relative URLs have an empty host and path and match no site rule.  Rows are kept as they
are, repeated rows included; an empty table gives an empty result.  Extra columns are kept whatever their
names; where one has the name of an added column, the added one gets underscores behind its name.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, salted_left_join, table, written


class Rule(NamedTuple):
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def tokens_of(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def host_rule(verdict: str, rule: str, rank: int = 2) -> Rule:
    """A rule ``host/path``: the host and its subdomains, if the path starts with the rule's."""
    host, slash, rest = rule.partition("/")
    host, path = host.translate(_LOWER), slash + rest
    sure = tokens_of(host)
    for m in re.finditer(r"[a-z0-9]+", path.lower()):
        if m.end() < len(path):  # the last token of a prefix may go on in the URL
            sure.append(m.group())
    return Rule(rule, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(sure), rank)


_PIECES = {"||": r"^(?:[^/]*\.)?", "^": r"(?:[^a-zA-Z0-9_.%-]|$)", "*": r"[\s\S]*"}


def pattern_rule(text: str) -> Rule:
    """A rule of pattern syntax; letters match in either case."""
    body = text.removeprefix("@@")
    parts = re.findall(r"\|\||[|^*]|[^|^*]+", body)
    regex, sure = "", []
    for i, part in enumerate(parts):
        if part == "|":
            regex += "^" if i == 0 else "$"
        elif part in _PIECES:
            regex += _PIECES[part]
        else:
            regex += "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else re.escape(c) for c in part.lower())
            open_left, open_right = (i == 0 or parts[i - 1] == "*"), (i + 1 == len(parts) or parts[i + 1] == "*")
            for m in re.finditer(r"[a-z0-9]+", part.lower()):
                if not (open_left and m.start() == 0 or open_right and m.end() == len(part)):
                    sure.append(m.group())
    exception = text.startswith("@@")
    return Rule(f"pattern:{text}", "allow" if exception else "block", regex, tuple(sure), 1 if exception else 0)


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: The rules of the query, host and path.
SITE_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: Words that mark hosts and folders without usable text.
BLOCKED_WORDS = (
    "adult porn xxx sex escort camgirls casino poker betting bets slots lottery gambling viagra pills pharmacy-online payday-loans replica "
    "warez torrent torrents keygen crack nulled spam spam-farm linkfarm doorway phishing malware spyware botnet ads adserver ads-track adclick "
    "banners popunder popups tracker trackers telemetry beacon clickbait affiliate coupons-daily essay-mill followers-shop"
).split()
#: Rules written one by one.
PATTERNS = [
    "|ads.", "||ad.*^banner^", "/ads/*/frame^", "/adframe.", "/banner/*.gif|", "/popup.", "^pixel.gif|", "^track^click^", "/redirect^to^", "/sponsored/", "/wp-login.", "/cgi-bin/*.exe|",
    "/xmlrpc.", "/comment-page-", "/trackback^", "/feed/*/comments^", "/cart^checkout^", "/account/login^", "/signup^", "/calendar/*/print^", "||login.", "||signup.", "||checkout.", "||stats.*^hit^",
    "-porn-", "-casino-", "-viagra-", ".xxx^", ".adult^", ".casino^", ".bet^", ".poker^", ".exe|", ".apk|", "free-*-download.", "cheap-*-online.", "||clk*^", "||trk*^",
    "@@||health.*^", "@@/privacy/", "@@/encyclopedia/",
]


def default_rules() -> list[Rule]:
    """Site rules; for each word a host label, the start, middle or end of one, and a folder; single patterns."""
    made = [p for w in BLOCKED_WORDS for p in (f"||{w}.", f"||{w}-", f"-{w}.", f"/{w}/")]
    return [host_rule(v, r) for v, r in SITE_RULES] + [pattern_rule(p) for p in dict.fromkeys([*made, *PATTERNS])]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _token_array(host: Column, path: Column) -> Column:
    """Distinct lower-case tokens of host and path."""
    return F.array_distinct(F.filter(F.split(F.lower(F.concat(host, F.lit("/"), path)), "[^a-z0-9]+"), lambda t: t != ""))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per token with the ``rules`` under it: each under the token that the fewest URLs have.

    ``urls`` has the array column ``tokens``; ``rules`` the columns of :class:`Rule`.
    """
    wanted = rules.select("name", F.explode("tokens").alias("token"))
    # At most one row for each token of a rule.
    listed = wanted.select("token").distinct()
    seen = urls.select(F.explode("tokens").alias("token")).join(listed, "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    best = wanted.join(seen, "token", "left").groupBy("name").agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token")).alias("best"))
    return rules.join(best, "name").groupBy(F.col("best.token").alias("token")).agg(F.collect_list(F.struct("name", "verdict", "pattern", "rank")).alias("rules"))


def _best(name: Column, verdict: Column, rank: Column) -> Column:
    return F.struct(rank.alias("rank"), F.length(name).alias("size"), name.alias("name"), verdict.alias("verdict"))


def judge(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Rows of ``pages`` with ``host``, ``path``, ``matched`` (the deciding rule's name or null) and ``verdict``."""
    host, path, matched, verdict = names = [free_name(pages.columns, c) for c in ("host", "path", "matched", "verdict")]
    split = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    # A row's verdict depends on (host, path) alone: candidates are fetched once for each.
    urls = split.select(F.col(host).alias("host"), F.col(path).alias("path")).distinct()
    urls = urls.withColumns({"whole": F.concat("host", "path"), "tokens": _token_array(F.col("host"), F.col("path"))})
    schema = "name string, verdict string, pattern string, tokens array<string>, rank int"
    indexed = pages.sparkSession.createDataFrame([tuple(r) for r in rules if r.tokens], schema)
    index = written(rule_index(urls, indexed), "rules")
    row_bytes = sum(len(r.pattern) + len(r.name) + 64 for r in rules) // max(1, len(rules)) + 64
    held = salted_left_join(urls.select("host", "path", "whole", F.explode("tokens").alias("token")), index, ["token"], row_bytes).where("rules is not null")
    tried = held.select("host", "path", "whole", F.explode("rules").alias("r")).where(F.regexp_like("whole", F.col("r.pattern"))).select("host", "path", _best(F.col("r.name"), F.col("r.verdict"), F.col("r.rank")).alias("best"))
    loose = [r for r in rules if not r.tokens]
    if loose:
        each = F.array(*[F.when(F.regexp_like("whole", F.lit(r.pattern)), _best(F.lit(r.name), F.lit(r.verdict), F.lit(r.rank))) for r in loose])
        tried = tried.union(urls.select("host", "path", F.array_max(F.array_compact(each)).alias("best")).where("best is not null"))
    found = written(tried.groupBy("host", "path").agg(F.max("best").alias("best")), "verdicts")
    best = free_name(split.columns, "best")
    out = salted_left_join(split, found.toDF(host, path, best), [host, path], 256)
    return out.select(*pages.columns, host, path, F.col(f"{best}.name").alias(matched), F.coalesce(F.col(f"{best}.verdict"), F.lit(default)).alias(verdict))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages`` judged by the site rules, else by the pattern rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = judge(pages, default_rules())
    return out.select("page_id", "host", "path", F.when(~F.col("matched").startswith("pattern:"), F.col("matched")).alias("rule"), "verdict")


def _oracle() -> str:
    sites = ", ".join(f"('{v}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for v, r in SITE_RULES)
    blocks, exceptions = ("|".join(f"(?:{r.pattern})" for r in default_rules() if r.rank == n).replace("'", "''") for n in (0, 1))
    return rf"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS rid,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(verdict, rhost, rpath, rule) AS (VALUES {sites}),
m AS (
  SELECT rid, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM u JOIN r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)
  GROUP BY rid)
SELECT u.page_id, u.host, u.path, m.rule,
       coalesce(m.verdict, CASE WHEN regexp_matches(u.host || u.path, '{exceptions}') THEN 'allow' WHEN regexp_matches(u.host || u.path, '{blocks}') THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN m USING (rid)"""


ORACLE_SQL = _oracle()
