"""URL filters: rules indexed by their rarest literal token.

A rule is (host, path, verdict).  It fits its host and all subdomains when
the URL's path starts with the rule's path; ``*`` in a rule's path stands
for any run of characters.  Of the rules that fit, the one with the longest
host and path wins; of equally long ones the first given.

Each rule is filed under the rarest of its literal tokens (runs of ASCII
letters and digits that are whole tokens in any URL that the rule fits);
how often a token occurs is counted over all URLs.  A URL's own tokens
fetch the candidate rules, and only their regular expressions run.  A rule
without such a token is a candidate for every URL.

Null URLs and URLs without ``://`` have an empty host and path; no rule
with a host fits them.  Where no rule fits, the rule is null and the verdict
``DEFAULT``.  The rules are an argument, at most ``MAX_RULES``, and travel
as one broadcast; nothing is shuffled but the token counts.  Repeated rows
and extra columns pass through; an input column named like an output column
is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordstats.llm.common import table, with_replaced

Rule = tuple[str, str, str]

# The rules of the registered query (host, path, verdict).
RULES: tuple[Rule, ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT = "allow"
MAX_RULES = 1_000_000
TOKEN = r"[A-Za-z0-9]+"
_TOKEN = re.compile(TOKEN)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_tokens(rule: Rule) -> list[str]:
    """Tokens that are whole tokens of every URL that the rule fits: not one
    beside a ``*``, nor one that ends the path."""
    host, path, _ = rule
    whole = host + path
    out = []
    for m in _TOKEN.finditer(whole):
        before = whole[m.start() - 1:m.start()] if m.start() else "."
        after = whole[m.end():m.end() + 1]
        # A host's last token ends where the URL's path begins, or the URL.
        closed = after != "" or path == "" and m.end() == len(host)
        if before != "*" and after != "*" and closed:
            out.append(m[0])
    return out


def rule_pattern(rule: Rule) -> re.Pattern:
    host, path, _ = rule
    body = ".*".join(re.escape(p) for p in path.split("*"))
    end = "" if path else r"(?=/|\Z)"
    return re.compile(rf"(?:[^/]*\.)?{re.escape(host)}{end}{body}", re.DOTALL)


def build_index(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, list[int]]:
    """Token -> numbers of the rules filed under it; "" for rules that every
    URL must try.  ``urls`` has host and path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    spark = urls.sparkSession
    tokens = [rule_tokens(r) for r in rules]
    wanted = sorted({t for ts in tokens for t in ts})
    counts: dict[str, int] = {}
    if wanted:
        known = spark.createDataFrame([(t,) for t in wanted], "token string")
        # The rules' own tokens: bounded by the rules.
        seen = (urls.select(F.explode(F.array_distinct(_tokens())).alias("token"))
                .join(F.broadcast(known), "token").groupBy("token").count())
        counts = {r["token"]: r["count"] for r in seen.collect()}
    index: dict[str, list[int]] = {}
    for i, ts in enumerate(tokens):
        key = min(ts, key=lambda t: (counts.get(t, 0), t)) if ts else ""
        index.setdefault(key, []).append(i)
    return index


def _tokens() -> Column:
    return F.regexp_extract_all(F.concat(F.col("host"), F.col("path")), F.lit(TOKEN), 0)


def judge_one(host: str, path: str, rules: Sequence[Rule], patterns: Sequence[re.Pattern],
              index: dict[str, list[int]]) -> tuple[int, int]:
    """(number of the winning rule or -1, number of candidates)."""
    whole = host + path
    candidates = list(index.get("", ()))
    for t in set(_TOKEN.findall(whole)):
        candidates += index.get(t, ())
    fits = [i for i in candidates if patterns[i].match(whole)]
    best = min(fits, key=lambda i: (-len(rules[i][0] + rules[i][1]), i), default=-1)
    return best, len(candidates)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, default: str = DEFAULT,
          url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and
    ``n_candidates`` (rules whose regular expressions ran)."""
    parsed = with_replaced(pages, {"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    model: Broadcast = pages.sparkSession.sparkContext.broadcast(
        (list(rules), build_index(parsed.select("host", "path"), rules)))

    @F.pandas_udf("rule string, verdict string, n_candidates int")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        given, index = model.value
        patterns = [rule_pattern(r) for r in given]
        for hosts, paths in batches:
            rows = []
            for h, p in zip(hosts, paths):
                i, n = judge_one(h, p, given, patterns, index)
                rows.append((given[i][0] + given[i][1] if i >= 0 else None,
                             given[i][2] if i >= 0 else default, n))
            yield pd.DataFrame(rows, columns=["rule", "verdict", "n_candidates"])

    out = with_replaced(parsed, {"_found": found(F.col("host"), F.col("path"))})
    return with_replaced(out, {c: F.col("_found")[c]
                               for c in ("rule", "verdict", "n_candidates")}).drop("_found")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every page's verdict."""
    return (judge(table(spark, sf_dir, "pages").select("page_id", "url"))
            .select("page_id", "host", "path", "rule", "verdict"))


ORACLE = """
WITH rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
         ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT page_id, url, row_number() OVER () AS n,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages),
parts AS (
  SELECT page_id, n,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM rest),
best AS (
  SELECT p.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.n)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN best b ON p.n = b.n
"""
