"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path``. Every rule has literal tokens (runs
of letters and digits with a delimiter or an end on both sides), one of which
must occur in any url that the rule fits. The rarest of them, counted over
all urls, is its index entry; a url's own tokens fetch the few rules whose
entry they are, and only those run their regular expression. DataFrame
functions only.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; the empty table gives an empty result; repeated
rows and ties (rules of the same length: the longer host, then the smaller
rule) are judged alike; very long urls are read whole; other columns are not
read and stay, whatever their names, but for host, path, rule and verdict,
which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The site rules of the query's contract, (verdict, host, path).
SITE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words that, as a whole token of host or path, mark a page
#: of no use for training; they judge urls that no site rule fits.
BLOCK_WORDS = ("ads", "adserver", "adult", "banner", "betting", "casino", "doubleclick", "escort",
               "gambling", "login", "phishing", "popup", "porn", "sponsored", "tracker",
               "tracking", "viagra", "warez", "xxx")


@dataclass(frozen=True)
class Rule:
    """A pattern over host + path; ``site`` rules win over word rules."""
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool
    length: int
    host_length: int


def _runs(text: str) -> list[str]:
    out, run = [], ""
    for ch in text + "/":
        if ch.isascii() and ch.isalnum():
            run += ch
        elif run:
            out, run = [*out, run], ""
    return out


def _escaped(text: str) -> str:
    return "".join(ch if ch.isalnum() else f"\\x{{{ord(ch):x}}}" for ch in text)


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Rule for a host with its subdomains and paths that begin with ``path``.

    The last run of letters of a path that doesn't end in a delimiter may go
    on in the url, so it is no whole token and not indexed.
    """
    tail = path if path.endswith(tuple("/-_.~")) else path[:max(path.rfind(c) for c in "/-_.~") + 1]
    return Rule(host + path, verdict,
                f"^(?:[^/]*\\.)?{_escaped(host.translate(str.maketrans(UPPER, LOWER)))}{_escaped(path)}",
                tuple(dict.fromkeys([*_runs(host.lower()), *[x.lower() for x in _runs(tail)]])),
                True, len(host + path), len(host))


def word_rule(word: str) -> Rule:
    """Rule that blocks urls with ``word`` as a whole token, in any case."""
    return Rule(word, "block", f"(?i)(?<![A-Za-z0-9]){_escaped(word)}(?![A-Za-z0-9])",
                (word.lower(),), False, len(word), 0)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path of a url."""
    after = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))
    return F.translate(after, UPPER, LOWER), path


def _tokens(host: Column, path: Column) -> Column:
    """Distinct tokens, and the empty one that fetches rules without a token."""
    return F.array_distinct(F.split(F.translate(
        F.concat(F.lit("/"), host, path), UPPER, LOWER), "[^a-z0-9]+"))


def judge(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (of a site, or null) and verdict.

    Two shuffles carry a row number, a rule number and a few short columns:
    one counts the tokens of all urls, one brings the matches of a row
    together. The rule index is joined by its checked size.
    """
    spark = pages.sparkSession
    schema = "rule_no int, name string, verdict string, pattern string, tokens array<string>, " \
             "site boolean, length int, host_length int"
    listed = spark.createDataFrame(
        [(i, r.name, r.verdict, r.pattern, list(r.tokens), r.site, r.length, r.host_length)
         for i, r in enumerate(rules)], schema)
    host, path = parts(F.col(url))
    seen = pages.select(host.alias("host"), path.alias("path")) \
        .select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token")) \
        .groupBy("token").agg(F.count("*").alias("n"))
    index = listed.select("rule_no", F.explode_outer("tokens").alias("token")) \
        .join(seen, "token", "left") \
        .groupBy("rule_no").agg(F.min(F.struct(
            F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("token", F.lit("")).alias("token")))
            .alias("rarest")) \
        .join(listed, "rule_no").select(F.col("rarest.token").alias("token"), "rule_no", "name",
                                        "verdict", "pattern", "site", "length", "host_length")
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*own).alias("page"), host.alias("host"), path.alias("path"),
                        F.monotonically_increasing_id().alias("row_no"))
    fetched = rows.select("host", "path", "row_no",
                          F.explode(_tokens(F.col("host"), F.col("path"))).alias("token")) \
        .join(index, "token") \
        .filter(F.expr("rlike(concat(host, path), pattern)"))
    best = fetched.groupBy("row_no").agg(
        F.max(F.when(F.col("site"), F.struct(
            "length", "host_length", (-F.col("rule_no")).alias("order"), "name", "verdict"))).alias("s"),
        F.max(F.when(~F.col("site"), F.col("verdict"))).alias("w"))
    return rows.join(best, "row_no", "left").select(
        "page.*", "host", "path", F.col("s.name").alias("rule"),
        F.coalesce("s.verdict", "w", F.lit("allow")).alias("verdict"))
