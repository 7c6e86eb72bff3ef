"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression over ``host || path`` with literal tokens that
every match must hold whole, in lower case. Each rule is filed under the one of
its tokens that the fewest URLs hold, counted over the whole table. The tokens
of a URL fetch the rules filed under them, and only those run. A rule without a
token is filed under every one of ``SPREAD`` keys, of which each URL has one, so
it is tried on all URLs and these never meet in one task.

Host rules name a host (with its subdomains) and the start of a path; the
longest one that fits decides. Pattern rules decide where no host rule fits,
block before allow. Rules of equal length: block before allow, then the name
that is last in order.

Cases: a null URL, or one without ``://``, has an empty host and path, no rule
and the default verdict; a very long URL is matched whole; rules may repeat or
share a pattern, each is tried; repeated rows and repeated ids keep their rows;
an empty table gives an empty table; all columns pass through, whatever their
names, and the added ones replace columns of their name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import regex
from pyspark.sql import Column, DataFrame, functions as F

from .common import apart

TOKEN = r"[\p{L}\p{M}\p{N}]+"
SCHEMA = "number int, rule string, pattern string, verdict string, rank int, tokens array<string>"
#: Keys of rules without tokens.
SPREAD = 64
#: The filter's own patterns: words of unwanted sites, as whole tokens of the host.
UNWANTED = ("adult", "bets", "casino", "malware", "phishing", "porn", "spam", "torrent", "warez", "xxx")


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def row(self) -> tuple:
        text = (self.host + self.path).lower()
        # the last token of a path may go on in the URL unless a separator ends it
        tokens = [m.group() for m in regex.finditer(TOKEN, text) if not self.path or m.end() < len(text)]
        return self.name, rf"^(?:[^/]*\.)?{re.escape(self.host)}{re.escape(self.path)}", self.verdict, len(self.name), sorted(set(tokens))


def token_rule(word: str, verdict: str = "block") -> tuple:
    """A pattern rule without name: ``word`` as a whole token of the host."""
    return None, rf"^(?:[^/]*[^a-z0-9/])?{word}(?:[^a-z0-9/][^/]*)?(?:/|$)", verdict, 0, [word]


def default_rules() -> list[HostRule]:
    return [HostRule("block", "com", "/en/"), HostRule("allow", "example.com", "/en/7"), HostRule("allow", "net", "/de/"), HostRule("block", "example.net", "/de/8"), HostRule("block", "org", "/es/")]


def host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Tokens of a URL in lower case: words of all letters, and their ASCII parts, which patterns may ask for by themselves."""
    found = lambda pattern: F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    return F.array_union(found(TOKEN), found("[a-z0-9]+"))


def judge(pages: DataFrame, rules: list[HostRule] | None = None, patterns: list[tuple] | None = None, default: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (of the host rule that decided) and verdict.

    The URL's own columns are all that is shuffled; Spark broadcasts the rules
    while they are small and shuffles them by token where they are not.
    """
    spark = pages.sparkSession
    rows = [r.row() for r in (default_rules() if rules is None else rules)] + ([token_rule(w) for w in UNWANTED] if patterns is None else patterns)
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    own, back = apart(pages.select(*(f"`{c}`" for c in pages.columns if c not in ("host", "path", "rule", "verdict"))), url_col)
    parts = own.withColumns({"host": host(F.col(url_col)), "path": path(F.col(url_col))})

    targets = parts.select("host", "path").filter("host <> '' or path <> ''").distinct().withColumn("target", F.concat("host", "path"))
    spread = lambda key: F.concat(F.lit("/"), key.cast("string"))  # no token holds a slash
    keys = F.concat(tokens(F.lower("target")), F.array(spread(F.pmod(F.xxhash64("target"), F.lit(SPREAD)))))
    by_token = targets.select("host", "path", "target", F.explode(keys).alias("token"))
    wanted = table.select(F.explode("tokens").alias("token")).distinct()
    small = len(rows) <= 10_000
    common = by_token.join(F.broadcast(wanted) if small else wanted, "token").groupBy("token").agg(F.count("*").alias("n"))
    entries = table.withColumn("token", F.explode("tokens")).join(common, "token", "left")
    rarest = entries.groupBy("number").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    bare = table.filter("size(tokens) = 0").select("number", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("key")).select("number", spread(F.col("key")).alias("token"))
    filed = table.join(rarest.unionByName(bare), "number").select("token", "rule", "pattern", "verdict", "rank")
    # tokens under which no rule is filed never leave their task while the rules are few
    fits = by_token.join(F.broadcast(filed) if small else filed, "token").filter(F.rlike("target", F.col("pattern")))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), F.struct("rank", "verdict", "rule")).alias("best"))
    out = parts.join(best, ["host", "path"], "left")
    return out.select(*back, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
