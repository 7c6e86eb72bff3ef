"""Completeness of repositories, backlogs, attempts and hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import is_unset, normal_host

#: Allowed hosts; a star matches anything but a slash (fixed values).
ALLOWED = ["https://*"]


def join_repos_pds(repos: DataFrame, pds: DataFrame) -> DataFrame:
    """Left join; hosts bring their columns with the prefix ``host_``."""
    hosts = pds.select(F.col("id").alias("pds"), F.col("host"), F.col("first_cursor_since_reset").alias("host_first_cursor"), F.col("cursor").alias("host_cursor"), F.col("disabled").alias("host_disabled"))
    return repos.join(hosts, "pds", "left")


def _enabled() -> Column:
    return F.coalesce(~F.col("host_disabled"), F.lit(True))


def _gap(mode: str) -> Column:
    indexed = F.greatest("last_indexed_rev", "last_firehose_rev") if mode == "model" else F.col("last_indexed_rev")
    rev = ~is_unset(F.col("first_rev_since_reset")) & (indexed < F.col("first_rev_since_reset"))
    cursor = F.col("first_cursor_since_reset").isNotNull() & (F.col("first_cursor_since_reset") != 0) & (F.col("first_cursor_since_reset") < F.col("host_first_cursor"))
    return is_unset(F.col("last_indexed_rev")) | F.coalesce(rev, F.lit(False)) | F.coalesce(cursor, F.lit(False))


def stale_repos(repos: DataFrame, pds: DataFrame, max_attempts: int = 3, mode: str = "code", check_disabled: bool = True) -> DataFrame:
    rows = join_repos_pds(repos, pds).filter(_gap(mode) & (F.coalesce("failed_attempts", F.lit(0)) < max_attempts))
    if check_disabled:
        rows = rows.filter(_enabled())
    return rows.select(*repos.columns)


def stale_limit(stale: DataFrame, n: int) -> DataFrame:
    return stale.orderBy("id").limit(n)


def backlog_by_host(repos: DataFrame, pds: DataFrame) -> DataFrame:
    return stale_repos(repos, pds).groupBy("pds").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "pds")


def backlog_sample(repos: DataFrame, pds: DataFrame, per_host: int) -> DataFrame:
    """At most so many stale repos of each host, by DID."""
    nth = F.row_number().over(Window.partitionBy("pds").orderBy("did"))
    return stale_repos(repos, pds).withColumn("nth", nth).filter(F.col("nth") <= per_host)


def complete_repos(repos: DataFrame, pds: DataFrame, with_cursor: bool = True, max_attempts: int = 3) -> DataFrame:
    rows = join_repos_pds(repos, pds)
    whole = (F.col("failed_attempts") < max_attempts) & (F.col("last_indexed_rev") != "") & (is_unset(F.col("first_rev_since_reset")) | (F.col("last_indexed_rev") >= F.col("first_rev_since_reset")))
    if with_cursor:
        own = F.col("first_cursor_since_reset")
        whole &= own.isNull() | (own == 0) | (own >= F.col("host_first_cursor"))
    return rows.filter(whole).select(*repos.columns)


def failed_repos(repos: DataFrame, max_attempts: int = 3) -> DataFrame:
    return repos.filter(F.col("failed_attempts") >= max_attempts)


def gauges(repos: DataFrame, pds: DataFrame) -> DataFrame:
    """Seen, complete and failed accounts."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(repos, "seen").crossJoin(count(complete_repos(repos, pds), "complete")).crossJoin(count(failed_repos(repos), "failed"))


def completeness_report(repos: DataFrame, pds: DataFrame) -> DataFrame:
    rows = join_repos_pds(repos, pds)
    reason = F.when(is_unset(F.col("last_indexed_rev")), "never indexed").when(~is_unset(F.col("first_rev_since_reset")) & (F.greatest("last_indexed_rev", "last_firehose_rev") < F.col("first_rev_since_reset")), "revision gap").when((F.col("first_cursor_since_reset") != 0) & (F.col("first_cursor_since_reset") < F.col("host_first_cursor")), "cursor reset")
    return rows.select("id", "did", F.greatest("last_indexed_rev", "last_firehose_rev").alias("known_to"), F.col("first_rev_since_reset").alias("live_from"), reason.isNotNull().alias("gap"), reason.alias("reason"))


def record_attempt(repos: DataFrame, attempts: DataFrame) -> DataFrame:
    """``attempts``: id, ok, error, at."""
    joined = repos.join(attempts.select("id", "ok", F.col("error").alias("_error"), F.col("at").alias("last_index_attempt")), "id", "left")
    n = F.when(F.col("ok"), 0).when(~F.col("ok"), F.coalesce("failed_attempts", F.lit(0)) + 1).otherwise(F.col("failed_attempts"))
    error = F.when(F.col("ok"), "").when(~F.col("ok"), F.col("_error")).otherwise(F.col("last_error"))
    return joined.withColumns({"failed_attempts": n.cast("int"), "last_error": error}).drop("ok", "_error")


def reset_failures(repos: DataFrame) -> DataFrame:
    return repos.withColumns({"failed_attempts": F.lit(0), "last_error": F.lit("")})


def error_summary(repos: DataFrame) -> DataFrame:
    return repos.filter(~is_unset(F.col("last_error"))).groupBy("last_error").agg(F.count("*").alias("n"))


def hosts_due(pds: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    old = F.col("last_list").isNull() | (F.col("last_list") < F.lit(as_of).cast("timestamp") - F.expr(f"interval {hours} hours"))
    return pds.filter(F.coalesce(~F.col("disabled"), F.lit(True)) & old)


def allowed(host: Column, patterns: list[str]) -> Column:
    """Whether the host matches one of the patterns."""
    import re

    regex = "|".join("".join("[^/]*" if c == "*" else "[^/]" if c == "?" else re.escape(c) for c in p) for p in patterns)
    return normal_host(host).rlike(f"^(?:{regex})$")


def host_whitelist(hosts: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    return hosts.filter(allowed(F.col("host"), patterns or ALLOWED))


def disable_unlisted(pds: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    return pds.withColumn("disabled", F.when(~allowed(F.col("host"), patterns or ALLOWED), True).otherwise(F.col("disabled")))


def seed_hosts(pds: DataFrame, hosts: DataFrame) -> DataFrame:
    """Hosts to insert: those not there yet."""
    return hosts.select("host").distinct().join(pds, "host", "left_anti")
