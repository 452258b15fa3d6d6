"""URL rules: expand, equi-join on short hash prefixes, confirm, take the longest.

A URL is expanded into every host suffix at a label and every path prefix, of the lengths
that some rule has; any other expression can match nothing. Each expression is hashed
(SHA-256); the join runs on the first four bytes of the digest, the whole digest confirms,
and of the rules that fit the longest wins. No Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.shared import free_names, without

PREFIX_CHARS = 8  # hexadecimal digits of the joined hash prefix: four bytes


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(raw, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule, or NULL) and ``verdict``.

    * ``rules`` (host, path, verdict): a rule fits its host and all subdomains if the path starts
      with its path. The longest (host and path together) wins, then the longer host, then
      ``block``. Rules without a host, a path or a verdict are ignored; repeated rules count once.
    * NULL urls and urls without ``://`` have an empty host and path and get ``default``.
    * Rows are judged one by one: repeated rows stay repeated, whatever their id. Existing
      columns of the four names are replaced. Rows meet in a shuffle by their own number, so
      a url, host or page id of many rows is no hot key.
    """
    pages = without(pages, "host", "path", "rule", "verdict")
    names = list(pages.columns)
    row, hosts, exprs, digest, known_prefix, known_digest, known_rule = free_names(
        pages, "_row", "_hosts", "_expression", "_digest", "_known_prefix", "_known_digest", "_known_rule"
    )
    rules = rules.dropna(subset=["host", "path", "verdict"]).distinct()
    known = rules.select(
        F.substring(_digest(F.col("host"), F.col("path")), 1, PREFIX_CHARS).alias(known_prefix),
        _digest(F.col("host"), F.col("path")).alias(known_digest),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"),
            F.length("host").alias("host_size"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias(known_rule),
    )
    # The lengths that rules have, as two short arrays: one row, at most one entry per length.
    lengths = rules.agg(
        F.coalesce(F.collect_set(F.length("host")), F.array().cast("array<int>")).alias("_host_sizes"),
        F.coalesce(F.collect_set(F.length("path")), F.array().cast("array<int>")).alias("_path_sizes"),
    ).first()
    host_sizes = F.array(*[F.lit(n) for n in sorted(lengths[0])]).cast("array<int>")
    path_sizes = F.array(*[F.lit(n) for n in sorted(lengths[1])]).cast("array<int>")

    read = pages.withColumns(
        {row: F.monotonically_increasing_id(), "host": url_host(F.col(url)), "path": url_path(F.col(url))}
    )
    size = F.length("host")
    at_label = lambda n: (size == n) | ((size > n) & (F.substring(F.col("host"), size - n, F.lit(1)) == "."))
    suffixes = F.transform(F.filter(host_sizes, at_label), lambda n: F.substring(F.col("host"), size - n + 1, n))
    prefixes = F.transform(
        F.filter(path_sizes, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    expanded = read.withColumn(
        exprs,
        F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: _digest(h, p)))),
    )
    each = expanded.select(*names, row, "host", "path", F.explode_outer(exprs).alias(digest))
    fits = each.join(
        known,
        (F.substring(F.col(digest), 1, PREFIX_CHARS) == F.col(known_prefix)) & (F.col(digest) == F.col(known_digest)),
        "left",
    )
    kept = [*names, "host", "path"]
    judged = fits.groupBy(row).agg(
        *[F.first(n).alias(n) for n in kept], F.max(known_rule).alias(hosts)
    )
    return judged.select(
        *kept,
        F.col(f"{hosts}.rule").alias("rule"),
        F.coalesce(F.col(f"{hosts}.verdict"), F.lit(default)).alias("verdict"),
    )
