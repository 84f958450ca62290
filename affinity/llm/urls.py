"""URL rules: host-suffix and path-prefix expressions, matched by hash.

Every URL's (host, path) is expanded into the expressions under which a rule could name it:
each suffix of the host that starts at a label, with each prefix of the path that is as long
as some rule's path. Expressions meet rules in an equi-join on the first hex digits of their
SHA-256; the full digest confirms, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import BROADCAST_ROWS, small

# The rules (host, path, verdict) of the query.
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

HASH_PREFIX = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://``."""
    at = F.expr(f"instr({url}, '://')")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _digest(host: str, path: str) -> F.Column:
    # NUL cannot be in a rule's host, so the pair can be read from the joined text in one way.
    return F.sha2(F.concat(host, F.lit("\0"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages(page_id, url)``.

    ``rules(host, path, verdict)``: a rule fits its host and all its subdomains if the path
    starts with the rule's. The rule with the longest text wins; among equal texts, the
    longer host, then ``block``. A URL that no rule fits gets ``default`` and a null rule.
    Rules with a null are left out. A null URL, or one without ``://``, has empty parts,
    which only a rule with an empty host could fit. Repeated rows and null ids are returned
    as they came; other columns are not read.

    Work is done once per different (host, path), so one hot URL costs one expansion.
    """
    host, path = host_and_path("url")
    pages = pages.select("page_id", "url").select(
        "page_id", host.alias("host"), path.alias("path")
    )
    rules = (
        rules.select("host", "path", "verdict")
        .dropna()
        .distinct()
        .select(
            _digest("host", "path").alias("rule_digest"),
            F.concat("host", "path").alias("rule"),
            F.length("host").alias("host_length"),
            F.length("path").alias("path_length"),
            "verdict",
        )
    )
    n_rules = rules.count()
    # One row: the different lengths of the rules' paths, and whether a rule names no host.
    known = rules.agg(
        F.sort_array(F.collect_set("path_length")).alias("lengths"),
        F.bool_or(F.col("host_length") == 0).alias("any_host"),
    ).first()
    lengths = F.array(*map(F.lit, known.lengths)).cast("array<int>")
    parts = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    if known.any_host:
        suffixes = F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")),
        lambda n: F.substring(F.col("path"), F.lit(1), n),
    )
    expanded = (
        parts.select("host", "path", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path", _digest("suffix", "prefix").alias("digest"))
        .withColumn("short", F.substring("digest", 1, HASH_PREFIX))
    )
    rules = rules.withColumn("short", F.substring("rule_digest", 1, HASH_PREFIX))
    best = F.struct(
        F.length("rule").alias("length"), "host_length", "verdict", "rule"
    )
    found = (
        expanded.join(small(rules, n_rules, BROADCAST_ROWS), "short")
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(best).alias("best"))
    )
    return pages.join(found, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
