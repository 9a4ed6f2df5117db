"""URL filters: host-suffix and path-prefix expressions against a rule table.

Every URL is expanded into (host suffix, path prefix) expressions, the way
public block lists are matched: ``a.b.net/x/y`` gives the hosts ``a.b.net``,
``b.net``, ``net`` and the paths ``""``, ``/``, ``/x/``. An equi-join on a short
prefix of each expression's digest finds candidate rules; the full digest and
the rest of the rule's path confirm them; precedence picks one rule per URL.

A rule's path may end anywhere, so its expression is the path up to the last
``/`` and the remainder is confirmed by ``startswith``. Expressions longer than
any rule's are never built: the deepest host and path of the rule table bound
the expansion, so a URL with thousands of slashes costs no more than a rule
has levels, and no rule can be missed.

Only built-in functions are used. URLs are made distinct before they are
expanded, so a URL that a third of all pages share is expanded once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ascii_lower, stored

#: Hexadecimal digits of the digest that the equi-join uses (32 bits).
SHORT_DIGITS = 8


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # A host holds no "/", so the pair is recoverable from the joined text.
    return F.sha2(F.concat(host, F.lit("/"), path), 256)


def _levels(rules: DataFrame) -> tuple[int, int]:
    """Deepest host (labels) and path (slashes) of the rules: two numbers."""
    row = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.max(F.size(F.split("path", "/")) - 1).alias("slashes"),
    ).first()
    return row["labels"] or 0, row["slashes"] or 0


def _suffixes(host: Column, labels: int) -> Column:
    parts = F.split(host, r"\.")
    own = F.size(parts)
    return F.transform(
        F.sequence(F.lit(1), F.least(own, F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice(parts, own - k + 1, k), "."),
    )


def _prefixes(path: Column, slashes: int) -> Column:
    # "/x/y" has the prefixes "", "/" and "/x/": its first k pieces, closed by "/".
    pieces = F.split(path, "/", slashes + 2)
    return F.transform(
        F.sequence(F.lit(0), F.least(F.size(pieces) - 1, F.lit(slashes))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(pieces, 1, k), "/"), F.lit("/"))),
    )


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` (page_id, url) by ``rules`` (host, path, verdict).

    Returns page_id, host, path, rule (``host`` + ``path`` of the rule, else
    null) and verdict (the rule's, else ``default``), one row per input row.

    - A rule fits its host and all subdomains if the URL's path starts with the
      rule's path. The longest rule (characters of host and path) wins; of
      equally long rules a block wins, then the smaller text.
    - A null URL, or one without ``://``, has an empty host and path; no rule
      fits it. Rules with a null host or path are ignored, repeated rules count
      once.
    - Repeated pages (the same page_id and url) give one row each. Other columns
      of ``pages`` are not read, so their names cannot clash.
    """
    rules = (
        rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"),
                     F.col("verdict").alias("rule_verdict"))
        .where("rule_host is not null and rule_path is not null").distinct()
        .withColumn("base", F.regexp_extract("rule_path", r"\A(.*/)?", 0))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("base")))
        .withColumn("short", F.substring("digest", 1, SHORT_DIGITS))
    )
    labels, slashes = _levels(rules.select(F.col("rule_host").alias("host"), F.col("rule_path").alias("path")))

    pages = pages.select("page_id", "url")
    urls = pages.select("url").distinct().select(
        "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    expressions = (
        urls.where("host <> ''")
        .select("url", "path", F.explode(_suffixes(F.col("host"), labels)).alias("suffix"))
        .select("url", "path", "suffix", F.explode(_prefixes(F.col("path"), slashes)).alias("prefix"))
        .withColumn("full", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("full", 1, SHORT_DIGITS))
    )
    hits = (
        expressions.join(rules, "short")
        .where((F.col("full") == F.col("digest")) & F.startswith(F.col("path"), F.col("rule_path")))
    )
    name = F.concat("rule_host", "rule_path")
    order = F.struct(
        (-F.length(name)).alias("longest"),
        F.when(F.col("rule_verdict") == "block", 0).otherwise(1).alias("strict"),
        name.alias("rule"), F.col("rule_verdict").alias("verdict"),
    )
    best = stored(pages.sparkSession, hits.groupBy("url").agg(F.min(order).alias("best")), "url-rules")
    return (
        # A sort-merge join by hint: the table of hit URLs grows with the pages.
        pages.join(best.hint("merge"), "url", "left")
        .select(
            "page_id",
            F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"),
            F.coalesce(url_path(F.col("url")), F.lit("")).alias("path"),
            F.col("best.rule").alias("rule"),
            F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"),
        )
    )
