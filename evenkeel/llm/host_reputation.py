"""URL filter: explicit rules first, then the reputation of the page's host.

Only DataFrame functions. Labelled page outcomes (good or bad) are counted by host. The
share of bad pages of a host is a beta-binomial: its prior lies around the share of its
registered domain, whose own prior lies around that of its suffix, and that one's around
the share of all. How tightly a level holds to the one above is learnt from the counts:
where (k - n m)^2 / (n m (1 - m)) is about 1 for each group, its members differ by chance
alone and the prior is tight; the excess over 1, divided by n - 1, is the correlation rho
of two pages of a group, and the prior counts as 1 / rho - 1 pages. A host is blocked when
even the lower bound of its posterior (``SPREADS`` standard deviations below the mean) is
above ``limit``: a host with few labels is judged by its relatives, not by one bad page.

Counts are summed before they are shuffled, so a hot host is a few rows; the join that
brings verdicts back is one that Spark can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import stored

# Share of bad pages, and standard deviations below the mean.
LIMIT, SPREADS = 0.4, 1.645
# Pages that a prior may count as.
WEAKEST, STRONGEST = 1.0, 10_000.0
# Suffixes of two labels under which names are registered.
LONG_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br",
    "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for NULL and for what has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` (verdict, host, path) that fits, else NULLs.

    A rule fits its host and all subdomains where the path starts with the rule's. Of
    rules of one length the first listed wins.
    """
    rule = verdict = None
    for told, at, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, at + start) if rule is None else rule.when(fits, at + start)
        verdict = F.when(fits, told) if verdict is None else verdict.when(fits, told)
    return (F.lit(None).cast("string"),) * 2 if rule is None else (rule, verdict)


def with_levels(df: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """``df`` (host, ...) with the registered ``domain`` and ``suffix`` of its host.

    User names, ports and a last dot do not count. An address of numbers is a domain and
    a suffix of its own; so is a host of one label.
    """
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":[0-9]*$", ""), r"\.$", "")
    last = lambda n: F.substring_index("_name", ".", -n)
    long = last(2).isin(*long_suffixes)
    address = F.col("_name").rlike(r"^[0-9.]+$|^\[")
    return (
        df.withColumn("_name", name)
        .withColumn("suffix", F.when(address, F.col("_name")).when(long, last(2)).otherwise(last(1)))
        .withColumn("domain", F.when(address, F.col("_name")).when(long, last(3)).otherwise(last(2)))
        .drop("_name")
    )


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, labelled, bad) of every host of ``pages`` (id, host).

    ``labels`` are (id, bad); NULL ids and outcomes other than 0 and 1 count for nothing.
    Several labels of a page are several outcomes.
    """
    told = labels.where("bad IN (0, 1)").groupBy("id").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("k"))
    rows = pages.groupBy("id", "host").agg(F.count("*").alias("rows"))
    return (
        rows.join(told, "id", "left")
        .groupBy("host")
        .agg(
            F.coalesce(F.sum(F.col("rows") * F.col("n")), F.lit(0)).cast("long").alias("labelled"),
            F.coalesce(F.sum(F.col("rows") * F.col("k")), F.lit(0)).cast("long").alias("bad"),
        )
    )


def prior_pages(groups: DataFrame, most: float = STRONGEST) -> float:
    """What a prior counts as, in pages, learnt from ``groups`` (above, labelled, bad); at most ``most``.

    Excess is summed in millionths, as whole numbers, so that no order of sums matters.
    """
    n, k, m = F.col("labelled"), F.col("bad"), F.col("above")
    excess = F.round(((k - n * m) * (k - n * m) / (n * m * (1 - m)) - 1) * 1e6).cast("long")
    seen = groups.where(n > 1).agg(F.sum(excess).alias("excess"), F.sum(n - 1).alias("free")).first()
    rho = seen.excess / 1e6 / seen.free if seen.free else 0.0
    return max(WEAKEST, 1 / rho - 1) if rho > 1 / (most + 1) else most


def reputations(hosts: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """(host, domain, suffix, labelled, bad, bad_rate, bad_bound) from (host, labelled, bad).

    ``bad_rate`` is the posterior mean of the share of bad pages, ``bad_bound`` its lower
    bound. Hosts without labels get their domain's. An empty table gives an empty result.
    The driver sees sums over all groups of a level alone.
    """
    known = stored(with_levels(hosts, long_suffixes), "hosts")
    total = known.agg(F.sum("labelled").alias("n"), F.sum("bad").alias("k")).first()
    start = F.lit(((total.k or 0) + 1) / ((total.n or 0) + 2))
    # A share that few labels tell is not known better than they do.
    most = min(STRONGEST, (total.n or 0) + 2.0)
    above = None
    for keys in (["suffix"], ["domain", "suffix"]):
        counts = known.groupBy(*keys).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
        counts = counts.withColumn("above", start) if above is None else counts.join(above, "suffix")
        groups = stored(counts, f"level-{keys[0]}")
        held = F.lit(prior_pages(groups, most))
        above = groups.select(*keys, ((held * F.col("above") + F.col("bad")) / (held + F.col("labelled"))).alias("above"))
    rows = stored(known.join(above, ["domain", "suffix"]), "level-host")
    held = F.lit(prior_pages(rows, most))
    rows = rows.withColumn("a", held * F.col("above") + F.col("bad")).withColumn(
        "b", held * (1 - F.col("above")) + (F.col("labelled") - F.col("bad"))
    )
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    bound = F.greatest(F.lit(0.0), mean - SPREADS * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))
    return rows.select("host", "domain", "suffix", "labelled", "bad", mean.alias("bad_rate"), bound.alias("bad_bound"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = (),
    id_column: str = "page_id",
    url_column: str = "url",
    limit: float = LIMIT,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, bad_rate, bad_bound.

    ``labels`` are (id, bad): outcomes of pages, 1 for bad. ``verdict`` is ``allow`` or
    ``block``: the longest fitting rule's (``rule``, else NULL), else ``block`` where the
    host's lower bound is above ``limit``. NULL urls and those without ``://`` have an
    empty host and path; they share the reputation of the empty host. Pages with a NULL
    id have no outcome but are judged. Rows that repeat are judged and counted as often
    as they occur. Without labels no host is blocked. An empty table gives an empty
    result. Other columns are not looked at.
    """
    host, path = url_parts(F.col(url_column))
    told, how = rule_of(F.col("host"), F.col("path"), rules)
    parts = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    known = reputations(outcomes(parts.select("id", "host"), labels), long_suffixes)
    return parts.join(known, "host", "left").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        told.alias("rule"),
        F.coalesce(how, F.when(F.col("bad_bound") > limit, "block").otherwise("allow")).alias("verdict"),
        "bad_rate",
        "bad_bound",
    )
