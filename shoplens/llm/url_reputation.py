"""URL filter by host reputation: rules first, then labelled page outcomes shrunk by empirical Bayes.

The outcomes of labelled pages (1 bad, 0 good) are counted per host and shrunk through beta-binomial
priors: the suffix (``org``) towards the rate of all labelled pages, the registered domain
(``example.org``) towards its suffix, the host towards its domain. How strongly a level pulls comes from
the spread of the rates below one parent beyond what chance gives (the analysis-of-variance estimate of
the beta-binomial correlation), estimated anew for each level. A host is blocked when the lower bound of
its posterior, ``SURE`` standard deviations below the mean, reaches ``LIMIT``: a few bad pages do not
condemn a host, and a host without labelled pages is judged by its domain and suffix.

The host of a url is what stands after the first ``://`` up to ``/``, ``?`` or ``#``, in lower case (A-Z),
the path what follows up to ``?`` or ``#``. For the levels a port and a user name are left out; an
address of digits and dots is its own domain and suffix. ``suffixes`` names suffixes of more than one
label (``co.uk``). A rule ``host/path`` fits its host and all subdomains if the path starts with the
rule's; the longest rule wins, of equally long ones the one that blocks. Rules are a list in the program,
so they are part of the plan, not data.

Null or odd url: host and path are empty, no rule fits, and the empty host is judged like any other.
Repeated rows are judged each by itself; a null page_id is kept. Very long urls are handled as they are.
Null labels are left out. Without any labelled page nothing is blocked but by rule. Extra columns stay
out of the result; an empty table gives no rows.

Only counts move: pages are combined to one row per host (and labelled document) before any shuffle, and
the pages meet only the blocked hosts, so a host with a third of all pages is one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.sources.stages import store

LIMIT, SURE = 0.3, 1.645
LOOSEST, TIGHTEST = 1e-4, 0.5  # bounds of the correlation: strengths of 9,999 pages and of one
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("host", "domain", "suffix")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)([^?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)([^?#]*)", 2)


def located(pages: DataFrame) -> DataFrame:
    """page_id, host, path of every row."""
    url = F.col("url").cast("string")
    return pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))


def rule_of(host: Column, path: Column, rules: Iterable[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that fits and its verdict; null where none does. ``rules``: (allow or block, rule)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last branch added is looked at first, so the longest rule comes last.
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + rest)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def with_levels(hosts: DataFrame, suffixes: Iterable[str] = ()) -> DataFrame:
    """``hosts`` with domain and suffix."""
    bare = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(bare, r"\.")
    long = [s.count(".") + 1 for s in suffixes]
    size = F.lit(1)
    for text, count in sorted(zip(suffixes, long), key=lambda s: s[1]):
        size = F.when((bare == text) | bare.endswith(f".{text}"), count).otherwise(size)

    def last(count: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - count, F.lit(0)) + 1, count), ".")

    address = bare.rlike(r"^[0-9.]+$")
    return hosts.withColumns(
        {"domain": F.when(address, bare).otherwise(last(size + 1)),
         "suffix": F.when(address, bare).otherwise(last(size))}
    )


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, bad) of every host; ``pages``: (host, item), ``outcomes``: (item, bad), one row per item."""
    items = pages.groupBy("host", "item").agg(F.count(F.lit(1)).alias("pages"))
    return items.join(outcomes, "item", "left").groupBy("host").agg(
        F.sum(F.when(F.col("bad").isNotNull(), F.col("pages")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("bad") == 1, F.col("pages")).otherwise(0)).alias("bad"),
    )


def strength(children: DataFrame, parent: str) -> float:
    """How many pages a parent's rate counts for in the rates of its children: (n, bad, parent)."""
    n, f = F.col("n").cast("double"), F.col("bad").cast("double")
    groups = children.filter("n > 0").groupBy(parent).agg(
        F.count(F.lit(1)).cast("double").alias("members"), F.sum(n).alias("pages"), F.sum(f).alias("fails"),
        F.sum(n * n).alias("squares"), F.sum(f * f / n).alias("rates"), F.sum(f - f * f / n).alias("within"),
    )
    # One row of sums, whatever the data.
    sums = groups.agg(
        F.sum("members").alias("members"), F.count(F.lit(1)).cast("double").alias("parents"),
        F.sum("pages").alias("pages"), F.sum(F.col("squares") / F.col("pages")).alias("uneven"),
        F.sum(F.col("rates") - F.col("fails") * F.col("fails") / F.col("pages")).alias("between"),
        F.sum("within").alias("within"),
    ).first()
    linked = TIGHTEST
    if sums.members and sums.members > sums.parents:
        free = sums.members - sums.parents
        size = (sums.pages - sums.uneven) / free
        between = sums.between / free
        within = sums.within / max(sums.pages - sums.members, 1.0)
        spread = between + (size - 1) * within
        linked = (between - within) / spread if spread > 0 else 0.0
    return 1 / min(max(linked, LOOSEST), TIGHTEST) - 1


def reputation(hosts: DataFrame) -> DataFrame:
    """host, n, bad, rate (posterior mean) and bound (its lower bound) of every host."""
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = store(domains, "domains")
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = store(tops.withColumn("root", F.lit("")), "suffixes")
    whole = tops.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((whole.bad or 0) + 1) / ((whole.n or 0) + 2)

    def posterior(level: DataFrame, pull: float, mean: Column) -> Column:
        return (pull * mean + F.col("bad")) / (pull + F.col("n"))

    top_rates = tops.select(
        "suffix", posterior(tops, strength(tops, "root"), F.lit(overall)).alias("above")
    )
    domain_rates = domains.join(top_rates, "suffix").select(
        "domain", "suffix", posterior(domains, strength(domains, "suffix"), F.col("above")).alias("mean")
    )
    pull = strength(hosts, "domain")
    rated = hosts.join(domain_rates, ["domain", "suffix"]).select(
        "host", "n", "bad", posterior(hosts, pull, F.col("mean")).alias("rate")
    )
    rate = F.col("rate")
    return rated.withColumn("bound", rate - SURE * F.sqrt(rate * (1 - rate) / (pull + F.col("n") + 1)))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, item: Column, rules: list[tuple[str, str]],
    limit: float = LIMIT, suffixes: Iterable[str] = (),
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``item`` is the column of ``pages`` that names what was labelled, ``outcomes`` its labels: (item, bad),
    bad 0 or 1; of several labels of one item their majority counts, bad if even.
    """
    known = (
        outcomes.filter("item IS NOT NULL AND bad IS NOT NULL")
        .groupBy("item").agg((F.avg("bad") >= 0.5).cast("int").alias("bad"))
    )
    url = F.col("url").cast("string")
    counts = host_counts(pages.select(host_of(url).alias("host"), item.alias("item")), known)
    hosts = store(with_levels(counts, suffixes), "hosts")
    rated = store(reputation(hosts), "host-reputation")
    blocked = rated.filter(F.col("bound") >= limit)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return located(pages).join(
        blocked.select("host", F.lit("block").alias("host_verdict")), "host", "left"
    ).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, "host_verdict", F.lit("allow")).alias("verdict"),
    )


#: The rules of the registered query (fixed values).
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def judge_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The pages judged by ``RULES`` and by the labels of the documents they show: the last number of a
    page's path is the doc_id. A page is bad if its document has quality 0 or is toxic."""
    number = F.regexp_extract(path_of(F.col("url").cast("string")), r"/([0-9]+)(\.[a-z]+)?/?$", 1)
    item = number.try_cast("bigint")
    bad = F.greatest(1 - F.col("quality"), F.col("toxic")).cast("int").alias("bad")
    return judge_urls(pages, labels.select(F.col("doc_id").alias("item"), bad), item, RULES)
