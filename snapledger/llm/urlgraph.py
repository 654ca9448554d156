"""URL filters: host and path rules first, then trust and distrust spread over the host graph.

DataFrame functions only, but for two rows of totals that tell when the ranks have settled. Ranks are whole
numbers, so that sums don't depend on the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import stored

MASS = 10**12  # what the seeds of one kind share, in the units of the answers
FINE = 10**12  # parts of such a unit in which ranks are worked out
ROUNDS = 8  # between two written tables of ranks
SMALL = 100_000  # links and seeds up to which a round is less work than dealing its rows out
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Public suffixes of two labels: well-known ones, not the whole public suffix list.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "org.nz", "co.jp", "ne.jp", "or.jp", "ac.jp", "co.kr", "or.kr", "com.br", "org.br", "com.mx", "com.ar", "com.co",
    "com.cn", "org.cn", "net.cn", "com.tw", "com.hk", "com.sg", "com.my", "co.in", "org.in", "co.id", "co.th", "com.tr", "com.ua", "co.il", "org.il", "co.za", "org.za", "com.eg", "com.pl", "github.io",
)
#: The host of an absolute or scheme-relative link.
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    """``host`` with all its subdomains, for paths that start with ``path``; written ``host/...``."""

    rule: str
    allow: bool

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


RULES = (UrlRule("com/en/", False), UrlRule("example.com/en/7", True), UrlRule("net/de/", True), UrlRule("example.net/de/8", False), UrlRule("org/es/", False))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    found = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest rule that fits as a struct (length, rule, allow), or null. Of equally long ones the last in order of text."""
    def of(r: UrlRule) -> Column:
        found = F.struct(F.lit(len(r.rule)).alias("length"), F.lit(r.rule).alias("rule"), F.lit(r.allow).alias("allow"))
        return F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), found)

    fits = [of(r) for r in rules]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<length:int,rule:string,allow:boolean>")


def host_edges(pages: DataFrame) -> DataFrame:
    """Links between hosts (src, dst, weight) from ``host`` and ``html``, and one from each host to the host it is a subdomain of and back.

    The latter go up from every host, one label at a time, to a host of two labels or one below a public suffix
    of ``SUFFIXES``; addresses in numbers have none.

    Links are counted per pair before they are shuffled, so a host with very many pages is no burden. Links
    to the same host don't count.
    """
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst")).withColumn("dst", F.translate("dst", _UPPER, _LOWER))
    hosts = pages.select(F.col("host").alias("src")).union(links.select("dst")).where(F.size(F.split("src", r"\.")) >= 3).distinct()
    named = hosts.where(~F.col("src").rlike(r"^[0-9.]+(:[0-9]*)?$")).select(F.split("src", r"\.").alias("x"))
    rest = lambda i: F.array_join(F.slice("x", i, F.size("x")), ".")
    each = F.transform(F.sequence(F.lit(1), F.size("x") - 2), lambda i: F.struct(rest(i).alias("src"), rest(i + 1).alias("dst")))
    steps = named.select(F.explode(each).alias("s"))
    up = steps.select("s.*").where(F.col("dst").rlike(r"^[^.]+(\.[^.]+)+$") & ~F.col("dst").isin(*SUFFIXES)).distinct()
    every = links.unionByName(up).unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return every.where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def spread(seeds: DataFrame, edges: DataFrame, keep: int = 85, tolerance: float = 1e-9, small: int = SMALL) -> DataFrame:
    """Personalised PageRank, settled: (allow, host, rank) from seeds (allow, host, n) over (allow, src, dst, weight).

    Both kinds of ``allow`` are ranked at once, each for itself. Each round a host passes ``keep`` per cent of
    its rank on by link weight; the rest comes from the seeds, in proportion to n. Rank at hosts without links
    out is given up. Ranks begin with the seeds' own part and only grow, so a kind's summed change is the
    growth of its total. Rounds go on until ``ROUNDS`` of them add at most ``tolerance`` of the mass to each
    total and reach no new host. A kind's mass is ``MASS`` times ``FINE``; shares are floored after the
    multiplication, so what a link loses is under one unit. Link weights are below 10^12.

    The same rounds run without a shuffle, in one task, if there are at most ``small`` links and seeds: a round of
    few rows is otherwise all scheduling, of as many tasks as there are shuffle partitions. Sums of whole numbers
    don't depend on how the rows are dealt.
    """
    totals = seeds.groupBy("allow").agg(F.sum("n").alias("total"))
    seed = F.expr(f"CAST(floor(CAST(n AS DECIMAL(18,0)) * {100 - keep} * CAST({MASS * FINE // 100} AS DECIMAL(23,0)) / CAST(total AS DECIMAL(18,0))) AS DECIMAL(38,0))")
    start = stored(seeds.join(totals, "allow").select("allow", "host", seed.alias("rank")), "seeds")
    out = edges.groupBy("allow", "src").agg(F.sum("weight").alias("out"))
    part, whole = F.expr(f"CAST(weight * {keep} AS DECIMAL(14,0))"), F.expr("CAST(out * 100 AS DECIMAL(20,0))")
    shares = edges.join(out, ["allow", "src"]).select("allow", F.col("src").alias("host"), "dst", part.alias("part"), whole.alias("out"))
    shares = stored(shares, "shares")
    few = shares.limit(small + 1).count() + start.limit(small + 1).count() <= small
    held = (lambda df: df.coalesce(1)) if few else (lambda df: df)  # no exchange between tables of one partition
    start, shares = held(start), held(shares).hint("merge") if few else shares
    share = F.expr("CAST(floor(CAST(rank * part AS DECIMAL(38,0)) / out) AS DECIMAL(38,0))")
    rank, before = start, None
    while True:
        figures = {r.allow: (r.total, r.hosts) for r in rank.groupBy("allow").agg(F.sum("rank").alias("total"), F.count("*").alias("hosts")).collect()}  # two rows at most
        if before is not None and all(hosts == before[k][1] and total - before[k][0] <= tolerance * MASS * FINE for k, (total, hosts) in figures.items()):
            return rank
        before = figures
        for _ in range(ROUNDS):
            passed = rank.join(shares, ["allow", "host"]).select("allow", F.col("dst").alias("host"), share.alias("rank")).where("rank > 0")
            rank = held(passed.unionByName(start)).groupBy("allow", "host").agg(F.sum("rank").cast("decimal(38,0)").alias("rank"))
        rank = held(stored(rank, "ranks"))


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, tolerance: float = 1e-9, ratio: int = 1, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: its id, host, path, ``rule`` (null if none fits), ``verdict``, ``trust`` and ``distrust``.

    Where no rule fits, a host's pages are blocked if its distrust exceeds ``ratio`` times its trust. Trust
    flows along links from hosts with pages that a rule allows, distrust against the links from hosts with
    pages that a rule blocks, in proportion to the number of such pages, until the ranks have settled (see
    ``spread``); verdicts compare them unrounded. A url that is null or without
    ``://`` has an empty host and path and is allowed. Null html has no links. Repeated rows count and are
    answered one by one; null ids stay; other columns aren't read. With no rows or no seeds nothing is blocked.
    """
    url = F.col(url_col)
    base = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = base.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    edges = stored(host_edges(pages.select(host_of(url).alias("host"), F.col(html_col).alias("html"))), "edges")
    seeds = stored(ruled.where("found IS NOT NULL AND host <> ''").groupBy("host", F.col("found.allow").alias("allow")).agg(F.count("*").alias("n")), "seed_hosts")
    both = edges.select(F.lit(True).alias("allow"), "src", "dst", "weight").unionByName(edges.select(F.lit(False).alias("allow"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    ranks = spread(seeds, both, tolerance=tolerance)
    of = lambda kind: F.coalesce(F.sum(F.when(kind, F.col("rank"))), F.lit(0)).cast("decimal(38,0)")
    fine = ranks.groupBy("host").agg(of(F.col("allow")).alias("trust"), of(~F.col("allow")).alias("distrust"))
    whole = lambda c: F.floor(F.col(c) / F.lit(FINE)).cast("long").alias(c)
    scores = stored(fine.select("host", (F.col("distrust") <= F.col("trust") * ratio).alias("fair"), whole("trust"), whole("distrust")), "scores")
    joined = ruled.join(scores, "host", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("trust", "distrust")})
    allow = F.coalesce(F.col("found.allow"), F.col("fair"), F.lit(True))
    return joined.select(F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), F.when(allow, "allow").otherwise("block").alias("verdict"), "trust", "distrust")
