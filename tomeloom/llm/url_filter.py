"""URL filters: rules first, then link-graph propagation of trust and distrust.

Rules are (host, path prefix, verdict) in a short list; the longest that fits a url decides. For the
other urls the host graph does: hyperlinks in the pages' html between hosts, and edges between a host and
the domain it belongs to. Hosts with pages that an allow rule fits are trusted seeds, hosts with pages under
a block rule are blocked seeds, each in the share of their pages. Personalised PageRank carries trust
along the edges, and distrust against them; a host is blocked where its distrust exceeds its trust and `least`.

Edges are counted by pair of hosts before anything else is shuffled; each round is one join and one
aggregate, written to the shared folder each time, or every fourth time in graphs of up to FEW_EDGES edges, which fit a task. Defined cases: a null url or one without
`://` has empty host and path, fits no rule and is allowed (as are hosts that nothing reaches); null html has no links;
rows that repeat are judged each; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, stored

FEW_EDGES = 1 << 20
#: (host, path prefix, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def split_url(url: Column) -> tuple[Column, Column]:
    """host and path columns."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def with_rule(pages: DataFrame, rules=None) -> DataFrame:
    """pages with host, path and fits: the longest rule as struct<rule, verdict>, or null."""
    host, path = split_url(F.col("url"))
    best = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    for h, p, verdict in rules or RULES:
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        this = F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.greatest(best, F.when(fits, this))
    return pages.withColumns({"host": host, "path": path}).withColumn("fits", best)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): hyperlinks between different hosts and, both ways, each host with the domain above it."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""), F.lit(1))
    link = pages.select(F.col("host").alias("src"), F.explode(found).alias("url"))
    dst = split_url(F.regexp_replace("url", "^//", "http://"))[0]
    link = link.select("src", dst.alias("dst")).where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))
    names = pages.select("host").distinct().union(link.select("dst")).distinct().where("host <> ''")
    up = names.select("host", F.split("host", "[.]").alias("labels"))
    up = up.select("host", F.expr("transform(sequence(1, greatest(size(labels) - 1, 1)), i -> array_join(slice(labels, i, size(labels)), '.'))").alias("ups"))
    pairs = up.where("size(ups) > 1").select(F.explode(F.expr("transform(sequence(0, size(ups) - 2), i -> struct(ups[i] as a, ups[i + 1] as b))")).alias("x")).select("x.a", "x.b").distinct()
    tree = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(pairs.select("b", "a")).withColumn("n", F.lit(1).cast("long"))
    return link.union(tree).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = 12, damping: float = 0.85) -> DataFrame:
    """(host, trust, distrust). seeds: (host, trust, distrust), each from 0 to 1."""
    sums = [edges.groupBy(end).agg(F.sum("n").alias("all")) for end in ("src", "dst")]
    out, into = sums if edges.count() <= FEW_EDGES else [stored(x, "host-sums") for x in sums]
    steps = edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("w"), F.lit("trust").alias("kind"))
    back = edges.join(into, "dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("n") / F.col("all"), F.lit("distrust"))
    steps = stored(steps.union(back), "host-steps")
    base = seeds.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "seed")).where("seed > 0")
    base = stored(base.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank")), "host-seeds")
    rank = base
    every = 4 if steps.count() <= FEW_EDGES else 1  # ranks that are written let Spark split the next join at a host of very many edges
    for i in range(rounds):
        moved = rank.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("w") * damping).alias("rank"))
        rank = moved.union(base).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if i % every == every - 1:
            rank = stored(rank, "host-ranks")
    of = lambda kind: F.coalesce(F.round(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), 9), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules=None, least: float = 0.01, **options) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row."""
    read = with_rule(pages.select("page_id", "url", "html"), rules)
    seeds = read.where("host <> ''").groupBy("host").agg(*[F.avg(F.coalesce((F.col("fits.verdict") == v).cast("double"), F.lit(0.0))).alias(k) for k, v in (("trust", "allow"), ("distrust", "block"))])
    found = stored(propagate(stored(host_edges(read), "host-edges"), seeds, **options), "host-scores")  # so that the join below can be split at a hot host
    ranks = found.withColumn("bad", (F.col("distrust") > F.col("trust")) & (F.col("distrust") > least))
    judged = with_rule(pages.select(F.col("page_id"), "url"), rules).join(ranks, "host", "left")
    verdict = F.coalesce("fits.verdict", F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("fits.rule").alias("rule"), verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
