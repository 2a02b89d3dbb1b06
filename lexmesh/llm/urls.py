"""URL filters: longest-rule matching, and link-graph propagation where no rule fits.

Hosts are vertices. Trust flows along links from hosts whose pages the rules
allow, and distrust flows against links from hosts whose pages they block (both
as personalised PageRank; Page et al. 1999, Gyongyi et al. 2004). A host
without a rule is blocked if its distrust exceeds its trust.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, shuffle_partitions
from .components import with_value

#: Fixed values: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

DAMPING = 0.85
#: Change of any host's mass over CUT rounds, as a share of it, at which propagation ends.
TOLERANCE = 1e-4
#: Rounds of the SQL, which can't test for the end: 0.85**60 is less than 1e-4.
ROUNDS = 60
#: Links up to which a host is never a hub.
LINKS = 1000
#: Rounds between two written tables.
CUT = 4


def parts(df: DataFrame, url_col: str) -> DataFrame:
    """Adds host and path. A null url, or one without ://, has both empty."""
    rest = F.expr(f"CASE WHEN contains(`{url_col}`, '://') THEN substring(`{url_col}`, locate('://', `{url_col}`) + 3) ELSE '' END")
    return df.withColumn("_rest", rest).withColumn("host", F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, UPPER.lower())).withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_rest")


def longest_rule(rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, html_col: str) -> DataFrame:
    """(src, dst, weight): links between hosts, and a link each way between a name and its parent domain.

    pages has host; relative links stay on their host and make no edge. Counts
    are summed per pair before anything is joined.
    """
    hrefs = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""), F.lit(1))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(hrefs).alias("dst")).withColumn("dst", F.translate("dst", UPPER, UPPER.lower()))
    links = links.where("src <> dst and dst <> ''").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    labels = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = pages.where("host like '%.%.%'").select("host").distinct().select(F.arrays_zip(names.alias("a"), F.slice(names, F.lit(2), F.size(names)).alias("b")).alias("e")).select(F.explode("e").alias("e")).where("e.b is not null").select("e.a", "e.b").distinct()
    family = chain.select("a", "b").union(chain.select("b", "a")).toDF("src", "dst").withColumn("weight", F.lit(1.0))
    return links.unionByName(family).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """(host, kind, mass): personalised PageRank of each kind of seed.

    edges has (kind, src, dst, share, hub), shares of a source and kind sum to 1;
    hub marks the links of the few hosts that have most of them: their mass is
    broadcast, so that the links stay where they are. seeds has (kind, host, mass). The mass of a host without links is lost,
    which scales all hosts of a kind alike. Each round is a join on (kind, host)
    and a sum by it; every few rounds are written, so lineage stays short. Without
    a number of rounds, they end when no host is new and no mass changes by more
    than TOLERANCE of itself.
    """
    start = seeds.select("kind", "host", "mass")
    mass = before = start
    keys = ["kind", "src"]
    rest, hubs = edges.where("not hub"), edges.where("hub")
    few = F.broadcast(hubs.select(*keys).distinct()) if hubs.limit(1).count() else None
    for k in itertools.count(1) if rounds is None else range(1, rounds + 1):
        at = mass.withColumnRenamed("host", "src")
        met = at.join(rest, keys) if few is None else at.join(rest, keys).unionByName(hubs.join(F.broadcast(at.join(few, keys)), keys))
        moved = met.select("kind", F.col("dst").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
        mass = moved.unionByName(start.withColumn("mass", F.col("mass") * (1 - damping))).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        if k % CUT == 0 or k == rounds:
            mass = materialize(mass, "mass")
            if rounds is None:
                was = before.select("kind", "host", F.col("mass").alias("was"))
                if not mass.join(was, ["kind", "host"], "left").where(F.abs(F.col("mass") - F.coalesce("was", F.lit(0.0))) > TOLERANCE * F.col("mass")).limit(1).count():
                    break
                before = mass
    return mass


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) for each row of pages.

    A null url, or one without ://, has an empty host and path, fits no rule, and
    is allowed, as is a host that no mass reaches. Null html has no links.
    Repeated rows each get their row; an empty table gives none; other columns
    are ignored.
    """
    rule, verdict = longest_rule(rules)
    seen = parts(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")), "_url").withColumn("rule", rule).withColumn("verdict", verdict)
    by_host = materialize(seen.where("host <> ''").groupBy("host").agg(F.count("*").alias("pages"), F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked")), "hosts")
    edges = host_edges(seen, "_html")
    edges = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    edges = materialize(edges, "links")
    out = materialize(edges.groupBy("kind", "src").agg(F.sum("weight").alias("total"), F.count("*").alias("n")), "sources")
    hot = (out.agg(F.sum("n").alias("n")).first().n or 0) // (4 * shuffle_partitions(pages.sparkSession)) + 1
    edges = with_value(edges, out.withColumn("hub", F.col("n") > max(hot, LINKS)), hot, ["kind", "src"])
    edges = materialize(edges.select("kind", "src", "dst", (F.col("weight") / F.col("total")).alias("share"), "hub"), "host-edges")
    seeds = by_host.select(F.explode(F.array(F.struct(F.lit("trust").alias("kind"), "host", (F.col("allowed") / F.col("pages")).alias("mass")), F.struct(F.lit("distrust").alias("kind"), "host", (F.col("blocked") / F.col("pages")).alias("mass")))).alias("s")).select("s.*").where("mass > 0")
    mass = propagate(edges, materialize(seeds, "seeds"))
    scored = mass.groupBy("host").agg(*(F.sum(F.when(F.col("kind") == k, F.col("mass")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")))
    hosts = by_host.select("host").join(scored, "host", "left").select("host", *(F.coalesce(k, F.lit(0.0)).alias(k) for k in ("trust", "distrust")))
    own = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return seen.select("_id", "host", "path", "rule", "verdict").join(hosts, "host", "left").select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), *(F.coalesce(k, F.lit(0.0)).alias(k) for k in ("trust", "distrust")))
