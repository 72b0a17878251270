"""URL filter by link-graph propagation over hosts.

Every url is judged by rules first: a rule names a host and a path, fits that
host and its subdomains when the path starts with the rule's, and the longest
rule that fits wins. What no rule fits is judged by its host's place in the
link graph: trust spreads from hosts with allowed pages along links, as
personalised PageRank; distrust spreads from hosts with blocked pages against
the links, to those that link there. A host is blocked if its share of all
distrust exceeds ``ratio`` times its share of all trust, and ``floor``.

Edges join hosts: links and host names that a page credits (href or src, and
names after a copyright sign), and a host with its parent domain, that with its
own parent and so on, as long as the parent has a dot, both ways.
They are summed per pair of hosts before anything is spread. Each iteration is
one join and one sum per host, written to the shared folder.

Defined results: a NULL url, or one without ``://``, has an empty host and
path, fits no rule and, with no links, is allowed; repeated rows each give a
row and count in the seeds; with no seeds of a kind nothing of it spreads; a
host at which both are 0 is allowed; NULL html has no links; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DAMPING, ITERATIONS = 0.75, 12  # what is left to spread in the end: 3 %
RATIO, FLOOR = 2.0, 1e-9
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>\\]+)"""
CREDIT = r"(?i)(?:&copy;|©)\s*([a-z0-9](?:[a-z0-9-]*\.)+[a-z]{2,})"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(pages: DataFrame, url: Column) -> DataFrame:
    """Adds ``host`` and ``path``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    return pages.withColumns({
        "host": F.coalesce(lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit("")),
        "path": F.coalesce(F.regexp_extract(tail, r"^([^?#]*)", 1), F.lit(""))})


def matched(rules=RULES) -> tuple[Column, Column]:
    """The rule that wins as text, and its verdict; NULL where none fits.
    Among rules of one length, a block comes first."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r))

    def fits(host: str, path: str) -> Column:
        own = F.col("host")
        return ((own == host) | own.endswith("." + host)) & F.col("path").startswith(path)
    return (F.coalesce(*(F.when(fits(h, p), h + p) for h, p, _ in ordered)),
            F.coalesce(*(F.when(fits(h, p), v) for h, p, v in ordered)))


def edges(pages: DataFrame) -> DataFrame:
    """(a, b, n): links of pages (host, html) from host to host, and between
    hosts and their parent domains."""
    names = F.concat(F.regexp_extract_all("html", F.lit(LINK), 1), F.regexp_extract_all("html", F.lit(CREDIT), 1))
    bare = F.regexp_replace(F.regexp_replace(lower_ascii(F.col("b")), r"^[^@]*@", ""), r"(:\d*|\.)$", "")
    links = (pages.where("host <> ''").select("host", F.explode(names).alias("b"))
             .groupBy(F.col("host").alias("a"), bare.alias("b")).agg(F.count("*").alias("n")))
    hosts = links.select("a").union(links.select("b")).union(pages.select("host")).toDF("a").where("a <> ''").distinct()
    # every suffix of a host, and its parent when that has a dot of its own
    labels = F.split("a", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    parent = F.regexp_extract("a", r"^[^.]+\.(.+\..+)$", 1)
    below = (hosts.select(F.explode(chain).alias("a")).select("a", parent.alias("b")).where("b <> ''").distinct()
             .withColumn("n", F.lit(1).cast("long")))
    both = links.union(below).union(below.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    return both.where("a <> b AND b <> ''").groupBy("a", "b").agg(F.sum("n").alias("n"))


def spread(graph: DataFrame, seeds: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(kind, host, score): seeds (kind, host, n) spread over (kind, a, b, n),
    each kind's seeds summing to 1."""
    total = graph.groupBy("kind", "a").agg(F.sum("n").alias("all"))
    steps = stored(graph.join(total, ["kind", "a"]).select("kind", "a", "b", (F.col("n") / F.col("all")).alias("share")), "steps")
    mass = seeds.groupBy("kind").agg(F.sum("n").alias("all"))
    start = stored(seeds.join(mass, "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("score")), "seeds")
    now = start
    back = start.select("kind", "host", ((1 - damping) * F.col("score")).alias("score"))
    for _ in range(iterations):
        moved = now.join(steps, (now["kind"] == steps["kind"]) & (now["host"] == steps["a"])).select(
            steps["kind"], F.col("b").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        now = stored(moved.union(back).groupBy("kind", "host").agg(F.sum("score").alias("score")), "spread")
    return now


def judge(pages: DataFrame, rules=RULES, damping: float = DAMPING, iterations: int = ITERATIONS, ratio: float = RATIO,
          floor: float = FLOOR, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page, with the host's
    ``trust`` and ``distrust`` where no rule fits."""
    p = split_url(pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html")), F.col("url"))
    rule, said = matched(rules)
    p = p.withColumns({"rule": rule, "said": said})
    judged = stored(p.select("page_id", "host", "path", "rule", "said"), "judged")
    links = stored(edges(p.select("host", "html")), "links")
    graph = links.select(F.lit("trust").alias("kind"), "a", "b", "n").union(
        links.select(F.lit("distrust").alias("kind"), F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    seeds = (judged.where("said IS NOT NULL AND host <> ''")
             .groupBy(F.when(F.col("said") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .agg(F.count("*").alias("n")))
    score = spread(graph, seeds, damping, iterations)
    value = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    hosts = score.groupBy("host").agg(value("trust"), value("distrust"))
    bad = (F.col("distrust") > ratio * F.col("trust")) & (F.col("distrust") > floor)
    return judged.join(hosts, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("said", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
