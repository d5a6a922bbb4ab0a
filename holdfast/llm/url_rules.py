"""Judging URLs: a given list of host and path rules, and association rules where no given rule fits.

URLs are sets of tokens (labels of the host, segments of the path, names in the query).  The URLs that
a given rule judges are the labelled examples.  Spark's FP-growth finds frequent combinations of
tokens and verdict; combinations that predict a verdict with enough confidence and support become
rules, those that say no more than a part of themselves are dropped.  Each is posted under the rarest of its
tokens in an inverted index, and a URL is compared only with the rules that its tokens lead to.

Rules may have any number of tokens.  Tokens that come in exactly the same labelled URLs are mined as one:
a rule with two of them says no more than with one, so they only take each other's place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import stored

SUPPORT = 0.002
CONFIDENCE = 0.8
DEFAULT = "allow"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits `host` and all its subdomains where the path begins with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) of a URL; all empty for null or without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    return host, path, query


def tokens(host: str = "host", path: str = "path", query: str = "query") -> Column:
    """Distinct tokens, digits as #: h:label, p:segment, q:name."""
    return F.expr(
        f"""array_sort(array_distinct(concat(
            transform(filter(split({host}, '[.]'), x -> x <> ''), x -> concat('h:', regexp_replace(x, '[0-9]+', '#'))),
            transform(filter(split({path}, '/'), x -> x <> ''), x -> concat('p:', regexp_replace(x, '[0-9]+', '#'))),
            transform(filter(transform(split({query}, '&'), x -> split(x, '=')[0]), x -> x <> ''), x -> concat('q:', regexp_replace(x, '[0-9]+', '#'))))))"""
    )


def given_rule(rules: tuple[Rule, ...]) -> Column:
    """(name, verdict) of the longest rule that fits, the first in the list among equals; else null."""
    found = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        on_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        answer = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(on_host & F.col("path").startswith(rule.path), answer).otherwise(found)
    return found


def _twins(kinds: DataFrame, least: float) -> DataFrame:
    """(token, leader): tokens of at least so many labelled rows; those of exactly the same URLs have one leader.

    `kinds` has a row (tokens, rows) per distinct set of tokens.  Sets of URLs are compared by two sums of hashes.
    """
    each = kinds.select(F.explode("tokens").alias("token"), "rows", F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(1), "tokens").alias("h2"))
    found = each.groupBy("token").agg(F.sum("rows").alias("rows"), F.bit_xor("h1").alias("h1"), F.sum(F.col("h2").cast("decimal(38,0)")).alias("h2"))
    found = found.where(F.col("rows") >= least).groupBy("rows", "h1", "h2").agg(F.collect_list("token").alias("twins"))
    return found.select(F.explode("twins").alias("token"), F.array_min("twins").alias("leader"))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(tokens, verdict, confidence, support): association rules from rows of (tokens, verdict).

    A rule is dropped if a rule of fewer tokens, all its own, gives the same verdict at least as surely.
    No rows: no rules.
    """
    root = workspace(labelled.sparkSession)
    kinds = stored(labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("rows")), "labelled-kinds", root)
    total = kinds.agg(F.sum("rows")).first()[0] or 0
    twins = stored(_twins(kinds.groupBy("tokens").agg(F.sum("rows").alias("rows")), support * total), "twins", root)
    leaders = kinds.select("tokens", F.explode("tokens").alias("token")).distinct().join(twins, "token").groupBy("tokens").agg(F.collect_set("leader").alias("leaders"))
    # A URL of rare tokens only still counts among the rows that support is a share of.
    items = F.concat(F.coalesce("leaders", F.array().cast("array<string>")), F.array(F.concat(F.lit("="), "verdict")))
    baskets = stored(labelled.join(leaders, "tokens", "left").select(items.alias("items")), "baskets", root)
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets).associationRules
    rules = found.select(
        F.array_sort("antecedent").alias("tokens"), F.col("consequent")[0].alias("verdict"), "confidence", "support"
    ).where(F.col("verdict").startswith("=") & ~F.exists("tokens", lambda t: t.startswith("=")))
    rules = stored(rules.withColumn("verdict", F.substring("verdict", 2, 1_000_000)), "rules", root)
    longer, shorter = rules.withColumn("key", F.explode("tokens")).alias("l"), rules.withColumn("key", F.col("tokens")[0]).alias("s")
    told = (
        longer.join(shorter, "key")
        .where("l.verdict = s.verdict AND size(l.tokens) > size(s.tokens) AND s.confidence >= l.confidence AND size(array_except(s.tokens, l.tokens)) = 0")
        .select("l.tokens", "l.verdict")
        .distinct()
    )
    kept = stored(rules.join(told, ["tokens", "verdict"], "left_anti").withColumn("rule", F.col("tokens")), "kept", root)
    # Every leader stands for any one of its twins.
    places = kept.select("rule", "verdict", F.posexplode("rule").alias("place", "leader"))
    choices = places.join(twins, "leader").groupBy("rule", "verdict", "place").agg(F.collect_list("token").alias("choices"))
    choices = choices.groupBy("rule", "verdict").agg(F.array_sort(F.collect_list(F.struct("place", "choices"))).alias("places"))
    spread = F.aggregate(
        "places",
        F.array(F.array().cast("array<string>")),
        lambda so_far, place: F.flatten(F.transform(place["choices"], lambda token: F.transform(so_far, lambda tokens: F.concat(tokens, F.array(token))))),
    )
    spelled = choices.select("rule", "verdict", F.explode(spread).alias("spelled"))
    return stored(kept.drop("tokens").join(spelled, ["rule", "verdict"]).select(F.array_sort("spelled").alias("tokens"), "verdict", "confidence", "support"), "spelled", root)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "page_id", url_column: str = "url", support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, confidence) of every row.

    rule: the given rule that fits, else null.  verdict: that rule's; else that of the mined rule that
    fits with the greatest confidence (ties: greatest support, then most tokens, then by name); else
    `allow`.  mined and confidence name the mined rule that decided.  Null URL or one without `://`:
    no host, path or tokens, so `allow`.  Null ids, repeated rows and empty tables are no exception.
    """
    root = workspace(pages.sparkSession)
    host, path, query = parts(F.col(f"`{url_column}`").cast("string"))
    rows = pages.select(F.col(f"`{id_column}`").alias("page_id"), host.alias("host"), path.alias("path"), query.alias("query"))
    rows = rows.withColumn("given", given_rule(rules)).withColumn("tokens", tokens()).drop("query")
    mined = mine(rows.where("given IS NOT NULL").select("tokens", F.col("given.verdict").alias("verdict")), support, confidence)

    # URLs of the same tokens get the same answer, so a common host or URL is matched once.
    unjudged = rows.where("given IS NULL")
    kinds = stored(unjudged.select("tokens").distinct(), "kinds", root)
    posted = kinds.select("tokens", F.explode("tokens").alias("key"))
    # A rule is posted under the token that the fewest of these have; a rule with a token that none has fits none.
    often = posted.groupBy("key").agg(F.count("*").alias("kinds"))
    keys = mined.withColumn("key", F.explode("tokens")).join(often, "key", "left")
    keys = keys.groupBy("tokens", "verdict", "confidence", "support").agg(F.min(F.struct(F.coalesce("kinds", F.lit(0)).alias("kinds"), "key")).alias("rarest"))
    rules_by_key = keys.withColumn("key", F.col("rarest.key")).where("rarest.kinds > 0").drop("rarest")
    order = F.struct(F.col("confidence"), F.col("support"), F.size("m.tokens").alias("n"), F.array_join("m.tokens", " ").alias("name"), F.col("verdict"))
    matched = (
        posted.alias("k")
        .join(rules_by_key.alias("m"), "key")
        .where(F.size(F.array_except("m.tokens", "k.tokens")) == 0)
        .groupBy("k.tokens")
        .agg(F.max(order).alias("best"))
    )
    matched = stored(matched, "matched", root)
    found = unjudged.join(matched, "tokens", "left").select(
        "page_id",
        "host",
        "path",
        F.lit(None).cast("string").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
        F.col("best.name").alias("mined"),
        F.col("best.confidence").alias("confidence"),
    )
    judged = rows.where("given IS NOT NULL").select(
        "page_id",
        "host",
        "path",
        F.col("given.name").alias("rule"),
        F.col("given.verdict").alias("verdict"),
        F.lit(None).cast("string").alias("mined"),
        F.lit(None).cast("double").alias("confidence"),
    )
    return judged.unionByName(found)
