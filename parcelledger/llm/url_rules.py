"""URL filter with mined association rules (operator 6).

A url is a set of tokens: labels of the host with their place from the right, pieces of the path, names of query fields.
Spark's FP-growth mines, over all labelled pages, the token sets that go along with the label "block"; rules are kept
above a support, a confidence and a lift, and a rule that has a more general rule of no less confidence is dropped. Rules
are indexed by their rarest token; a page is matched through its tokens and then checked for the whole rule. Listed host
rules come first; the longest that fits decides.

A null url, or one without "://", has an empty host and path, fits no rule and is allowed. Repeated pages are judged each
for itself. Without labelled pages there are no mined rules. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelledger.llm.common import stored, table

# Listed rules, host/path and verdict.
LISTED = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
LABEL = "=block"
SUPPORT, CONFIDENCE, LIFT = 0.002, 0.6, 1.2
#: A token set must also occur in so many labelled pages, which matters where few are labelled.
LEAST_PAGES = 20
RULE = "tokens array<string>, support double, confidence double, lift double, rule_id string"
#: Mined rules are broadcast up to this many, and shuffled beyond.
BROADCAST_RULES = 20_000


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*+)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*+([^?#]*+)", 1)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url."""
    labels = F.reverse(F.split(host, r"\."))
    places = F.transform(labels, lambda x, i: F.concat(F.lit("h"), i.cast("string"), F.lit(":"), x))
    pieces = F.transform(F.split(path, "[^\\p{L}\\p{N}]+"), lambda x: F.concat(F.lit("p:"), F.lower(x)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^([^=]*)", 1)))
    scheme = F.array(F.concat(F.lit("s:"), F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z]+)://", 1)))
    every = F.concat(scheme, places, pieces, names)
    return F.array_distinct(F.filter(every, lambda x: ~x.rlike("^[a-z][0-9]*:$")))


def mine(labelled: DataFrame) -> DataFrame:
    """(rule_id, tokens, support, confidence, lift) from rows with tokens and blocked; all of them are read."""
    baskets = labelled.select(
        F.when(F.col("blocked"), F.array_append("tokens", F.lit(LABEL))).otherwise(F.col("tokens")).alias("items")
    )
    n = baskets.count()
    if n < LEAST_PAGES:
        return labelled.sparkSession.createDataFrame([], RULE)
    support = max(SUPPORT, LEAST_PAGES / n)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=CONFIDENCE).fit(baskets)
    found = model.associationRules.filter(
        (F.col("consequent") == F.array(F.lit(LABEL))) & (F.col("lift") >= LIFT)
    ).select(F.array_sort("antecedent").alias("tokens"), "support", "confidence", "lift")
    named = found.withColumn("rule_id", F.array_join("tokens", " "))
    # A rule is looked up without each of its tokens in turn: a more general rule of no less confidence makes it idle.
    wider = named.select(
        F.col("rule_id").alias("narrow"),
        F.col("confidence").alias("own"),
        F.explode(F.transform("tokens", lambda t: F.array_join(F.array_remove("tokens", t), " "))).alias("rule_id"),
    )
    idle = wider.join(named.select("rule_id", "confidence"), "rule_id").filter("confidence >= own").select("narrow")
    return named.join(idle, named["rule_id"] == idle["narrow"], "left_anti")


def match(pages: DataFrame, rules: DataFrame, n_rules: int) -> DataFrame:
    """(key, mined): for pages with key and tokens, the best rule each page holds in full."""
    spread = rules.select("rule_id", "confidence", F.col("tokens").alias("needs"), F.explode("tokens").alias("token"))
    use = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n_rules"))
    ranked = spread.join(use, "token").groupBy("rule_id", "confidence", "needs")
    index = ranked.agg(F.min_by("token", F.struct("n_rules", "token")).alias("token"))
    held = pages.select("key", "tokens", F.explode("tokens").alias("token"))
    met = held.join(F.broadcast(index) if n_rules <= BROADCAST_RULES else index, "token")
    whole = met.filter(F.size(F.array_except("needs", "tokens")) == 0)
    return whole.groupBy("key").agg(F.max_by("rule_id", F.struct("confidence", "rule_id")).alias("mined"))


def listed_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, what in sorted(LISTED, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) for every page; a page is labelled by the row of its number.

    Pages labelled toxic, or of quality 0, are the ones to block.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = parsed.select(
        "page_id", "host", "path", tokens_of(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    ).withColumn("key", F.array_join("tokens", " "))
    marks = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        (F.max(F.coalesce("toxic", F.lit(0))).eqNullSafe(1) | F.min("quality").eqNullSafe(0)).alias("blocked")
    )
    rules = stored(mine(rows.join(marks, "page_id").select("tokens", "blocked")), "url-rules")
    # Pages that share a token set are matched together.
    best = match(rows.select("key", "tokens"), rules, rules.count())
    rule, verdict = listed_rule(F.col("host"), F.col("path"))
    return rows.join(best, "key", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "mined",
    )


def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Every page with its verdict."""
    return judge(table(spark, folder, "pages"), table(spark, folder, "labels"))
