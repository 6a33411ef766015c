"""URL filters: pattern rules indexed by their rarest literal token.

A rule is (action, pattern) with a pattern like `example.org/en/`: a host, which also stands for its subdomains, and
the start of a path.  Labels of the host and whole segments of the path are literal tokens.  Each rule is filed under
the token that fewest urls hold; a url's tokens fetch candidate rules, and only those run as regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rules sent to every executor at most; a longer list is joined by shuffle.
BROADCAST_RULES = 20_000
#: A url is hot from so many rows on; at most so many hot urls, the hottest, are sent to every executor.
HOT_ROWS, HOT_URLS = 10_000, 10_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPECIAL = r"([\\.\[\]{}()*+?^$|#&~-])"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host_: Column, path_: Column, whole: bool) -> Column:
    """Labels of the host (h:) and segments of the path (p:); with whole, only segments that a slash ends."""
    segments = F.split(path_, "/")
    if whole:
        segments = F.slice(segments, 1, F.size(segments) - 1)
    named = F.concat(F.transform(F.split(host_, r"\."), lambda x: F.concat(F.lit("h:"), x)), F.transform(segments, lambda x: F.concat(F.lit("p:"), x)))
    return F.array_distinct(F.filter(named, lambda x: F.length(x) > 2))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """rule, action, rank (length; earlier wins a tie), regex and token, one row for each literal token of a rule."""
    if not rules:
        return spark.sql("SELECT '' rule, '' action, 0L rank, '' regex, '' token WHERE false")
    if any("/" not in p or p.startswith("/") or a not in ("allow", "block") for a, p in rules):
        raise ValueError("a rule is (allow or block, host/path)")
    listed = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(a).alias("action"), F.lit(p).alias("rule"), F.lit(i).alias("n")) for i, (a, p) in enumerate(rules)])).alias("r")).select("r.*")
    host_ = F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER)
    path_ = F.expr("substring(rule, instr(rule, '/'))")
    regex = F.concat(F.lit(r"(?s)\A(?:[^/]*\.)?"), F.regexp_replace(F.concat(host_, path_), _SPECIAL, r"\\$1"))
    rank = F.length("rule") * F.lit(1 << 20).cast("long") - F.col("n")
    return listed.select("rule", "action", rank.alias("rank"), regex.alias("regex"), F.explode(tokens(host_, path_, True)).alias("token"))


def decide(urls: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """urls(u), distinct and not null -> u, rule and action of those that a rule fits: the longest one's."""
    filed = rule_table(urls.sparkSession, rules)
    parted = urls.select("u", host(F.col("u")).alias("h"), path(F.col("u")).alias("p"))
    held = parted.select("u", F.concat("h", "p").alias("target"), F.explode(tokens(F.col("h"), F.col("p"), False)).alias("token"))
    bounded = F.broadcast if len(rules) <= BROADCAST_RULES else lambda x: x
    common = held.join(bounded(filed.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("urls"))
    rarest = F.row_number().over(W.partitionBy("rank").orderBy(F.coalesce("urls", F.lit(0)), "token"))
    index = filed.join(common, "token", "left").withColumn("place", rarest).where("place = 1").select("token", "rule", "action", "rank", "regex")
    fits = held.join(bounded(index), "token").where("target rlike regex")
    return fits.groupBy("u").agg(F.max_by(F.struct("rule", "action"), "rank").alias("won")).select("u", "won.rule", "won.action")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of pages, all columns, with host, path, rule and verdict.

    host follows the first ://, up to / ? # or the end, A-Z lower-cased; path follows it, up to ? # or the end.  A null
    url, or one without ://, has both empty.  The longest rule that fits decides; where none fits, rule is null and the
    verdict is `default`.  Each row in gives one row out; an empty table gives none.  Columns of pages that are named
    host, path, rule or verdict are replaced; any other names may be in use, since those of this function are made new.

    Every different url is decided once.  Decisions of the hottest urls are sent to every executor, and their rows, like those
    without a url, are dealt out evenly when the others meet theirs.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    own = "_"
    while any(c.lower().startswith(own) for c in pages.columns):
        own += "_"
    url, name = F.col("url"), lambda *columns: [f"{own}{c}" for c in columns]
    counted = pages.where(url.isNotNull()).groupBy(url.alias("u")).agg(F.count("*").alias("n"))
    won = decide(counted.select("u"), rules)
    hot = counted.where(F.col("n") >= hot_rows).orderBy(F.desc("n"), "u").limit(HOT_URLS).select("u").join(won, "u", "left").toDF(*name("hot", "hot_rule", "hot_action"))
    cold = won.withColumn("salt", F.lit(0).cast("long")).toDF(*name("u", "rule", "action", "salt"))
    out = pages.join(F.broadcast(hot), url == F.col(f"{own}hot"), "left")
    alone = url.isNull() | F.col(f"{own}hot").isNotNull()
    out = out.withColumns({f"{own}key": F.when(~alone, url).otherwise(""), f"{own}of": F.when(alone, 1 + F.monotonically_increasing_id()).otherwise(0)})
    out = out.join(cold, (F.col(f"{own}key") == F.col(f"{own}u")) & (F.col(f"{own}of") == F.col(f"{own}salt")), "left")
    rule, action = (F.coalesce(*name(c, f"hot_{c}")) for c in ("rule", "action"))
    return out.select(*[F.col(f"`{c}`") for c in pages.columns], host(url).alias("host"), path(url).alias("path"), rule.alias("rule"), F.coalesce(action, F.lit(default)).alias("verdict"))
