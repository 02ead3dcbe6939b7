"""URL filter: pattern rules indexed by their rarest literal token, so that only few of them meet a url's characters.

A url's tokens are its runs of letters and digits.  Each pattern rule names literal tokens that every url it fits must
hold as whole tokens; the index keeps the one that the urls at hand hold least often.  A url's tokens fetch the rules
that may fit by an equality join, and only those run their regular expression.  Host rules (a host and a prefix of the
path) come first: their key is looked up among the host's suffixes in the same way, and the longest wins.

Null urls and urls without ``://`` have an empty host and path and fit no host rule.  Each different url is judged once.
Its verdict then goes back to its rows: those of null urls, which have none, and those of urls with a large share of all
rows are spread over ``SALTS`` places first.  Rules may be lists or tables of any length; they are broadcast up to
``BROADCAST_RULES`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common

#: Rules that are sent to every task; more of them are joined by shuffling both sides.
BROADCAST_RULES = 50_000
#: A url with one of this many rows is spread over so many places; there are no more such urls than that.
HOT_SHARE, HOT_LEAST, SALTS = 1000, 1000, 64

Rules = list | DataFrame

#: Host rules as (host, path prefix, verdict).
HOST_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]

#: Pattern rules as (regular expression over the lower-cased url, its literal tokens); they block.
PATTERN_RULES = [
    (r"://([^/?#]*[.-])?free-(bets?|casino|spins?|pills)\b", ["free"]),
    (r"://([^/?#]*[.-])?cheap-(pills?|meds|loans?|viagra)\b", ["cheap"]),
    (r"://([^/?#]*[.-])?(online-)?casino[.-]", ["casino"]),
    (r"://([^/?#]*[.-])?poker[.-]", ["poker"]),
    (r"://([^/?#]*[.-])?bets?-bonus\b", ["bonus"]),
    (r"://([^/?#]*[.-])?adult-(cams?|video|dating)\b", ["adult"]),
    (r"://([^/?#]*[.-])?xxx[.-]", ["xxx"]),
    (r"://([^/?#]*[.-])?porn[.-]", ["porn"]),
    (r"://([^/?#]*[.-])?payday-loans?\b", ["payday"]),
    (r"://([^/?#]*[.-])?replica-(watches|bags)\b", ["replica"]),
    (r"://([^/?#]*[.-])?download-(free-)?(crack|keygen|warez)\b", ["download"]),
    (r"://([^/?#]*[.-])?warez[.-]", ["warez"]),
    (r"://([^/?#]*[.-])?keygen[.-]", ["keygen"]),
    (r"://([^/?#]*[.-])?ads[.-](server|click|track)\b", ["ads"]),
    (r"/(wp-login|xmlrpc)\.php\b", ["php"]),
    (r"[?&]affiliate_id=", ["affiliate", "id"]),
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """A host and the domains it lies in."""
    parts = F.split(host, r"\.")
    return F.transform(parts, lambda _, i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."))


def tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def rule_table(spark: SparkSession, rules: Rules, schema: str) -> tuple[DataFrame, bool]:
    """The rules as a table, and whether they are few enough to be sent to every task."""
    if isinstance(rules, DataFrame):
        table = common.stage(rules.select(*[c.split()[0] for c in schema.split(", ")]), "rules")
        return table, table.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    return spark.createDataFrame(rules, schema), len(rules) <= BROADCAST_RULES


def sent(table: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(table) if few else table


def rule_index(urls: DataFrame, rules: DataFrame, few: bool) -> DataFrame:
    """(token, pattern): every pattern of ``rules`` under the one of its literal tokens that the urls hold least often."""
    literals = rules.select("pattern", F.explode("literals").alias("token"))
    used = literals.select("token").distinct()
    counts = (
        urls.select(F.explode(tokens(F.col("url"))).alias("token")).join(sent(used, few), "token")  # tokens of the rules only
        .groupBy("token").agg(F.count("*").alias("n"))
    )
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))
    return literals.join(counts, "token", "left").groupBy("pattern").agg(rarest.alias("least")).select("least.token", "pattern")


def spread(pages: DataFrame, urls: DataFrame, judged: DataFrame) -> DataFrame:
    """Every row of ``pages`` with what ``judged`` says of its url; ``urls`` tells how many rows a url has."""
    total = urls.agg(F.sum("n")).first()[0] or 0
    hot = urls.filter(F.col("n") >= max(HOT_LEAST, total // HOT_SHARE)).select("url", F.lit(True).alias("hot"))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    # At most HOT_SHARE urls are hot, as each has one in HOT_SHARE of the rows.
    placed = pages.join(F.broadcast(hot), "url", "left").withColumn(
        "place", F.when(F.col("hot") | F.col("url").isNull(), place).otherwise(0)
    ).drop("hot")
    places = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copies = judged.join(F.broadcast(hot), "url", "left").withColumn("place", F.explode(places)).drop("hot")
    return placed.join(copies, ["url", "place"], "left").drop("place")


def verdicts(pages: DataFrame, host_rules: Rules | None = None, patterns: Rules | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) of every row of ``pages`` (page_id, url).

    ``host_rules``: (rule_host, prefix, says); ``patterns``: (pattern, literals).
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    counted = pages.filter(F.col("url").isNotNull()).groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    urls = common.stage(counted, "urls").select("url", "n", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    hosts, few_hosts = rule_table(spark, HOST_RULES if host_rules is None else host_rules, "rule_host string, prefix string, says string")
    fitting = (
        urls.select("url", "path", F.explode(suffixes(F.col("host"))).alias("rule_host"))
        .join(sent(hosts, few_hosts), "rule_host").filter(F.col("path").startswith(F.col("prefix")))
    )
    longest = F.max(F.struct(F.length(F.concat("rule_host", "prefix")), F.concat("rule_host", "prefix").alias("rule"), "says"))
    by_host = fitting.groupBy("url").agg(longest.alias("best")).select("url", F.col("best")["rule"].alias("rule"), F.col("best")["says"].alias("says"))
    rules, few = rule_table(spark, PATTERN_RULES if patterns is None else patterns, "pattern string, literals array<string>")
    by_pattern = (
        urls.select("url", F.explode(tokens(F.col("url"))).alias("token")).join(sent(rule_index(urls, rules, few), few), "token")
        .filter(F.expr("lower(url) rlike pattern")).groupBy("url").agg(F.min("pattern").alias("pattern"))
    )
    judged = by_host.join(by_pattern, "url", "full")
    return spread(pages, urls, judged).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
        F.coalesce("says", F.when(F.col("pattern").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
        F.when(F.col("says").isNull(), F.col("pattern")).alias("pattern"),
    )


def oracle_sql(host_rules: list[tuple[str, str, str]] | None = None, patterns: list[tuple[str, list[str]]] | None = None) -> str:
    """The same verdicts in SQL: every rule against every different url, without an index."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    hosts = ", ".join(f"({quote(h)}, {quote(p)}, {quote(s)})" for h, p, s in host_rules or HOST_RULES)
    rules = ", ".join(f"({quote(p)})" for p, _ in patterns or PATTERN_RULES)
    return f"""
WITH u AS (
  SELECT url, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM (SELECT DISTINCT url FROM pages)
), s AS (
  SELECT url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), h AS (
  SELECT url, arg_max(r.host || r.prefix, length(r.host || r.prefix)) AS rule, arg_max(says, length(r.host || r.prefix)) AS says
  FROM s JOIN (VALUES {hosts}) r(host, prefix, says)
    ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.prefix) GROUP BY url
), p AS (
  SELECT url, min(pattern) AS pattern FROM s JOIN (VALUES {rules}) r(pattern) ON regexp_matches(lower(url), pattern) GROUP BY url
)
SELECT page_id, s.host, s.path, h.rule, coalesce(says, CASE WHEN pattern IS NOT NULL THEN 'block' END, 'allow') AS verdict,
       CASE WHEN says IS NULL THEN pattern END AS pattern
FROM pages LEFT JOIN s ON pages.url IS NOT DISTINCT FROM s.url LEFT JOIN h ON s.url = h.url LEFT JOIN p ON s.url = p.url
"""
