"""URL filter by expanded expressions and short hash prefixes.

Each URL becomes one expression per host suffix (label by label) and per path
prefix.  Path prefixes are taken at the lengths that occur among the rules,
so a rule path may end anywhere, not only at a slash.  An expression's
SHA-256 is cut to ``prefix_bytes``; the rules are equi-joined on that short
prefix, and a match counts only if the full digest agrees.  Of the matching
rules the longest ``host + path`` wins; of equally long ones the longer host,
then ``block`` over ``allow``.  Spark broadcasts the rules only while their
own size is under its threshold, else both sides are shuffled by the prefix.

Defined results: a null URL, or one without ``://``, has an empty host and
path and no rule; a URL no rule fits gets ``default``; repeated pages are
judged row by row; an empty table gives an empty result; the result has only
the named columns, whatever else the pages carry.  Hosts are lower-cased for
A-Z only; ports and user parts stay in the host, as the text before the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for a URL without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def _digest(host: Column, path: Column) -> Column:
    # a newline cannot be confused with a part of the host's own text: the path starts after it
    return F.sha2(F.encode(F.concat(host, F.lit("\n"), path), "UTF-8"), 256)


def rules_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, rule_host string, rule_path string")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url: str = "url",
    default: str = "allow",
    prefix_bytes: int = 4,
) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row."""
    hex_digits = 2 * prefix_bytes
    hashed = rules.select(
        "action",
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"),
        _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"),
    ).withColumn("short", F.substring("rule_digest", 1, hex_digits))
    lengths = [
        r[0] for r in rules.select(F.length("rule_path")).distinct().orderBy(F.length("rule_path")).collect()
    ]  # at most the longest rule path

    host, path = split_url(F.col(url))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        host.alias("host"),
        path.alias("path"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
        if lengths
        else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    expressions = (
        rows.withColumn("suffix", F.explode_outer(F.when(F.col("host") != "", suffixes)))
        .withColumn("prefix", F.explode_outer(prefixes))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("digest", 1, hex_digits))
    )
    fits = F.col("digest") == F.col("rule_digest")
    best = F.max(
        F.when(
            fits,
            F.struct(
                F.length("rule").alias("length"),
                "host_length",
                (F.col("action") == "block").alias("blocks"),
                "rule",
                "action",
            ),
        )
    )
    judged = expressions.join(hashed, "short", "left").groupBy("row", "id", "host", "path").agg(
        best.alias("best")
    )
    return judged.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"),
    )


def op5_url_filter(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return judge_urls(pages.select("page_id", "url"), rules_table(spark))


OP5_SQL = r"""
with parts as (
  select row_number() over () as row_no, page_id,
         case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
), urls as (
  select row_no, page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
  from parts
), rules(action, rule_host, rule_path) as (
  values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
         ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), ranked as (
  select u.*, r.*, row_number() over (
           partition by row_no order by length(rule_host || rule_path) desc nulls last,
           length(rule_host) desc, action desc) as k
  from urls u left join rules r
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select page_id, host, path, rule_host || rule_path as rule, coalesce(action, 'allow') as verdict
from ranked where k = 1
"""
