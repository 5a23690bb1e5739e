"""URL filters: allow and block rules on hosts and paths, DataFrame functions only.

A rule (host, path, verdict) fits its host and all subdomains of it where the
URL's path starts with the rule's path (as text: ``/en/1`` fits ``/en/12``).
Of several that fit, the longest host and path together wins, then the longer
host, then block over allow; where none fits, ``default`` holds.

Each URL becomes its host-suffix and path-prefix expressions: a suffix for
each number of labels and a prefix for each length that the rules use
together (their shapes). An expression's SHA-256 stands for it: rules and
expressions meet on its first 32 bits, the rest of the digest is compared
after that, and precedence is a maximum of the confirmed rules per URL. Rules
are broadcast where their measured bytes are below ``BROADCAST_BYTES``; beyond
that they are copied to ``SALTS`` shares of each hash prefix, so that a suffix
which a third of all URLs have meets them in as many tasks.

Rows meet again by id, host, path and their partition of the input, summed
before the shuffle: neither a hot host nor a repeated row lands in one task,
and a retried task deals the same rows.

Cases: the host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased, with any port and user; the path follows up to ``?``,
``#`` or the end. Null, empty or scheme-less URLs have an empty host and path
(a rule with an empty host and path fits them). Repeated rows are answered one
by one, null ids too; an empty table gives an empty table; rules with a null
host, path or verdict are left out, repeated ones count once; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

BROADCAST_BYTES = 16 << 20
SALTS = 8            # copies of each rule where rules are not broadcast
ROW_BYTES = 160      # a rule's digest, hash prefix and row besides its text
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = "#"      # neither hosts nor paths hold it


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _short(digest: Column) -> Column:
    """First 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def prepared(rules: DataFrame) -> DataFrame:
    """Distinct rules with their shape, digest and precedence."""
    host = F.translate("host", UPPER, LOWER)
    r = rules.where("host is not null and path is not null and verdict is not null") \
        .select(host.alias("h"), F.col("path").alias("p"), F.col("verdict").alias("v")).distinct()
    digest = F.sha2(F.concat("h", F.lit(SEPARATOR), "p"), 256)
    return r.select(
        _labels(F.col("h")).alias("labels"), F.length("p").alias("chars"), digest.alias("full"), _short(digest).alias("short"),
        F.struct((F.length("h") + F.length("p")).alias("long"), F.length("h").alias("host"), (F.col("v") == "block").alias("block"),
                 F.concat("h", "p").alias("rule"), F.col("v").alias("verdict")).alias("best"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``pages``: its id, host, path, the winning rule (null: none)
    and verdict, by ``rules (host, path, verdict)``."""
    ready = prepared(rules)
    known = ready.agg(F.sum(F.octet_length("best.rule") + ROW_BYTES).alias("bytes"),
                      F.collect_set(F.struct("labels", "chars")).alias("shapes")).first()
    shapes = sorted((s["labels"], s["chars"]) for s in known["shapes"])
    host, path = split_url(pages[f"`{url_col}`"])
    urls = pages.select(pages[f"`{id_col}`"].alias("id"), host.alias("host"), path.alias("path"),
                        F.spark_partition_id().alias("part")).withColumn("n", _labels(F.col("host")))
    digests = [F.when((F.col("n") >= k) & (F.length("path") >= c),
                      F.sha2(F.concat(F.substring_index("host", ".", -k), F.lit(SEPARATOR), F.substring("path", 1, c)), 256))
               for k, c in shapes]
    # one more row stands for the URL itself; its negative number meets no rule and spreads
    own = F.lit("").alias("d")
    rows = urls.select("id", "host", "path", "part", F.explode(F.array_compact(F.array(own, *digests))).alias("d"))
    alone = F.col("d") == ""
    short = F.when(alone, -1 - F.abs(F.hash("id", "host", "path", "part").cast("long"))).otherwise(_short(F.col("d")))
    rows = rows.withColumn("k", short)
    side = ready.select("short", "full", "best")
    if (known["bytes"] or 0) <= broadcast_bytes:
        met = rows.join(F.broadcast(side), (F.col("k") == F.col("short")) & (F.col("d") == F.col("full")), "left")
    else:
        salted = rows.withColumn("salt", F.pmod(F.hash("id", "path", "part"), F.lit(SALTS)))
        many = side.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = salted.join(many, (F.col("k") == F.col("short")) & (F.col("salt") == F.col("s")) & (F.col("d") == F.col("full")), "left")
    won = met.groupBy("id", "host", "path", "part").agg(
        F.max("best").alias("best"), F.sum((F.col("d") == "").cast("int")).alias("copies"))
    each = won.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


RULES = "VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), " \
        "('com', '/fr/', 'allow'), ('com', '/de/', 'block')"


def op11_url_filter(spark, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT col1 AS host, col2 AS path, col3 AS verdict FROM {RULES}")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


OP11_SQL = rf"""
WITH rules(rhost, rpath, verdict) AS ({RULES}),
rest AS (SELECT page_id, row_number() OVER () AS row,
                CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (SELECT page_id, row, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM rest),
urls AS (SELECT page_id, row, translate(host, '{UPPER}', '{LOWER}') AS host,
                regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path FROM cut),
fits AS (SELECT row, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
         FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
         GROUP BY row)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (row)
"""
