"""URL filters by a sort-merge range join of addresses with nested prefix rules, in DataFrame operations only.

A rule (host, path) becomes the key ``reversed host + "/" + path``; everything that it covers on its own host is the
interval of keys that begin with it. An address gives one key per domain that its host belongs to, up to the most labels
any rule has, so that a rule's subdomains are covered too. Rules and keys are sorted together over range
partitions. A sweep in key order then knows at each key the last rule begun; as prefix intervals are nested,
the active rules are that rule and those around it, which each rule carries as its stack, longest first.
The rules still open at a partition's begin come from the partitions before it (a row each).

Distinct addresses are judged, so that a hot URL is one row, and pages take the verdict of their address.

Rows: a null url, or one without ``://``, has an empty host and path, which no rule fits. Repeated rows each come out. Equal
rules count once; if one is both blocked and allowed, it blocks. Of rules that fit, the one with the longest host and path
wins, on a tie the one with the longer host. Input columns other than the id and the url are left out, so
no name can clash.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopgrain.operators.lookup import lookup
from shopgrain.sources.scratch import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def rules_with_stacks(rules: DataFrame) -> DataFrame:
    """key, labels, stack for each distinct rule (verdict, host, path); the stack holds it and the rules around it."""
    keyed = (
        rules.select("verdict", F.translate("host", UPPER, LOWER).alias("host"), "path")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", _key(_labels(F.col("host")), F.col("path")))
    )
    entry = F.struct(
        (F.length("host") + F.length("path")).alias("length"),
        F.length("host").alias("host_length"),
        F.col("key"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict"),
    )
    around = keyed.select(F.col("key").alias("outer"), entry.alias("entry"))
    # only prefixes as long as some rule's key can be one, so a long path has few
    lengths = keyed.agg(F.collect_set(F.length("key"))).scalar()
    within = F.filter(
        "lengths",
        lambda n: (n <= F.length("key")) & (n >= F.length("key") - F.length("path")),
    )
    prefixes = keyed.withColumn("lengths", lengths).select(
        "key",
        F.size(_labels(F.col("host"))).alias("labels"),
        F.explode(within).alias("length"),
    ).withColumn("outer", F.expr("left(key, length)"))
    return (
        prefixes.join(around, "outer")
        .groupBy("key", "labels")
        .agg(F.sort_array(F.collect_set("entry"), asc=False).alias("stack"))
    )


def _swept(keys: DataFrame, stacked: DataFrame) -> DataFrame:
    """host, path, fit: the innermost rule of each key (null if none)."""
    spark = keys.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    begins = stacked.select("key", F.lit(0).alias("kind"), "stack")
    both = begins.unionByName(
        keys.withColumn("kind", F.lit(1)), allowMissingColumns=True
    ).repartitionByRange(partitions, "key", "kind")
    ranged = materialise(both.withColumn("part", F.spark_partition_id()), "ranges")
    last_rule = (
        ranged.where("kind = 0")
        .groupBy("part")
        .agg(F.max(F.struct("key", "stack")).alias("last"))
        .select("part", F.col("last.stack").alias("own"))
    )
    # one row per partition from here to the join
    parts = spark.range(partitions).select(F.col("id").cast("int").alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.join(last_rule, "part", "left").select(
        "part", F.last("own", ignorenulls=True).over(before).alias("carried")
    )
    so_far = (
        Window.partitionBy("part")
        .orderBy("key", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    active = F.coalesce(F.last("stack", ignorenulls=True).over(so_far), F.col("carried"))
    fits = F.get(F.filter("active", lambda r: F.startswith(F.col("key"), r["key"])), F.lit(0))
    return (
        ranged.join(F.broadcast(carried), "part")
        .withColumn("active", active)
        .where("kind = 1")
        .select("host", "path", fits.alias("fit"))
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    default: str = "allow",
) -> DataFrame:
    """id, host, path, rule (null if none fits), verdict of every page under ``rules`` (verdict, host, path)."""
    host, path = host_and_path(F.col(url_column))
    split = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    stacked = materialise(rules_with_stacks(rules), "rules")
    most_labels = stacked.agg(F.max("labels")).first()[0] or 0
    addresses = split.select("host", "path").where("host <> ''").distinct()
    labels = _labels(F.col("host"))
    levels = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, most_labels))))
    keys = addresses.select("host", "path", F.explode(levels).alias("level")).select(
        "host", "path", _key(F.slice(labels, F.lit(1), F.col("level")), F.col("path")).alias("key")
    )
    judged = (
        _swept(keys, stacked)
        .where("fit is not null")
        .groupBy("host", "path")
        .agg(F.max("fit").alias("fit"))
    )
    # a hot address is spread over tasks, pages without one all have the same
    return lookup(split, judged, ["host", "path"]).select(
        F.col("id").alias(id_column),
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.lit(default)).alias("verdict"),
    )
