"""URL filters as a sort-merge range join of pages with nested rules.

A rule is a host and the start of a path; it fits its host and all subdomains. Host labels are
reversed, and with the path they form a canonical key under which all that a rule fits on one
host is one interval: from the key itself to the key followed by a byte no text contains. A page
has one point for each host above it that rules know. Points and interval ends are sorted
together; where an interval starts its rule is pushed on the stack of active ones, where it ends it
is popped, and each point sees the top of the stack that the events before it leave. The
longest rule wins over all hosts above the page (host and path together; equally long ones by the
longer host, then by text).

Pages are judged once per distinct host and path. A host with very many of them is swept in
several parts, each with a copy of that host's rules, so no sorted run grows with the table.

Cases: a null url, or one without ``://``, has an empty host and path and fits no rule; rules with
a null host or path count for nothing; of equal rules that differ in the verdict ``block`` holds;
without rules every page gets the default verdict; rows that repeat get the same result each;
other columns of the pages play no part.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.tables import UPPER
from shelfwise.session import materialize

SWEEP_ROWS = 100_000
PUSH, POP, POINT = 0, 1, 2  # in this order at equal keys


def parts(url):
    """Host and path of a url; both empty if there is no ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return (F.translate(host, UPPER, UPPER.lower()).alias("host"),
            F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path"))


def reversed_labels(host):
    return F.reverse(F.split(host, r"\."))


def canonical(host_key, path):
    """Bytes that sort hosts by their labels from the right, then paths."""
    return F.concat(F.encode(host_key, "UTF-8"), F.lit(b"\x00"), F.encode(path, "UTF-8"))


def known_rules(rules: DataFrame) -> DataFrame:
    """Each distinct rule once, with its reversed host."""
    known = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "verdict")
    return known.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(
        F.array_join(reversed_labels(F.col("host")), ".").alias("host_key"), "path",
        F.struct(F.concat("host", "path").alias("rule"), "verdict").alias("rule"))


def interval_events(known: DataFrame) -> DataFrame:
    """Where each rule's interval begins, which pushes it, and ends, which pops it."""
    key = canonical(F.col("host_key"), F.col("path"))
    return known.select("host_key", "salt", "rule", F.explode(F.array(
        F.struct(key.alias("key"), F.lit(PUSH).alias("kind")),
        F.struct(F.concat(key, F.lit(b"\xff")).alias("key"), F.lit(POP).alias("kind")),
    )).alias("event")).select("host_key", "salt", "rule", "event.*")


def active_rules(events: DataFrame) -> DataFrame:
    """The points among the events, each with the rule on top of the stack there.

    Intervals of prefixes are nested, so pushes less pops before a point are the depth of the
    stack, and its top is the last rule that was pushed to that depth."""
    place = Window.partitionBy("host_key", "salt").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("kind") == PUSH, 1).when(F.col("kind") == POP, -1).otherwise(0)
    level = Window.partitionBy("host_key", "salt", "depth").orderBy("key", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    deep = events.withColumn("depth", F.sum(step).over(place)).where(
        (F.col("kind") != POP) & (F.col("depth") > 0))
    return deep.withColumn("top", F.last("rule", ignorenulls=True).over(level)).where(
        F.col("kind") == POINT)


def verdicts(pages: DataFrame, rules: DataFrame, default="allow", sweep_rows=SWEEP_ROWS):
    """Every page with ``host``, ``path``, ``rule`` and ``verdict`` beside its own columns, which
    are kept unless they have one of these names."""
    spark = pages.sparkSession
    own = [F.col(f"`{name}`") for name in pages.columns
           if name.lower() not in ("host", "path", "rule", "verdict")]
    judged = pages.select(F.struct(*own).alias("own"), *parts(F.col("url")))
    known = materialize(known_rules(rules), "url-rules")
    deepest = known.agg(F.max(F.size(F.split("host_key", r"\.")))).first()[0] or 0

    labels = reversed_labels(F.col("host"))
    depth = F.least(F.size(labels), F.lit(deepest))
    above = F.when(depth > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
        lambda n: F.array_join(F.slice(labels, 1, n), ".")))
    points = judged.select("host", "path").distinct().select(
        "host", "path", F.explode(above).alias("host_key"))
    points = points.join(known.select("host_key").distinct(), "host_key", "left_semi")
    points = materialize(points, "url-points")

    shares = points.groupBy("host_key").agg(
        F.ceil(F.count("*") / F.lit(sweep_rows)).cast("int").alias("salts"))
    events = interval_events(known.join(shares, "host_key").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")))
    dealt = points.join(shares, "host_key").select(
        "host_key", F.pmod(F.xxhash64("host", "path"), "salts").cast("int").alias("salt"),
        canonical(F.col("host_key"), F.col("path")).alias("key"), F.lit(POINT).alias("kind"),
        "host", "path")
    found = active_rules(events.unionByName(dealt, allowMissingColumns=True))
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        F.length("top.rule").alias("long"), F.length("host_key").alias("host_long"),
        F.col("top.rule").alias("rule"), F.col("top.verdict").alias("verdict"))).alias("best"))
    return judged.join(best, ["host", "path"], "left").select(
        "own.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
