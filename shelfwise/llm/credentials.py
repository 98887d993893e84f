"""Secrets in texts, and weak candidates that only count beside their complement.

Strong finds are assignments to a secret's name, access identifiers and long hexadecimal numbers
(the base kinds). A credential mostly has several parts: an identifier, a secret and an endpoint. Weak
candidates for each (a user name, a bare token, a short password, an address) are everywhere, so one
is reported only where its complement stands in the same scope, not further than ``REACH`` code points
away. A scope ends at a blank line. What completes what:

* an identifier: a secret, strong or weak;
* a weak secret: an identifier (an access identifier or a weak one);
* an endpoint: a strong secret, or both a weak secret and an identifier.

Positions come from cutting a text at a pattern: lengths of the pieces and the matches in turn add up
to the places of the matches. Parts are joined to scopes and to the nearest parts on either side by
sorted sweeps over the parts of a text (windows that carry the last end on), never by pairs.
Parts are small rows; the texts themselves are read once and never shuffled.

Weak candidates are leftmost and non-overlapping among themselves; one that overlaps a
base find is not reported and completes nothing. A bare token needs lower and upper case and a digit.

Cases: a null text is empty; every row is judged on its own, so rows that share an id or repeat get
a result each; a null id stays null; an empty table gives an empty result; other columns play no part.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import materialize

REACH = 400

GAP = r"""["']?\x20*[:=]\x20*["']?"""


def either_case(words: str) -> str:
    """A pattern for words in which each ASCII letter may have either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The base kinds' patterns.
ASSIGN = f"(?:{either_case('password|passwd|secret|token|api_?key')}){GAP}([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
MIN_VALUE = 8

IDENTIFIER = (f"(?:{either_case('username|user|login|account|client_?id|access_?key_?id')}){GAP}"
              "[A-Za-z0-9@._+-]{3,}")
NAMED = (f"(?:{either_case('password|passwd|secret|token|api_?key|pwd|passphrase|private_?key')})"
         f"{GAP}[A-Za-z0-9+/_.=-]{{4,}}")
TOKEN = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = (f"{either_case('https?://')}[A-Za-z0-9.-]+(?::[0-9]+)?"
            f"|(?:{either_case('hostname|host|server|endpoint')}){GAP}[A-Za-z0-9.-]{{4,}}(?::[0-9]+)?")
WEAK = f"({IDENTIFIER})|({NAMED})|({TOKEN})|({ENDPOINT})"
BLANK_LINE = r"\n[\x20\x09-\x0D]*\n"

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
FIRST_WEAK, BREAK = 3, -1


def _matches(text, pattern, kind):
    """Where ``pattern`` matches: lengths of the pieces before each match and of the matches, and
    the kind of each, null for a match that does not count."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(
        F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"),
        F.transform(found, F.length).alias("size"), kind(found).alias("kind"))


def _always(number):
    return lambda found: F.transform(found, lambda _: F.lit(number))


def _assigned(text):
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1))
    return lambda _: F.transform(values, lambda x: F.when(F.length(x) >= MIN_VALUE, 0))


def _weak_kind(text):
    """The kind of each weak candidate from the group it matched; null for a poor token."""
    who, named, token = (
        F.regexp_extract_all(text, F.lit(WEAK), F.lit(group)) for group in (1, 2, 3))

    def kind(found):
        mixed = (found["token"].rlike("[a-z]") & found["token"].rlike("[A-Z]")
                 & found["token"].rlike("[0-9]"))
        return (F.when(F.length(found["who"]) > 0, FIRST_WEAK)
                .when((F.length(found["named"]) > 0) | mixed, FIRST_WEAK + 1)
                .when(F.length(found["token"]) == 0, FIRST_WEAK + 2))

    return lambda _: F.transform(
        F.arrays_zip(who.alias("who"), named.alias("named"), token.alias("token")), kind)


LISTS = {"assign": "assign", "access": "access", "hex": "hex", "weak": "beside.weak",
         "breaks": "beside.breaks"}


def found_parts(documents: DataFrame, id: str, text: str) -> DataFrame:
    """A row a text with its number, id and lists of matches; null lists where there are none."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("whole"))
    whole = F.col("whole")
    return rows.select(
        "row", "id",
        F.when(whole.rlike(ASSIGN), _matches(whole, ASSIGN, _assigned(whole))).alias("assign"),
        F.when(whole.rlike(ACCESS), _matches(whole, ACCESS, _always(1))).alias("access"),
        F.when(whole.rlike(HEX), _matches(whole, HEX, _always(2))).alias("hex"),
        F.when(whole.rlike(WEAK), F.struct(
            _matches(whole, WEAK, _weak_kind(whole)).alias("weak"),
            _matches(whole, BLANK_LINE, _always(BREAK)).alias("breaks"))).alias("beside"))


def placed(parts: DataFrame) -> DataFrame:
    """``row, start, end, kind`` of each match that counts, in code points."""
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("list"), F.col(path).alias("found"))
                               for name, path in LISTS.items()))).alias("each")
    rows = parts.repartition("row").select("row", each).select(
        "row", "each.list", F.posexplode("each.found").alias("at", "m"))
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(
        Window.partitionBy("row", "list").orderBy("at"))
    return rows.select("row", F.col("m.kind").alias("kind"), end.alias("end"),
                       (end - F.col("m.size")).alias("start")).where("kind IS NOT NULL")


def _neighbours(names: dict, *by: str) -> dict:
    """For each condition the largest end before a part and the smallest start after it, among
    the parts of the same ``by`` that meet the condition."""
    before = Window.partitionBy(*by).orderBy("start", "kind").rowsBetween(
        Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(
        Window.unboundedPreceding, -1)
    columns = {}
    for name, condition in names.items():
        columns[f"{name}_before"] = F.max(F.when(condition, F.col("end"))).over(before)
        columns[f"{name}_after"] = F.min(F.when(condition, F.col("start"))).over(after)
    return columns


def linked(parts: DataFrame) -> DataFrame:
    """The base parts, and the weak ones whose complement is near."""
    kind, weak = F.col("kind"), F.col("kind") >= FIRST_WEAK
    scope = F.sum((kind == BREAK).cast("int")).over(
        Window.partitionBy("row").orderBy("start", "kind").rowsBetween(
            Window.unboundedPreceding, 0))
    base = {"base": kind.between(0, FIRST_WEAK - 1)}
    covered = (F.coalesce(F.col("base_before") > F.col("start"), F.lit(False))
               | F.coalesce(F.col("base_after") < F.col("end"), F.lit(False)))
    rows = parts.withColumn("scope", scope).where(kind != BREAK).withColumns(
        _neighbours(base, "row")).where(~(weak & covered))
    rows = rows.withColumns(_neighbours({
        "strong": kind.isin(0, 2), "who": kind.isin(1, FIRST_WEAK),
        "what": kind == FIRST_WEAK + 1}, "row", "scope"))

    def near(name):
        gap = F.least(F.col("start") - F.col(f"{name}_before"),
                      F.col(f"{name}_after") - F.col("end"))
        return F.coalesce(gap <= REACH, F.lit(False))

    complete = (F.when(kind == FIRST_WEAK, near("strong") | near("what"))
                .when(kind == FIRST_WEAK + 1, near("who"))
                .otherwise(near("strong") | near("what") & near("who")))
    return rows.where(~weak | complete).select("row", "start", "end", "kind")


def find(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id`` and ``spans``, an array of ``start, kind, end`` in order, of every row; ``kind`` is a
    number in ``KINDS``."""
    parts = materialize(found_parts(documents, id, text), "secret-parts")
    bare = F.coalesce("assign", "access", "hex", "beside.weak").isNull()
    span = F.struct(*(F.col(name).cast("int").alias(name) for name in ("start", "kind", "end")))
    spans = linked(placed(parts.where(~bare))).groupBy("row").agg(
        F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    held = parts.where(~bare).select("row", "id").join(spans, "row", "left")
    return parts.where(bare).select("id", none.alias("spans")).unionByName(
        held.select("id", F.coalesce("spans", none).alias("spans"))).withColumnRenamed("id", id)


def spelled(spans):
    """``kind:start:end``, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")
