"""Quality rules: counts within a text, and lines that many documents of a host share.

Every line is hashed in its normalised form (blanks at the ends and the case of A-Z do not
count). For each host and line the distinct documents are counted, copies of one whole text as
one document: removing copies is the work of the duplicate operators, and a copied page is not
made of page furniture. Lines in more documents than ``limit`` allows are removed, and a document
of which too little is left is rejected, as is one that fails the rules on its own text.

A line above the limit is in more than a given share of its host's documents, so a host has few
of them. ``clean`` sends them to the documents as long as they are few in all, and no text is
shuffled then; more of them are joined by their hashes, with the same result.

Cases: a null text counts as empty, fails and is rejected; a null host is a host of its own;
rows that repeat get the same result each; an empty table gives an empty result; other columns
are kept by ``clean`` and play no part.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.tables import BLANKS, fingerprint, line_key, words
from shelfwise.session import materialize

SYMBOLS = "#*$%&|<>"
# Up to so many lines above the limit, over all hosts and of one, are broadcast by ``clean``.
SHARED_LINES = 100_000
HOST_LINES = 1_000


@dataclass(frozen=True)
class Limits:
    """``min_documents`` and ``percent``: a line is above the limit if more documents of the
    host hold it than the first and than so many hundredths of the host's documents.
    ``kept_percent``: a document is depleted if less of its characters is left.
    """

    min_words: int = 50
    repeat_percent: int = 50
    min_documents: int = 20
    percent: int = 5
    kept_percent: int = 30


DOCUMENT = ["doc_id", "print", "host", "no_host"]
HOST = ["host", "no_host"]
LINE = [*HOST, "k1", "k2"]


def identity(host):
    """What tells documents apart; rows equal in all of it have equal results."""
    return (F.col("doc_id"), fingerprint(F.col("text")).alias("print"),
            F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
            F.col(host).isNull().alias("no_host"))


# Windows of three words by hash, each with its place; equal ones are neighbours once sorted.
# Words and windows are bound to names, so that no optimiser rule makes them more than once.
WORD_COUNTS = """
element_at(transform(array(words), w -> struct(
    size(w) AS n_words,
    element_at(transform(
        array(sort_array(transform(if(size(w) > 2, sequence(0, size(w) - 3), array()),
            i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS i)))),
        s -> size(array_distinct(flatten(transform(
            filter(s, (x, i) -> (i > 0 AND s[i - 1].h = x.h)
                OR (i + 1 < size(s) AND s[i + 1].h = x.h)),
            x -> array(x.i, x.i + 1, x.i + 2)))))), 1) AS n_repeat_words)), 1)
"""


def text_counts(documents: DataFrame, host="source", limits: Limits = Limits(),
                **more) -> DataFrame:
    """Counts of each document's own text, one row a row, beside what identifies it and ``more``
    columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parted = documents.select(
        *identity(host), *(column.alias(name) for name, column in more.items()), words(F.col("text")).alias("words"), F.length(text).alias("chars"),
        F.length(F.translate(text, BLANKS, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        F.filter(F.split(text, "\n"),
                 lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("lines"))
    counted = parted.withColumn("counts", F.expr(WORD_COUNTS)).select(
        *DOCUMENT, *more, "chars", F.col("counts.n_words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long"), F.col("n_symbols").cast("long"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.col("counts.n_repeat_words").cast("long").alias("n_repeat_words"))
    return counted.withColumn(
        "base_failed", (F.col("n_words") < limits.min_words)
        | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")))


def host_lines(documents: DataFrame, host: str) -> DataFrame:
    """The lines that have a word: document, place, 128 bits of the key, characters."""
    lines = documents.select(
        *identity(host),
        F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("pos", "line"))
    lines = lines.select("*", line_key(F.col("line")).alias("key")).where("key <> ''")
    return lines.select(*DOCUMENT, "pos", F.xxhash64("key").alias("k1"),
                        F.xxhash64(F.lit(1), "key").alias("k2"), F.length("line").alias("chars"))


def frequent_lines(documents: DataFrame, host="source", limits: Limits = Limits()) -> DataFrame:
    """Hosts and lines above the limit. Counts are made in the tasks first, so that a host with
    a third of all documents, or a line in all of them, reaches a task as partial counts."""
    held = host_lines(documents, host).select(*LINE, "print").distinct()
    held = held.groupBy(*LINE).agg(F.count("*").alias("held_by")).where(
        F.col("held_by") > limits.min_documents)
    sizes = documents.select(*identity(host)).select(*HOST, "print").distinct()
    sizes = sizes.groupBy(*HOST).agg(F.count("*").alias("size"))
    return held.join(sizes, HOST).where(
        100 * F.col("held_by") > limits.percent * F.col("size")).select(*LINE)


def removed_lines(documents: DataFrame, frequent: DataFrame, host="source") -> DataFrame:
    """Of each document that holds lines above the limit: their keys and characters."""
    found = host_lines(documents, host).join(frequent, LINE)
    found = found.select(*DOCUMENT, "pos", "k1", "k2", "chars").distinct()
    return found.groupBy(*DOCUMENT).agg(
        F.sum("chars").alias("removed_chars"),
        F.collect_set(F.struct("k1", "k2")).alias("removed_keys"))


def with_removed(rows: DataFrame, removed: DataFrame) -> DataFrame:
    removed = removed.select(*(F.col(name).alias(f"r_{name}") for name in DOCUMENT),
                             "removed_chars", "removed_keys")
    same = [F.col(name).eqNullSafe(F.col(f"r_{name}")) for name in DOCUMENT]
    return rows.join(removed, same, "left").drop(*(f"r_{name}" for name in DOCUMENT))


def judge(documents: DataFrame, host="source", limits: Limits = Limits(),
          frequent: DataFrame | None = None) -> DataFrame:
    """The counts of every document, ``removed_chars`` and ``removed_keys``, ``base_failed`` and
    ``kept``. No text is shuffled, only hashes of lines and counts are."""
    frequent = frequent_lines(documents, host, limits) if frequent is None else frequent
    rows = with_removed(text_counts(documents, host, limits),
                        removed_lines(documents, frequent, host))
    gone = F.coalesce(F.col("removed_chars"), F.lit(0))
    depleted = 100 * (F.col("chars") - gone) < limits.kept_percent * F.col("chars")
    return rows.select(
        *DOCUMENT, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        gone.alias("removed_chars"), "removed_keys", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"))


def clean(documents: DataFrame, host="source", limits: Limits = Limits(),
          shared=SHARED_LINES, of_host=HOST_LINES) -> DataFrame:
    """The documents that pass, without the lines above the limit; all columns are kept, and
    ``n_chars`` is counted anew where a text changes."""
    frequent = materialize(frequent_lines(documents, host, limits), "frequent-lines")
    sizes = frequent.groupBy(*HOST).agg(F.count("*").alias("n"))
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    few = (total or 0) <= shared and (largest or 0) <= of_host
    found = (in_place if few else rejoined)(documents, frequent, host, limits)
    return found.select(*(_column(name, documents) for name in documents.columns))


def in_place(documents: DataFrame, frequent: DataFrame, host, limits: Limits) -> DataFrame:
    """What is left of the documents that pass, by the lines of each host as a broadcast."""
    lines = frequent.groupBy(*HOST).agg(F.collect_set(F.struct("k1", "k2")).alias("host_keys"))
    rows = text_counts(documents, host, limits, row=_own(documents), old_text=F.col("text"))
    rows = rows.join(F.broadcast(lines), HOST, "left")
    keys = F.col("host_keys")
    # Bound to names step by step, and filtered in the generator, so that all is made once.
    cut = F.transform(
        F.array(F.split(F.coalesce(F.col("old_text"), F.lit("")), "\n")),
        lambda all_: F.struct(F.size(all_).alias("n"), F.when(keys.isNull(), all_).otherwise(
            _without(all_, keys)).alias("left")))
    joined = F.transform(cut, lambda c: F.struct(
        c["n"].alias("n"), F.size(c["left"]).alias("n_left"),
        F.array_join(c["left"], "\n").alias("text")))
    passed = F.filter(joined, lambda j: ~F.col("base_failed") & ~(
        100 * (F.length(j["text"]) - F.greatest(j["n_left"] - 1, F.lit(0)) + j["n"] - 1)
        < limits.kept_percent * F.col("chars")))
    found = rows.select("row", "old_text", F.explode(passed).alias("judged"))
    changed = F.col("judged.n_left") < F.col("judged.n")
    return found.select("row", changed.alias("changed"), F.when(
        changed, F.col("judged.text")).otherwise(F.col("old_text")).alias("new_text"))


def rejoined(documents: DataFrame, frequent: DataFrame, host, limits: Limits) -> DataFrame:
    """The same, by a join of the documents with their judgements."""
    judged = materialize(
        judge(documents, host, limits, frequent).select(*DOCUMENT, "removed_keys", "kept"),
        "judged")
    passed = judged.where("kept").groupBy(*DOCUMENT).agg(
        F.max("removed_keys").alias("removed_keys"))
    rows = documents.select(_own(documents).alias("row"), "text", *identity(host))
    same = [rows[name].eqNullSafe(passed[name]) for name in DOCUMENT]
    found = rows.join(passed, same).select("row", "text", "removed_keys")
    changed = F.col("removed_keys").isNotNull()
    left = _without(F.split("text", "\n"), F.col("removed_keys"))
    return found.select("row", changed.alias("changed"), F.when(
        changed, F.array_join(left, "\n")).otherwise(F.col("text")).alias("new_text"))


def _own(documents):
    """The other columns, which may have any names."""
    return F.struct(*(F.col(f"`{name}`") for name in documents.columns if name != "text"))


def _without(lines, keys):
    return F.filter(lines, lambda line: ~F.array_contains(
        keys, F.struct(F.xxhash64(line_key(line)).alias("k1"),
                       F.xxhash64(F.lit(1), line_key(line)).alias("k2"))))


def _column(name, documents):
    if name == "text":
        return F.col("new_text").alias("text")
    old = F.col("row").getField(name)
    if name == "n_chars":
        kind = documents.schema[name].dataType
        return F.when(F.col("changed"), F.length("new_text").cast(kind)).otherwise(old).alias(name)
    return old.alias(name)
