"""Language identification by rank-order profiles.

A profile is the most frequent letter n-grams of one to three letters in order of frequency, with
a mark where a word begins or ends. A document's profile, from its whole text, is compared with
each language's: every n-gram adds how many places it is out of place, and the length of the
profile if the language does not have it. The smallest sum wins, ties by name; the score is one
minus the share of the largest sum possible.

Profiles are counted over a bounded random sample of the labelled documents, ``fit_documents`` a
language at most, of which the driver gets the profiles only.

Cases: a null text, one without letters, or a table without labels to learn from gives ``und``
and score 0; a null ``doc_id`` is not held out and not learned from; rows that repeat get the same
result each; an empty table gives an empty result; other columns play no part.
"""

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.batches import small

PROFILE = 400
FIT_DOCUMENTS = 4000
UNKNOWN = "und"
EDGE = 1  # stands where a word begins or ends
BITS = 21


@lru_cache(1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngrams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, as often as they occur."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64)
    inside = np.concatenate([[False], letter, [False]])
    padded = np.concatenate([[0], codes, [0]]).astype(np.int64)
    padded[~inside] = EDGE
    kept = inside.copy()
    kept[:-1] |= inside[1:]
    kept[-1] |= inside[-2]
    kept[1:] |= inside[:-1]
    line = padded[kept]
    edge = line == EDGE
    two = (line[:-1] << BITS | line[1:])[~(edge[:-1] & edge[1:])]
    three = (line[:-2] << 2 * BITS | line[1:-1] << BITS | line[2:])[~edge[1:-1]]
    return np.concatenate([line[~edge], two, three])


def most_frequent(codes, counts, size) -> np.ndarray:
    return codes[np.lexsort((codes, -counts))[:size]]


def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of each language, counted a batch."""
    for batch in small(batches):
        by_language: dict[str, list[np.ndarray]] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_language.setdefault(language, []).append(ngrams(text))
        for language, found in by_language.items():
            codes, counts = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(codes), pa.string()), pa.array(codes),
                 pa.array(counts.astype(np.int64))], names=["lang", "code", "n"])


def held_out():
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                      F.lit(False))


def profiles(documents: DataFrame, fit_documents=FIT_DOCUMENTS, size=PROFILE) -> dict:
    """Codes of each language's profile in order of frequency."""
    labelled = documents.where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(~held_out())
    known = labelled.groupBy("lang").agg(F.count("*").alias("known"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    # A row a language, as the profiles are; texts stay where they are read.
    sample = labelled.join(F.broadcast(known), "lang").where(
        place * F.col("known") < fit_documents).select("lang", "text")
    counts = sample.mapInArrow(tallied, "lang string, code long, n long")
    counts = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    rows = counts.select("lang", "code", rank.alias("rank")).where(F.col("rank") <= size)
    found: dict[str, list] = {}
    for row in rows.orderBy("lang", "rank").collect():  # ``size`` rows a language
        found.setdefault(row.lang, []).append(row.code)
    return {language: np.array(codes, np.int64) for language, codes in found.items()}


def distances(text: str, known: list, size: int):
    """Out-of-place distance to each profile, and the largest possible; None without letters."""
    codes, counts = np.unique(ngrams(text), return_counts=True)
    if not len(codes):
        return None
    own = most_frequent(codes, counts, size)
    places = np.arange(len(own))
    sums = []
    for ordered, ranks in known:
        at = np.minimum(np.searchsorted(ordered, own), len(ordered) - 1)
        out = np.where(ordered[at] == own, np.abs(ranks[at] - places), size)
        sums.append(int(out.sum()))
    return np.array(sums), size * len(own)


def predicted(batches: Iterator[pa.RecordBatch], shared, size) -> Iterator[pa.RecordBatch]:
    names = sorted(shared.value)
    known = []
    for name in names:
        order = np.argsort(shared.value[name])
        known.append((shared.value[name][order], order))
    for batch in small(batches):
        languages, scores = [], []
        for text in batch.column("text"):
            found = distances(text.as_py(), known, size) if text.is_valid and names else None
            if found is None:
                languages.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(found[0].argmin())
            languages.append(names[best])
            scores.append(1.0 - found[0][best] / found[1])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(batch.num_columns)),
             pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
            names=[*batch.schema.names, "lang_pred", "score"])


def predict(rows: DataFrame, known: dict, size=PROFILE) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score`` for their ``text``, its only input."""
    shared = rows.sparkSession.sparkContext.broadcast(known)  # ``size`` codes a language
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(partial(predicted, shared=shared, size=size),
                           f"{columns}, lang_pred string, score double")


def identify(documents: DataFrame, fit_documents=FIT_DOCUMENTS) -> DataFrame:
    """Every document with ``held_out``, ``lang_pred`` and ``score``."""
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, profiles(documents, fit_documents)).drop("text")


def accept(documents: DataFrame, min_score: float, fit_documents=FIT_DOCUMENTS) -> DataFrame:
    """The documents, as they are, whose text some language's profile fits well enough."""
    own = F.struct(*(F.col(f"`{name}`") for name in documents.columns if name != "text"))
    rows = predict(documents.select(own.alias("row"), "text"), profiles(documents, fit_documents))
    rows = rows.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return rows.select(*(
        F.col("text") if name == "text" else F.col("row").getField(name).alias(name)
        for name in documents.columns))
