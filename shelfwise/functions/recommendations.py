"""Expressions over ranked lists. All are built-in functions, none a Python UDF."""

from pyspark.sql import Column, functions as F

from shelfwise.schemas import EXPORT_ITEMS, LIST_LENGTH

# How a printed list shows an entry, and the time format.
PRINTED_ENTRY = r"product_id_int=(\d+), rating=(-?[\d.]+(?:[eE][-+]?\d+)?)"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def answer_items(recs) -> Column:
    """``(product_id_int, rating)`` entries as served: ``(product_id, score)`` in double."""
    return F.transform(recs, lambda x: F.struct(
        x["product_id_int"].alias("product_id"),
        x["rating"].cast("double").alias("score"),
    ))


def export_items(recs) -> Column:
    """Entries as exported, all that were ranked: ``(product_id, predicted_rating)``."""
    return F.transform(recs, lambda x: F.struct(
        x["product_id_int"].alias("product_id"),
        x["rating"].cast("double").alias("predicted_rating"),
    ))


def printed_items(text, length: int = LIST_LENGTH) -> Column:
    """Entries of a list that an older export printed as text, signs and exponents included.
    Entries are taken whole, so one without a number for a rating leaves the others as they are."""
    entries = F.regexp_extract_all(text, F.lit(PRINTED_ENTRY), F.lit(0))
    return F.transform(F.slice(entries, 1, length), lambda x: F.struct(
        F.regexp_extract(x, PRINTED_ENTRY, 1).cast("int").alias("product_id"),
        F.regexp_extract(x, PRINTED_ENTRY, 2).cast("double").alias("predicted_rating"),
    )).cast(EXPORT_ITEMS)


def iso_timestamp(ts) -> Column:
    return F.date_format(ts, ISO_MICROS)
