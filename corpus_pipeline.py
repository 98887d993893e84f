"""From raw documents to packed training sequences, as stages that hand over written tables.

Each stage takes all that the one before has kept: documents that fail the quality rules go, and
lines that too many documents of a source share; then those in no language the profiles know;
lines an earlier document has are dropped; of near-equal documents (five-word shingles, Jaccard
similarity 0.8) the first stays; the rest is packed into sequences.
"""

from shelfwise.llm import jaccard, language, line_dedup, packing, quality
from shelfwise.llm.tables import table
from shelfwise.session import materialize

MIN_SCORE = 0.25  # of a language's profile; far below any text in a known language


def quality_stage(spark, documents, folder):
    return quality.clean(documents)


def language_stage(spark, documents, folder):
    return language.accept(documents, MIN_SCORE)


def line_stage(spark, documents, folder):
    return line_dedup.dedup(documents)


def near_duplicate_stage(spark, documents, folder):
    return jaccard.one_of_each(documents)


def packing_stage(spark, documents, folder):
    return packing.pack(documents)


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", near_duplicate_stage),
    ("packing", packing_stage),
]

# Profiles, shingle groups and tokens cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each one's result is written and read again."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name)
    return rows
