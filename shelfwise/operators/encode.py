"""Text ids to dense integers and back, by mapping tables."""

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.operators.lookup import balanced_lookup, hot_keys, key_counts, spread_lookup
from shelfwise.schemas import RATING_KEY
from shelfwise.session import materialize, together

# monotonically_increasing_id() holds the partition above bit 33 and the row in it below.
ROW_BITS = 33


def with_positions(df: DataFrame, position: str, *order, path: str | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, … in a total order.

    Rows are sorted by range over all partitions and written with their partition and row
    number, so a re-run task cannot shift them. The first position of a partition comes
    from the sizes before it: one small row a partition is all that meets in one task.
    """
    slot = F.monotonically_increasing_id()
    ordered = materialize(df.orderBy(*order).withColumn("_slot", slot), "ordered", path)
    part = F.shiftright("_slot", ROW_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ordered.groupBy(part).agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    row = F.col("_slot").bitwiseAND((1 << ROW_BITS) - 1)
    return (
        ordered.select("*", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(position, F.col("_start") + row)
        .drop("_part", "_slot", "_start")
    )


def index_by_frequency(df: DataFrame, column: str) -> DataFrame:
    """``(column, column_int, n)``: most frequent first, equal counts by text; no NULL id."""
    counts = key_counts(df.filter(F.col(column).isNotNull()), column)
    numbered = with_positions(counts, "_position", F.desc("n"), F.asc(column))
    return numbered.select(column, F.col("_position").cast("int").alias(f"{column}_int"), "n")


def extend_index(id_map: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """The index of ``df`` in which every id that ``id_map`` knows keeps its number, also if
    ``df`` lacks it (with an ``n`` of 0); new ids go on from the largest, most frequent first.

    Known ids are joined by id and new ones are those without a partner, so no list of ids
    reaches the driver; the largest number does.
    """
    known = id_map.select(column, f"{column}_int")
    counts = materialize(key_counts(df.filter(F.col(column).isNotNull()), column), "counts")
    first = known.agg(F.max(f"{column}_int")).first()[0]
    new = with_positions(
        counts.join(known, column, "left_anti"), "_position", F.desc("n"), F.asc(column))
    number = F.col("_position") + F.lit(0 if first is None else first + 1)
    kept = known.join(counts, column, "left").select(
        column, f"{column}_int", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return kept.unionByName(new.select(column, number.cast("int").alias(f"{column}_int"), "n"))


def index_columns(df: DataFrame, *columns: str, known=None) -> list[DataFrame]:
    """Written maps of several columns; the jobs of each do not wait for the others. ``known`` has
    earlier maps by column, whose numbers stay."""

    def build(column):
        def index():
            if known:
                return extend_index(known[column], df, column)
            return index_by_frequency(df, column)

        return lambda: materialize(index(), column)

    return together(df.sparkSession, *[build(c) for c in columns])


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def encode_column(df: DataFrame, id_map: DataFrame, column: str, *, fitted_on_df=False, **limits):
    """Add ``column_int``. An unseen or NULL id gets the number of known ids.

    ``fitted_on_df`` says that the map counts the rows of ``df`` itself, which saves a pass.
    """
    output = f"{column}_int"
    df = drop_if_present(df, output)
    known, total = id_map.agg(F.count("*"), F.sum("n")).first()
    pairs = id_map.select(column, output)
    rest = [c for c in df.columns if c != column]
    if fitted_on_df:
        found = spread_lookup(
            df, pairs, column, hot_keys(id_map, column, total or 0, **limits), rest
        )
    else:
        found = balanced_lookup(df, pairs, column, rest, **limits)
    return found.withColumn(output, F.coalesce(F.col(output), F.lit(known)).cast("int"))


def encode(ratings: DataFrame, user_map: DataFrame, product_map: DataFrame, **options):
    """Ratings with both integer ids, columns in the order of the encoded schema."""
    encoded = encode_column(ratings, user_map, "user_id", **options)
    encoded = encode_column(encoded, product_map, "product_id", **options)
    return encoded.select(*RATING_KEY, "user_id_int", "product_id_int")


def decode_column(df: DataFrame, id_map: DataFrame, column: str, spread_on, **limits):
    """Replace ``column_int`` by the text id; an index without a map row gives NULL."""
    index = f"{column}_int"
    return balanced_lookup(
        df, id_map.select(index, column), index, spread_on, **limits
    ).drop(index)


def mapping_of(encoded: DataFrame, column: str) -> DataFrame:
    """The distinct ``(column, column_int)`` pairs of an encoded table, e.g. its train half."""
    return encoded.select(column, f"{column}_int").distinct()
