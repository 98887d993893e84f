"""Schemas and fixed values shared by all modules. Nothing is inferred from data."""

from pyspark.sql import types as T

# Column names of the original review layout and what they become.
RAW_NAMES = {"reviewerID": "user_id", "asin": "product_id", "overall": "rating"}

# Texts that pandas.read_csv treats as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Valid ratings, list length, answer length, split and model settings, and the
# message of an empty answer.
RATING_MIN, RATING_MAX = 1.0, 5.0
LIST_LENGTH = 10
DEFAULT_N = 5
TRAIN_SHARE, SPLIT_SEED = 0.8, 42
RANK, MAX_ITER, REG_PARAM = 10, 10, 0.1
EMPTY_MESSAGE = "Utilisateur non trouvé dans le modèle ALS."

RATING_KEY = ["user_id", "product_id", "rating"]

RATINGS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("rating", T.DoubleType(), False),
])

USER_MAP = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("user_id_int", T.IntegerType(), False),
    T.StructField("n", T.LongType(), False),
])

PRODUCT_MAP = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("product_id_int", T.IntegerType(), False),
    T.StructField("n", T.LongType(), False),
])

RECOMMENDATIONS = T.StructType([
    T.StructField("user_id_int", T.IntegerType(), False),
    T.StructField("recommendations", T.ArrayType(T.StructType([
        T.StructField("product_id_int", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
    ]))),
])

EXPORT_ITEMS = T.ArrayType(T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("predicted_rating", T.DoubleType()),
]))

EXPORT = T.StructType([
    T.StructField("user_id_int", T.IntegerType()),
    T.StructField("recommendations", EXPORT_ITEMS),
])

REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType(), False),
    T.StructField("user_id", T.LongType()),
    T.StructField("n", T.IntegerType()),
])

ANSWER_ITEMS = T.ArrayType(T.StructType([
    T.StructField("product_id", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
]))

STORED_ANSWERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("recommendations", ANSWER_ITEMS),
    T.StructField("timestamp", T.StringType()),
])
