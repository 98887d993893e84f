"""The operators as registered queries over whole tables."""

from pyspark.sql import functions as F

from shelfwise.llm import (
    clusters,
    credentials,
    jaccard,
    language,
    line_dedup,
    packing,
    quality,
    token_files,
    tool_calls,
    urls,
    vectors,
    viterbi,
    whitening,
)
from shelfwise.llm.tables import table


def op1_token_files(spark, folder):
    """Where does each document lie in the corpus of token ids, as the written files say?"""
    return token_files.round_trip(table(spark, folder, "documents").select("doc_id", "text"))


def op2_line_dedup(spark, folder):
    """Which lines of which documents stay when each line is kept in its first document only?"""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    rows = line_dedup.apply(documents, line_dedup.keep_bitmaps(documents))
    return rows.select(
        "row.doc_id", F.col("lines").cast("long").alias("n_lines"),
        F.col("n_dropped").cast("long").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_packing(spark, folder):
    """In which sequence, and where in it, is each piece of each document?"""
    return packing.pack(table(spark, folder, "documents").select("doc_id", "text"))


def op4_vectors(spark, folder):
    """Which vectors have near duplicates, and which group is each one in?"""
    return vectors.near_duplicates(table(spark, folder, "embeddings").select("vec_id", "embedding"))


SCHEMAS = {
    "search": {
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "maximum": 400}}},
    "summarise": {
        "required": ["text", "sentences"],
        "properties": {"text": {"type": "string"},
                       "sentences": {"type": "integer", "minimum": 1}}},
    "translate": {
        "required": ["text", "target"],
        "properties": {"text": {"type": "string"},
                       "target": {"type": "string", "enum": ["en", "fr"]}}},
}


def op5_tool_calls(spark, folder):
    """Every user turn as a tool call with the next turn as its result: linked and checked.

    The tables hold no tool calls, so turns stand for them. A call needs those two and four
    turns before it.
    """
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    key = "md5(concat(conv_id, ':', {}))".format
    users = turns.where("role = 'user'").select(
        "conv_id", F.expr(key("turn")).alias("call_id"), F.col("turn").alias("seq"), "text",
        F.expr("element_at(array('search', 'summarise', 'translate'),"
               " CAST((turn div 2) % 3 AS INT) + 1)").alias("tool"),
        F.expr(f"array({key('turn - 2')}, {key('turn - 4')})").alias("depends_on"))
    calls = users.withColumn("arguments", F.expr("""CASE tool
        WHEN 'search' THEN to_json(struct(text AS query, length(text) AS limit))
        WHEN 'summarise' THEN to_json(struct(
            text, length(text) - length(replace(text, '.', '')) AS sentences))
        ELSE to_json(struct(CASE WHEN length(text) % 2 = 0 THEN 'en'
                            WHEN length(text) % 3 = 0 THEN 'xx' END AS target, text)) END"""))
    results = turns.where("role <> 'user'").select(
        F.expr(key("turn - 1")).alias("call_id"), F.col("text").alias("result"))
    return tool_calls.linked(calls, results, SCHEMAS)


def op6_quality_rules(spark, folder):
    """Which documents pass the rules on their own text and on lines shared within a source?"""
    return quality.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_chars")


def op7_viterbi(spark, folder):
    """How many pieces has each document, which ones, and do they decode to its text?"""
    return viterbi.encode(table(spark, folder, "documents").select("doc_id", "text")).drop("ids")


def op8_language_id(spark, folder):
    """Which language is each document in?"""
    return language.identify(
        table(spark, folder, "documents").select("doc_id", "text", "lang")
    ).select("doc_id", "held_out", "lang_pred", "score")


def op9_jaccard(spark, folder):
    """Which group of near-equal texts is each document in?"""
    return jaccard.groups(table(spark, folder, "documents").select("doc_id", "text"),
                          width=3, percent=90)


RULES = """
SELECT * FROM VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
AS rules(host, path, verdict)
"""


def op10_url_filters(spark, folder):
    """Which rule holds for each page, and what does it say?"""
    rules = spark.sql(RULES)
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urls.verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op11_whitening(spark, folder):
    """Each vector along the first four principal components, scaled to unit variance."""
    return whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op12_clusters(spark, folder):
    """Which of 40 clusters is each vector in after five rounds, and how close to its centroid?"""
    return clusters.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op13_secrets(spark, folder):
    """Which secrets does each document hold, and which weak candidates beside them?"""
    found = credentials.find(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < credentials.FIRST_WEAK)

    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(credentials.spelled(base).cast("binary"), 256).alias("base_sha256"),
        credentials.spelled(spans).alias("spans"))


QUERIES = {
    "op10_url_filters": op10_url_filters,
    "op11_whitening": op11_whitening,
    "op12_clusters": op12_clusters,
    "op13_secrets": op13_secrets,
    "op1_token_files": op1_token_files,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_vectors": op4_vectors,
    "op5_tool_calls": op5_tool_calls,
    "op6_quality_rules": op6_quality_rules,
    "op7_viterbi": op7_viterbi,
    "op8_language_id": op8_language_id,
    "op9_jaccard": op9_jaccard,
}
