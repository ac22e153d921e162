"""Queries of the operators over the test tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hitloom.llm import chat_format as chat
from hitloom.llm import language_id as language
from hitloom.llm import license_scan as licenses
from hitloom.llm import secret_scan as secrets
from hitloom.llm.exact_dedup import exact_dedup
from hitloom.llm.hard_negatives import mine
from hitloom.llm.jaccard_join import jaccard_join
from hitloom.llm.line_dedup import line_dedup
from hitloom.llm.packing import pack
from hitloom.llm.passage_dedup import repeated_passages
from hitloom.llm.quality_rules import COUNTS, quality_rules
from hitloom.llm.ranked_search import ranked_search
from hitloom.llm.source_mixing import mix

TOKENIZER = "word_bpe_49k.json"


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(documents(spark, folder)).select("doc_id", "text", "n_lines", "deleted", "homes")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(documents(spark, folder)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op4_passage_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(documents(spark, folder))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_scan(documents(spark, folder))
    own = F.transform("base", lambda x: x["label"])
    others = F.transform("found", lambda x: x["label"])
    weights = F.transform("found", lambda x: x["weight"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["first"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, others)), ",").alias("labels"),
        F.greatest(
            F.when(F.size("base") > 0, F.lit(0.9)).otherwise(F.lit(0.0)), F.coalesce(F.array_max(weights), F.lit(0.0))
        ).alias("score"),
    )


def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken", "uses")


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(documents(spark, folder), width=3, num=90, den=100).select("doc_id", "n_shingles", "component_id", "class_id")


def messages(rows: DataFrame) -> DataFrame:
    """Conversations as reply trees: each row replies to the one before it in its conversation."""
    tree = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = rows.select(tree.alias("tree"), "turn", "role", "text").withColumn("message", F.row_number().over(order).cast("long"))
    return numbered.select(
        "tree", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    back = chat.read_back(chat.chat_format(messages(rows.unionByName(extra))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.when(F.col("tree") != "none", F.col("tree").cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.secret_scan(documents(spark, folder))
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in secrets.BASE], F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(documents(spark, folder)).select("doc_id", *COUNTS, "base_failed", "kept", "distance")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return ranked_search(documents(spark, folder), items).select("item_id", "rank", "doc_id", "score")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder)).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), F.coalesce("nearest", F.lit("und")).alias("lang_pred"),
        "score", "distance", "rejected",
    )


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_line_dedup, op3_exact_dedup, op4_passage_dedup, op5_license_scan, op6_source_mixing,
    op7_jaccard_join, op8_chat_format, op9_secret_scan, op10_quality_rules, op11_ranked_search,
    op12_hard_negatives, op13_language_id,
)}
ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
      doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM d WINDOW w AS (PARTITION BY t)""",
    "op11_ranked_search": r"""
    WITH low AS (
      SELECT 'd' AS side, row_number() OVER () AS own, doc_id AS id, text FROM documents
      UNION ALL SELECT 'q', row_number() OVER (), item_id, text FROM benchmark),
    runs AS (
      SELECT side, own, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM low),
    tfs AS (SELECT own, id, term, count(*) AS tf FROM runs WHERE side = 'd' GROUP BY ALL),
    sizes AS (SELECT own, sum(tf)::BIGINT AS n FROM tfs GROUP BY own),
    corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
    weights AS (
      SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, corpus GROUP BY term, docs),
    asked AS (SELECT DISTINCT own AS item, id AS item_id, term FROM runs WHERE side = 'q'),
    scores AS (
      SELECT item, item_id, t.own, t.id AS doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total)))))::BIGINT AS score
      FROM asked JOIN tfs t USING (term) JOIN weights USING (term) JOIN sizes USING (own), corpus
      GROUP BY ALL)
    SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= 50""",
    "op12_hard_negatives": """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    pairs AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    good AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
    hard AS (
      SELECT g.*, p.other_id AS negative_id, p.score AS negative_score,
        row_number() OVER (PARTITION BY g.anchor_id, g.positive_id ORDER BY p.score DESC, p.other_id)::INTEGER AS rank
      FROM good g JOIN pairs p ON p.anchor_id = g.anchor_id AND NOT p.same
        AND 80 * positive_score <= 100 * p.score AND 100 * p.score <= 100 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 5""",
}
