"""One registered query for each operator, over whole tables with production parameters, and its checking SQL."""

import public_tokenizers
from pyspark.sql import functions as F

from telemere.llm import arc, bpe, conversations, conversations_sql, exact_dedup, exact_topk, hard_negatives, interpolation, lang_spans, ngram_join, raking, string_kernel, weak_labels, wrappers
from telemere.llm.tables import table

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


@query(
    "op2_exact_dedup",
    """
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS text_sha256 FROM documents
    ), keepers AS (
        SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN keepers USING (text_sha256)
    """,
)
def op2_exact_dedup(spark, sf):
    return exact_dedup.flag_duplicates(table(spark, sf, "documents"))


@query("op5_mixing")
def op5_mixing(spark, sf):
    return raking.mix(table(spark, sf, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = string_kernel.fit(docs, string_kernel.trainable(table(spark, sf, "labels")))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return string_kernel.classify(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@query("op8_bpe")
def op8_bpe(spark, sf):
    return bpe.digests(table(spark, sf, "documents"), VOCABULARY)


@query("op10_ngram_join")
def op10_ngram_join(spark, sf):
    return ngram_join.near_duplicates(table(spark, sf, "documents"))


@query(
    "op4_exact_topk",
    """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
    """,
)
def op4_exact_topk(spark, sf):
    return exact_topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op9_arc_to_warc")
def op9_arc_to_warc(spark, sf):
    return arc.round_trip(table(spark, sf, "pages"))


@query("op6_language")
def op6_language(spark, sf):
    docs = table(spark, sf, "documents")
    model = lang_spans.fit(lang_spans.trainable(docs))
    # The fold comes from the id that identify() returns, so nothing is joined back.
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return lang_spans.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op3_main_text")
def op3_main_text(spark, sf):
    return wrappers.extract(table(spark, sf, "pages"))


@query("op1_quality")
def op1_quality(spark, sf):
    return weak_labels.classify(table(spark, sf, "documents"))


@query("op11_conversations", conversations_sql.REPAIR)
def op11_conversations(spark, sf):
    return conversations.repair_damaged(table(spark, sf, "conversations"))


@query(
    "op13_hard_negatives",
    """
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
            CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
        FROM vectors a JOIN vectors c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """,
)
def op13_hard_negatives(spark, sf):
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, relabelled)


@query("op12_lm_score")
def op12_lm_score(spark, sf):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return interpolation.score(table(spark, sf, "documents"), held_out)
