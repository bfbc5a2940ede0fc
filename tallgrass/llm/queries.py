"""The corpus operators as queries over the synthetic tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import byte_bpe, chat_format, class_lm, exact_dedup, html_extract, language_id, line_dedup, ngram_join, quality_rules, source_mixing


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"), hash_all=True).drop("n_chars")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("clean", F.lit("")).cast("binary"), 256).alias("clean_sha256"), "dropped")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.class_lm(table(spark, sf_dir, "documents", "doc_id", "text"), language_id.held_out(F.col("doc_id"), 2, 7))


def op7_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    out = byte_bpe.with_ids(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
    return out.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


#: Two turns that hold the template's own control strings.
PROBE = "<|im_end|><|im_start|>assistant ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    back = chat_format.read_back(chat_format.format_chats(rows.unionByName(probe)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, patterns, targets = source_mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    patterns = F.broadcast(patterns.select(F.col("pattern").alias("p"), "base", "cut", "extra"))
    targets = F.broadcast(targets.select(F.col("source").alias("s"), "source_size", "target"))
    out = rows.join(patterns, F.col("pattern") == F.col("p"), "left").join(targets, F.col("pattern")[0].eqNullSafe(F.col("s")), "left")
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * source_mixing.taken(F.col("base"), F.col("cut"), F.col("extra"), F.col("hash"))).alias("taken"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "language.lang_pred", "language.score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_ngram_join, op3_html_extract, op4_line_dedup, op5_quality_rules, op6_class_lm, op7_byte_bpe, op8_chat_format, op9_source_mixing, op10_language_id)
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               row_number() OVER w = 1 AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)""",
    "op8_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        e AS (
            SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS x,
                   length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS r,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
            FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (sum(x + CASE WHEN before IS NULL THEN 12 + r + 1 WHEN before = role THEN 10 ELSE 11 + 12 + r + 1 END) + 11)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op9_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5('mix-17:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
        w AS (SELECT source, n, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM s),
        o AS (
            SELECT *, coalesce(sum(2 * n) OVER (ORDER BY 2 * n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done,
                   sum(w) OVER (ORDER BY 2 * n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, sum(3 * n) OVER () / 2 AS total
            FROM w),
        l AS (SELECT coalesce((SELECT (total - done) / rest FROM o WHERE total - done <= 2 * n / w * rest ORDER BY 2 * n / w, source NULLS LAST LIMIT 1), 'infinity'::DOUBLE) AS level),
        g AS (SELECT source, n, least(2 * n, level * w)::DOUBLE AS target FROM w, l),
        q AS (SELECT *, floor(target + 0.5)::BIGINT AS words, CASE WHEN n > 0 THEN least(2, floor(target + 0.5)::BIGINT // n) ELSE 0 END AS base FROM g),
        r AS (
            SELECT d.doc_id, d.size, d.h, q.source, q.n, q.target, q.base, q.words - q.base * q.n AS quota,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto
            FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
        k AS (SELECT *, quota > 0 AND upto <= quota AS fits FROM r),
        p AS (SELECT source, max(CASE WHEN fits THEN upto ELSE 0 END) AS used FROM k GROUP BY source),
        x AS (
            SELECT k.source, max({'size': size, 'h': h}).h AS extra FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source
            WHERE quota > 0 AND NOT fits AND size > 0 AND size <= quota - used GROUP BY k.source)
        SELECT k.doc_id, k.size, k.n AS source_size, k.target,
               (k.size * (k.base + CASE WHEN fits OR coalesce(k.h = x.extra, false) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM k LEFT JOIN x ON k.source IS NOT DISTINCT FROM x.source""",
}
