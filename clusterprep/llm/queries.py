"""Queries of the training-data operators, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterprep.llm import (
    bwt_dedup,
    conversations,
    exact_dedup,
    grouping,
    language_id,
    line_dedup,
    order_minhash,
    packing,
    phrases,
    pieces,
    pii,
    quality,
    winnowing,
)
from clusterprep.llm.rows import in_held_out
from clusterprep.llm.tokens import default_path


WORDS = "word_bpe_49k.json"  # vocabulary file of the packing query
RANKS = "byte_bpe_50k.tiktoken"  # vocabulary file of the id matrices
PIECES = "piece_bpe_32k.model"  # model file of the SentencePiece query
GOOD = 0.7  # least score of a good document


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _learned_from(rows: DataFrame) -> DataFrame:
    """Rows that models may learn from: those with an id that is not held out."""
    return rows.filter(F.col("doc_id").isNotNull() & ~in_held_out(F.col("doc_id")))


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.QualityModel:
    return quality.fit_quality_model(docs, _learned_from(labels))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_model(docs, _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        in_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )


def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), default_path(RANKS))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_classes(_table(spark, sf_dir, "documents")).drop("row")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.shared_runs(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))

    def add(total, run):
        new = run["end"] - F.greatest(total["end"], run["first"])
        return F.struct(
            F.greatest(total["end"], run["end"]).alias("end"),
            (total["hit"] + F.greatest(new, F.lit(0))).alias("hit"),
        )

    items = F.array_sort(F.array_distinct(F.transform("runs", lambda r: r["item_id"])))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(F.array_sort("runs"), start, add)["hit"].alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_copies(_table(spark, sf_dir, "documents")).drop("row")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.pack_documents(_table(spark, sf_dir, "documents"), default_path(WORDS))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit_language_model(_learned_from(docs))
    return language_id.identify_language(docs, model).select(
        "doc_id", in_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(_table(spark, sf_dir, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults put in by a hash of id and turn; dropped turns are not `present`."""
    turns = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.concat_ws(
            ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
        ).alias("place"),
    )
    fault = F.crc32(F.col("place").cast("binary")) % 20
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.translate("text", conversations.ENDINGS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (fault != 0).alias("present"),
        F.explode(copies).alias("copy"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(_table(spark, sf_dir, "conversations"))
    return conversations.repair_conversations(turns, present_col="present")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    both = pieces.encode_pieces(docs, default_path(PIECES), decoded=True)
    # JSON of whole numbers is written faster than an array of strings is made and joined.
    numbers = F.btrim(F.to_json("ids"), F.lit("[]"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # imports this module

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_personal_data": op2_personal_data,
        "op3_token_packing": op3_token_packing,
        "op4_order_minhash": op4_order_minhash,
        "op5_decontaminate": op5_decontaminate,
        "op6_line_dedup": op6_line_dedup,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_language_id": op9_language_id,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_phrases": op11_phrases,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_sentencepiece": op13_sentencepiece,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_decontaminate": """
            WITH d AS (
              SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
            i AS (
              SELECT item_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
            sizes AS (SELECT DISTINCT least(len(w), 10) AS n FROM i WHERE len(w) > 0),
            iw AS (
              SELECT DISTINCT item_id, n, list_slice(w, p, p + n - 1) AS g
              FROM (SELECT item_id, w, least(len(w), 10) AS n,
                           unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p
                    FROM i WHERE len(w) > 0)),
            dw AS (
              SELECT doc_id, n, p, list_slice(w, p, p + n - 1) AS g
              FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
                    FROM d CROSS JOIN sizes WHERE len(w) >= n)),
            m AS (SELECT doc_id, n, p, item_id FROM dw JOIN iw USING (n, g)),
            hit AS (
              SELECT doc_id, count(DISTINCT h) AS n_hit
              FROM (SELECT doc_id, unnest(range(p, p + n)) AS h FROM m) GROUP BY doc_id),
            found AS (
              SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
            SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit,
                   coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
                   n_hit IS NOT NULL AS contaminated
            FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)""",
        "op7_exact_dedup": """
            WITH t AS (
              SELECT doc_id, length(coalesce(text, '')) AS chars,
                     regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare
              FROM documents),
            g AS (
              SELECT bare, count(*) AS group_size, min(doc_id) FILTER (chars = most) AS keep_id
              FROM (SELECT *, max(chars) OVER (PARTITION BY bare) AS most FROM t) GROUP BY bare)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
                   sha256(bare) AS text_sha256
            FROM t JOIN g USING (bare)""",
        "op11_phrases": """
            WITH piece AS (
              SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t
              FROM documents),
            w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
            total AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
            f AS (
              SELECT lang, g, CAST(count(*) AS HUGEINT) AS f
              FROM (SELECT lang, list_slice(w, p, p + k - 1) AS g
                    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p
                          FROM w CROSS JOIN range(1, 6) AS size(k) WHERE len(w) >= k))
              GROUP BY lang, g),
            part AS (SELECT lang, g, f FROM f WHERE f >= 100),
            cut AS (
              SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM part WHERE len(g) > 1),
            scored AS (
              SELECT cut.lang, cut.g, cut.f AS a, x.f AS l, y.f AS r, n, k,
                     (1000 * cut.f * n) // (x.f * y.f) AS score
              FROM cut JOIN total USING (lang)
              JOIN part x ON x.lang = cut.lang AND x.g = list_slice(cut.g, 1, k)
              JOIN part y ON y.lang = cut.lang AND y.g = list_slice(cut.g, k + 1, len(cut.g))),
            least AS (
              SELECT * FROM scored
              QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
            inner_part AS (
              SELECT DISTINCT lang, list_slice(g, p, p + k - 1) AS g, f
              FROM (SELECT lang, g, f, k, unnest(range(1, len(g) - k + 2)) AS p
                    FROM part CROSS JOIN range(2, 5) AS size(k) WHERE len(g) > k)),
            kept AS (
              SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM least
              WHERE NOT EXISTS (SELECT 1 FROM inner_part i
                                WHERE i.lang = least.lang AND i.g = least.g AND i.f = least.a)),
            ranked AS (
              SELECT *, row_number() OVER (PARTITION BY lang
                                           ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
            SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a,
                   CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
                   CAST(score AS BIGINT) AS score
            FROM ranked WHERE rank <= 2000""",
    }
