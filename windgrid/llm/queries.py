"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windgrid.llm import bpe, chat, codes, dedup, mixing, packing, pages, quality, ranked, scoring, search, secrets, toxicity
from windgrid.llm.common import crc_residue, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    held_out = crc_residue("doc_id", 4) == 2
    model = toxicity.ToxicityModel.fit(documents, labels, held_out)
    return documents.select("doc_id", held_out.alias("held_out"), model.column(F.col("text"), 0.3).alias("t")).select("doc_id", "held_out", "t.*")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("_id") % 50 == 0, k=5, scale=256.0)


OP4_SQL = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.sql("SELECT -1L AS conv_id, turn, role, text FROM VALUES (0L, 'user', '{0}'), (1L, 'assistant', '{0}') AS t(turn, role, text)".format(control))
    done = chat.format_paths(chat.linear_messages(given.unionByName(added)))
    turns = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    done = done.withColumns({"turns": turns, "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))})
    return done.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP7_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), clean AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given
), counted AS (
  SELECT *, length(replace(role, '\', '\\')) + len(regexp_extract_all(role, '</?s>|<<SYS>>|<</SYS>>|<\|[a-z_]+\|>|\[/?INST\]'))
    + length(replace(text, '\', '\\')) + len(regexp_extract_all(text, '</?s>|<<SYS>>|<</SYS>>|<\|[a-z_]+\|>|\[/?INST\]')) + 13 AS chars
  FROM clean
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM counted GROUP BY conv_id
"""

def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.per_document(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    judged, _ = quality.judge(documents.select("doc_id", "text"), labels)
    return judged.select("doc_id", "_s.h.n_words", "_s.word_chars", "_s.n_symbols", "_s.l.n_dup_lines", "_s.h.n_repeat_words", "base_failed", "kept", "rule")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.link(table(spark, sf_dir, "documents"), size=3, percent=85)


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents").select("doc_id", "text"), crc_residue("doc_id", 10) == 0)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    n_tokens = (F.length("ids") / 4).cast("long").alias("n_tokens")
    return done.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = r"""
WITH occurrences AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
), lengths AS (
  SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM occurrences GROUP BY row
), whole AS (
  SELECT count(*) AS all_n, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths
), asked AS (
  SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark))
), counted AS (
  SELECT row, term, count(*) AS tf FROM occurrences WHERE term IN (SELECT term FROM asked) GROUP BY row, term
), weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(all_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, whole GROUP BY term
), impacts AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_n) // all_terms))) AS impact
  FROM counted JOIN weighed USING (term) JOIN lengths USING (row), whole
), scored AS (
  SELECT item, any_value(item_id) AS item_id, row, any_value(doc_id) AS doc_id, CAST(sum(impact) AS BIGINT) AS score
  FROM asked JOIN impacts USING (term) GROUP BY item, row
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    out = codes.with_label_error(coded).withColumn("codebooks_sha256", F.lit(codes.digest(books)))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_sql(rounds: int = 4) -> str:
    """Every round as two further named tables."""
    steps = """
WITH sound AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS (
  SELECT rid, position, list_slice(v, position * len(v) // 4 + 1, (position + 1) * len(v) // 4) AS part FROM sound, (SELECT unnest(range(4)) AS position)
), book0 AS (
  SELECT position, rid - 1 AS entry, part FROM parts WHERE rid <= 256
)"""
    for r in range(rounds + 1):
        steps += f""", near{r} AS (
  SELECT rid, position, arg_min(entry, d * 256 + entry) AS entry, min(d) AS distance FROM (
    SELECT p.rid, p.position, b.entry, CAST(list_sum(list_transform(list_zip(p.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts p JOIN book{r} b USING (position)
  ) GROUP BY rid, position
)"""
        if r < rounds:
            steps += f""", sums{r} AS (
  SELECT position, entry, k, CAST(floor(sum(x) / count(*)) AS BIGINT) AS x FROM (
    SELECT n.position, n.entry, unnest(p.part) AS x, unnest(range(len(p.part))) AS k FROM near{r} n JOIN parts p USING (rid, position)
  ) GROUP BY position, entry, k
), book{r + 1} AS (
  SELECT b.position, b.entry, coalesce(s.part, b.part) AS part
  FROM book{r} b LEFT JOIN (SELECT position, entry, list(x ORDER BY k) AS part FROM sums{r} GROUP BY position, entry) s USING (position, entry)
)"""
    return steps + f""", coded AS (
  SELECT rid, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY position) AS code, CAST(sum(distance) AS BIGINT) AS error FROM near{rounds} GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY position, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN sound USING (rid)
"""


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op2_bpe": op2_bpe, "op5_language_model": op5_language_model, "op8_pages": op8_pages, "op9_near_duplicates": op9_near_duplicates, "op3_quality": op3_quality, "op10_secrets": op10_secrets, "op7_chat": op7_chat, "op4_top_k": op4_top_k, "op6_toxicity": op6_toxicity, "op1_packing": op1_packing, "op11_ranked": op11_ranked, "op12_codes": op12_codes, "op13_mixing": op13_mixing}
ORACLES: dict[str, str] = {"op7_chat": OP7_SQL, "op4_top_k": OP4_SQL, "op11_ranked": OP11_SQL, "op12_codes": op12_sql()}
