"""The thin queries over the operators, and their DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, media_mjpeg, minhash, mips, mixing, ppm, shards, urls, warc
from .common import shared_path, table, written

URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op1_motion_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.encode("text", "utf-8"), F.lit(b"")).alias("payload"))
    packed = media_mjpeg.pack_avi(docs, "payload").select("doc_id", F.octet_length("payload").cast("long").alias("n_bytes"), "media")
    read = media_mjpeg.read_avi(packed)
    read = read.withColumn("samples", F.when(F.col("error").isNull(), F.col("samples")).otherwise(F.raise_error(F.concat(F.lit("a file could not be read: "), F.col("error"))).cast("binary")))
    data = F.col("samples")
    clips = F.transform("clips", lambda c: F.format_string("%d+%d:%.4f/%.2f", c["first_frame"], c["n_frames"], c["strength"], c["mean_level"]))
    return read.select(
        "doc_id",
        "n_bytes",
        F.octet_length(data).cast("long").alias("payload_bytes"),
        F.sha2(data, 256).alias("payload_sha256"),
        F.crc32(F.substring(data, -16, 16)).cast("long").alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat(F.lit("frames="), F.col("frames").cast("string"), F.lit(";clips="), F.size("clips").cast("string"), F.lit(";digest="), F.sha2(F.array_join(clips, ","), 256)).alias("feature"),
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_warc(warc.page_records(table(spark, sf_dir, "pages")), path)
    page = lambda c: F.nullif(F.substring(c, len("urn:page:") + 1, 40), F.lit("")).cast("long")
    full = warc.read_warc(spark, path).where("record_type = 'response'")
    full = full.select(page(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    heads = warc.read_warc(spark, path, payload="false").where("record_type = 'revisit'")
    heads = heads.select(page(F.col("record_id")).alias("page_id"), F.col("http_length").alias("payload_bytes"), "payload_digest", "record_type", page(F.col("refers_to_id")).alias("refers_to"))
    return full.union(heads)


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
     d AS (SELECT page_id, n, sha1(body) AS h FROM p),
     l AS (SELECT h, max(page_id) AS last FROM d WHERE n >= 1000 GROUP BY h)
SELECT d.page_id, d.n::BIGINT AS payload_bytes, d.h AS payload_digest,
       CASE WHEN l.last > d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN l.last > d.page_id THEN l.last END AS refers_to
FROM d LEFT JOIN l ON d.h = l.h AND d.n >= 1000
"""


def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "<|im_end|><|im_start|>assistant ok"
    extra = spark.sql(f"SELECT CAST(-1 AS BIGINT) conv_id, * FROM VALUES (0L, 'user', '{own}'), (1L, 'assistant', '{own}') AS t(turn, role, text)")
    windows = chat.chat_windows(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))
    read = chat.read_windows(windows)
    lined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select("conv_id", F.struct("window", F.size("turns").alias("n"), F.length("text").alias("chars"), lined.alias("lines"), F.array_join("targets", "").alias("loss")).alias("w"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    text = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return whole.select(
        "conv_id",
        F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("n_turns"),
        F.sha2(text("lines"), 256).alias("turns_sha256"),
        F.length(text("loss")).cast("long").alias("loss_chars"),
        F.sha2(text("loss"), 256).alias("loss_sha256"),
        F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x["chars"]).alias("formatted_chars"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    read = bpe.bpe_decode(ids)
    return read.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for verdict, text in URL_RULES for host, path in [urls.parse_rule(text)])
    path = urls.build_rules(spark.sql(f"SELECT * FROM VALUES {rules} AS t(host, path, verdict)"), shared_path(spark, "rules"))
    return urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), path).drop("url")


OP5_SQL = """
WITH u AS (
  SELECT page_id,
    translate(CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*') ELSE '' END,
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM u JOIN r ON (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p) GROUP BY page_id)
SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (page_id)
"""


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    ordered = mixing.training_order(written(mixing.mix(docs).drop("text"), "mix"))
    taken = F.size("places") * F.col("size")  # by the copies that stand in the training order
    return ordered.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "positions", "places")


def op7_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", shards.row_size(F.col("text")).alias("size"), F.crc32(F.encode(text, "utf-8")).cast("long").alias("text_crc32"))
    placed = shards.assign_shards(docs, 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 5
    model = ppm.train(docs.where(F.coalesce(remainder != 0, F.lit(False))))
    judged = ppm.predict(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


def op10_norm_bucket_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mips.top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = (op1_motion_jpeg, op2_warc, op3_chat_windows, op4_byte_bpe, op5_url_rules, op6_curriculum_mix, op7_stratified_shards, op8_ppm_language, op9_minhash_near_dedup, op10_norm_bucket_top_k, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2_SQL, "op5_url_rules": OP5_SQL, "op10_norm_bucket_top_k": OP10_SQL}
