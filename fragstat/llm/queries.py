"""The registered queries of this subpackage, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragstat.config import checkpoint_root
from fragstat.llm.bpe import encode
from fragstat.llm.decontamination import find_overlaps
from fragstat.llm.exact_dedup import exact_groups
from fragstat.llm.line_dedup import dedup_lines
from fragstat.llm.lm_scoring import lm_scores
from fragstat.llm.ngram_join import near_duplicates
from fragstat.llm.periodic_runs import periodic_runs
from fragstat.llm.sharding import record_size, shard_documents
from fragstat.llm.shipping import ship
from fragstat.llm.substring_dedup import remove_repeated_passages
from fragstat.llm.suffix_dedup import repeated_spans
from fragstat.llm.toxicity import fit, with_scores
from fragstat.llm.url_filters import judge_urls, rules_frame
from fragstat.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    checkpoint_root(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_documents(_table(spark, sf_dir, "documents"), shards=24, seed=42)
    return shards.select(
        "doc_id", record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # the package of vocabulary files; the operator itself takes any path

    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode(docs, path, decoded_col="decoded")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5
    model = fit(docs, _table(spark, sf_dir, "labels"), remainder != 0)
    return with_scores(docs, model).select(
        "doc_id", (remainder == 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents")).drop("n_points")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
g AS (
  SELECT content, count(*) AS group_size, arg_min(doc_id, (-points, doc_id)) AS keep_id
  FROM d GROUP BY content)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.content) AS text_sha256
FROM d JOIN g USING (content)
"""

#: The rules that op6 judges by (fixed values): verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), rules_frame(spark, URL_RULES)).drop("url")


OP6_SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages),
r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS n
  FROM p LEFT JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)),
l AS (SELECT a AS u, b AS v FROM e UNION SELECT b, a FROM e),
c AS (SELECT doc_id AS u, doc_id AS r FROM documents UNION SELECT l.v, c.r FROM c JOIN l ON l.u = c.u)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c.r) AS component_id
FROM d JOIN c ON c.u = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return lm_scores(docs, remainder != 2).select(
        "doc_id", (remainder == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))

# DuckDB has no CRC-32; this is its bit-by-bit definition over the digits of the id.
_CRC = """xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

OP8_SQL = rf"""
WITH d AS (
  SELECT doc_id, {_CRC} % 7 = 2 AS held_out, list_append(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+'), ' end') AS words
  FROM documents),
t AS (SELECT doc_id, held_out, unnest(words) AS w, unnest(list_prepend(' end', words[:-2])) AS v FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
p AS (SELECT v, w, count(*) AS n FROM t WHERE NOT held_out GROUP BY v, w),
s AS (SELECT coalesce(sum(c), 0)::DOUBLE AS total, count(*)::DOUBLE AS kinds FROM c),
x AS (
  SELECT t.doc_id, t.held_out, coalesce(c.c, 0) AS c, coalesce(h.c, 0) AS h, coalesce(p.n, 0) AS n, s.total, s.kinds,
    CASE WHEN s.total = 0 THEN 1 ELSE
      (greatest(coalesce(c.c, 0) - 0.75::DOUBLE, 0) + 0.75::DOUBLE * s.kinds / (s.kinds + 1)) / s.total END AS root
  FROM t CROSS JOIN s LEFT JOIN c ON t.w = c.w LEFT JOIN c AS h ON t.v = h.w LEFT JOIN p ON t.v = p.v AND t.w = p.w)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (WHERE c > 0) AS n_known,
  any_value(total)::BIGINT AS train_tokens,
  round(fsum(log10((c + 1) / (total + 1 * (kinds + 1)))), 6) AS base_score,
  round(fsum(CASE WHEN n > 0 THEN log10((n + 300.0::DOUBLE * root) / (h + 300.0::DOUBLE))
    ELSE log10(300.0::DOUBLE / (h + 300.0::DOUBLE)) + log10(root) END), 6) AS score
FROM x GROUP BY doc_id, held_out
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_overlaps(docs, _table(spark, sf_dir, "benchmark")).select(
        "doc_id", (F.size("overlaps") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("overlaps.item")).alias("item_ids"),
        F.size("overlaps").cast("long").alias("n_overlaps"),
        F.coalesce(F.array_max(F.transform("overlaps", lambda x: x["end"] - x["start"])), F.lit(0)).cast("long")
        .alias("longest_words"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return remove_repeated_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 48),
    lambda i: {'i': i, 'k': sha256(array_to_string(w[i:i + 49], ' '))}), recursive := true)
  FROM d WHERE len(w) >= 50),
m AS (SELECT k, min(doc_id) AS least FROM k GROUP BY k),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM k JOIN m USING (k) WHERE least < doc_id),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
r AS (
  SELECT p.doc_id, count(c.i) AS n_removed, string_agg(x, ' ' ORDER BY p.i) FILTER (c.i IS NULL) AS kept
  FROM p LEFT JOIN c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=4)


#: A word, as the operators cut them.
WORD = r"[^\x20\x09-\x0D]+"


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The texts that op13 is asked about: where h, the CRC-32 of the id's digits, ends
    in 0, each word from ``a`` on gives way to word ``a + (i - a) % p``; other rows stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    a = F.when(n > 0, g % F.greatest(n, F.lit(1))).otherwise(0)
    times = 3 + g % 8
    p = 1 + F.call_function("div", n - a, times)
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    longer = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.flatten(F.array_repeat(block, times.cast("int"))))
    tail = F.array_join(F.slice(longer, F.lit(1), n.cast("int")), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), tail).otherwise(F.col("text")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periodic_tails(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
                                                   F.lit("\n")))
    return periodic_runs(docs).withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"),
        (-F.col("longest.less")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("(1000 * -longest.less) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o, {_CRC} AS h FROM documents),
e AS (SELECT *, len(o) AS n, h // 10 AS g, CASE WHEN len(o) > 0 THEN h // 10 % len(o) ELSE 0 END AS a FROM d),
t AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE o END AS w
  FROM e),
k AS (
  SELECT doc_id, n, unnest(list_transform(range(n - 4),
    lambda i: {{'i': i, 'k': array_to_string(w[i + 1:i + 5], ' ')}}), recursive := true)
  FROM t WHERE n >= 5),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q
  FROM k AS a JOIN k AS b ON a.doc_id = b.doc_id AND a.k = b.k AND a.i < b.i AND 4 * (b.i - a.i) <= a.n),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS place FROM pairs)
  GROUP BY doc_id, q, place HAVING count(*) + 4 + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches AS x WHERE NOT EXISTS (
    FROM stretches AS y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
r AS (
  SELECT doc_id, count(*) AS n_runs, max({{'l': len, 's': -s, 'q': -q}}) AS best,
    string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed
  FROM runs GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(n)) AS i FROM t),
v AS (
  SELECT p.doc_id, string_agg(x, ' ' ORDER BY p.i) AS kept
  FROM p ANTI JOIN c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, best.l AS length, -best.q AS period,
  1000 * best.l // -best.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(kept, '')) AS collapsed_sha256
FROM t LEFT JOIN r USING (doc_id) LEFT JOIN v USING (doc_id)
"""

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filters": op6_url_filters,
    "op7_ngram_join": op7_ngram_join,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op5_exact_dedup": OP5_SQL,
    "op6_url_filters": OP6_SQL,
    "op7_ngram_join": OP7_SQL,
    "op8_lm_scoring": OP8_SQL,
    "op11_substring_dedup": OP11_SQL,
    "op13_periodic_runs": OP13_SQL,
}
