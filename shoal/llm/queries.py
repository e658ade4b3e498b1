"""One registered query per operator, over whole tables, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_files

    return token_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack, pieces

    return pack(pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1, cap=4096), 4096)


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import shares

    return shares(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op4_mix_sources"] = r"""
WITH base AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST(CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
              + 1.0::DOUBLE) / 4503599627370497.0::DOUBLE)
         / (CASE WHEN length(text) > 0
                 THEN 0.1::DOUBLE + 0.9::DOUBLE * length(regexp_replace(text, '[^\p{L}\x20\x09-\x0D]+', '', 'g'))
                      / length(text)
                 ELSE 1.0::DOUBLE END) AS key
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY source),
weighed AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
         sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM per),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS pos,
         (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
firsts AS (SELECT pos AS first_pos, level AS first_level FROM ranked WHERE level * w <= cap ORDER BY pos LIMIT 1),
goal AS (
  SELECT source, source_size, CASE WHEN pos >= first_pos THEN least(cap, first_level * w) ELSE cap END AS target
  FROM ranked LEFT JOIN firsts ON true),
summed AS (
  SELECT b.*, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS epochs,
         coalesce(sum(size) OVER (PARTITION BY b.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM base b JOIN goal g ON b.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(round(target - epochs * source_size) AS BIGINT) - before)) AS BIGINT) AS taken
FROM summed
"""


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archived

    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import crc_mod, identify

    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    found = identify(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


ORACLES["op10_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31) + 1 AS BIGINT), 1)), '')
           AS payload_digest,
         min(page_id) OVER (PARTITION BY html) AS first_id
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import crc_mod
    from .quality import THRESHOLD, scored

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    found = scored(docs, labels.select("doc_id", F.col("quality").cast("int").alias("label")), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


@query
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import scaled, top_k

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled(F.col("embedding")).alias("numbers"))
    return top_k(vectors, F.col("vec_id") % 100 == 0, 10)


ORACLES["op1_top_k"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents"), 13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op5_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS words FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(words) - 11)) AS s, words FROM d WHERE len(words) >= 13),
k AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 12], ' ')) AS h FROM w),
m AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY h) AS first_id FROM k),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM m WHERE first_id < doc_id),
lost AS (SELECT doc_id, count(*) AS n, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN n IS NULL THEN words
              ELSE [words[x] FOR x IN range(1, len(words) + 1) IF NOT list_contains(gone, x)] END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id)
"""


@query
def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .syncmers import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import similar_groups

    return similar_groups(table(spark, sf_dir, "documents"), per_cent=85, k=4)


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .infill import infill, restored

    made = infill(table(spark, sf_dir, "documents"), seed=1)
    back = restored(made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output"))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


ORACLES["op11_fill_in_middle"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
h AS (
  SELECT *, CAST(CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS BIGINT) AS a,
         CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS BIGINT) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
s AS (
  SELECT *, substr(text, 1, least(a, b)) AS p, substr(text, least(a, b) + 1, abs(a - b)) AS m,
         substr(text, greatest(a, b) + 1) AS s FROM h)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s
"""


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .transducers import token_counts

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=1024)


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .part_codes import codebooks_sha256, compress, with_label_error
    from .topk import scaled

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", scaled(F.col("embedding"), 4096.0).alias("numbers"))
    coded, books = compress(vectors)
    return (with_label_error(coded).withColumn("codebooks_sha256", F.lit(codebooks_sha256(books)))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def _rounds(n: int) -> str:
    """SQL of the rounds: distances, nearest entries and the entries they move to; the last assignment comes behind them."""
    steps = []
    for r in range(n + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
  FROM (SELECT vec_id, part, entry, CAST(list_sum([(x[i] - y[i]) * (x[i] - y[i]) FOR i IN range(1, len(x) + 1)]) AS BIGINT) AS d
        FROM p JOIN c{r} USING (part)) GROUP BY vec_id, part)""")
        if r < n:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(z, y) AS y FROM c{r} LEFT JOIN (
    SELECT part, entry, list(CAST(floor(CAST(s AS DOUBLE) / n) AS BIGINT) ORDER BY i) AS z FROM (
      SELECT part, entry, i, sum(v) AS s, count(*) AS n FROM (
        SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM a{r} JOIN p USING (vec_id, part)) GROUP BY part, entry, i)
    GROUP BY part, entry) USING (part, entry))""")
    return ",".join(steps)


ORACLES["op12_vector_codes"] = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, [CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, e[1 + part * len(e) // 8 : (part + 1) * len(e) // 8] AS x FROM k, range(8) AS r(part)),
c0 AS MATERIALIZED (
  SELECT part, entry, x AS y FROM p JOIN (
    SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS entry FROM k ORDER BY vec_id LIMIT 16) USING (vec_id)),
{_rounds(6)},
b AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c6),
v AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN k USING (vec_id), b
"""
