"""A query for each operator over its whole table; columns follow the operators' contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendmart.llm import hmm, idfiles, importance, mixing, neardup, neighbours, packing, pages, pseudonyms, quality, repeats, secret_scan, vptree
from spendmart.llm.common import table
from spendmart.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
#: A key for tests and timing. Pass a secret one of your own in production.
SAMPLE_KEY = b"pseudonym-sample-key"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.with_pseudonyms(docs, SAMPLE_KEY, counts="found").select("doc_id", "text", "found.*")


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = secret_scan.identifiers(docs)
    return docs.select("doc_id", secret_scan.secrets_column(F.col("text"), known).alias("found")).select("doc_id", "found.*")


@query
def op3_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judged(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", *(f"judged.{c}" for c in quality.COUNTS), "judged.base_failed", "judged.kept"
    )


@query
def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op4_repeats"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM words WHERE len(w) >= 20
), named AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS name FROM windows
), ranked AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY name ORDER BY doc_id, i) AS r FROM named
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS k FROM ranked WHERE r > 1
), gone_lists AS (
  SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id
), kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(ks), 0) AS n_removed,
         CASE WHEN ks IS NULL THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(ks, k)), lambda k: w[k]) END AS left_words
  FROM words LEFT JOIN gone_lists USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(left_words, ' ')) AS kept_sha256
FROM kept
"""


@query
def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    # windows hold the square roots of the sources' shares, as long as the sources last
    return packing.pack(table(spark, sf_dir, "documents"), temper=0.5)


@query
def op7_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = idfiles.new_file_set(spark)
    idfiles.write_ids(table(spark, sf_dir, "documents"), path)
    read = idfiles.read_ids(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "source", "mix.epoch", "mix.block", "mix.n_tokens", "mix.target_tokens")


ORACLE["op8_mixing"] = r"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS n_tokens,
         md5(concat_ws(':', '17', doc_id::VARCHAR, coalesce(text, ''))) AS key
  FROM documents
), totals AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_rows FROM rows GROUP BY source
), ends AS (
  SELECT max(tokens)::DOUBLE AS most, min(tokens)::DOUBLE AS least FROM totals WHERE tokens > 0
), bisection AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1,
         CASE WHEN pow(most / least, 1 - (low + high) / 2) > 2.0 THEN (low + high) / 2 ELSE low END,
         CASE WHEN pow(most / least, 1 - (low + high) / 2) > 2.0 THEN high ELSE (low + high) / 2 END
  FROM bisection, ends WHERE step < 40
), chosen AS (
  SELECT round(high, 9) AS exponent FROM bisection WHERE step = 40
), plan AS (
  SELECT source, tokens, ceil(n_rows / 4096.0)::BIGINT AS blocks,
         CASE WHEN tokens > 0 THEN floor(tokens * pow(tokens / most, exponent - 1))::BIGINT ELSE 0 END AS target_tokens
  FROM totals, ends, chosen
), weights AS (
  SELECT *, CASE WHEN tokens > 0 THEN target_tokens // tokens ELSE 1 END AS epochs,
         target_tokens - CASE WHEN tokens > 0 THEN target_tokens // tokens ELSE 1 END * tokens AS rest
  FROM plan
), dealt AS (
  SELECT r.*, w.* EXCLUDE (source), ('0x' || substr(key, 1, 12))::BIGINT % blocks AS block
  FROM rows r JOIN weights w ON r.source IS NOT DISTINCT FROM w.source
), keyed AS (
  SELECT *, md5('block17:' || block) AS block_key FROM dealt
), summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY block_key, block RANGE UNBOUNDED PRECEDING) AS block_end,
         sum(n_tokens) OVER (PARTITION BY source ORDER BY block_key, block, key RANGE UNBOUNDED PRECEDING) AS row_end
  FROM keyed
), times AS (
  SELECT *, epochs + CASE WHEN rest > 0 AND (block_end <= rest OR row_end <= rest) THEN 1 ELSE 0 END AS n FROM summed
)
SELECT doc_id, source, unnest(range(0, n::BIGINT)) AS epoch, block, n_tokens, target_tokens FROM times WHERE n > 0
"""


@query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "pages").select("page_id", "url", pages.main_text_column(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op10_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ \t-\r]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id, d.doc_id = min(b) AS kept
FROM documents d JOIN reach ON a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
GROUP BY d.doc_id
"""


@query
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resampled(docs, table(spark, sf_dir, "benchmark").select("text"))


# CRC-32 by its table, which the SQL makes from the polynomial, over each distinct word's bytes.
ORACLE["op11_importance"] = r"""
WITH crc_table AS (
  SELECT list(list_reduce(list_concat([n], range(8)), lambda r, _: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)
              ORDER BY n) AS t
  FROM range(256) AS bytes(n)
), doc_words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), target_words AS (
  SELECT unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), doc_counts AS (
  SELECT rid, word, count(*) AS n FROM (SELECT rid, unnest(w) AS word FROM doc_words) GROUP BY ALL
), hexed AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_counts UNION SELECT word FROM target_words)
), buckets AS (
  SELECT word, xor(list_reduce(
    list_concat([4294967295], list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
    lambda r, b: xor(r // 256, t[xor(r % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table
), sources AS (
  SELECT bucket, sum(n) AS s FROM doc_counts JOIN buckets USING (word) GROUP BY bucket
), targets AS (
  SELECT bucket, count(*) AS t FROM target_words JOIN buckets USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM sources) AS s_all, (SELECT coalesce(sum(t), 0) FROM targets) AS t_all
), gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000))::DOUBLE / ((s + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
  FROM sources LEFT JOIN targets USING (bucket), totals
), weights AS (
  SELECT rid, sum(n * gain)::BIGINT AS weight FROM doc_counts JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY rid
), scored AS (
  SELECT d.rid, doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM doc_words d LEFT JOIN weights USING (rid)
), ranked AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (rid)
"""


@query
def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.clustered(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _clusters(of: str) -> str:
    """The nearest of the centroids in table ``of`` for each vector."""
    return f"""(SELECT * FROM (
    SELECT rid, c, d, row_number() OVER (PARTITION BY rid ORDER BY d, c) AS r
    FROM (SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS d FROM parts JOIN {of} USING (i) GROUP BY rid, c)) WHERE r = 1)"""


ORACLE["op13_centroids"] = (
    """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), parts AS MATERIALIZED (
  SELECT rid, unnest(range(64)) AS i, unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS x FROM kept
), seeds AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('2:' || vec_id), rid) - 1 AS c FROM kept
), c0 AS MATERIALIZED (
  SELECT c, i, x AS y FROM seeds JOIN parts USING (rid) WHERE c < 40
)"""
    + "".join(
        f""", sums{r} AS MATERIALIZED (
  SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM {_clusters(f"c{r}")} JOIN parts USING (rid) GROUP BY c, i
), c{r + 1} AS MATERIALIZED (
  SELECT c, i, CASE WHEN n IS NULL THEN y WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END AS y FROM c{r} LEFT JOIN sums{r} USING (c, i)
)"""
        for r in range(5)
    )
    + f""", final AS MATERIALIZED {_clusters("c5")}, names AS (
  SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY c
)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM final JOIN kept USING (rid) JOIN names USING (c)
"""
)
