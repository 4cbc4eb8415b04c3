"""The registered queries of this subpackage: name -> (query, DuckDB SQL or None).

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

import public_tokenizers as tokenizers_on_disk
from pyspark.sql import DataFrame, SparkSession

from emberwake.llm.byte_bpe import bpe_round_trip
from emberwake.llm.centroids import vector_clusters
from emberwake.llm.common import crc_mod, reachable, table
from emberwake.llm.decontaminate import contamination
from emberwake.llm.exact_dedup import exact_duplicates
from emberwake.llm.license_scan import license_scan
from emberwake.llm.minhash import near_duplicates
from emberwake.llm.ngram_lm import language_model_scores
from emberwake.llm.partenum import similar_documents
from emberwake.llm.sharding import balanced_shards
from emberwake.llm.token_files import read_token_files, write_token_files
from emberwake.llm.toxicity import toxicity_scores
from emberwake.llm.vector_codes import compressed_vectors
from emberwake.llm.warc import build_derivatives, read_derivatives, write_responses

END_ID = 2


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: ``documents`` in 8 shards of near equal bytes."""
    return balanced_shards(table(spark, sf_dir, "documents"), 8)


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over ``documents``."""
    reachable(spark)
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("row")


SQL_EXACT_DEDUP = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: ``documents`` against ``benchmark``."""
    reachable(spark)
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL_DECONTAMINATION = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM lowered),
item_windows AS (
  SELECT DISTINCT id AS item_id, least(10, len(words)) AS n,
         array_to_string(words[s:s + least(10, len(words)) - 1], ' ') AS win
  FROM (SELECT id, words, unnest(range(1, greatest(2, len(words) - 8))) AS s FROM w
        WHERE kind = 'b' AND len(words) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT id AS doc_id, n, s, array_to_string(words[s:s + n - 1], ' ') AS win
  FROM (SELECT id, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM w, lengths
        WHERE kind = 'd' AND len(words) >= n)),
hits AS (SELECT doc_id, item_id, s, n FROM doc_windows JOIN item_windows USING (n, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.id AS doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN covered ON covered.doc_id = w.id LEFT JOIN listed ON listed.doc_id = w.id
WHERE kind = 'd'
"""


def q_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: the license templates in ``documents``."""
    reachable(spark)
    return license_scan(table(spark, sf_dir, "documents"))


def q_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over ``documents``: 3-word shingles, similarity 0.9."""
    reachable(spark)
    return similar_documents(table(spark, sf_dir, "documents"), 3, 90)


SIMILAR_CTES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[p:p + 2], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 1))) AS p FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
                    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2) c
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= {percent} * (na.n + nb.n - common)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents
          UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.other)
"""
SQL_NGRAM_JACCARD = SIMILAR_CTES.replace("{percent}", "90") + """
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) r ON r.id = d.doc_id
"""


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: ``documents`` scored by a lexicon learned from ``labels``."""
    reachable(spark)
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over ``documents``: digests of the ids and of the decoded bytes."""
    reachable(spark)
    return bpe_round_trip(table(spark, sf_dir, "documents"),
                          tokenizers_on_disk.path("byte_bpe_multi_50k.tiktoken"), tokenizers_on_disk.PATTERN,
                          ("n_tokens", "ids_sha256", "decoded_sha256"))


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: ``pages`` as response files, their derivatives, read back."""
    reachable(spark)
    pages = table(spark, sf_dir, "pages")
    folder, files = write_responses(pages)
    return read_derivatives(*build_derivatives(folder, files), pages.schema["page_id"].dataType.simpleString())


def q_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over ``documents``: learned from six sevenths of them."""
    reachable(spark)
    return language_model_scores(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) == 2)


def q_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over ``documents``: written, then read back from the files."""
    reachable(spark)
    folder, directory = write_token_files(table(spark, sf_dir, "documents"),
                                          tokenizers_on_disk.path("byte_bpe_50k.json"), END_ID)
    return read_token_files(folder, directory)


def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over ``embeddings``: 8 centroids, 10 rounds."""
    reachable(spark)
    return vector_clusters(table(spark, sf_dir, "embeddings"), 8, 10, 64)


def q_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over ``embeddings``: 4 parts, 256 entries, 4 rounds."""
    reachable(spark)
    return compressed_vectors(table(spark, sf_dir, "embeddings"), 64)


def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over ``documents``: 3-word shingles, similarity 0.85."""
    reachable(spark)
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85)


SQL_MINHASH = SIMILAR_CTES.replace("{percent}", "85") + """
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT id, min(other) AS component_id FROM reach GROUP BY id) r ON r.id = d.doc_id
"""


#: DuckDB: whole finite vectors as integers.
KEPT_VECTORS = """
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)"""


def mean_floor(sums: str, count: str) -> str:
    """DuckDB: exact floor of a quotient; its integer division truncates."""
    return f"CAST(({sums} - (({sums} % {count}) + {count}) % {count}) // {count} AS BIGINT)"


def sql_centroids(centroids: int = 8, rounds: int = 10, seed: int = 3) -> str:
    """Operator 11 as one query, a table per round."""
    steps = [f"""WITH {KEPT_VECTORS},
x AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS p FROM kept),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, p, x AS y FROM s JOIN x USING (vec_id) WHERE c < {centroids})"""]
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS (SELECT vec_id, c, sum((x - y) * (x - y)) AS d FROM x JOIN c{k} USING (p) GROUP BY vec_id, c),
a{k} AS MATERIALIZED (SELECT vec_id, min(d) AS d, arg_min(c, (d, c)) AS c FROM d{k} GROUP BY vec_id)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT c, p, sum(x) AS s, count(*) AS n FROM a{k} JOIN x USING (vec_id) GROUP BY c, p),
c{k + 1} AS MATERIALIZED (SELECT c, p, coalesce({mean_floor("m.s", "m.n")}, y) AS y FROM c{k} LEFT JOIN m{k} m USING (c, p))""")
    return ",\n".join(steps) + f""",
sha AS (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} JOIN sha USING (c)"""


def sql_vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Operator 12 as one query, a table per round."""
    size = 64 // parts
    steps = [f"""WITH {KEPT_VECTORS},
x AS MATERIALIZED (SELECT vec_id, g // {size} AS k, g % {size} AS p, x
                   FROM (SELECT vec_id, unnest(v) AS x, unnest(range(64)) AS g FROM kept)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept),
b0 AS MATERIALIZED (SELECT k, e, p, x AS y FROM s JOIN x USING (vec_id) WHERE e < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (SELECT vec_id, k, e, sum((x - y) * (x - y)) AS d FROM x JOIN b{r} USING (k, p) GROUP BY vec_id, k, e),
a{r} AS MATERIALIZED (SELECT vec_id, k, min(d) AS d, arg_min(e, (d, e)) AS e FROM d{r} GROUP BY vec_id, k)""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT k, e, p, sum(x) AS s, count(*) AS n FROM a{r} JOIN x USING (vec_id, k) GROUP BY k, e, p),
b{r + 1} AS MATERIALIZED (SELECT k, e, p, coalesce({mean_floor("m.s", "m.n")}, y) AS y FROM b{r} LEFT JOIN m{r} m USING (k, e, p))""")
    return ",\n".join(steps) + f""",
coded AS (SELECT vec_id, string_agg(lower(lpad(to_hex(e), 2, '0')), '' ORDER BY k) AS code, sum(d) AS error
          FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY k, e, p)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


QUERIES = {
    "op1_sharding": (q_sharding, None),
    "op2_exact_dedup": (q_exact_dedup, SQL_EXACT_DEDUP),
    "op3_decontamination": (q_decontamination, SQL_DECONTAMINATION),
    "op4_license_scan": (q_license_scan, None),
    "op5_ngram_jaccard": (q_ngram_jaccard, SQL_NGRAM_JACCARD),
    "op6_toxicity": (q_toxicity, None),
    "op7_byte_bpe": (q_byte_bpe, None),
    "op8_warc": (q_warc, None),
    "op9_lm_score": (q_lm_score, None),
    "op10_token_files": (q_token_files, None),
    "op11_centroids": (q_centroids, sql_centroids()),
    "op12_vector_codes": (q_vector_codes, sql_vector_codes()),
    "op13_minhash": (q_minhash, SQL_MINHASH),
}
