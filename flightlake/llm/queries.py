"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flightlake.llm import centroids, feistel, fim, html_tree, langid, licenses, packing, quality_forest, toxicity, warc
from flightlake.llm.decontaminate import contaminated
from flightlake.llm.ring import ring_shards
from flightlake.llm.simhash_trie import simhash_components

# A key for the given tables only; a deployment passes its own secret.
DEMO_KEY = b"demo-key-not-a-secret"
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    """Place of the public vocabulary file on the executors (the operators take it as a parameter)."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = warc.archive_and_index(_table(spark, sf_dir, "pages"))
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at")


def q_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), sequence=1024)


def q_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_shards(_table(spark, sf_dir, "documents"), shards=24)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel.with_pseudonyms(_table(spark, sf_dir, "documents"), DEMO_KEY, keep=["doc_id"])


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    known = _table(spark, sf_dir, "labels").where(_remainder(5) != 0).select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, known))
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_forest.fit(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality_forest.judge(docs, model, keep=["doc_id"])


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_components(_table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_tree.extract(pages, html_tree.fit(pages), keep=["page_id", "url"])


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.fit(docs, training=_remainder(3) != 1, bounds=False)
    found = langid.identify(docs, profiles, keep=["doc_id"])
    return found.select("doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score", "cosine")


def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, seed=2)


def q_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"), seed=1, keep=["doc_id"])
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fim.restored(), 256).alias("restored_sha256"))


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc_merge": q_warc,
    "op2_shortest_pack": q_pack,
    "op3_ring_shards": q_ring,
    "op4_feistel_pii": q_pii,
    "op5_toxicity_ftrl": q_toxicity,
    "op6_quality_forest": q_quality,
    "op7_simhash_trie": q_simhash,
    "op8_html_tree": q_html,
    "op9_decontaminate": q_decontaminate,
    "op10_language_hd": q_language,
    "op11_centroid_dictionaries": q_centroids,
    "op12_fim_swar": q_fim,
    "op13_license_diagonals": q_licenses,
}

# Brute force: every shingle of every document against every item's shingles, compared as text.
DECONTAMINATE_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
dw AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM d),
ds AS (SELECT DISTINCT doc_id, text, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM dw),
iw AS (SELECT item_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w
       FROM (SELECT DISTINCT item_id, text FROM benchmark)),
its AS (SELECT DISTINCT item_id, text AS item_text, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM iw),
n AS (SELECT item_id, item_text, count(*) AS n_item FROM its GROUP BY ALL),
hit AS (SELECT doc_id, text, its.item_id, its.item_text, count(*) AS n_shared FROM ds JOIN its USING (s) GROUP BY ALL)
SELECT doc_id, hit.item_id AS item_id, n_item, n_shared, n_shared / n_item AS containment
FROM hit JOIN n ON hit.item_id = n.item_id AND hit.item_text = n.item_text
WHERE n_shared / n_item >= 0.8 - 1e-12
"""

# What the archives must hold, straight from the pages. (The key of a URL as web pages have it: a scheme, no port.)
WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, url, sha256(h) AS payload_digest, CAST(strlen(h) AS BIGINT) AS payload_bytes FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1),
u AS (SELECT *, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', '') AS host,
             regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(url, '^[^?#]*(\?[^#]+)', 1) AS query FROM d)
SELECT page_id, payload_bytes, u.payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to,
       CASE WHEN url = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
            || CASE WHEN path = '' THEN '/' ELSE path END || query END AS url_key,
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(((coalesce(page_id, 0) % 8640000000) + 8640000000) % 8640000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
FROM u LEFT JOIN f ON u.payload_digest = f.payload_digest
"""


def _centroids_sql(k: int = 40, rounds: int = 5, dims: int = 64, seed: int = 2) -> str:
    """Every vector against every centroid, component by component, one CTE a round."""
    ctes = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: isfinite(c))) = {dims})""",
            f"""x AS MATERIALIZED (SELECT r, unnest(range({dims})) AS d,
  unnest(list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT))) AS v FROM e)""",
            f"""first AS (SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')), r) - 1 AS c
  FROM e QUALIFY c < {k})""",
            "c0 AS MATERIALIZED (SELECT c, d, v FROM first JOIN x USING (r))"]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT r, min({{'dist': dist, 'c': c}}) AS best FROM (
  SELECT r, c, CAST(sum((x.v - m.v) * (x.v - m.v)) AS BIGINT) AS dist FROM x JOIN c{i} m USING (d) GROUP BY r, c) GROUP BY r)""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT m.c, m.d, coalesce(s.v, m.v) AS v FROM c{i} m LEFT JOIN (
  SELECT best.c AS c, d, CAST(floor(CAST(sum(v) AS DOUBLE) / count(*)) AS BIGINT) AS v FROM a{i} JOIN x USING (r) GROUP BY ALL) s
  ON m.c = s.c AND m.d = s.d)""")
    return "WITH " + ",\n".join(ctes) + f""",
h AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.dist AS distance,
       CAST(sum(best.dist) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.dist) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} JOIN e USING (r) JOIN h ON h.c = best.c"""


FIM_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
h AS (SELECT *, len(u) AS n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2,
             CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""


def _licenses_sql(templates=licenses.TEMPLATES) -> str:
    """Grams compared as text instead of hashes; diagonals, merging and verification as relations."""
    table = ", ".join(f"({i}, '{t.label}', {t.base}, {t.k}, {t.slack}, CAST({t.share} AS DOUBLE), '{' '.join(t.words)}', {t.key_range[0] or 0}, {t.key_range[1] or 0})"
                      for i, t in enumerate(templates))
    return rf"""
WITH t(template, label, base, k, slack, share, body, key_first, key_end) AS (VALUES {table}),
tg AS (SELECT template, k, unnest(list_transform(range(0, len(w) - k + 1), lambda i: {{'t': i, 'gram': array_to_string(w[i + 1:i + k], ' ')}})) AS g
       FROM (SELECT template, k, string_split(body, ' ') AS w FROM t)),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
dg AS (SELECT r, k, unnest(list_transform(range(0, greatest(len(w) - k + 1, 0)), lambda i: {{'pos': i, 'gram': array_to_string(w[i + 1:i + k], ' ')}})) AS g
       FROM d, (VALUES (2), (4)) AS ks(k)),
hit AS (SELECT r, template, dg.g.pos - tg.g.t AS diagonal, tg.g.t AS tp FROM dg JOIN tg ON dg.k = tg.k AND dg.g.gram = tg.g.gram),
diag AS (SELECT DISTINCT r, template, diagonal FROM hit),
gap AS (SELECT r, template, diagonal, diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) AS gap FROM diag),
grp AS (SELECT r, template, diagonal, sum(CASE WHEN gap IS NULL OR gap > slack THEN 1 ELSE 0 END)
               OVER (PARTITION BY r, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM gap JOIN t USING (template)),
cov AS (SELECT r, template, span, count(DISTINCT tp + j) AS covered FROM (
          SELECT r, template, span, tp, unnest(range(0, k)) AS j FROM hit JOIN grp USING (r, template, diagonal) JOIN t USING (template)) GROUP BY ALL),
ext AS (SELECT r, template, span, min(diagonal + tp) AS first_word, max(diagonal + tp) AS last, bool_or(key_end = 0 OR (tp <= key_first AND tp + k >= key_end)) AS key_hit
        FROM hit JOIN grp USING (r, template, diagonal) JOIN t USING (template) GROUP BY ALL),
s AS (SELECT r, label, base, share, first_word, covered / greatest(len(string_split(body, ' ')), last + k - first_word) AS similarity
      FROM ext JOIN cov USING (r, template, span) JOIN t USING (template) WHERE key_hit),
v AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(first_word) FILTER (WHERE base) AS first_word, max(first_word) FILTER (WHERE base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(similarity) AS score
      FROM s WHERE similarity >= share GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN v USING (r)
"""


SQL = {"op1_warc_merge": WARC_SQL, "op9_decontaminate": DECONTAMINATE_SQL, "op11_centroid_dictionaries": _centroids_sql(),
       "op12_fim_swar": FIM_SQL, "op13_license_diagonals": _licenses_sql()}
