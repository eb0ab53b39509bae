"""The registered queries of this subpackage, one thin query per operator, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm import best_fit_packing, dart_minhash, decontamination, graph_ann, language_id, merkle_manifest, pca_clustering, secret_scan, sentencepiece_codec, substring_dedup, suffix_dedup, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_decode(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, ~language_id.held_out())
    plain = docs.select("doc_id", "text").withColumn("held_out", language_id.held_out())
    return language_id.identify(plain, model).select("doc_id", "held_out", "lang_pred", "score", "spans")


def op4_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir)).drop("text")


def dated_entries(pages: DataFrame) -> DataFrame:
    """List entries that the crawl itself yields: pages on suspicious hosts report their domain, others a section."""
    host, segment = url_filter.host_of(F.col("url")), url_filter.segment_of(F.col("url"))
    domain = F.regexp_replace(host, r"^(www|blog|m)\.", "")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 53, F.lit(366)).cast("int"))
    action = F.when(F.col("page_id") % 3 == 0, "remove").otherwise("add")
    entry = lambda name, rule: (F.lit(name).alias("list"), rule.alias("rule"), action.alias("action"), day.alias("listed_on"), F.col("page_id").alias("seq"))
    suspicious = pages.where(host.rlike("spam|casino|pills|adult|bets")).select(*entry("block", domain))
    sections = pages.where(F.col("url").contains("utm_source") & (F.col("page_id") % 7 == 0)).select(*entry("block", F.concat(domain, F.lit("/"), segment)))
    trusted = pages.where(F.col("url").contains("#top") & (F.col("page_id") % 11 == 0)).select(*entry("allow", F.concat(host, F.lit("/"), segment)))
    return suspicious.unionByName(sections).unionByName(trusted)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    return url_filter.evaluate(pages.select("page_id", "url", day.alias("fetched_on")), dated_entries(pages)).drop("url")


OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
         nullif(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)), '\.+$', ''), '') AS host,
         regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]+)', 1) AS segment,
         DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS fetched_on,
         DATE '2024-01-01' + CAST(page_id * 53 % 366 AS INTEGER) AS listed_on,
         CASE WHEN page_id % 3 = 0 THEN 'remove' ELSE 'add' END AS action
  FROM pages),
named AS (SELECT *, regexp_replace(host, '^(www|blog|m)\.', '') AS domain FROM parts),
entries AS (
  SELECT 'block' AS list, domain AS rule, action, listed_on, page_id FROM named WHERE regexp_matches(host, 'spam|casino|pills|adult|bets')
  UNION ALL SELECT 'block', domain || '/' || segment, action, listed_on, page_id FROM named WHERE contains(url, 'utm_source') AND page_id % 7 = 0
  UNION ALL SELECT 'allow', host || '/' || segment, action, listed_on, page_id FROM named WHERE contains(url, '#top') AND page_id % 11 = 0),
daily AS (SELECT list, lower(rule) AS rule, listed_on, arg_max(action, page_id) AS action FROM entries GROUP BY 1, 2, 3),
dated AS (SELECT *, lead(listed_on) OVER (PARTITION BY list, rule ORDER BY listed_on) AS until FROM daily),
asked AS (
  SELECT page_id, fetched_on, unnest([array_to_string(list_slice(string_split(host, '.'), i, 99), '.') FOR i IN range(1, greatest(2, len(string_split(host, '.'))))]) AS suffix, segment
  FROM named),
rules AS (SELECT page_id, fetched_on, suffix AS rule FROM asked UNION ALL SELECT page_id, fetched_on, suffix || '/' || segment FROM asked WHERE segment <> ''),
ranked AS (
  SELECT r.page_id, d.list, d.rule, d.listed_on,
         row_number() OVER (PARTITION BY r.page_id ORDER BY d.list = 'allow' DESC, length(d.rule) DESC, d.rule DESC, d.listed_on DESC) AS k
  FROM rules r JOIN dated d ON r.rule = d.rule AND d.action = 'add' AND r.fetched_on >= d.listed_on AND (d.until IS NULL OR r.fetched_on < d.until))
SELECT n.page_id, n.fetched_on, n.host,
       CASE WHEN k.rule IS NULL THEN 'unlisted' WHEN k.list = 'allow' THEN 'allowed' ELSE 'blocked' END AS verdict,
       k.rule, k.listed_on AS listed_since
FROM named n LEFT JOIN ranked k ON n.page_id = k.page_id AND k.k = 1
"""


def op9_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicates(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model).select("doc_id", "held_out", "score", "predicted")


def op11_pca_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pca_clustering.cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), dim=64, k=16, rounds=3, salt="1:")
    return pca_clustering.members_with_inertia(found).select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaves = merkle_manifest.document_leaves(table(spark, sf_dir, "documents"), tampered)
    return merkle_manifest.manifest(leaves, "source", "doc_id").proofs().drop("path")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


OP11_SQL = """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v AS m FROM kept QUALIFY c < 16),
""" + "".join(f"""
a{i} AS (
  SELECT r, vec_id, v, min(d) AS d, arg_min(c, (d, c)) AS c
  FROM (SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept, c{i}) GROUP BY ALL),
""" + (f"""
s{i} AS (SELECT c, place, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i}) GROUP BY 1, 2),
c{i + 1} AS (
  SELECT o.c, coalesce(n.m, o.m) AS m
  FROM c{i} o LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) / n AS BIGINT) ORDER BY place) AS m FROM s{i} GROUP BY 1) n ON n.c = o.c),
""" if i < 3 else "") for i in range(4)) + """
own AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a3 GROUP BY 1)
SELECT vec_id, CAST(a3.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia, (SELECT CAST(sum(d) AS BIGINT) FROM a3) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a3 JOIN own ON own.c = a3.c JOIN c3 ON c3.c = a3.c
"""

_CRC32 = """list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({x}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda h, b: CASE WHEN b >= 0 THEN xor(h, b) WHEN h % 2 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END)"""
_FIELD = "coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
_LEAF = " || ".join(_FIELD.format(x=x) for x in ("doc_id", "source", "lang", "n_chars"))
OP12_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS r, doc_id, source, sha256({_LEAF} || {_FIELD.format(x="text")}) AS leaf, sha256({_LEAF} || {_FIELD.format(x="replace(text, chr(10), '')")}) AS bare,
    coalesce(xor({_CRC32.format(x="CAST(doc_id AS VARCHAR)")}, 4294967295) % 2 = 0, false) AS tampered FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
low AS (
  SELECT 0 AS level, source, idx, leaf AS h FROM placed
  UNION ALL SELECT level + 1, source, idx // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER (PARTITION BY source) AS n FROM low) WHERE n > 1 GROUP BY ALL),
ends AS (SELECT source, max(level) AS depth, arg_max(h, level) AS subroot FROM low GROUP BY 1),
sources AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM ends),
high AS (
  SELECT 0 AS level, place AS idx, subroot AS h FROM sources
  UNION ALL SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)) FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY ALL),
nodes AS (
  SELECT source, level, idx, h FROM low UNION ALL SELECT NULL, level + 1000, idx, h FROM high),
steps AS (
  SELECT p.r, level FROM placed p JOIN ends e ON e.source IS NOT DISTINCT FROM p.source, range(0, 64) t(level) WHERE level < e.depth
  UNION ALL SELECT p.r, level + 1000 FROM placed p, range(0, 64) t(level) WHERE level < (SELECT max(level) FROM high)),
sides AS (
  SELECT s.r, s.level, coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx < q.at), '') AS lft, coalesce(string_agg(n.h, '' ORDER BY n.idx) FILTER (n.idx > q.at), '') AS rgt
  FROM steps s JOIN placed p ON p.r = s.r JOIN sources o ON o.source IS NOT DISTINCT FROM p.source,
    LATERAL (SELECT CASE WHEN s.level < 1000 THEN p.idx // CAST(pow(3, s.level) AS BIGINT) ELSE o.place // CAST(pow(3, s.level - 1000) AS BIGINT) END AS at) q
    LEFT JOIN nodes n ON n.level = s.level AND (s.level >= 1000 OR n.source IS NOT DISTINCT FROM p.source) AND n.idx // 3 = q.at // 3
  GROUP BY s.r, s.level),
paths AS (SELECT r, list({{'lft': lft, 'rgt': rgt}} ORDER BY level) AS path FROM sides GROUP BY 1),
folds AS (
  SELECT p.r, 1 AS k, CASE WHEN tampered THEN bare ELSE leaf END AS h FROM placed p
  UNION ALL SELECT f.r, f.k + 1, sha256(q.path[f.k].lft || f.h || q.path[f.k].rgt) FROM folds f JOIN paths q ON q.r = f.r WHERE f.k <= len(q.path)),
tops AS (SELECT r, arg_max(h, k) AS folded_root FROM folds GROUP BY 1),
root AS (SELECT arg_max(h, level) AS root FROM high)
SELECT p.doc_id, p.leaf, e.subroot, root.root, sha256(coalesce(array_to_string(list_transform(q.path, lambda x: x.lft || x.rgt), ''), '')) AS proof_sha256, t.folded_root, t.folded_root = root.root AS verified
FROM placed p JOIN ends e ON e.source IS NOT DISTINCT FROM p.source JOIN tops t ON t.r = p.r LEFT JOIN paths q ON q.r = p.r, root
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_sentencepiece, op3_language_id, op4_graph_ann, op5_suffix_array, op6_decontamination, op7_secret_scan, op8_url_filter, op9_dart_minhash, op10_toxicity, op11_pca_clustering, op12_merkle_manifest, op13_best_fit_packing)}


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filter": OP8_SQL, "op11_pca_clustering": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
