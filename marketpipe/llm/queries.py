"""The queries of this subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, clustering, exact_dedup, html_text, importance, langid, line_dedup, media, minhash, packing, quality, toxicity, warc
from .shared import prepare, table


def tokenizer() -> str:
    """The file of the public byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.near_groups(table(spark, sf_dir, "documents"), percent=85)


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.apply(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    out = media.features(media.encode(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = quality.predict(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", langid.held_out().alias("held_out"), "score", "predicted")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return clustering.cluster(table(spark, sf_dir, "embeddings")).drop("compared")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    out = toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_html": op2_html,
    "op3_line_dedup": op3_line_dedup,
    "op4_media": op4_media,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_langid": op8_langid,
    "op9_bpe": op9_bpe,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_clustering": op11_clustering,
    "op12_importance": op12_importance,
    "op13_toxicity": op13_toxicity,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Cleaned documents of the table {docs}: (doc_id, parts, kept), lists of lines before and after.
LINE_SQL = r"""
lines AS (SELECT doc_id, source, i, line, regexp_replace(line, '^[ \t\r\f\v]+|[ \t\r\f\v]+$', '', 'g') AS bare
  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM {docs})),
spread AS (SELECT bare, min(doc_id) FILTER (WHERE source IS NOT NULL) AS first_id FROM lines WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT source) >= 10),
cleaned AS (SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE s.bare IS NOT NULL AND s.first_id <> l.doc_id) AS n_removed,
  coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE s.bare IS NULL OR s.first_id = l.doc_id), '') AS text
  FROM lines l LEFT JOIN spread s ON l.bare = s.bare GROUP BY l.doc_id)
"""


def cluster_sql(clusters: int = 8, rounds: int = 10, seed: str = "3") -> str:
    """Integer clustering with one table of centroids per round."""
    distance = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    nearest = "SELECT v.vec_id, v.row, v.v, min({{k: {d}, c: c.cluster}}) AS m FROM vectors v CROSS JOIN c{k} c GROUP BY ALL"
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)""",
        "vectors AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY sha256('%s:' || vec_id), v) AS row FROM kept)" % seed,
        f"c0 AS MATERIALIZED (SELECT row - 1 AS cluster, v FROM vectors WHERE row <= {clusters})",
    ]
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT vec_id, v, m.c AS cluster, m.k AS distance FROM ({nearest.format(d=distance, k=k)}))")
        if k < rounds:
            steps.append(f"s{k} AS (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY ALL)")
            mean = f"(SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{k} GROUP BY cluster)"
            steps.append(f"c{k + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN {mean} m USING (cluster))")
    return "WITH " + ",\n".join(steps) + f"""
SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia, sum(a.distance) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)"""


#: The reflected polynomial is the checksum's; its table is built by the rule.
IMPORTANCE_SQL = r"""
WITH crc AS (SELECT list(list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
texts AS (SELECT 'd' AS side, row_number() OVER () AS row, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
words AS (SELECT side, row, doc_id, regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (SELECT side, row, unnest(w || list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) AS f FROM words),
bytes AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
bucketed AS (SELECT f, xor(list_reduce([4294967295] || list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) %% 10000 AS bucket FROM bytes CROSS JOIN crc),
counts AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t FROM features JOIN bucketed USING (f) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000) / ((s + 1)::DOUBLE * ((sum(t) OVER ())::DOUBLE + 10000))))::BIGINT AS gain FROM counts),
sums AS (SELECT row, count(*) AS n, sum(gain)::BIGINT AS total FROM features JOIN bucketed USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
weighted AS (SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n, 0) AS n_features, CASE WHEN n > 0 THEN (total - ((total %% n) + n) %% n) // n ELSE 0 END AS weight,
  ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM words LEFT JOIN sums USING (row) WHERE side = 'd'),
scored AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weighted),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 AND doc_id IS NOT NULL ORDER BY score DESC, doc_id, n_features) AS nth,
  (count(*) FILTER (WHERE n_words >= 20 AND doc_id IS NOT NULL) OVER ()) * 25 // 100 AS want FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND doc_id IS NOT NULL AND nth <= want THEN nth END AS rank FROM ranked""" % _LOWER

ORACLE: dict[str, str] = {
    "op3_line_dedup": "WITH " + LINE_SQL.format(docs="documents") + """
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE c.n_lines END AS n_lines, c.n_removed, length(c.text) AS n_chars, sha256(c.text) AS text_sha256
FROM documents d JOIN cleaned c USING (doc_id)""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS response FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN n < 1000 OR page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM r""",
    "op11_clustering": cluster_sql(),
    "op12_importance": IMPORTANCE_SQL,
    "op10_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""",
}
