"""The queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lines
from .codes import vector_codes
from .common import crc_of_id, table
from .jaccard import jaccard_classes
from .langid import identify, learn
from .lines import line_dedup
from .media import media_columns
from .mixing import mix_sizes
from .negatives import hard_negatives
from .neardup import near_duplicates
from .packing import pack
from .quality import grade, ratings
from .quality import learn as learn_grades
from .secret_scan import KINDS, find_secrets, span_list
from .suffix_tree import score
from .wrappers import extract_main


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sizes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of_id() % 5 == 0
    profiles = learn(docs.where(~held_out))
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles).drop("text")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), words=4, percent=85).select("doc_id", "n_shingles", "component_id", "class_id")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents"), crc_of_id() % 7 != 2)
    return out.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn_grades(docs, ratings(table(spark, sf_dir, "labels")), 3)
    return grade(docs, model).drop("text")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main(table(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary())


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = vector_codes(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("found", lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_list(of("assign", "access", "hex")), 256).alias("base_sha256"), span_list(F.col("found")).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP1_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL),
n AS (
  SELECT *, row_number() OVER w - 1 AS p, count(*) OVER (PARTITION BY doc_id) AS n
  FROM l WHERE trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    ')) <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
r AS (
  SELECT doc_id, p, p = 0 OR substr(h, 1, 1) >= '{lines.MARK}' AS starts, p = n - 2 OR substr(h, 2, 1) >= '{lines.MARK}' AS ends, n
  FROM (SELECT *, md5(md5(line) || md5(lead(line) OVER (PARTITION BY doc_id ORDER BY p))) AS h FROM n) WHERE p < n - 1),
b AS (
  SELECT a.doc_id, a.p AS s, coalesce(min(z.p) FILTER (WHERE z.ends), least(a.p + {lines.MOST - 1}, any_value(a.n) - 2)) + 1 AS e
  FROM r a JOIN r z ON a.doc_id = z.doc_id AND z.p BETWEEN a.p AND a.p + {lines.MOST - 1} WHERE a.starts GROUP BY a.doc_id, a.p
  UNION SELECT doc_id, p, p + 1 FROM r),
c AS (SELECT b.doc_id, s, e, list(line ORDER BY p) AS body FROM b JOIN n ON b.doc_id = n.doc_id AND n.p BETWEEN s AND e GROUP BY b.doc_id, s, e),
f AS (SELECT *, first_value(doc_id) OVER w AS f, s - first_value(s) OVER w AS shift, row_number() OVER w AS nth FROM c WINDOW w AS (PARTITION BY body ORDER BY doc_id, s)),
m AS (SELECT doc_id, s, e, f, shift FROM f WHERE nth > 1),
t AS (
  SELECT m.*, k, x.line IS NOT DISTINCT FROM y.line AND x.line IS NOT NULL AS same
  FROM m CROSS JOIN (SELECT unnest(range(-{lines.BEFORE}, {lines.BEHIND + 1})) AS k)
  LEFT JOIN n x ON x.doc_id = m.doc_id AND x.p = CASE WHEN k < 0 THEN s + k ELSE e + k END
  LEFT JOIN n y ON y.doc_id = m.f AND y.p = CASE WHEN k < 0 THEN s + k ELSE e + k END - shift),
g AS (
  SELECT doc_id, f, shift, t.s + coalesce(max(k) FILTER (WHERE k < 0 AND NOT same), -{lines.BEFORE + 1}) + 1 AS s, t.e + coalesce(min(k) FILTER (WHERE k > 0 AND NOT same), {lines.BEHIND + 1}) - 1 AS e
  FROM t GROUP BY doc_id, t.s, t.e, f, shift),
j AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY doc_id, f, shift ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, true) AS fresh FROM g),
q AS (
  SELECT doc_id, f, shift, min(s) AS s, max(e) AS e
  FROM (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id, f, shift ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM j) GROUP BY doc_id, f, shift, island),
o AS (SELECT DISTINCT f AS doc_id, s - shift AS s, e - shift AS e FROM q),
o1 AS (SELECT o.* FROM o WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.doc_id = o.doc_id AND q.s <= o.s AND q.e >= o.e)),
x AS (
  SELECT DISTINCT n.doc_id, n.p, n.i FROM n JOIN q ON n.doc_id = q.doc_id AND n.p BETWEEN q.s AND q.e
  WHERE NOT EXISTS (SELECT 1 FROM o1 WHERE o1.doc_id = n.doc_id AND n.p BETWEEN o1.s AND o1.e)),
u AS (SELECT *, lead(p) OVER w = p + 1 AS goes_on, lead(i) OVER w AS next_i FROM x WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
y AS (SELECT DISTINCT doc_id, unnest(range(i, CASE WHEN goes_on THEN next_i ELSE i END + 1)) AS i FROM u),
k AS (SELECT doc_id, count(*) FILTER (WHERE NOT coalesce(goes_on, false)) AS n_chunks_removed, count(*) AS n_gone FROM u GROUP BY doc_id),
z AS (
  SELECT l.doc_id, count(*) AS n_lines, count(y.i) AS n_lines_removed, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE y.i IS NULL), '') AS text
  FROM l LEFT JOIN y ON l.doc_id = y.doc_id AND l.i = y.i GROUP BY l.doc_id),
a AS (SELECT doc_id, any_value(n) AS n FROM n GROUP BY doc_id)
SELECT d.doc_id, z.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed,
       coalesce(n_chunks_removed, 0) AS n_chunks_removed, coalesce(n_gone = n, false) AS all_removed
FROM documents d LEFT JOIN z ON d.doc_id = z.doc_id LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN a ON d.doc_id = a.doc_id
"""

OP2_SQL = """
WITH d AS (
  SELECT doc_id, source, substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS h,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i FROM s),
c AS (SELECT *, i % 3 + 1 AS weight, 3 * source_size AS cap FROM w),
n AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, i) AS need,
         CAST((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM c),
f AS (SELECT need AS free_need, level AS free_level FROM n WHERE level * weight <= cap ORDER BY need LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN need < free_need THEN CAST(cap AS DOUBLE) ELSE least(free_level * weight, CAST(cap AS DOUBLE)) END AS target
  FROM n, f),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
u AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
m AS (
  SELECT u.source, u.h, p.source_size, p.target, p.passes,
         CASE WHEN p.target - p.passes * p.source_size >= p.source_size OR u.upto <= p.target - p.passes * p.source_size
                   OR 2 * u.upto - u.words < 2 * (p.target - p.passes * p.source_size) THEN 1 ELSE 0 END AS more
  FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, m.source_size, m.target, CAST(d.size * (m.passes + m.more) AS BIGINT) AS taken
FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source AND d.h = m.h
"""

_WHOLE = "[CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]"
_FINITE = "embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0"

OP11_SQL = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS i, vec_id, label, {_WHOLE} AS q FROM embeddings WHERE {_FINITE}),
p AS (SELECT i, part, q[part * (len(q) // 16) + 1 : (part + 1) * (len(q) // 16)] AS x FROM v, range(16) r(part)),
c0 AS (SELECT part, i AS entry, x AS c FROM p WHERE i < 64),
""" + "".join(f"""
d{k} AS (
  SELECT i, p.part, min(CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, c)]) AS BIGINT) * 64 + entry) AS best, any_value(x) AS x
  FROM p JOIN c{k} c ON p.part = c.part GROUP BY i, p.part),
""" + (f"""
m{k} AS (
  SELECT part, entry, list(mean ORDER BY pos) AS c
  FROM (SELECT part, best % 64 AS entry, pos, CAST(floor(sum(comp) / count(*)) AS BIGINT) AS mean
        FROM (SELECT part, best, unnest(x) AS comp, unnest(range(len(x))) AS pos FROM d{k}) GROUP BY part, best % 64, pos)
  GROUP BY part, entry),
c{k + 1} AS (SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM c{k} c LEFT JOIN m{k} m ON c.part = m.part AND c.entry = m.entry),
""" if k < 2 else "") for k in range(3)) + """
e AS (SELECT i, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM d2 GROUP BY i),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN e USING (i), s
"""

OP13_SQL = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST({_WHOLE} AS DOUBLE[]) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS alike, CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v a, v WHERE a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

QUERIES = {"op1_line_dedup": op1_line_dedup, "op2_mixing": op2_mixing, "op3_language_id": op3_language_id, "op4_media_columns": op4_media_columns, "op5_jaccard_join": op5_jaccard_join, "op6_quality": op6_quality, "op7_html_extraction": op7_html_extraction, "op8_embedding_near_dedup": op8_embedding_near_dedup, "op9_lm_scoring": op9_lm_scoring, "op10_packing": op10_packing, "op11_vector_codes": op11_vector_codes, "op12_secret_scan": op12_secret_scan, "op13_hard_negatives": op13_hard_negatives}
ORACLES = {"op1_line_dedup": OP1_SQL, "op2_mixing": OP2_SQL, "op11_vector_codes": OP11_SQL, "op13_hard_negatives": OP13_SQL}
