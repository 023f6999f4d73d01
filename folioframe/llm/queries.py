"""The registered queries of this subpackage, with SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioframe.llm import decontamination, language_id, license_scan, lm, near_dup, packing, quality, toxicity, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules of op8, as (verdict, host/path).
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(_table(spark, sf_dir, "pages"), "page_id", "url", "html").drop("warc_record_id", "warc_date", "target_uri")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.train(docs))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    score = toxicity.scorer(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return docs.select("doc_id", score("text").alias("s")).select(
        "doc_id", F.col("s.grade").alias("severity"), F.col("s.expected").alias("expected_severity"), F.col("s.p_toxic").alias("p_toxic"), F.col("s.toxic").alias("toxic")
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.similar_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"), 5)
    models = language_id.train(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), models).select("doc_id", "held_out", "lang_pred", "score")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES).withColumn("score", F.round("score", 6))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"), 10)
    return lm.score(docs, lm.train(docs.where(~held_out)), held_out)


QUERIES = {
    f.__name__: f
    for f in (op1_warc, op2_license_scan, op3_toxicity, op4_jaccard_join, op5_packing, op6_decontamination, op7_language_id, op8_url_filter, op9_quality, op10_lm_score)
}

_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
#: Distinct shingles of each row: (id, shingle).
_SHINGLES = """
SELECT DISTINCT id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i+4], ' ') ELSE len(w) || ' ' || array_to_string(w, ' ') END AS shingle
FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (SELECT {id} AS id, {words} AS w FROM {table}) WHERE len(w) > 0)
"""


def _shingles(table: str, key: str) -> str:
    return _SHINGLES.format(id=key, table=table, words=_WORDS.format(text="coalesce(text, '')"))


#: Base32 of a SHA-1 in hex: every five hex digits are four letters.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda k:
substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (k // 4)::INT, 5))::BIGINT >> (5 * (3 - k % 4))::INT) & 31)::INT, 1)), '')"""

_REST = "substr(url, instr(url, '://') + 3)"
_UP, _LOW = f"'{url_filter._UPPER}'", f"'{url_filter._LOWER}'"
_FIT = " ".join(
    f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}') THEN ['{name}/{rest}', '{verdict}']"
    for verdict, (name, _, rest) in sorted(((v, r.partition("/")) for v, r in URL_RULES), key=lambda x: -len("".join(x[1])))
)


def _log_p(kind: str) -> str:
    lowest = f"(c_{kind} + 1) / (n_{kind} + {url_filter.SIZE})"
    middle = f"(bc_{kind} + {url_filter.KAPPA} * ({lowest})) / (b_{kind} + {url_filter.KAPPA})"
    return f"ln((abc_{kind} + {url_filter.KAPPA} * ({middle})) / (ab_{kind} + {url_filter.KAPPA}))"


#: The models, the calibration and the verdicts; grams are strings here, and those that no example has are looked up by their parts.
_URL_FILTER = f"""
WITH p AS (SELECT page_id, url, instr(url, '://') > 0 AS whole FROM pages),
q AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN whole THEN translate(regexp_extract({_REST}, '^([^/?#]*)', 1), {_UP}, {_LOW}) ELSE '' END AS host,
 CASE WHEN whole THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path, coalesce(CASE WHEN whole THEN {_REST} ELSE url END, '') AS text FROM p),
s AS (SELECT r, page_id, host, path, CASE {_FIT} END AS fit,
 translate(regexp_replace(regexp_replace(translate(text, {_UP}, {_LOW}), '[^a-z0-9./-]', '_', 'g'), '[0-9]', '0', 'g'), '{url_filter.ALPHABET[1:]}', '{url_filter.DIGITS[1:]}') AS t FROM q),
x AS MATERIALIZED (SELECT *, fit[2] = 'allow' AS good, fit IS NOT NULL AND ('0x' || substr(md5(t), 1, 4))::INT % 5 = 0 AS aside FROM s),
g AS MATERIALIZED (SELECT r, fit IS NOT NULL AND NOT aside AS taught, good, unnest(list_transform(range(1, length(t) + 1), lambda i: substr('00' || t, i, 3))) AS k FROM x),
abc AS MATERIALIZED (SELECT k, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad FROM g WHERE taught GROUP BY k),
n AS (SELECT coalesce(sum(good), 0) AS good, coalesce(sum(bad), 0) AS bad FROM abc), ab AS (SELECT left(k, 2) AS k, sum(good) AS good, sum(bad) AS bad FROM abc GROUP BY 1),
bc AS (SELECT right(k, 2) AS k, sum(good) AS good, sum(bad) AS bad FROM abc GROUP BY 1), b AS (SELECT substr(k, 2, 1) AS k, sum(good) AS good, sum(bad) AS bad FROM abc GROUP BY 1),
c AS (SELECT right(k, 1) AS k, sum(good) AS good, sum(bad) AS bad FROM abc GROUP BY 1),
met AS (SELECT d.k, {", ".join(f"coalesce({t}.{k}, 0)::DOUBLE AS {t}_{k}" for t in ("abc", "ab", "bc", "b", "c", "n") for k in ("good", "bad"))}
 FROM (SELECT DISTINCT k FROM g) d CROSS JOIN n LEFT JOIN abc ON abc.k = d.k LEFT JOIN ab ON ab.k = left(d.k, 2) LEFT JOIN bc ON bc.k = right(d.k, 2) LEFT JOIN b ON b.k = substr(d.k, 2, 1) LEFT JOIN c ON c.k = right(d.k, 1)),
model AS (SELECT k, CASE WHEN n_good > 0 AND n_bad > 0 THEN {_log_p("good")} - {_log_p("bad")} ELSE 0 END AS ratio FROM met),
score AS MATERIALIZED (SELECT r, sum(ratio) / count(*) AS score FROM g JOIN model USING (k) GROUP BY r),
y AS MATERIALIZED (SELECT x.*, coalesce(score, 0) AS score FROM x LEFT JOIN score USING (r)),
bin AS (SELECT greatest(-{url_filter.BINS}, least({url_filter.BINS}, floor(score * 100))) AS bin, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad FROM y WHERE aside GROUP BY 1),
cost AS (SELECT bin / 100 AS edge, coalesce(sum(good) OVER before, 0) / greatest(sum(good) OVER (), 1) + (sum(bad) OVER () - coalesce(sum(bad) OVER before, 0)) / greatest(sum(bad) OVER (), 1) AS cost
 FROM bin WINDOW before AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
edge AS (SELECT coalesce((SELECT edge FROM cost ORDER BY cost, abs(edge) LIMIT 1), 0) AS edge)
SELECT page_id, host, path, fit[1] AS rule, coalesce(fit[2], CASE WHEN score >= edge THEN 'allow' ELSE 'block' END) AS verdict, round(score, 6) AS score FROM y CROSS JOIN edge
"""

ORACLE_SQL = {
    "op8_url_filter": _URL_FILTER,
    "op1_warc": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h)
SELECT page_id, n AS payload_bytes, {_BASE32.replace("h,", "p.h,")} AS payload_digest,
CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f ON p.h = f.h
""",
    "op4_jaccard_join": f"""
WITH RECURSIVE s AS MATERIALIZED ({_shingles("documents", "doc_id")}),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
k AS (SELECT md5(string_agg(shingle, '|' ORDER BY shingle)) AS k, id FROM s GROUP BY id),
c AS (SELECT k, min(id) AS rep FROM k GROUP BY k),
r AS (SELECT s.* FROM s JOIN c ON s.id = c.rep),
common AS (SELECT a.id AS x, b.id AS y, count(*) AS m FROM r a JOIN r b ON a.shingle = b.shingle AND a.id < b.id GROUP BY a.id, b.id),
pair AS (SELECT x, y FROM common JOIN n p ON p.id = x JOIN n q ON q.id = y WHERE 100 * m >= 80 * (p.n + q.n - m)),
edge AS (SELECT x, y FROM pair UNION ALL SELECT y, x FROM pair),
reach(id, root) AS (SELECT rep, rep FROM c UNION SELECT edge.y, reach.root FROM reach JOIN edge ON edge.x = reach.id WHERE edge.y > reach.root),
least AS (SELECT id, min(root) AS root FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least.root, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.id = d.doc_id LEFT JOIN k ON k.id = d.doc_id LEFT JOIN c ON c.k = k.k LEFT JOIN least ON least.id = c.rep
""",
    "op6_decontamination": f"""
WITH d AS ({_shingles("documents", "doc_id")}), b AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT id, count(*) AS n FROM b GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(n.n) AS n_shingles, count(*) AS n_matched, count(*) / any_value(n.n) AS containment
FROM d JOIN b ON d.shingle = b.shingle JOIN n ON n.id = b.id GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(n.n)
""",
}
