"""Queries of enrichment, merging, holdings, reports and incremental operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import holdings, language, stemming, strings, text
from folioframe.operators import enrichment, intervals, joins, merging, reports
from folioframe.plans.record_catalogue import _parts
from folioframe.plans.registry import Tables, query
from folioframe.records import model
from folioframe.sources import formats
from folioframe.streaming import events, incremental


def _orders(t: Tables) -> DataFrame:
    """Orders as records: 001 key, 100 the customer's number in $0 and a name to be replaced, 773 a link to the customer."""
    customer = F.concat(F.lit("(DE-627)"), F.col("o_custkey").cast("string"))
    fields = F.array(model.field("001", {"": F.col("o_orderkey")}, "", ""), model.field("100", {"a": F.col("o_orderstatus"), "0": customer}), model.field("773", {"w": customer, "t": F.col("o_orderpriority")}))
    return t.orders.select(F.col("o_orderkey").alias("control_number"), F.lit("00000nab a2200000 u 4500").alias("leader"), fields.alias("fields"))


# Joins.


@query("""SELECT n_nationkey, (SELECT string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) FROM customer WHERE c_nationkey = n_nationkey) AS segments FROM nation""")
def attached_values(t: Tables) -> DataFrame:
    got = enrichment.attach(t.nation, t.customer, "n_nationkey", "c_nationkey", "c_mktsegment", "segments")
    return got.select("n_nationkey", F.array_join("segments", "|").alias("segments"))


@query("""SELECT p_partkey AS control_number, CASE WHEN p_type LIKE 'S%' THEN 'T' || length(p_type) ELSE '' END AS added FROM part""")
def reference_fields(t: Tables) -> DataFrame:
    lookup = t.part.where("p_type like 'S%'").select(F.col("p_type").alias("ref"), F.concat(F.lit("T"), F.length("p_type")).alias("value")).distinct()
    got = enrichment.add_from_references(_parts(t), lookup, ("650",), "a", r"^(.+) \.$", "653", "a")
    return got.select("control_number", model.first_value(F.col("fields"), "653", "a").alias("added"))


@query("""SELECT o_orderkey AS control_number, '(DE-627)' || CASE WHEN c_custkey % 3 = 0 THEN 'c' ELSE '' END || o_custkey AS link, o_orderpriority AS title
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def rewritten_links(t: Tables) -> DataFrame:
    renamed = t.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("ref"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("new"))
    got = enrichment.rewrite_references(_orders(t), renamed, ("773",), "w", "(DE-627)")
    return got.select("control_number", model.first_value(F.col("fields"), "773", "w").alias("link"), model.first_value(F.col("fields"), "773", "t").alias("title"))


@query("""SELECT o_orderkey AS control_number, coalesce(c_name, o_orderstatus) AS name, coalesce(c_mktsegment, '') AS segment
FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey < 12""")
def authority_fields(t: Tables) -> DataFrame:
    authority = t.customer.where("c_nationkey < 12").select(F.col("c_custkey").cast("string").alias("ref"), "c_name", "c_mktsegment")
    got = enrichment.from_authority(_orders(t), authority, ("100",), r"^\(DE-627\)(.+)$", {"a": "c_name", "c": "c_mktsegment"})
    first = lambda code: model.first_value(F.col("fields"), "100", code)
    return got.select("control_number", first("a").alias("name"), first("c").alias("segment"))


@query("SELECT l_orderkey, arg_min(p_brand, l_linenumber::BIGINT * 1000000000 + l_partkey) AS brand FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 40 GROUP BY l_orderkey")
def two_hop_lookup(t: Tables) -> DataFrame:
    lines = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"])
    items = t.lineitem.groupBy("l_orderkey").agg(lines.alias("parts"))
    return enrichment.two_hop(items, t.part.where("p_size > 40"), "l_orderkey", "parts", "p_partkey", "p_brand").withColumnRenamed("p_brand", "brand")


@query("""SELECT p_partkey, p_size = 50 OR (p_partkey - p_partkey % 10) IN (SELECT p_partkey FROM part WHERE p_size = 50) AS held FROM part""")
def inherited_flag(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.array(F.col("p_partkey") - F.col("p_partkey") % 10).alias("up"), (F.col("p_size") == 50).alias("own"))
    return enrichment.inherited_flag(rows, "p_partkey", "up", "own", "held").select("p_partkey", "held")


@query("""SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') OR c_acctbal < 0 AS kept FROM customer""")
def used_authorities(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("number"))
    kept, dropped = enrichment.split_used(rows, t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("ref")), "number")
    return kept.select("c_custkey", F.lit(True).alias("kept")).unionByName(dropped.select("c_custkey", F.lit(False).alias("kept")))


@query("""WITH k AS (SELECT lower(c_mktsegment) AS keyword, count(*) AS n FROM customer GROUP BY 1), a AS (SELECT lower(string_split(p_type, ' ')[1]) AS h, min(p_partkey) AS ref FROM part GROUP BY 1
UNION ALL SELECT 'building', -1) SELECT keyword, n, min(ref)::VARCHAR AS ref FROM k LEFT JOIN a ON h = keyword GROUP BY keyword, n""")
def keyword_matches(t: Tables) -> DataFrame:
    headings = t.part.select(F.split("p_type", " ").getItem(0).alias("heading"), F.col("p_partkey").alias("ref"))
    headings = headings.unionByName(t.spark.createDataFrame([("Building ", -1)], "heading string, ref long"))
    return enrichment.keyword_matches(t.customer, headings, "c_mktsegment", "heading", "ref").withColumn("ref", F.col("ref").cast("string"))


@query("""SELECT k, lang, source FROM (SELECT doc_id % 50 AS k, lang, source, row_number() OVER (PARTITION BY doc_id % 50, lang ORDER BY CASE source WHEN 'books' THEN 1 WHEN 'web' THEN 2 ELSE 3 END, source) AS r
FROM documents WHERE source IS NOT NULL) WHERE r = 1""")
def best_translation(t: Tables) -> DataFrame:
    rows = t.documents.select((F.col("doc_id") % 50).alias("k"), "lang", "source", F.col("source").alias("origin"))
    return enrichment.best_translation(rows, "k", "lang", "source", "origin", ("books", "web")).select("k", "lang", "source")


@query("""SELECT k, l AS lang FROM (SELECT DISTINCT doc_id % 300 AS k FROM documents), (SELECT unnest(['en', 'de', 'fr', 'es']) AS l) WHERE (k, l) NOT IN (SELECT (doc_id % 300, lang) FROM documents WHERE lang IS NOT NULL)""")
def translation_gaps(t: Tables) -> DataFrame:
    return enrichment.translation_gaps(t.documents.select((F.col("doc_id") % 300).alias("k"), "lang"), "k", "lang", ("en", "de", "fr", "es"))


@query("""SELECT lang, count(DISTINCT doc_id % 300) AS translated, (SELECT count(DISTINCT doc_id % 300) FROM documents) - count(DISTINCT doc_id % 300) AS missing FROM documents WHERE lang IS NOT NULL GROUP BY lang""")
def translation_coverage(t: Tables) -> DataFrame:
    return enrichment.translation_coverage(t.documents.select((F.col("doc_id") % 300).alias("k"), "lang"), "k", "lang")


@query("""SELECT c_custkey, c_mktsegment AS item, false AS bundled FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT c_custkey, n_name, true FROM customer JOIN nation ON n_regionkey = CASE c_mktsegment WHEN 'BUILDING' THEN 0 ELSE 1 END WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def bundle_members(t: Tables) -> DataFrame:
    bundles = t.nation.where("n_regionkey < 2").select(F.when(F.col("n_regionkey") == 0, "BUILDING").otherwise("MACHINERY").alias("bundle"), "n_name")
    return enrichment.expand_bundles(t.customer.select("c_custkey", F.col("c_mktsegment").alias("item")), bundles, "item", "bundle", "n_name")


@query("""SELECT l_orderkey, l_linenumber, coalesce(p_size, 0) AS size, CASE WHEN p_partkey IS NULL THEN 'dangling' ELSE p_brand END AS link
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size < 25""")
def link_type_tag(t: Tables) -> DataFrame:
    some = t.part.where("p_size < 25").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_brand")
    return t.lineitem.join(some, "l_partkey", "left").select("l_orderkey", "l_linenumber", F.coalesce("p_size", F.lit(0)).alias("size"), joins.cascade(F.col("p_brand"), F.lit("dangling")).alias("link"))


@query("""WITH s AS (SELECT s_suppkey, 1992 + s_suppkey % 4 AS y, s_nationkey % 5 + 1 AS v FROM supplier),
x AS (SELECT l_orderkey, l_linenumber, l_suppkey, year(l_shipdate) AS y, l_linenumber AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN x.y > s.y OR (x.y = s.y AND x.v >= s.v) ELSE (x.y > s.y OR (x.y = s.y AND x.v >= s.v)) AND (x.y < s.y + 3 OR (x.y = s.y + 3 AND x.v <= s.v + 2)) END, false) AS available
FROM x LEFT JOIN s ON s_suppkey = l_suppkey""")
def holdings_availability(t: Tables) -> DataFrame:
    text_of = lambda c: c.cast("string")
    year, volume = 1992 + F.col("s_suppkey") % 4, F.col("s_nationkey") % 5 + 1
    until = F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(F.concat(text_of(volume + 2), F.lit("."), text_of(year + 3)))
    statements = t.supplier.select("s_suppkey", F.concat(text_of(volume), F.lit("."), text_of(year), F.lit(" - "), until).alias("statement"))
    articles = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.year("l_shipdate").alias("year"), F.col("l_linenumber").alias("volume"), F.lit(None).cast("int").alias("issue"))
    return holdings.availability(articles, statements, "l_suppkey", "s_suppkey", "statement").select("l_orderkey", "l_linenumber", "available")


# Merging.


@query("""SELECT max(p_partkey) AS control_number, arg_max(p_name, p_partkey) || ' /' AS title, count(DISTINCT lower(p_type)) AS n_topics,
CASE WHEN count(*) = 2 THEN min(p_partkey)::VARCHAR ELSE '' END AS merged FROM part GROUP BY p_partkey // 2""")
def merged_forms(t: Tables) -> DataFrame:
    rows = _parts(t)
    links = t.part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("a"), (F.col("p_partkey") + 1).alias("b"))
    got = merging.merge_forms(rows, merging.groups_of(rows, links, "a", "b"), 2024)
    f = F.col("fields")
    return got.select("control_number", model.first_value(f, "245", "a").alias("title"), F.size(model.values(f, "650", "a")).alias("n_topics"), model.first_value(f, "ZWI", "b").alias("merged"))


@query("""SELECT o_custkey, CASE o_orderpriority WHEN '1-URGENT' THEN '2-HIGH' ELSE o_orderpriority END AS item, min(o_orderdate) AS seen FROM orders GROUP BY 1, 2""")
def merged_subscriptions(t: Tables) -> DataFrame:
    renamed = t.spark.createDataFrame([("1-URGENT", "2-HIGH")], "ref string, new string")
    return merging.merge_subscriptions(t.orders.select("o_custkey", F.col("o_orderpriority").alias("item"), F.col("o_orderdate").alias("seen")), renamed, "o_custkey", "item", "seen")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0 OR (doc_id % 2 = 0 AND text IS NOT NULL)")
def changed_records(t: Tables) -> DataFrame:
    digest = F.sha1(F.coalesce("text", F.lit("")).cast("binary"))
    now = t.documents.select("doc_id", F.when((F.col("doc_id") % 2 == 0) & F.col("text").isNotNull(), F.concat(digest, F.lit("x"))).otherwise(digest).alias("h"))
    return merging.changed(now, t.documents.where("doc_id % 3 <> 0").select("doc_id", digest.alias("h")), "doc_id", "h").select("doc_id")


# Reports.


@query("""SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) AS domain, CASE page_id % 3 WHEN 1 THEN 'timeout' ELSE 'refused' END AS error, count(*) AS n, min(page_id) AS page_id, arg_min(url, page_id) AS url
FROM pages WHERE page_id % 3 > 0 GROUP BY 1, 2""")
def error_report(t: Tables) -> DataFrame:
    k = F.col("page_id") % 3
    return reports.error_report(t.pages.withColumn("error", F.when(k == 1, "timeout").when(k == 2, "refused").otherwise("ok")), "page_id", "url", "error", ("ok",))


@query("""SELECT CASE event_type WHEN 'error' THEN 'SEVERE' ELSE 'INFO' END AS level, 'user ' || user_id % 10 AS message, count(*) AS n, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1, 2""")
def log_report(t: Tables) -> DataFrame:
    level = F.when(F.col("event_type") == "error", "SEVERE").otherwise("INFO")
    lines = t.events.select(F.concat(F.col("event_id").cast("string"), F.lit(" "), level, F.lit(": user "), (F.col("user_id") % 10).cast("string")).alias("line"), "ts")
    return reports.log_report(lines, "line", "ts").drop("rank")


@query("""SELECT p_partkey, 'p_size' AS "column", p_size::VARCHAR AS old, (p_size + 1)::VARCHAR AS new FROM part WHERE p_partkey % 4 = 0
UNION ALL SELECT p_partkey, 'p_brand', p_brand, NULL FROM part WHERE p_partkey % 4 = 1 UNION ALL SELECT p_partkey, 'p_size', p_size::VARCHAR, NULL FROM part WHERE p_partkey % 4 = 1""")
def column_changes(t: Tables) -> DataFrame:
    other = t.part.where("p_partkey % 4 <> 1").withColumn("p_size", F.when(F.col("p_partkey") % 4 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return reports.column_changes(t.part, other, "p_partkey", ["p_brand", "p_size"])


@query("""SELECT 'n' || n_nationkey AS node, 'big' AS class FROM nation WHERE n_regionkey IN (1, 2) UNION ALL SELECT 'n' || n_nationkey, 'low' FROM nation WHERE n_nationkey < 5
UNION ALL SELECT 'c' || c_custkey, 'big' FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey IN (1, 2) UNION ALL SELECT 'c' || c_custkey, 'low' FROM customer WHERE c_nationkey < 5""")
def spread_classes(t: Tables) -> DataFrame:
    node = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    rules = {"big": [F.col("n_regionkey") == 1, F.col("n_regionkey") == 2], "low": [F.col("n_nationkey") < 5]}
    links = t.customer.select(node("n", "c_nationkey").alias("src"), node("c", "c_custkey").alias("dst"))
    return reports.classify(t.nation.withColumn("node", node("n", "n_nationkey")), rules, "node", links)


@query("SELECT count(*) FILTER (WHERE p_size < 10) AS small, count(*) FILTER (WHERE p_brand = 'Brand#11') AS first_brand, count(*) AS every FROM part")
def count_buckets(t: Tables) -> DataFrame:
    return reports.count_buckets(t.part, {"small": F.col("p_size") < 10, "first_brand": F.col("p_brand") == "Brand#11", "every": F.lit(True)})


# Scalars, intervals and models.


@query("""SELECT p_partkey, regexp_replace(lower(string_split(p_type, ' ')[1]), '^(.{3,}?)(?:ations|ation|ings|ness|ing|ies|edly|ed|es|ly|s)$', '\\1') AS stem FROM part""")
def stems(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", stemming.stem(F.split("p_type", " ").getItem(0), "en").alias("stem"))


@query("""WITH x AS (SELECT c_custkey, lpad(c_custkey::VARCHAR, 8, '0') AS s FROM customer), y AS (SELECT *, list_sum(list_transform(range(1, 8), lambda k: substr(s, k::INT, 1)::INT * (9 - k))) AS t FROM x)
SELECT c_custkey, substr(s, 8, 1) = ((11 - t % 11) % 11)::VARCHAR AS valid, substr(s, 1, 4) || '-' || substr(s, 5, 4) AS issn FROM y""")
def issn_check(t: Tables) -> DataFrame:
    number = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    return t.customer.select("c_custkey", text.issn_valid(number).alias("valid"), strings.issn(number).alias("issn"))


@query("""SELECT p_partkey, '10.' || (1000 + p_size) || '/' || replace(lower(p_brand), '#', '.') AS doi FROM part""")
def doi_extract(t: Tables) -> DataFrame:
    said = F.concat(F.lit("https://doi.org/10."), (1000 + F.col("p_size")).cast("string"), F.lit("/"), F.replace("p_brand", F.lit("#"), F.lit(".")))
    return t.part.select("p_partkey", strings.doi(said).alias("doi"))


@query("""SELECT l_orderkey, round((least(max(l_linenumber), 6) - greatest(min(l_linenumber), 3) + 1)::DOUBLE / (greatest(max(l_linenumber), 6) - least(min(l_linenumber), 3) + 1), 9) AS score FROM lineitem GROUP BY l_orderkey""")
def interval_score(t: Tables) -> DataFrame:
    spans = t.lineitem.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("a"), F.max("l_linenumber").alias("b"))
    return spans.select("l_orderkey", F.round(intervals.score(F.col("a"), F.col("b"), F.lit(3), F.lit(6)), 9).alias("score"))


@query(r"""WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '(\p{L}+)')) AS w FROM documents WHERE lang IS NOT NULL), c AS (SELECT lang, '_' || w || '_' AS w, count(*) AS n FROM w GROUP BY ALL),
g AS (SELECT lang, n, substr(w, i, k) AS ngram FROM (SELECT *, unnest(range(1, length(w) - k + 2)) AS i FROM (SELECT *, unnest(range(1, 6)) AS k FROM c) WHERE length(w) >= k)),
s AS (SELECT lang, ngram, sum(n) AS n FROM g WHERE ngram <> '_' GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, ngram) AS r, sqrt(sum(n::DOUBLE * n) OVER (PARTITION BY lang)) AS norm FROM s)
SELECT lang, ngram, r AS place, n::BIGINT AS n FROM r WHERE r <= 400""")
def ngram_model(t: Tables) -> DataFrame:
    return language.ngram_counts(t.documents.where("lang is not null"), "lang", "text").select("lang", "ngram", "place", "n")


@query("""SELECT event_id AS control_number, (props::JSON ->> '$.k') AS k FROM events""")
def json_records(t: Tables) -> DataFrame:
    got = formats.from_json(t.events.select("event_id", "props"), "props", "event_id", [formats.Mapping("500", "a", "$.k")])
    return got.select(F.col("control_number").cast("long").alias("control_number"), model.first_value(F.col("fields"), "500", "a").alias("k"))


# Incremental behaviour.


@query("""WITH b AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) AS s FROM events)
SELECT event_type, start, count(*) AS n FROM (SELECT event_type, s AS start FROM b UNION ALL SELECT event_type, s - INTERVAL 30 MINUTE FROM b) GROUP BY ALL""")
def events_sliding(t: Tables) -> DataFrame:
    got = events.windowed(t.events, "ts", ["event_type"], "1 hour", "30 minutes")
    return got.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("""WITH u AS (SELECT c_custkey, c_mktsegment AS m, max(o_orderdate) AS seen FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderkey % 2 = 0 GROUP BY ALL)
SELECT c_custkey AS "user", c_custkey AS serial, o_orderkey FROM u JOIN orders ON o_custkey = c_custkey WHERE o_orderdate > seen AND year(o_orderdate) BETWEEN 1996 AND 1998 AND o_orderkey % 5 <> 0""")
def notifications(t: Tables) -> DataFrame:
    seen = t.orders.where("o_orderkey % 2 = 0").groupBy("o_custkey").agg(F.max("o_orderdate").alias("seen"))
    subscriptions = t.customer.join(seen, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_custkey").alias("user"), F.col("c_custkey").alias("serial"), "seen")
    items = t.orders.select(F.col("o_custkey").alias("serial"), "o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    sent = t.orders.where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("user"), "o_orderkey")
    return incremental.notifications(items, subscriptions, sent, "o_orderkey", "o_orderdate", "year", 1998)


@query("""WITH c AS (SELECT DISTINCT user_id, event_type FROM events), s AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 3 = 0)
SELECT * FROM c WHERE (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM s)""")
def saved_searches(t: Tables) -> DataFrame:
    return incremental.new_results(t.events, t.events.where("event_id % 3 = 0"), "user_id", "event_type")


@query("""SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '1998-08-01 00:00:00' - INTERVAL 90 DAY""")
def tardy_sources(t: Tables) -> DataFrame:
    return incremental.tardy(t.orders, "o_custkey", "o_orderdate", "1998-08-01 00:00:00", 90)
