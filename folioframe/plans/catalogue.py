"""Registered queries over the driver's tables, each with its SQL.

Each runs an operator of this library on whole tables; the SQL is written on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import text
from folioframe.operators import graph, intervals, joins, ranking, sets
from folioframe.plans import enrichment_catalogue, functions_catalogue, further_catalogue, linking_catalogue, record_catalogue  # noqa: F401
from folioframe.plans.registry import ORACLE_SQL, QUERIES, Tables, query  # noqa: F401
from folioframe.records import model
from folioframe.records.query import compile_conjunction, compile_query

# Aggregations.


@query("""SELECT count(*) AS n, count(DISTINCT doc_id) AS n_keys, max(length(text)) AS longest, round(avg(length(text)), 4) AS mean_length,
count(*) FILTER (WHERE text IS NULL OR text = '') AS n_empty FROM documents""")
def profile_collection(t: Tables) -> DataFrame:
    n = F.length("text")
    return t.documents.agg(
        F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_keys"), F.max(n).cast("long").alias("longest"),
        F.round(F.avg(n), 4).alias("mean_length"), F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("n_empty"),
    )


@query("SELECT source, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY source")
def tag_summary(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs"))


@query(r"""SELECT word, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '([a-z0-9]+)', 1)) AS word FROM documents)
GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def top_terms(t: Tables) -> DataFrame:
    per = t.documents.select(F.explode(F.array_distinct(text.words(F.col("text")))).alias("word"))
    return per.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)


@query("SELECT l_partkey, count(DISTINCT l_orderkey) AS n_orders, count(*) AS n_lines FROM lineitem GROUP BY l_partkey")
def refcount_distinct_vs_total(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_orderkey").alias("n_orders"), F.count("*").alias("n_lines"))


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY quality, toxic")
def confusion_counts(t: Tables) -> DataFrame:
    return t.labels.groupBy("quality", "toxic").agg(F.count("*").alias("n"))


@query("""SELECT p_type, p_brand, n FROM (SELECT p_type, p_brand, count(*) AS n, row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS r
FROM part GROUP BY p_type, p_brand) WHERE r = 1""")
def mode_form(t: Tables) -> DataFrame:
    counts = t.part.groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    return ranking.first_of(counts, ["p_type"], [F.negative("n"), F.col("p_brand")])


@query("SELECT o_custkey, max(o_orderdate) AS latest, min(o_orderdate) AS first, count(*) AS n FROM orders GROUP BY o_custkey")
def max_per_key(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"), F.min("o_orderdate").alias("first"), F.count("*").alias("n"))


@query("SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey")
def min_per_bundle(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"))


@query("SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)")
def relational_division(t: Tables) -> DataFrame:
    wanted = t.events.agg(F.countDistinct("event_type").alias("n")).scalar()
    return t.events.groupBy("user_id").agg(F.countDistinct("event_type").alias("n")).where(F.col("n") == wanted).select("user_id")


@query("SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey HAVING count(*) = 1")
def having_once(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("o_orderkey"), F.count("*").alias("n")).where("n = 1").drop("n")


@query("""SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY l_suppkey
HAVING count(*) FILTER (WHERE l_returnflag = 'R') >= 0.1 * count(*)""")
def threshold_share(t: Tables) -> DataFrame:
    got = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    return got.where("n_returned >= 0.1 * n")


@query("SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def list_agg(t: Tables) -> DataFrame:
    met = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return met.groupBy("r_name").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ", ").alias("nations"))


@query("""SELECT l_returnflag, l_linestatus, grouping_id(l_returnflag, l_linestatus) AS g, count(*) AS n, round(sum(l_quantity), 2) AS qty
FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def cube_rollup(t: Tables) -> DataFrame:
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(
        F.grouping_id().alias("g"), F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query("SELECT p_type, count(*) AS n, round(avg(p_retailprice), 4) AS mean, round(stddev_samp(p_retailprice), 4) AS sd, min(p_retailprice) AS low, max(p_retailprice) AS high FROM part GROUP BY p_type")
def value_statistics(t: Tables) -> DataFrame:
    p = "p_retailprice"
    return t.part.groupBy("p_type").agg(
        F.count("*").alias("n"), F.round(F.avg(p), 4).alias("mean"), F.round(F.stddev_samp(p), 4).alias("sd"), F.min(p).alias("low"), F.max(p).alias("high")
    )


# Joins.


@query("""SELECT l_orderkey, l_linenumber, o_orderpriority AS priority, o_orderdate AS ordered FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def parent_attr_inherit(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    return joins.inherit(lines, t.orders, "l_orderkey", "o_orderkey", {"priority": "o_orderpriority", "ordered": "o_orderdate"})


@query("SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def anti_ill(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_nationkey")


@query("""SELECT o_custkey % 7 + 1000000 * (o_custkey % 3) AS missing, count(*) AS n FROM orders
WHERE o_custkey % 7 + 1000000 * (o_custkey % 3) NOT IN (SELECT c_custkey FROM customer) GROUP BY 1""")
def dangling_refs(t: Tables) -> DataFrame:
    refs = t.orders.select((F.col("o_custkey") % 7 + 1000000 * (F.col("o_custkey") % 3)).alias("missing"))
    return joins.dangling(refs, t.customer, "missing", "c_custkey").groupBy("missing").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AS in_bulk FROM part")
def semi_flag(t: Tables) -> DataFrame:
    return joins.flag(t.part.select("p_partkey"), t.lineitem.where("l_quantity > 49"), "p_partkey", "l_partkey", "in_bulk")


@query("""WITH e AS (SELECT DISTINCT l_suppkey AS a, l_partkey % 101 AS b FROM lineitem WHERE l_quantity > 40)
SELECT a, b FROM e WHERE NOT EXISTS (SELECT 1 FROM e AS r WHERE r.a = e.b AND r.b = e.a)""")
def missing_backlinks(t: Tables) -> DataFrame:
    edges = t.lineitem.where("l_quantity > 40").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 101).alias("b"))
    return joins.missing_reverse(edges, "a", "b")


@query("""SELECT p_partkey, prefix FROM part JOIN (VALUES ('a'), ('b'), ('gr'), ('re'), ('blu')) v(prefix) ON starts_with(lower(p_name), prefix)""")
def prefix_join(t: Tables) -> DataFrame:
    prefixes = t.spark.createDataFrame([("a",), ("b",), ("gr",), ("re",), ("blu",)], "prefix string")
    rows = t.part.select("p_partkey", F.lower("p_name").alias("name"))
    return joins.prefix_join(rows, prefixes, "name", "prefix", [1, 2, 3]).select("p_partkey", "prefix")


@query("""SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM documents a JOIN documents b ON md5(a.text) = md5(b.text) AND a.doc_id < b.doc_id
WHERE a.doc_id = (SELECT min(c.doc_id) FROM documents c WHERE md5(c.text) = md5(a.text))""")
def duplicate_pairs(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("k"))
    least = keyed.groupBy("k").agg(F.min("doc_id").alias("doc_a"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(least, "k").where("doc_id > doc_a").select("doc_a", F.col("doc_id").alias("doc_b"))


# Windows, ranks and pages.


@query("""SELECT o_custkey, o_orderkey, o_orderdate, rank FROM (SELECT o_custkey, o_orderkey, o_orderdate,
row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3""")
def rank_newest(t: Tables) -> DataFrame:
    order = [F.desc("o_orderdate"), F.desc("o_totalprice"), F.col("o_orderkey")]
    return ranking.ranked(t.orders, ["o_custkey"], order, 3).select("o_custkey", "o_orderkey", "o_orderdate", F.col("rank").cast("long").alias("rank"))


@query("""SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, max(c_acctbal) OVER (PARTITION BY c_nationkey) AS best FROM customer) WHERE c_acctbal >= 0.9 * best""")
def topk_ties(t: Tables) -> DataFrame:
    return ranking.near_top(t.customer, ["c_nationkey"], "c_acctbal", 0.9).select("c_nationkey", "c_custkey", "c_acctbal")


@query("""SELECT n_nationkey, s_suppkey, s_name FROM (SELECT s_nationkey AS n_nationkey, s_suppkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS r FROM supplier) WHERE r = 1""")
def first_wins(t: Tables) -> DataFrame:
    rows = t.supplier.select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_name")
    return ranking.first_of(rows, ["n_nationkey"], [F.col("s_suppkey")])


@query("SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 50")
def paginate(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), "o_orderkey").offset(50).limit(25)


@query("""WITH RECURSIVE l AS (SELECT l_orderkey, l_quantity::BIGINT AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS i FROM lineitem),
c AS (SELECT l_orderkey, i, q AS used, 0 AS chunk FROM l WHERE i = 1
UNION ALL SELECT l.l_orderkey, l.i, CASE WHEN used + q <= 80 THEN used + q ELSE q END, CASE WHEN used + q <= 80 THEN chunk ELSE chunk + 1 END
FROM c JOIN l ON l.l_orderkey = c.l_orderkey AND l.i = c.i + 1)
SELECT l_orderkey, chunk, count(*) AS n FROM c GROUP BY l_orderkey, chunk""")
def byte_chunks(t: Tables) -> DataFrame:
    line = F.struct("l_linenumber", "l_partkey", "l_quantity", F.col("l_quantity").cast("bigint").alias("q"))
    per = t.lineitem.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["q"]).alias("sizes"))
    chunk = F.posexplode(ranking.chunk_lengths(F.col("sizes"), 80)).alias("chunk", "n")
    return per.select("l_orderkey", chunk).select("l_orderkey", "chunk", F.col("n").cast("bigint").alias("n"))


# Sets, differences and graphs.


@query("SELECT min(doc_id) AS doc_id, sha1(text) AS h, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY sha1(text)")
def dedup_key(t: Tables) -> DataFrame:
    keyed = t.documents.where("text is not null").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("h"))
    return keyed.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


_OLD_NEW = """a AS (SELECT o_orderkey, o_orderstatus, o_totalprice::DECIMAL(18, 2) AS o_totalprice FROM orders WHERE o_orderkey % 10 <> 0),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice::DECIMAL(18, 2) AS o_totalprice FROM orders WHERE o_orderkey % 11 <> 0)"""


def _old_new(t: Tables) -> tuple[DataFrame, DataFrame]:
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))
    new = rows.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return rows.where("o_orderkey % 10 <> 0"), new


@query(f"""WITH {_OLD_NEW} SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'left' WHEN a.o_orderkey IS NULL THEN 'right'
WHEN a.o_orderstatus = b.o_orderstatus AND a.o_totalprice = b.o_totalprice THEN 'same' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def diff_left_right(t: Tables) -> DataFrame:
    return sets.compare(*_old_new(t), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query(f"""WITH {_OLD_NEW} SELECT o_orderkey, o_orderstatus FROM b UNION ALL SELECT o_orderkey, o_orderstatus FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)""")
def delta_apply(t: Tables) -> DataFrame:
    return sets.apply_delta(*_old_new(t), "o_orderkey").select("o_orderkey", "o_orderstatus")


@query(f"""WITH {_OLD_NEW} SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'upsert' END AS action FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus""")
def incremental_diff(t: Tables) -> DataFrame:
    return sets.incremental(*_old_new(t), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("""SELECT 'both' AS kind, c_nationkey AS k FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'customer', c_nationkey FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'either', c_nationkey FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)""")
def union_intersect_except(t: Tables) -> DataFrame:
    a, b = t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k"))
    parts = {"both": a.intersect(b), "customer": a.subtract(b), "either": a.union(b).distinct()}
    out = [df.select(F.lit(name).alias("kind"), "k") for name, df in parts.items()]
    return out[0].union(out[1]).union(out[2])


_EDGES = "e AS (SELECT DISTINCT o_custkey AS a, o_custkey * 7 AS b FROM orders)"


def _edges(t: Tables) -> DataFrame:
    """One edge of every customer with an order; targets are not folded, so nodes, components and their depth grow with the table."""
    return t.orders.select(F.col("o_custkey").alias("a"), (F.col("o_custkey") * 7).alias("b"))


@query(f"""WITH RECURSIVE {_EDGES}, u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(node, label) AS (SELECT a, a FROM u UNION SELECT u.b, r.label FROM r JOIN u ON u.a = r.node) SELECT node, min(label) AS canonical FROM r GROUP BY node""")
def connected_components(t: Tables) -> DataFrame:
    return graph.canonical(_edges(t), "a", "b")


@query(f"""WITH RECURSIVE {_EDGES}, r(node, tag) AS (SELECT a, a % 5 FROM e UNION SELECT e.b, r.tag FROM r JOIN e ON e.a = r.node) SELECT node, tag FROM r""")
def tag_propagation(t: Tables) -> DataFrame:
    tagged = _edges(t).select(F.col("a").alias("node"), (F.col("a") % 5).alias("tag"))
    return graph.propagate(tagged, _edges(t), "node", "tag", "a", "b")


# Intervals.

_SPANS = "s AS (SELECT l_orderkey AS k, min(epoch(l_shipdate)::BIGINT // 86400) AS lo, max(epoch(l_shipdate)::BIGINT // 86400) AS hi FROM lineitem GROUP BY l_orderkey)"
_WINDOWS = "w AS (SELECT o_orderkey AS q, epoch(o_orderdate)::BIGINT // 86400 AS c, epoch(o_orderdate)::BIGINT // 86400 + 3 AS d FROM orders)"


def _day(c: str):
    return F.floor(F.unix_timestamp(c) / 86400)


def _spans(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.min(_day("l_shipdate")).alias("lo"), F.max(_day("l_shipdate")).alias("hi"))


@query(f"""WITH {_SPANS}, {_WINDOWS}, v AS (SELECT DISTINCT c, d FROM w), z AS (SELECT lo, hi, count(*) AS n, min(k) AS k FROM s GROUP BY lo, hi),
m AS (SELECT c, d, sum(n)::BIGINT AS n, min(k) AS first_k, round(max((least(hi, d) - greatest(lo, c) + 1) / (greatest(hi, d) - least(lo, c) + 1)), 6) AS best FROM z JOIN v ON d >= lo AND c <= hi GROUP BY c, d)
SELECT q, n, first_k, best FROM w JOIN m USING (c, d)""")
def interval_overlap(t: Tables) -> DataFrame:
    """Every order's window. Equal windows and equal spans meet once, with the number and least key of the spans, so pairs grow with the days covered and not with orders squared."""
    windows = t.orders.select(F.col("o_orderkey").alias("q"), _day("o_orderdate").alias("c"), (_day("o_orderdate") + 3).alias("d"))
    spans = _spans(t).groupBy("lo", "hi").agg(F.count("*").alias("n"), F.min("k").alias("k"))
    met = intervals.overlap_join(spans, windows.select("c", "d").distinct(), ("lo", "hi"), ("c", "d"))
    score = intervals.score(F.col("lo"), F.col("hi"), F.col("c"), F.col("d"))
    best = met.groupBy("c", "d").agg(F.sum("n").alias("n"), F.min("k").alias("first_k"), F.round(F.max(score), 6).alias("best"))
    return windows.join(best, ["c", "d"]).select("q", "n", "first_k", "best")


@query("""WITH x AS (SELECT o_custkey AS k, epoch(o_orderdate)::BIGINT // 86400 AS lo, epoch(o_orderdate)::BIGINT // 86400 + 30 AS hi FROM orders),
m AS (SELECT *, max(hi) OVER (PARTITION BY k ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR lo > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS i FROM m)
SELECT k, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM i GROUP BY k, i""")
def interval_merge(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("k"), _day("o_orderdate").alias("lo"), (_day("o_orderdate") + 30).alias("hi"))
    return intervals.islands(rows, ["k"], "lo", "hi")


# Records and their query languages.


def _records(t: Tables) -> DataFrame:
    """Parts as records: 100 name, 260 brand and type, 300 size."""
    fields = F.array(
        model.field("100", {"a": F.col("p_name")}), model.field("260", {"a": F.col("p_brand"), "b": F.col("p_type")}), model.field("300", {"a": F.col("p_size")})
    )
    return t.part.select(F.col("p_partkey").alias("control_number"), fields.alias("fields"))


@query("""SELECT p_partkey AS control_number, p_name AS name FROM part WHERE (p_brand = 'Brand#11' OR regexp_matches(p_type, 'STEEL|steel')) AND NOT p_size > 20""")
def grep_expr(t: Tables) -> DataFrame:
    wanted = compile_query('(260a == "Brand#11" OR 260b == /STEEL|steel/) AND NOT 300a == /^(2[1-9]|[3-9][0-9]|[0-9]{3,})$/')
    return _records(t).where(wanted).select("control_number", model.first_value(F.col("fields"), "100", "a").alias("name"))


@query("SELECT p_partkey AS control_number FROM part WHERE regexp_matches(p_brand, '[12]$') AND p_size < 10")
def mgrep(t: Tables) -> DataFrame:
    return _records(t).where(compile_conjunction("260a=[12]$ 300a=^[0-9]$")).select("control_number")


@query("""SELECT p_partkey AS control_number, replace(upper(p_brand), '#', '-') AS brand, CASE WHEN p_size < 25 THEN 1 ELSE 0 END AS n_sizes, 3 + CASE WHEN p_size < 25 THEN 1 ELSE 0 END AS n_fields FROM part""")
def filter_ops(t: Tables) -> DataFrame:
    fields = model.remove_fields(F.col("fields"), "300", "a", "^(2[5-9]|[3-9][0-9]|[0-9]{3,})$")
    fields = model.edit_values(fields, "260", "a", lambda v: F.replace(F.upper(v), F.lit("#"), F.lit("-")))
    fields = model.insert_field(fields, model.field("245", {"a": F.lit("x")}), "245")
    got = _records(t).select("control_number", fields.alias("fields"))
    n = F.size(F.filter("fields", lambda f: f["tag"] == "300"))
    return got.select("control_number", model.first_value(F.col("fields"), "260", "a").alias("brand"), n.alias("n_sizes"), F.size("fields").alias("n_fields"))


# Scalar functions and events.


@query(r"""SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host,
len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS n_links FROM pages""")
def url_parts(t: Tables) -> DataFrame:
    parts = text.url_parts(F.col("url"))
    return t.pages.select("page_id", parts["scheme"].alias("scheme"), parts["host"].alias("host"), F.size(text.links(F.col("html"))).cast("long").alias("n_links"))


@query("SELECT k, count(*) AS n FROM (SELECT (props::JSON ->> '$.k')::INT AS k FROM events) GROUP BY k")
def json_lookup(t: Tables) -> DataFrame:
    return t.events.select(F.get_json_object("props", "$.k").cast("int").alias("k")).groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_tumbling(t: Tables) -> DataFrame:
    got = t.events.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return got.select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "total")


@query("""WITH m AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM m) SELECT user_id, min(ts) AS start, count(*) AS n FROM i GROUP BY user_id, i""")
def events_session(t: Tables) -> DataFrame:
    got = t.events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.min("ts").alias("start"), F.count("*").alias("n"))
    return got.select("user_id", "start", "n")


@query("SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def scd2_latest(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "value", "ts", "event_id")
    return rows.groupBy("user_id").agg(F.max_by(F.struct("event_type", "value"), F.struct("ts", "event_id")).alias("x")).select("user_id", "x.event_type", "x.value")
