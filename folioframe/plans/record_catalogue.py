"""Queries of records, scalar functions, ranges, linkage and validation, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import ranges, strings
from folioframe.operators import graph, matching, validation
from folioframe.plans.registry import Tables, query
from folioframe.records import accessors, checks, edits, grep, model


def _parts(t: Tables) -> DataFrame:
    """Parts as records: 001 key, 245 title of name, type and brand, 260 brand, 300 size, 650 type; a serial if the size is even."""
    lit = F.lit
    fields = F.array(
        model.field("001", {"": F.col("p_partkey")}, "", ""), model.field("245", {"a": F.concat("p_name", lit(" /")), "b": F.col("p_type"), "n": F.when(F.col("p_size") < 10, F.col("p_size"))}),
        model.field("260", {"a": F.col("p_brand")}), model.field("300", {"a": F.col("p_size")}), model.field("650", {"a": F.concat(F.col("p_type"), lit(" ."))}),
    )
    leader = F.concat(lit("00000na"), F.when(F.col("p_size") % 2 == 0, "s").otherwise("m"), lit(" a2200000 u 4500"))
    return t.part.select(F.col("p_partkey").alias("control_number"), leader.alias("leader"), fields.alias("fields"))


@query("""WITH x AS (SELECT *, p_brand LIKE 'Brand#1%' AS hit FROM part WHERE p_size % 2 = 0)
SELECT p_partkey AS control_number, 0 AS place, '245a' AS label, p_name || ' /' AS value FROM x WHERE hit
UNION ALL SELECT p_partkey, CASE WHEN hit THEN 1 ELSE 0 END, '260a', p_brand FROM x WHERE p_brand NOT LIKE '%3'
UNION ALL SELECT p_partkey, CASE WHEN hit THEN 1 ELSE 0 END + CASE WHEN p_brand NOT LIKE '%3' THEN 1 ELSE 0 END, '300a', p_size::VARCHAR FROM x""")
def grep_projection(t: Tables) -> DataFrame:
    asked = 'leader[7]="s" "300a", if 260a == "^Brand#1" extract 245a, if 260a !== "3$" extract 260a, if 999 exists extract *'
    return grep.grep(_parts(t), asked)


@query("SELECT p_partkey AS control_number, '300' AS tag, p_size::VARCHAR AS value FROM part UNION ALL SELECT p_partkey, '260', p_brand FROM part")
def tag_grep(t: Tables) -> DataFrame:
    return grep.tag_grep(_parts(t), "^(26|30)")


@query("SELECT p_partkey AS control_number FROM part WHERE p_brand BETWEEN 'Brand#11' AND 'Brand#22' OR p_brand BETWEEN 'Brand#41' AND 'Brand#43'")
def range_filter(t: Tables) -> DataFrame:
    wanted = grep.in_ranges(F.col("fields"), "260", "a", [("Brand#11", "Brand#22"), ("Brand#41", "Brand#43")])
    return _parts(t).where(wanted).select("control_number")


@query("SELECT p_partkey AS control_number FROM part WHERE lower(p_type) IN (SELECT DISTINCT lower(p_type) FROM part WHERE p_size = 7)")
def heading_filter(t: Tables) -> DataFrame:
    headings = t.part.where("p_size = 7").select("p_type")
    return grep.with_heading(_parts(t), headings).select("control_number")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) WHERE n % 10 = 0""")
def every_kth(t: Tables) -> DataFrame:
    return grep.every_kth(t.orders.select("o_orderkey"), ["o_orderkey"], 10)


@query(r"""SELECT p_partkey AS control_number, 'brand ' || substr(p_brand, 7) AS brand, lower(p_type) AS heading, replace(p_name, 'o', '0') || ' /' AS title,
CASE WHEN p_size < 10 THEN 'small' END AS note, CASE WHEN p_size >= 40 THEN 4 ELSE 5 END + CASE WHEN p_size < 10 THEN 1 ELSE 0 END AS n_fields
FROM part WHERE p_brand NOT LIKE '%5' AND p_size % 2 = 1""")
def augment_ops(t: Tables) -> DataFrame:
    ops = r"""
        # whole values, characters, matches, then fields
        drop 260a:5$
        keep-level m
        replace 260a '^Brand#(\d+)$' 'brand \1'
        translate 650a [:upper:] [:lower:]
        filter-chars 650a ' .'
        globally-substitute 245a o 0
        remove-fields 300a:^[4-9][0-9]$
        insert-field-if 500a:small 300a:^[0-9]$
    """
    got = edits.apply_ops(_parts(t), ops)
    f = F.col("fields")
    note = model.first_value(f, "500", "a")
    first = lambda tag: model.first_value(f, tag, "a")
    return got.select("control_number", first("260").alias("brand"), first("650").alias("heading"), first("245").alias("title"), F.when(note != "", note).alias("note"), F.size(f).alias("n_fields"))


@query("""SELECT p_partkey AS control_number, 0 AS rule, p_brand AS value FROM part WHERE NOT regexp_matches(p_brand, '#[1-4]')
UNION ALL SELECT p_partkey, 1, p_size::VARCHAR FROM part WHERE p_size < 5""")
def rule_violations(t: Tables) -> DataFrame:
    rules = checks.parse_rules("# brands, then sizes\nsubfield_match ## 260a #[1-4]\nfirst_subfield_match ## 300a ^([5-9]|\\d\\d+)$\n")
    return checks.violations(_parts(t), rules)


@query("""SELECT p_partkey AS control_number, p_name || ' : ' || p_type || CASE WHEN p_size < 10 THEN ' ' || p_size ELSE '' END AS title, p_name AS main,
p_size % 2 = 0 AS is_serial, true AS in_order, true AS valid FROM part""")
def record_accessors(t: Tables) -> DataFrame:
    f = F.col("fields")
    return _parts(t).select(
        "control_number", accessors.complete_title(f).alias("title"), accessors.main_title(f).alias("main"), checks.is_serial(F.col("leader")).alias("is_serial"),
        checks.in_order(f).alias("in_order"), checks.is_valid(F.col("leader"), f).alias("valid"),
    )


# Ranges.


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_linenumber AS b, 1 + l_partkey % 40 AS c, l_quantity::INT AS v, 10 + l_suppkey % 30 AS w FROM lineitem)
SELECT l_orderkey, l_linenumber, b * 1000000 + c * 1000 + v AS lower, b * 1000000 + c * 1000 + w AS upper FROM x WHERE w > v""")
def scripture_refs(t: Tables) -> DataFrame:
    said = F.concat((1 + F.col("l_partkey") % 40).cast("string"), F.lit(", "), F.col("l_quantity").cast("int").cast("string"), F.lit("-"), (10 + F.col("l_suppkey") % 30).cast("string"))
    found = ranges.scripture(said, F.lpad(F.col("l_linenumber").cast("string"), 2, "0"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.explode(found).alias("r"))
    return rows.select("l_orderkey", "l_linenumber", F.col("r.lower").cast("int").alias("lower"), F.col("r.upper").cast("int").alias("upper"))


@query("""SELECT p_partkey, p_size * 10000 + (1 + p_partkey % 90) * 100 AS lower, p_size * 10000 + (2 + p_partkey % 90) * 100 AS upper FROM part""")
def canon_refs(t: Tables) -> DataFrame:
    said = F.concat(F.col("p_size").cast("string"), F.lit(","), (1 + F.col("p_partkey") % 90).cast("string"), F.lit("-"), (2 + F.col("p_partkey") % 90).cast("string"))
    return t.part.select("p_partkey", ranges.canons(said).alias("r")).select("p_partkey", "r.lower", "r.upper")


@query("""SELECT o_orderkey, '1000' || strftime(o_orderdate, '%Y%m%d') || '_10002030' || '1231' AS code, strftime(o_orderdate, '%Y')
|| CASE WHEN strftime(o_orderdate, '%m%d') = '0101' THEN '' ELSE strftime(o_orderdate, '-%m-%d') END || ' - 2030' AS shown FROM orders""")
def time_ranges(t: Tables) -> DataFrame:
    code = ranges.times(F.concat(F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit("-")), 2030)
    return t.orders.select("o_orderkey", code.alias("code"), ranges.times_text(code).alias("shown"))


# Scalar functions.


@query(r"""SELECT doc_id, sha1(lower(strip_accents(trim(regexp_replace(text, '[\p{P}\p{Z}\t\n\r\f\v]+', ' ', 'g'))))) AS key FROM documents""")
def title_keys(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.sha1(strings.title_key(F.col("text")).cast("binary")).alias("key"))


@query("""SELECT c_custkey, upper(left(c_mktsegment, 1)) || substr(c_mktsegment, 2) AS caps, length(c_name) - length(replace(c_name, '0', '')) AS zeros,
regexp_matches(c_name, '^.*#0+[1-9].$') AS two_digits, regexp_replace(c_name, '0+', '0', 'g') AS short,
CASE c_custkey % 10 WHEN 1 THEN c_custkey || CASE WHEN c_custkey % 100 = 11 THEN 'th' ELSE 'st' END WHEN 2 THEN c_custkey || CASE WHEN c_custkey % 100 = 12 THEN 'th' ELSE 'nd' END
WHEN 3 THEN c_custkey || CASE WHEN c_custkey % 100 = 13 THEN 'th' ELSE 'rd' END ELSE c_custkey || 'th' END AS nth FROM customer""")
def scalar_text(t: Tables) -> DataFrame:
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey", strings.initial_caps(F.col("c_mktsegment")).alias("caps"), strings.char_count(name, "0").alias("zeros"), (strings.glob(name, "*#*[1-9]?") & name.rlike("#0+..$") & ~name.rlike("#0+$")).alias("two_digits"),
        strings.collapse(name, "0").alias("short"), strings.ordinal(F.col("c_custkey")).alias("nth"),
    )


@query("""SELECT o_orderkey, julian(o_orderdate::DATE)::BIGINT AS jd, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS zulu, day(last_day(o_orderdate::DATE)) AS days,
(year(o_orderdate) % 4 = 0 AND year(o_orderdate) % 100 <> 0) OR year(o_orderdate) % 400 = 0 AS leap FROM orders""")
def date_functions(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", strings.julian_day(d.cast("date")).cast("long").alias("jd"), strings.zulu(d).alias("zulu"),
        strings.days_in_month(F.year(d), F.month(d)).cast("long").alias("days"), strings.is_leap_year(F.year(d)).alias("leap"),
    )


@query(r"""SELECT page_id, sha1(trim(regexp_replace(regexp_replace(html, '</?[A-Za-z][^>"'']*(?:(?:"[^"]*"|''[^'']*'')[^>"'']*)*>', ' ', 'g'), '\s+', ' ', 'g'))) AS text,
array_to_string(list_slice(string_split(regexp_extract(lower(url), '://([^/?#]*)', 1), '.'), -2, -1), '.') AS site FROM pages""")
def html_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.sha1(strings.strip_tags(F.col("html")).cast("binary")).alias("text"), strings.major_site(F.col("url")).alias("site"))


# Linkage, order and validation.


@query("""WITH a AS (SELECT * FROM part WHERE p_partkey % 50 = 0), m AS (
SELECT a.p_partkey AS k, 1 AS step, 'name+size' AS kind, b.p_partkey AS b FROM a JOIN part b ON a.p_name = b.p_name AND a.p_size = b.p_size WHERE a.p_brand LIKE '%1'
UNION ALL SELECT a.p_partkey, 0, 'price', b.p_partkey FROM a JOIN part b ON a.p_retailprice = b.p_retailprice WHERE a.p_brand NOT LIKE '%1')
SELECT k AS asked, any_value(kind) AS kind, count(DISTINCT b) AS n, min(b) AS first FROM m GROUP BY k""")
def match_cascade(t: Tables) -> DataFrame:
    price = F.col("p_retailprice").cast("string")
    keys = {"price": price, "name": F.col("p_name"), "size": F.col("p_size").cast("string")}
    index = matching.key_index(t.part, "p_partkey", keys)
    asked = matching.key_index(t.part.where("p_partkey % 50 = 0"), "p_partkey", keys | {"price": F.when(~F.col("p_brand").endswith("1"), price)}).withColumnRenamed("target", "asked")
    got = matching.match_cascade(asked, index, "asked", ["price", ("name", "size")])
    return got.select("asked", "kind", F.size("targets").cast("long").alias("n"), F.get("targets", F.lit(0)).alias("first"))


@query("""WITH x AS (SELECT doc_id, source, sha1(text) AS h FROM documents WHERE text IS NOT NULL), g AS (SELECT source, h, min(doc_id) AS canonical FROM x GROUP BY ALL HAVING count(*) > 1)
SELECT doc_id AS member, canonical FROM x JOIN g USING (source, h)""")
def duplicate_groups(t: Tables) -> DataFrame:
    return matching.duplicate_groups(t.documents, "doc_id", F.col("source"), F.array(F.sha1(F.col("text").cast("binary"))))


@query("""SELECT sha1(text) AS item, string_agg(DISTINCT source, ',' ORDER BY source) AS holders FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) > 1""")
def held_by_several(t: Tables) -> DataFrame:
    held = t.documents.where("text is not null").select(F.sha1(F.col("text").cast("binary")).alias("item"), "source")
    return validation.held_by_several(held, "item", "source").select("item", F.array_join("holders", ",").alias("holders"))


@query("""WITH c AS (SELECT list_transform(['SMALL', 'BRASS'], lambda q: list_max(list_transform(string_split(p_type, ' '), lambda w:
list_max(list_transform(range(0, length(q) + 1), lambda n: CASE WHEN left(w, n) = left(q, n) THEN least(n, length(w)) ELSE 0 END)) / greatest(length(w), length(q))))) AS s, p_type FROM part)
SELECT p_type, round(any_value(list_sum(s)), 6) AS score, count(*) AS n FROM c GROUP BY p_type""")
def facet_prefix_sort(t: Tables) -> DataFrame:
    facets = t.part.groupBy("p_type").agg(F.count("*").alias("n"))
    return facets.select("p_type", F.round(matching.chain_similarity(F.split("p_type", " "), ["SMALL", "BRASS"]), 6).alias("score"), "n")


@query("""SELECT 'r' || r_regionkey AS node, 0 AS level FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation
UNION ALL SELECT 'c' || c_custkey, 2 FROM customer""")
def topological_levels(t: Tables) -> DataFrame:
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = t.nation.select(name("r", "n_regionkey").alias("a"), name("n", "n_nationkey").alias("b"))
    edges = edges.union(t.customer.select(name("n", "c_nationkey"), name("c", "c_custkey")))
    return graph.levels(edges, "a", "b")


@query("""WITH n AS (SELECT n_nationkey AS k, string_agg(s_name, ', ' ORDER BY s_name) AS names FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT c_custkey, names FROM customer LEFT JOIN n ON c_nationkey = k""")
def name_synonyms(t: Tables) -> DataFrame:
    got = matching.synonyms(t.customer, t.supplier, "c_nationkey", "s_nationkey", "s_name", 100_000_000)
    return got.select("c_custkey", F.get("synonyms", F.lit(0)).alias("names"))


@query("""SELECT event_id AS record, 'value' AS name, 'mismatch' AS problem FROM events WHERE event_type = 'click' AND NOT regexp_matches(value::VARCHAR, '^[1-9]')
UNION ALL SELECT event_id, 'props', 'unexpected' FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, 'note', 'missing' FROM events WHERE event_type = 'click' AND user_id % 2 = 1""")
def harvest_validation(t: Tables) -> DataFrame:
    spark = t.spark
    rules = spark.createDataFrame(
        [(None, "click", "value", "always", "^[1-9]"), (None, "click", "props", "sometimes", None), (None, "click", "note", "sometimes", None), ("1", "click", "note", "always", None), (None, "error", "value", "ignore", "^x")],
        "origin string, kind string, name string, presence string, pattern string",
    )
    e = t.events.where("event_type in ('click', 'error')").select(F.col("event_id").alias("record"), (F.col("user_id") % 2).cast("string").alias("origin"), F.col("event_type").alias("kind"), "value", "props")
    both = F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).cast("string").alias("value")) for n in ("value", "props")))
    values = e.select("record", "origin", "kind", F.explode(both).alias("v")).select("record", "origin", "kind", "v.name", "v.value")
    return validation.validate(values, rules)


@query("""SELECT doc_id, p.phrase FROM (SELECT doc_id, ' ' || array_to_string(regexp_extract_all(lower(text), '([a-z0-9]+)', 1), ' ') || ' ' AS w FROM documents)
JOIN (SELECT unnest(['das die', 'the', 'que el']) AS phrase) p ON contains(w, ' ' || p.phrase || ' ')""")
def title_phrases(t: Tables) -> DataFrame:
    from folioframe.functions.text import words

    phrases = t.spark.createDataFrame([(["das", "die"],), (["the"],), (["que", "el"],)], "phrase array<string>")
    texts = t.documents.select("doc_id", words(F.col("text")).alias("words"))
    return validation.contained_phrases(texts, phrases, "doc_id", "words", "phrase").select("doc_id", F.array_join("phrase", " ").alias("phrase"))
