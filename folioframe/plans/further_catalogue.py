"""Queries of record sinks and sources, further accessors, edits, dumps and incremental operators, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import stemming, strings
from folioframe.operators import dumps, enrichment, merging
from folioframe.operators.graph import _folder
from folioframe.plans.record_catalogue import _parts
from folioframe.plans.registry import Tables, query
from folioframe.records import accessors, checks, edits, further, grep, model
from folioframe.sources import files, formats
from folioframe.streaming import incremental

LEADER = "00000nam a2200000 u 4500"


def _rich(t: Tables) -> DataFrame:
    """Orders as records with fields of many kinds."""
    o, s = F.col, lambda c: F.col(c).cast("string")
    key = F.concat(F.lit("(DE-627)"), s("o_custkey"))
    fields = F.array(
        model.field("001", {"": s("o_orderkey")}, "", ""), model.field("008", {"": F.concat(F.lit("000000s"), F.date_format("o_orderdate", "yyyy"), F.lit("    xx" + " " * 18 + "ger"))}, "", ""),
        model.field("020", {"a": F.concat(F.lit("978"), s("o_custkey"))}), model.field("022", {"a": F.when(o("o_custkey") % 2 == 0, s("o_custkey"))}),
        model.field("024", {"a": F.concat(F.lit("10.1/"), s("o_custkey")), "2": F.when(o("o_custkey") % 3 == 0, "doi").otherwise("wikidata")}), model.field("035", {"a": F.concat(F.lit("(DE-588)"), s("o_custkey"))}),
        model.field("041", {"a": F.lit("ger"), "h": F.lit("eng")}), model.field("100", {"a": F.concat(F.lit("A"), s("o_custkey"))}), model.field("245", {"a": F.lit("T /"), "b": F.lit("R")}),
        model.field("264", {"c": F.date_format("o_orderdate", "yyyy-MM")}), model.field("264", {"c": F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-99"))}), model.field("264", {"c": F.lit("1800")}),
        model.field("520", {"a": F.lit("one")}), model.field("520", {"a": s("o_orderstatus")}), model.field("650", {"a": F.concat(F.lit("x:"), s("o_orderpriority")), "9": F.concat(F.lit("g:"), s("o_orderstatus"))}),
        model.field("655", {"a": F.when(o("o_orderkey") % 5 == 0, "Open Access").otherwise("Other")}), model.field("670", {"a": F.lit("Wikipedia"), "u": F.concat(F.lit("http://w/"), s("o_custkey"))}),
        model.field("700", {"a": F.lit("B")}), model.field("700", {"a": F.concat(F.lit("A"), s("o_custkey"))}), model.field("773", {"w": key, "g": F.concat(F.lit("year:"), F.date_format("o_orderdate", "yyyy"))}, "1", "8"),
        model.field("776", {"i": F.when(o("o_orderkey") % 2 == 0, "Online-Ausg.").otherwise("Druckausg."), "w": key}), model.field("856", {"z": F.when(o("o_orderkey") % 3 == 0, "kostenfrei").otherwise("nein"), "u": F.lit("u")}),
        model.field("LOK", {"0": F.lit("000 x")}), model.field("LOK", {"0": F.lit("852  "), "a": s("o_orderstatus"), "m": F.when(o("o_orderkey") % 7 == 0, "e")}),
    )
    return t.orders.select(s("o_orderkey").alias("control_number"), F.lit(LEADER).alias("leader"), fields.alias("fields"), "o_custkey", "o_orderdate")


# Sources and sinks.


@query("SELECT p_partkey::VARCHAR AS control_number, p_name || ' /' AS title, p_brand AS brand, CASE WHEN p_size % 2 = 0 THEN 's' ELSE 'm' END AS level FROM part")
def binary_files(t: Tables) -> DataFrame:
    """Records written as binary files by all tasks, in two goes, and read back in splits."""
    path = _folder(t.spark)
    parts = _parts(t).withColumn("control_number", F.col("control_number").cast("string"))
    files.write_binary(parts.where("control_number < '5'"), path, records_a_file=5000)
    files.write_binary(parts.where("control_number >= '5'"), path, "append")
    back = files.read_records(t.spark, path)
    f = F.col("fields")
    return back.select("control_number", model.first_value(f, "245", "a").alias("title"), model.first_value(f, "260", "a").alias("brand"), F.substr("leader", F.lit(8), F.lit(1)).alias("level"))


@query("SELECT p_partkey::VARCHAR AS control_number, p_name || ' /' AS title, p_size::VARCHAR AS size FROM part")
def xml_files(t: Tables) -> DataFrame:
    path = f"{_folder(t.spark)}/records.xml"
    formats.write_xml(_parts(t), path)
    back, f = files.read_xml(t.spark, path), F.col("fields")
    return back.select("control_number", model.first_value(f, "245", "a").alias("title"), model.first_value(f, "300", "a").alias("size"))


@query("SELECT n_name AS key, 'x;' || n_nationkey AS value FROM nation")
def map_files(t: Tables) -> DataFrame:
    path = _folder(t.spark)
    t.nation.select(F.concat(F.replace("n_name", F.lit(" "), F.lit("\\ ")), F.lit("=x\\;"), F.col("n_nationkey").cast("string"), F.lit(";"))).write.text(path)
    return files.read_map(t.spark, path)


@query("SELECT c_custkey::VARCHAR AS id, 1 + c_nationkey AS n, 'http://x/' || c_custkey AS target FROM customer")
def link_list_files(t: Tables) -> DataFrame:
    path = _folder(t.spark)
    lines = t.spark.createDataFrame([("#FORMAT: BEACON",), ("#TARGET: http://x/{ID}",)], "value string")
    rows = t.customer.select(F.concat(F.col("c_custkey").cast("string"), F.lit("|"), (1 + F.col("c_nationkey")).cast("string")).alias("value"))
    lines.coalesce(1).union(rows).write.text(path)
    return files.read_beacon(t.spark, path)


@query("SELECT s_suppkey::VARCHAR AS s_suppkey, 'a \"b\", ' || s_name AS note FROM supplier")
def separated_files(t: Tables) -> DataFrame:
    path = _folder(t.spark)
    rows = t.supplier.select("s_suppkey", F.concat(F.lit('a "b", '), F.col("s_name")).alias("note"))
    rows.write.option("header", True).option("escape", '"').csv(path)
    return files.read_dsv(t.spark, path)


@query("SELECT member, kind, dump FROM (VALUES ('x_aut.mrc', 'authority', 'authorities'), ('b001.raw', 'superior', 'titles'), ('tit.mrc', 'title', 'titles')) v(member, kind, dump)")
def dump_members(t: Tables) -> DataFrame:
    names = t.spark.createDataFrame([("x_aut.mrc",), ("b001.raw",), ("tit.mrc",), ("x-lok.mrc",), ("readme",)], "member string")
    return dumps.regrouped(names.withColumn("kind", formats.member_kind(F.col("member"))))


# Accessors.


@query("""SELECT o_orderkey::VARCHAR AS control_number, 'one ' || o_orderstatus AS summary, 'A' || o_custkey || '|B' AS authors, CASE WHEN o_custkey % 2 = 0 THEN o_custkey::VARCHAR ELSE '' END AS issns, '978' || o_custkey AS isbns,
CASE WHEN o_custkey % 3 = 0 THEN '10.1/' || o_custkey ELSE '' END AS dois, 'ger|eng' AS languages, o_custkey::VARCHAR AS superior, o_orderstatus AS numeric, 'x:' || o_orderpriority AS matching, 'ger,eng' AS spoken,
strftime(o_orderdate, '%Y') AS issue_year, strftime(o_orderdate, '%Y') AS year FROM orders""")
def record_facts(t: Tables) -> DataFrame:
    f, joined = F.col("fields"), lambda c: F.array_join(c, "|")
    return _rich(t).select(
        "control_number", accessors.summary(f).alias("summary"), joined(accessors.authors(f)).alias("authors"), joined(accessors.issns(f)).alias("issns"), joined(accessors.isbns(f)).alias("isbns"),
        joined(accessors.dois(f)).alias("dois"), joined(accessors.languages(f)).alias("languages"), joined(accessors.superior_keys(f)).alias("superior"), joined(accessors.numeric_values(f, "650", "9", "g")).alias("numeric"),
        joined(accessors.values_matching(f, "650", "a", "^x:")).alias("matching"), F.array_join(model.values(f, "041", "ah"), ",").alias("spoken"), accessors.issue(f)["year"].alias("issue_year"),
        accessors.publication_year(F.col("leader"), f, 2030).alias("year"),
    )


@query("""SELECT o_orderkey::VARCHAR AS control_number, '1800|' || strftime(o_orderdate, '%Y') || '-99' AS produced, o_custkey::VARCHAR AS authority, CASE WHEN o_custkey % 3 = 0 THEN '' ELSE '10.1/' || o_custkey END AS wikidata,
'http://w/' || o_custkey AS wikipedia, o_custkey::VARCHAR AS linked, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey::VARCHAR ELSE '' END AS online, o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 AS open, o_orderkey % 7 = 0 AS acquired,
'020   $a978' || o_custkey AS text, sha1('020   $a978' || o_custkey) AS hash, '264|655' AS unknown FROM orders""")
def record_links(t: Tables) -> DataFrame:
    f = F.col("fields")
    known = ("001", "008", "020", "022", "024", "035", "041", "100", "245", "520", "650", "670", "700", "773", "776", "856")
    isbn = F.get(F.filter(f, lambda x: x["tag"] == "020"), F.lit(0))
    return _rich(t).select(
        "control_number", F.array_join(further.production_dates(f), "|").alias("produced"), further.authority_number(f).alias("authority"), further.wikidata_id(f).alias("wikidata"), further.wikipedia_link(f).alias("wikipedia"),
        F.array_join(further.cross_links(f), "|").alias("linked"), F.array_join(further.cross_links(f, ("776",), "Online"), "|").alias("online"), further.is_open_access(f).alias("open"),
        further.is_acquisition(f).alias("acquired"), further.as_text(isbn).alias("text"), further.field_hash(isbn).alias("hash"), F.array_join(further.unknown_tags(f, known), "|").alias("unknown"),
    )


@query("SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_sums FROM orders")
def record_checksums(t: Tables) -> DataFrame:
    """The order of fields does not count, and neither do the tags left out."""
    f = F.filter("fields", lambda x: x["tag"].isin("035", "001"))
    return _rich(t).select(model.checksum(F.reverse(f), ["001"]).alias("h")).agg(F.count("*").alias("n"), F.countDistinct("h").alias("n_sums"))


@query("""SELECT o_orderkey::VARCHAR AS control_number, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS local_fields, '-1,0' AS numbers FROM orders""")
def local_blocks(t: Tables) -> DataFrame:
    f = F.col("fields")
    kept = F.filter(checks.drop_unused_blocks(f, "^F$"), lambda x: x["tag"] == "LOK")
    return _rich(t).select("control_number", F.size(kept).alias("local_fields"), F.array_join(F.array_distinct(checks.block_starts(f)), ",").alias("numbers"))


# Edits.


@query("""SELECT o_orderkey::VARCHAR AS control_number, '978-' || o_custkey AS isbn, 'A' || o_custkey || ';n' AS author, 'Z' || o_orderstatus AS replaced, 'eng' AS moved, 'ger' AS renamed, 3 AS n_520, 'N' AS ended, 1 AS n_700, '264b' AS retagged,
'R' AS only_b, CASE WHEN o_orderkey % 5 = 0 THEN 'OA' ELSE 'Other' END AS form FROM orders""")
def edit_functions(t: Tables) -> DataFrame:
    f = F.col("fields")
    f = edits.replace_first_if(f, "020", "a", "^978", "978-")
    f = edits.add_subfield(f, "100", "n", F.lit("n"), "^A", "a")
    f = edits.replace_field(f, "022", {"a": "r"})
    f = edits.replace_strings(f, "655", "a", {"Open Access": "OA"})
    f = edits.insert_at_end(f, model.field("520", {"a": F.lit("N")}), "520")
    f = edits.replace_code(f, "041", "a", "b")
    f = edits.retag(f, "264", "26X")
    f = edits.delete_subfields(f, "245", "a")
    f = edits.delete_first_subfield(f, "776", "i")
    f = edits.sanitize(f)
    got = _rich(t).select("control_number", f.alias("f"), F.col("o_custkey"))
    g = F.col("f")
    status = F.element_at(model.values(g, "520", "a"), 2)
    n = lambda tag: F.size(F.filter(g, lambda x: x["tag"] == tag))
    return got.select(
        "control_number", model.first_value(g, "020", "a").alias("isbn"), F.array_join(model.values(g, "100", "an"), ";").alias("author"), F.concat(F.lit("Z"), status).alias("replaced"), model.first_value(g, "041", "h").alias("moved"),
        model.first_value(g, "041", "b").alias("renamed"), n("520").alias("n_520"), F.element_at(model.values(g, "520", "a"), -1).alias("ended"), (n("700") - 1).alias("n_700"),
        F.when((n("264") == 0) & (n("26X") == 3), "264b").alias("retagged"), F.array_join(model.values(g, "245", "ab"), "").alias("only_b"), model.first_value(g, "655", "a").alias("form"),
    )


@query("SELECT p_partkey AS control_number, CASE WHEN p_brand = 'Brand#11' THEN 'First Brand' WHEN p_brand = 'Brand#12' THEN 'Second' ELSE p_brand END AS brand FROM part")
def canonical_values(t: Tables) -> DataFrame:
    loud = model.edit_values(F.col("fields"), "260", "a", lambda v: F.when(v.isin("Brand#11", "Brand#12"), F.concat(F.lit("  "), F.upper(v))).otherwise(v))
    f = further.normalised(loud, "260", "a", {"brand#11": "First Brand", "brand#12": "Second"})
    return _parts(t).select("control_number", model.first_value(f, "260", "a").alias("brand"))


@query("SELECT doc_id, sha1(text) AS text FROM documents WHERE text IS NOT NULL")
def repaired_texts(t: Tables) -> DataFrame:
    """Texts read as ISO 8859-1 and written as UTF-8 again, repaired."""
    twice = F.decode(F.col("text").cast("binary"), "ISO-8859-1")
    return t.documents.where("text is not null").select("doc_id", F.sha1(further.repaired(twice).cast("binary")).alias("text"))


# Collections.


def _lines(t: Tables) -> DataFrame:
    """A deletion list: orders with a key divisible by 3 whole, by 5 for their local data."""
    key = F.rpad(F.col("o_orderkey").cast("string"), 10, " ")
    sign = F.when(F.col("o_orderkey") % 3 == 0, "A").when(F.col("o_orderkey") % 5 == 0, "9")
    return t.orders.select(F.concat(F.lit("20240101000"), sign, key, F.lit("0001")).alias("value")).where("value is not null").union(t.spark.createDataFrame([("",), ("odd line",)], "value string"))


@query("SELECT o_orderkey::VARCHAR AS control_number, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 2 END AS local_fields FROM orders WHERE o_orderkey % 3 <> 0")
def deletion_list(t: Tables) -> DataFrame:
    got = dumps.delete(_rich(t).select("control_number", "leader", "fields"), dumps.deletions(_lines(t)))
    return got.select("control_number", F.size(F.filter("fields", lambda f: f["tag"] == "LOK")).alias("local_fields"))


@query("SELECT o_orderkey % 1000 AS k, count(*) AS n_left, count(*) FILTER (WHERE o_orderkey % 2000 >= 1000) AS n_right FROM orders GROUP BY 1 HAVING count(*) <> count(*) FILTER (WHERE o_orderkey % 2000 >= 1000)")
def strict_compare(t: Tables) -> DataFrame:
    k = (F.col("o_orderkey") % 1000).alias("k")
    return dumps.strict_difference(t.orders.select(k), t.orders.where("o_orderkey % 2000 >= 1000").select(k))


@query("SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys, 7 AS n_parts FROM orders")
def shuffled_parts(t: Tables) -> DataFrame:
    got = dumps.shuffled(t.orders.select("o_orderkey"), "o_orderkey", 5).withColumn("part", dumps.part_of(F.col("o_orderkey"), 7))
    return got.agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("n_keys"), F.countDistinct("part").cast("int").alias("n_parts"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'O') THEN 'a' ELSE 'b' END AS level FROM lineitem""")
def component_levels(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber", F.monotonically_increasing_id()).alias("control_number"), F.lit("00000naa a2200000").alias("leader"), F.array("l_orderkey").alias("parents"))
    books = t.orders.where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("control_number"))
    return dumps.fixed_levels(rows, F.col("parents"), books).select("l_orderkey", "l_linenumber", F.substr("leader", F.lit(8), F.lit(1)).alias("level"))


@query("SELECT c_custkey AS control_number, (SELECT max(year(o_orderdate)) FROM orders WHERE o_custkey = c_custkey) AS year FROM customer")
def serial_years(t: Tables) -> DataFrame:
    years = t.orders.select(F.col("o_custkey").alias("control_number"), F.year("o_orderdate").cast("bigint").alias("year"))
    return dumps.sort_years(t.customer.select(F.col("c_custkey").alias("control_number")), years)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE regexp_matches(c_mktsegment, '^(BUILD|AUTO)'))")
def journal_subset(t: Tables) -> DataFrame:
    return dumps.subset_by_parent(t.orders.select("o_orderkey", "o_custkey"), t.customer, "^(BUILD|AUTO)", "c_mktsegment", "c_custkey", "o_custkey")


@query("SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45) OR regexp_matches(p_name, '^a') AS collection FROM part")
def article_collections(t: Tables) -> DataFrame:
    return dumps.collections(t.part.select("p_partkey", "p_name"), t.lineitem.where("l_quantity > 45"), "p_partkey", "l_partkey", "p_name", "^a").select("p_partkey", "collection")


@query("SELECT p_partkey AS control_number, CASE WHEN p_size < 10 THEN 'de:D' || p_size || '|en:E' ELSE 'en:old' END AS headings FROM part")
def heading_translations(t: Tables) -> DataFrame:
    records = _parts(t).withColumn("fields", F.concat("fields", F.array(model.field("750", {"a": F.lit("old"), "9": F.lit("en")}))))
    small = t.part.where("p_size < 10")
    new = small.select(F.col("p_partkey").alias("control_number"), F.lit("en").alias("language"), F.lit("E").alias("text")).union(small.select("p_partkey", F.lit("de"), F.concat(F.lit("D"), F.col("p_size").cast("string"))))
    got = dumps.translated_headings(records, new)
    shown = F.transform(F.filter("fields", lambda f: f["tag"] == "750"), lambda f: F.concat(model.first_value(F.array(f), "750", "9"), F.lit(":"), model.first_value(F.array(f), "750", "a")))
    return got.select("control_number", F.array_join(F.array_sort(shown), "|").alias("headings"))


# Joins of links and local data.


@query("SELECT c_custkey, coalesce((SELECT string_agg(DISTINCT l, ',' ORDER BY l) FROM (SELECT 'even' AS l WHERE c_custkey % 2 = 0 UNION ALL SELECT 'three' WHERE c_custkey % 3 = 0)), '') AS lists FROM customer")
def link_lists(t: Tables) -> DataFrame:
    def one(k: int) -> DataFrame:
        return t.customer.where(f"c_custkey % {k} = 0").select(F.col("c_custkey").alias("id"), F.lit(1).alias("n"), F.lit("x").alias("target"))

    got = enrichment.link_lists(t.customer.select("c_custkey"), {"even": one(2), "three": one(3)}, "c_custkey")
    return got.select("c_custkey", F.array_join(F.coalesce(F.transform("links", lambda x: x["list"]), F.expr("cast(array() as array<string>)")), ",").alias("lists"))


@query("SELECT p_partkey, 'http://' || p_brand AS url FROM part WHERE p_size % 2 = 1")
def missing_urls(t: Tables) -> DataFrame:
    items = t.part.select("p_partkey", F.upper("p_brand").alias("doi"), F.when(F.col("p_size") % 2 == 0, F.array(F.concat(F.lit("http://"), F.col("p_brand")))).otherwise(F.expr("cast(array() as array<string>)")).alias("known"))
    urls = t.part.select(F.lower("p_brand").alias("doi"), F.concat(F.lit("http://"), F.col("p_brand")).alias("link")).distinct()
    return enrichment.missing_urls(items, urls, "p_partkey", "doi", "link", "known")


@query("SELECT o_orderkey::VARCHAR AS control_number, CASE WHEN o_orderstatus = 'F' THEN 3 ELSE 2 END AS local_fields FROM orders")
def local_data(t: Tables) -> DataFrame:
    local = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("control_number"), F.array(model.field("LOK", {"0": F.lit("938  "), "a": F.lit("l")})).alias("fields"))
    got = enrichment.add_local(_rich(t).select("control_number", "leader", "fields"), local)
    return got.select("control_number", F.size(F.filter("fields", lambda f: f["tag"] == "LOK")).alias("local_fields"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def preferred_records(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_mktsegment")
    return enrichment.prefer(rows, rows.where("c_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("new")), "c_custkey")


@query("SELECT k, count(*) AS n FROM (SELECT CASE WHEN c_nationkey < 5 THEN 100 + c_nationkey ELSE c_nationkey END AS k FROM customer) GROUP BY k")
def swapped_keys(t: Tables) -> DataFrame:
    renamed = t.nation.where("n_nationkey < 5").select(F.col("n_nationkey").alias("ref"), (100 + F.col("n_nationkey")).alias("new"))
    return merging.swap_keys(t.customer.select("c_custkey", F.col("c_nationkey").alias("k")), renamed, "k").groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey::VARCHAR AS control_number, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE '(DE-627)' || o_custkey END AS link FROM orders")
def obsolete_references(t: Tables) -> DataFrame:
    gone = t.customer.where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("ref"))
    got = enrichment.without_references(_rich(t).select("control_number", "leader", "fields"), gone, ("773",), "w", r"^\(DE-627\)(.+)$")
    return got.select("control_number", model.first_value(F.col("fields"), "773", "w").alias("link"))


@query("""SELECT p_partkey, k AS keyword FROM part, (VALUES ('hot plate'), ('small'), ('widget'), ('Small Widget')) v(k) WHERE contains(' ' || lower(p_name) || ' ', ' ' || lower(k) || ' ')""")
def title_keywords(t: Tables) -> DataFrame:
    """Whole words count, singly or side by side; none of these has an ending of the language asked for."""
    keywords = t.spark.createDataFrame([("hot plate",), ("small",), ("widget",), ("Small Widget",)], "k string")
    return stemming.keywords_in_titles(t.part, keywords, "p_partkey", "p_name", "k", "none", 4)


@query("""SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(text), '([a-z]+)', 1), lambda w: w NOT IN ('the', 'der', 'die', 'que')), ' ') AS words FROM documents WHERE text IS NOT NULL""")
def content_words(t: Tables) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)
    return t.documents.where("text is not null").select("doc_id", F.array_join(stemming.without_stop_words(words, ["the", "DER", "die", "que"]), " ").alias("words"))


@query("""WITH m AS (SELECT user_id, event_type, event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00')
SELECT user_id AS "user", event_type AS feed, count(*) AS n, max(ts) AS newest FROM m GROUP BY ALL""")
def feed_digests(t: Tables) -> DataFrame:
    items = t.events.select(F.concat_ws("/", "event_type", "user_id").alias("feed"), "ts", F.col("event_id").alias("item_id"), F.col("event_type").alias("title"))
    users = t.events.select(F.col("user_id").alias("user"), F.concat_ws("/", "event_type", "user_id").alias("feed"), F.expr("timestamp '2024-01-05 00:00:00'").alias("notified")).distinct()
    got = incremental.digests(items, users, "ts")
    return got.select("user", F.substring_index("feed", "/", 1).alias("feed"), "n", F.get("items", F.lit(0))["ts"].alias("newest"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'url' ELSE 'hash' END AS "by", 1000000 + p_partkey AS record FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""")
def deliveries(t: Tables) -> DataFrame:
    """Items delivered by url if their key is even, by hash if it is divisible by three; deliveries that failed do not count."""
    key, record = F.col("p_partkey"), (1000000 + F.col("p_partkey")).alias("id")
    items = t.part.select("p_partkey", F.array(F.concat(F.lit("http://x/"), key.cast("string"))).alias("urls"), F.sha1(key.cast("string").cast("binary")).alias("h"))
    known = t.part.select(record, F.when(key % 3 == 0, F.sha1(key.cast("string").cast("binary"))).alias("hash"), F.when((key % 2 == 0) | (key % 3 == 0), "ok").otherwise("error").alias("state"))
    urls = t.part.where("p_partkey % 2 = 0").select(record.alias("record_id"), F.concat(F.lit("https://x/"), key.cast("string"), F.lit("/")).alias("url"))
    return incremental.delivered(items, urls, known, "p_partkey", "h", ("error",)).select("p_partkey", "by", F.get("records", F.lit(0)).alias("record"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE event_type <> 'error') AS kept, true AS within FROM events")
def cache_expiry(t: Tables) -> DataFrame:
    ends = incremental.expiry(F.col("event_id"), F.col("ts"), F.col("event_type") == "error")
    within = ends.isNull() | ends.between(F.col("ts") + F.expr("interval 30 days"), F.col("ts") + F.expr("interval 60 days"))
    return t.events.select(ends.alias("e"), within.alias("w")).agg(F.count("*").alias("n"), F.count_if(F.col("e").isNull()).alias("kept"), F.bool_and("w").alias("within"))


# Strings and incremental.


@query("""SELECT o_orderkey, regexp_replace(reverse(regexp_replace(reverse(o_orderkey::VARCHAR), '(\\d{3})', '\\1,', 'g')), '^,', '') AS grouped, CASE WHEN length(o_orderpriority) <= 6 THEN o_orderpriority ELSE left(o_orderpriority, 3) || '...' END AS cut, '"' || o_orderpriority || ', x"' AS csv,
regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS letters FROM orders""")
def string_forms(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", strings.grouped(F.col("o_orderkey")).alias("grouped"), strings.truncate(p, 6).alias("cut"), strings.csv_field(F.concat(p, F.lit(", x"))).alias("csv"), strings.only_chars(p, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("letters")
    )


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 240 HOUR AND ts <= TIMESTAMP '2024-01-10 00:00:00'")
def recent_items(t: Tables) -> DataFrame:
    return incremental.recent(t.events, "ts", "2024-01-10 00:00:00", 240).select("event_id", "user_id")


@query("SELECT p_partkey AS control_number FROM part WHERE p_size BETWEEN 10 AND 20 AND p_brand = 'Brand#11'")
def term_and_range(t: Tables) -> DataFrame:
    f = F.col("fields")
    return _parts(t).where((model.first_value(f, "260", "a") == "Brand#11") & grep.in_ranges(F.transform(f, lambda x: x), "300", "a", [("10", "20")]) & (F.length(model.first_value(f, "300", "a")) == 2)).select("control_number")
