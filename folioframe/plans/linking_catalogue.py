"""Queries of conversions, scripture in queries and titles, links, local blocks, made records, registers and tags, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import scalars, scripture
from folioframe.operators import registers
from folioframe.plans.registry import Tables, query
from folioframe.records import linking, model

BOOKS = {"1mose": "01", "ruth": "08", "markus": "41", "4esra": "78"}
SPELLINGS = {"1mos": "1mose", "mk": "markus", "mark": "markus"}


def _text(name: str):
    return F.col(name).cast("string")


@query(r"""SELECT p_partkey, trim(p_name, 'aeiou') AS trimmed, CASE WHEN length(p_brand) >= 9 THEN p_brand ELSE lpad(p_brand, 9, '.') END AS padded, regexp_matches(p_type, '^(SMALL|PROMO)') AS small, list_reduce(list_transform([p_name, p_brand], lambda s: replace(s, ' ', '\ ')), lambda a, b: a || ' ' || b) AS joined,
p_name AS first, lower(to_hex(p_size)) AS hex_size, lower(hex(p_name)) AS hex_name, p_size::BIGINT AS from_hex, array_to_string(list_filter(string_split(p_type, ' '), lambda s: s <> ''), '|') AS parts,
CASE WHEN length(p_type) <= 12 THEN p_type ELSE substr(p_type, 1, 9) || '...' END AS short, replace(p_brand, '#', '#') AS printable, CASE WHEN p_size % 3 = 0 THEN true WHEN p_size % 3 = 1 THEN false END AS truth FROM part""")
def scalar_conversions(t: Tables) -> DataFrame:
    joined = scalars.join_escaped(F.array("p_name", "p_brand"), " ")
    word = F.when(F.col("p_size") % 3 == 0, "Yes").when(F.col("p_size") % 3 == 1, "OFF").otherwise("perhaps")
    return t.part.select(
        "p_partkey", scalars.trim_chars(F.col("p_name"), "aeiou").alias("trimmed"), scalars.padded(F.col("p_brand"), 9, ".").alias("padded"), scalars.starts_with_any(F.col("p_type"), ["SMALL", "PROMO"]).alias("small"),
        joined.alias("joined"), F.get(scalars.split_escaped(joined, " "), F.lit(0)).alias("first"), scalars.in_base(F.col("p_size"), 16).alias("hex_size"), scalars.to_hex(F.col("p_name")).alias("hex_name"),
        scalars.number(scalars.in_base(F.col("p_size"), 16), 16).alias("from_hex"), F.array_join(scalars.split_trimmed(F.col("p_type"), " "), "|").alias("parts"), scalars.shortened(F.col("p_type"), 12).alias("short"),
        scalars.from_quoted_printable(scalars.quoted_printable(F.col("p_brand"))).alias("printable"), scalars.truth(word).alias("truth"),
    )


@query("""SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS shown, o_orderdate::TIMESTAMP AS read,
strftime(o_orderdate::TIMESTAMP AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Berlin', '%Y-%m-%d %H:%M:%S') AS local,
'[' || strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00Z TO ' || strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') || 'T00:00:00Z] OR [1970-01-01T00:00:00Z TO 1970-01-01T00:00:07Z]' AS asked FROM orders""")
def time_conversions(t: Tables) -> DataFrame:
    day, seconds = F.date_format("o_orderdate", "yyyy-MM-dd"), F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    spans = F.concat(seconds.cast("string"), F.lit(":"), (seconds + 86400).cast("string"), F.lit(" 0:7"))
    return t.orders.select(
        "o_orderkey", scalars.reformatted(day, "yyyy-MM-dd", "dd.MM.yyyy").alias("shown"), scalars.time_of(F.concat(day, F.lit("T01:00:00+01:00"))).alias("read"),
        scalars.local_time(F.concat(day, F.lit("T00:00:00Z")), "Europe/Berlin").alias("local"), scalars.dates_query(spans).alias("asked"),
    )


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey % 150 + 1 AS c, l_suppkey % 90 + 1 AS v, l_quantity::INT AS w FROM lineitem), y AS (SELECT *, lpad(c::VARCHAR, 3, '0') AS cc, lpad(v::VARCHAR, 3, '0') AS vv FROM x)
SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN '01' || cc || '000-01' || cc || '999|41001002-41001002' WHEN 2 THEN '41' || cc || vv || '-41' || cc || vv WHEN 3 THEN '08000000-08999999'
WHEN 4 THEN '78001000-78002999' WHEN 5 THEN '78' || lpad((c + 14)::VARCHAR, 3, '0') || vv || '-78' || lpad((c + 14)::VARCHAR, 3, '0') || vv WHEN 6 THEN CASE WHEN w > v THEN '41' || cc || vv || '-41' || cc || lpad(w::VARCHAR, 3, '0') END END AS found FROM y""")
def scripture_queries(t: Tables) -> DataFrame:
    """References in queries: books with numerals and spellings, several with OR, aliases, shifted books, rising and falling ranges, unknown books."""
    c, v, w = ((x).cast("int").cast("string") for x in (F.col("l_partkey") % 150 + 1, F.col("l_suppkey") % 90 + 1, F.col("l_quantity")))
    lit, n = F.lit, F.col("l_linenumber")
    asked = F.when(n == 1, F.concat(lit("1 Mos "), c, lit(" or Genre"))).when(n == 2, F.concat(lit("MK"), c, lit(":"), v, lit("b"))).when(n == 3, lit("the Moabite")).when(n == 4, lit("5 Ezra"))
    asked = asked.when(n == 5, F.concat(lit("6Esra "), c, lit(","), v)).when(n == 6, F.concat(lit("Mark "), c, lit(", "), v, lit("-"), w)).otherwise(F.concat(lit("Nobody "), c))
    parts = F.transform(F.split(asked, "(?i) or "), lambda p: scripture.aliased(p, {"genre": "mk 1,2", "themoabite": "ruth"}))
    found = scripture.references(F.array_join(parts, " OR "), BOOKS, SPELLINGS)
    return t.lineitem.select("l_orderkey", "l_linenumber", F.array_join(F.transform(found, lambda r: F.concat_ws("-", r["lower"], r["upper"])), "|").alias("found"))


@query("""SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'good ' || 'samaritan' WHEN 1 THEN 'mk ' || p_size WHEN 2 THEN '1 mos. ' || p_size || ',2' WHEN 4 THEN 'samaritan' END AS reference FROM part WHERE p_size % 5 <> 3""")
def scripture_suggestions(t: Tables) -> DataFrame:
    s, lit, k = _text("p_size"), F.lit, F.col("p_size") % 5
    title = F.when(k == 0, F.concat("p_name", lit(" The GOOD   Samaritan"))).when(k == 1, F.concat(lit("on Mk "), s)).when(k == 2, F.concat(lit("to 1 Mos. "), s, lit(",2 and after"))).when(k == 3, F.concat(lit("3 Mai "), s)).otherwise(lit("A Samaritan"))
    return scripture.suggestions(t.part.select("p_partkey", title.alias("title")), "p_partkey", "title", {"samaritan": "a", "good samaritan": "b"}, BOOKS, SPELLINGS)


def _linked(t: Tables) -> DataFrame:
    """Orders as records with links, headings of another script, and local blocks of two owners."""
    o, s = F.col, _text
    fields = F.array(
        model.field("001", {"": s("o_orderkey")}, "", ""), model.field("024", {"a": F.concat(F.lit("10.1/"), s("o_custkey")), "2": F.lit("doi")}), model.field("650", {"0": F.concat(F.lit("(DE-588)"), s("o_custkey"))}),
        model.field("856", {"u": F.concat(F.lit("http://h/"), s("o_orderkey"))}), model.field("856", {"u": F.concat(F.lit("h/"), s("o_orderkey"))}), model.field("856", {"u": F.when(o("o_orderkey") % 2 == 0, F.concat(F.lit("urn:"), s("o_custkey"))).otherwise("w.org")}),
        model.field("880", {"6": F.when(o("o_orderkey") % 3 == 0, "750-01/Hant").otherwise("100-02"), "a": s("o_orderstatus"), "2": F.lit("own"), "9": F.lit("Z:q")}),
        model.field("LOK", {"0": F.lit("000 x")}), model.field("LOK", {"0": F.lit("852  "), "a": F.lit("one")}), model.field("LOK", {"0": F.lit("936ln"), "a": s("o_orderstatus")}), model.field("LOK", {"0": F.lit("936ln"), "a": F.lit("F")}),
        model.field("LOK", {"0": F.lit("000 x")}), model.field("LOK", {"0": F.lit("852  "), "a": F.when(o("o_orderkey") % 4 == 0, "one").otherwise("two")}), model.field("LOK", {"0": F.lit("936ln"), "a": F.lit("A")}),
        model.field("LOK", {"0": F.lit("866  "), "x": F.when(o("o_orderkey") % 5 == 0, F.concat(F.lit("10.1/"), s("o_custkey"), F.lit(" from 2030")))}),
    )
    return t.orders.select(s("o_orderkey").alias("control_number"), fields.alias("fields"))


@query("""SELECT o_orderkey::VARCHAR AS control_number, 'http://h/' || o_orderkey || '|' || CASE WHEN o_orderkey % 2 = 0 THEN 'https://nbn-resolving.org/urn:' || o_custkey ELSE 'http://w.org' END || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '|https://doi.org/10.1/' || o_custkey END AS links,
CASE WHEN o_orderkey % 3 = 0 THEN '  ' || o_orderstatus || ',own,L:hant,Z:q' END AS heading, o_custkey::VARCHAR AS refs, o_orderkey % 4 = 0 AS alone,
array_to_string(list_sort(list_distinct(list_filter(['F', o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN 'A' END], lambda x: x IN ('A', 'F', 'O')))), ':') AS notations FROM orders""")
def record_links(t: Tables) -> DataFrame:
    f = F.col("fields")
    heading = F.get(F.transform(F.filter(linking.translated_headings(f, "own"), lambda x: x["tag"] == "750"), lambda x: F.concat(F.lit("  "), F.array_join(F.transform(x["subfields"], lambda s: s["value"]), ","))), F.lit(0))
    return _linked(t).select(
        "control_number", F.array_join(model.values(linking.unique_links(f), "856", "u"), "|").alias("links"), heading.alias("heading"), F.array_join(linking.authority_references(f), "|").alias("refs"),
        linking.held_by_alone(f, "one").alias("alone"), model.first_value(linking.with_notations(f, ["one"], ["A", "F", "O"]), "652", "a").alias("notations"),
    )


@query("""SELECT 'LR' || s_suppkey AS control_number, CASE WHEN s_nationkey % 3 = 0 THEN 'Nachlass von ' WHEN s_nationkey % 3 = 1 THEN 'Teilnachlass von ' ELSE 'Archivmaterialien zu ' END || 'F ' || s_name || ',' || ' 18' || (s_nationkey + 10) || '-' ||
CASE WHEN s_nationkey % 3 = 1 THEN ' (Teilnachlass, Briefe)' ELSE '' END AS title, s_name || ', F|(DE-588)' || s_suppkey || '|(DE-627)' || s_suppkey || '|18' || (s_nationkey + 10) || '-' AS person, 'u' || s_suppkey || ',v' AS targets FROM supplier WHERE s_nationkey % 7 <> 0""")
def archive_records(t: Tables) -> DataFrame:
    lit, s, k = F.lit, _text, F.col("s_nationkey")
    link = model.field("BEA", {"0": lit("lr"), "a": lit("Arch"), "u": F.concat(lit("u"), s("s_suppkey")), "v": F.when(k % 3 == 0, "Nachlass").when(k % 3 == 1, "Teilnachlass")})
    more = F.when(k % 3 == 1, F.array(F.struct(lit("v").alias("code"), lit("Briefe").alias("value")))).otherwise(F.array().cast(f"array<{model.SUBFIELD}>"))
    first = F.struct(lit("BEA").alias("tag"), lit(" ").alias("ind1"), lit(" ").alias("ind2"), F.concat(link["subfields"], more).alias("subfields"))
    fields = F.array(
        model.field("035", {"a": F.concat(lit("(DE-588)"), s("s_suppkey"))}), model.field("100", {"a": F.when(k % 7 != 0, F.concat("s_name", lit(", F"))), "d": F.concat(lit("18"), (k + 10).cast("string"), lit("-"))}),
        first, model.field("BEA", {"0": lit("lr"), "a": lit("B"), "u": lit("v")}), model.field("BEA", {"0": lit("xx"), "u": lit("w")}),
    )
    made, f = linking.archive_records(t.supplier.select(s("s_suppkey").alias("control_number"), fields.alias("fields"))), F.col("fields")
    return made.select("control_number", model.first_value(f, "245", "a").alias("title"), F.array_join(model.values(f, "100", "a0d"), "|").alias("person"), F.array_join(model.values(f, "856", "u"), ",").alias("targets"))


@query("""SELECT c_custkey::VARCHAR AS control_number, CASE WHEN c_custkey % 2 = 0 THEN 'even' || CASE WHEN c_custkey % 3 = 0 THEN ',third' ELSE '' END WHEN c_custkey % 3 = 0 THEN 'third' ELSE '' END AS bundles, 't' AS title FROM customer
UNION ALL SELECT 'even', '', 'Even ones'""")
def bundle_records(t: Tables) -> DataFrame:
    key = _text("c_custkey")
    records = t.customer.select(key.alias("control_number"), F.lit("x").alias("leader"), F.array(model.field("245", {"a": F.lit("t")})).alias("fields"))
    bundles = t.customer.select(key.alias("member"), F.explode(F.array_compact(F.array(F.when(F.col("c_custkey") % 2 == 0, "even"), F.when(F.col("c_custkey") % 3 == 0, "third")))).alias("bundle"))
    made, f = linking.bundle_records(records, bundles, t.spark.createDataFrame([("even", "Even ones")], "bundle string, title string")), F.col("fields")
    return made.select("control_number", F.array_join(model.values(f, "BSP", "a"), ",").alias("bundles"), model.first_value(f, "245", "a").alias("title"))


# Registers, tags and collections.


def _versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("t"), F.min_by("o_orderpriority", "o_orderkey").alias("name"), F.min_by("o_orderstatus", "o_orderkey").alias("status"))
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("t"), F.max_by("o_orderpriority", "o_orderkey").alias("name"), F.when(F.count("*") % 2 == 0, F.max_by("o_orderstatus", "o_orderkey")).alias("status"))
    return first, last


_VERSIONS = """WITH v AS (SELECT o_custkey, min(o_orderdate) AS t, max(o_orderdate) AS u, arg_min(o_orderpriority, o_orderkey) AS name, arg_max(o_orderpriority, o_orderkey) AS name2, arg_min(o_orderstatus, o_orderkey) AS status,
CASE WHEN count(*) % 2 = 0 THEN arg_max(o_orderstatus, o_orderkey) END AS status2 FROM orders GROUP BY o_custkey) """


@query(_VERSIONS + """SELECT o_custkey, 'name' AS attribute, name AS before, name2 AS after, date_diff('day', t::DATE, u::DATE) AS days FROM v WHERE name <> name2
UNION ALL SELECT o_custkey, 'status', status, status2, date_diff('day', t::DATE, u::DATE) FROM v WHERE status <> status2""")
def register_changes(t: Tables) -> DataFrame:
    return registers.register_changes(*_versions(t), "o_custkey", "t", ["name", "status"]).withColumn("days", F.col("days").cast("long"))


@query(_VERSIONS + "SELECT o_custkey, u AS t, name2 AS name, coalesce(status2, status) AS status FROM v")
def register_merged(t: Tables) -> DataFrame:
    return registers.register_merged(*_versions(t), "o_custkey", "t", ["name", "status"])


@query("""SELECT l_orderkey, l_linenumber, s_nationkey, CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE l_partkey::VARCHAR END AS volume, left(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey::VARCHAR ELSE l_returnflag || '-long' END, 8) AS issue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey < 12""")
def journal_articles(t: Tables) -> DataFrame:
    articles = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", _text("l_partkey").alias("volume"), F.when(F.col("l_linenumber") % 2 == 1, F.concat("l_returnflag", F.lit("-long"))).alias("issue"))
    journals = t.supplier.where("s_nationkey < 12").select("s_suppkey", "s_nationkey")
    return registers.journal_articles(articles, journals, "l_suppkey", "s_suppkey").select("l_orderkey", "l_linenumber", "s_nationkey", "volume", "issue")


def _tags(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    tags = t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("tag"))
    return tags, t.lineitem.select(F.col("l_partkey").alias("tag_id"), F.col("l_orderkey").alias("resource_id")), t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("record_id"))


@query("""SELECT o_custkey AS record_id, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS keywords FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def tag_keywords(t: Tables) -> DataFrame:
    return registers.tag_keywords(*_tags(t)).select("record_id", F.array_join("keywords", "|").alias("keywords"))


@query("""WITH kept AS (SELECT l_partkey, l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 15))
SELECT 'tags' AS kind, count(*) AS n, sum(p_partkey)::BIGINT AS s FROM part WHERE p_partkey IN (SELECT l_partkey FROM kept) UNION ALL SELECT 'uses', count(*), sum(l_partkey)::BIGINT FROM kept
UNION ALL SELECT 'resources', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM kept)""")
def clean_tags(t: Tables) -> DataFrame:
    gone = t.customer.where("c_nationkey < 15").select(F.col("c_custkey").alias("record_id"))
    tags, uses, resources = registers.clean_tags(*_tags(t), gone)
    counted = [df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum(c).cast("long").alias("s")) for kind, df, c in (("tags", tags, "id"), ("uses", uses, "tag_id"), ("resources", resources, "id"))]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query("SELECT c_custkey, count(o_orderkey) AS n_articles FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def collection_sizes(t: Tables) -> DataFrame:
    return registers.collection_sizes(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_custkey")


@query("""SELECT p_type AS term, arg_min(p_brand || ',' || p_name, p_partkey) AS synonyms FROM part WHERE p_size % 3 = 0 GROUP BY p_type""")
def reference_terms(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", F.array(F.concat("p_type", F.lit(", gnd/12345678"))).alias("a"), F.when(F.col("p_size") % 3 == 0, F.array(F.concat("p_brand", F.lit(", ,"), "p_name"))).otherwise(F.array("p_name", F.lit("98765432X"))).alias("b"))
    return registers.reference_terms(parts, F.col("a"), F.col("b"), "p_partkey")


@query("""WITH a AS (SELECT p_partkey, p_name, string_split(p_type, ' ') AS c FROM part), b AS (SELECT *, list_position(list_transform(c, lambda w: left(w, 1) = 'B'), true) AS k FROM a)
SELECT p_partkey, array_to_string(CASE WHEN coalesce(k, 0) < 2 THEN c ELSE list_transform(c, lambda w, i: CASE WHEN i = 1 THEN c[k] WHEN i = k THEN c[1] ELSE w END) END, ' ') AS chain FROM b""")
def aligned_chains(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.array_join(registers.aligned_chain(F.split("p_type", " "), ["B"]), " ").alias("chain"))


@query("""SELECT doc_id, coalesce(CASE WHEN lang IS NOT NULL THEN upper(source) END, source) AS title, text IS NOT NULL AND text <> '' AS has_text FROM documents""")
def localized_documents(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.col("source").alias("title"), F.when(F.col("lang").isNotNull(), F.upper("source")).alias("title_de"), registers.has_any_text(["text"]).alias("has_text"))
    return registers.localized_columns(rows, ["title"], "de").select("doc_id", "title", "has_text")
