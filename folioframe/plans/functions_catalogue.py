"""Queries of text, number, time and markup functions, of further sources, and of options of the query languages, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions import language, strings, text
from folioframe.operators.graph import _folder
from folioframe.plans.record_catalogue import _parts
from folioframe.plans.registry import Tables, query
from folioframe.records import edits, grep
from folioframe.records.query import compile_query
from folioframe.sources import formats, messages
from folioframe.streaming import events, incremental


def _string(name: str):
    return F.col(name).cast("string")


@query("""SELECT c_custkey, replace(c_name, '#', '|') AS words, c_mktsegment = 'BUILDING' AS phrase, true AS capital, regexp_matches(c_name, '^[0-9]+$') AS digits, c_acctbal >= 0 AS amount, c_name || ' ' || c_mktsegment AS flat,
CASE WHEN c_custkey % 2 = 0 THEN '97800' || lpad(c_custkey::VARCHAR, 8, '0') END AS isbn, '1234-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS issn, 'jose ' || lower(c_mktsegment) AS author, 'a\\"' || c_custkey || '\\n' AS literal FROM customer""")
def word_forms(t: Tables) -> DataFrame:
    name, key, lit = F.col("c_name"), _string("c_custkey"), F.lit
    isbn = F.concat(lit("978-00"), F.lpad(key, 8, "0"), F.when(F.col("c_custkey") % 2 == 0, "").otherwise("9"))
    return t.customer.select(
        "c_custkey", F.array_join(strings.chop_words(name), "|").alias("words"), strings.has_phrase(F.split(F.concat(lit("in the "), "c_mktsegment"), " "), F.array(lit("the"), lit("BUILDING"))).alias("phrase"),
        strings.is_initial_caps(name).alias("capital"), strings.is_unsigned(name).alias("digits"), strings.is_decimal(F.col("c_acctbal").cast("decimal(12,2)").cast("string")).alias("amount"),
        text.collapse_space(F.concat(lit(" "), name, lit(" \t\n"), "c_mktsegment", lit("\n"))).alias("flat"), strings.isbn(isbn).alias("isbn"),
        strings.issn(F.concat(lit("1234"), F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0"))).alias("issn"), strings.author_key(F.concat("c_mktsegment", lit(", José M. "), lit("K."))).alias("author"),
        strings.c_escape(F.concat(lit('a"'), key, lit("\n"))).alias("literal"),
    )


@query("""SELECT p_partkey, round(1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type)), 9) AS alike,
left(p_type, (list_max(list_transform(range(0, 15), lambda k: CASE WHEN left(p_type, k) = left('SMALL ANODIZED', k) AND k <= length(p_type) THEN k ELSE 0 END)))::INT) AS prefix,
right(p_name, (list_max(list_transform(range(0, 13), lambda k: CASE WHEN right(p_name, k) = right('small widget', k) AND k <= length(p_name) THEN k ELSE 0 END)))::INT) AS suffix FROM part""")
def text_measures(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.round(text.similarity(F.col("p_name"), F.col("p_type")), 9).alias("alike"), strings.common_prefix(F.col("p_type"), F.lit("SMALL ANODIZED")).alias("prefix"), strings.common_suffix(F.col("p_name"), F.lit("small widget")).alias("suffix")
    )


@query("""WITH a AS (SELECT o_orderkey AS n, lpad(o_orderkey::VARCHAR, 8, '0') AS d, '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz' AS z FROM orders), b AS (SELECT *, (11 - list_sum(list_transform(range(1, 9), lambda k: substr(d, k::INT, 1)::INT * (10 - k)))::BIGINT % 11) % 11 AS c FROM a)
SELECT n AS o_orderkey, ltrim(substr(z, (n // 238328 % 62 + 1)::INT, 1) || substr(z, (n // 3844 % 62 + 1)::INT, 1) || substr(z, (n // 62 % 62 + 1)::INT, 1) || substr(z, (n % 62 + 1)::INT, 1), '0') AS base62, CASE WHEN c = 10 THEN 'X' ELSE c::VARCHAR END AS digit,
concat_ws(' ', CASE WHEN n // 60000 > 0 THEN n // 60000 || 'm' END, CASE WHEN n // 1000 % 60 > 0 THEN n // 1000 % 60 || 's' END, CASE WHEN n % 1000 > 0 THEN n % 1000 || 'ms' END) AS span,
CASE WHEN n % 6 < 4 THEN [1994, 49, 8, 3999][(n % 6 + 1)::INT]::VARCHAR END AS roman FROM b WHERE n > 0 AND n < 3600000""")
def number_forms(t: Tables) -> DataFrame:
    n = F.col("o_orderkey")
    numeral = F.get(F.array(*map(F.lit, ["MCMXCIV", "xlix", "VIII", "MMMCMXCIX", "IIX", "abc"])), (n % 6).cast("int"))
    return t.orders.where("o_orderkey > 0 and o_orderkey < 3600000").select(
        "o_orderkey", strings.base62(n).alias("base62"), text.key_check_digit(F.lpad(n.cast("string"), 8, "0"), 8).alias("digit"), strings.milliseconds(n).alias("span"), strings.roman(numeral).cast("string").alias("roman")
    )


@query("""SELECT page_id, sha1(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&apos;')) AS escaped, sha1(html) AS back, sha1(url) AS decoded,
regexp_extract(lower(url), '^([a-z]+://[^/?#]*)', 1) || coalesce(nullif(regexp_extract(url, '://[^/?#]*([^#]*)', 1), ''), '/') AS canonical FROM pages""")
def markup_forms(t: Tables) -> DataFrame:
    html, url = F.col("html"), F.col("url")
    return t.pages.select(
        "page_id", F.sha1(strings.escape_html(html).cast("binary")).alias("escaped"), F.sha1(strings.unescape_html(strings.escape_html(html)).cast("binary")).alias("back"),
        F.sha1(F.url_decode(strings.url_encode(url)).cast("binary")).alias("decoded"), strings.canonical_url(url).alias("canonical"),
    )


@query("""SELECT event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS mail, julian(ts::DATE)::BIGINT AS day, ts::DATE AS back FROM events""")
def time_forms(t: Tables) -> DataFrame:
    day = strings.julian_day(F.col("ts").cast("date"))
    return t.events.select("event_id", strings.rfc1123(F.col("ts")).alias("mail"), day.cast("long").alias("day"), strings.from_julian_day(day).cast("timestamp").alias("back"))


# Sources.


@query("SELECT 'f' AS feed, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey::VARCHAR ELSE 'http://x/' || s_suppkey END AS item_id, s_name || ' <&>' AS title, 'http://x/' || s_suppkey AS link, TIMESTAMP '2024-02-03 04:05:06' + INTERVAL (s_nationkey) DAY AS pub_date FROM supplier")
def feed_files(t: Tables) -> DataFrame:
    path, key = _folder(t.spark), _string("s_suppkey")
    stamp = F.date_format(F.date_add(F.lit("2024-02-03").cast("date"), F.col("s_nationkey").cast("int")), "EEE, dd MMM yyyy")
    items = t.supplier.select(F.when(F.col("s_suppkey") % 2 == 0, key).alias("guid"), F.concat("s_name", F.lit(" <&>")).alias("title"), F.concat(F.lit("http://x/"), key).alias("link"), F.concat(stamp, F.lit(" 04:05:06 +0000")).alias("pubDate"))
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return formats.read_feed(t.spark, path, "f").drop("description")


@query("""SELECT o_custkey::VARCHAR AS identifier, strftime(max(o_orderdate), '%Y-%m-%d') AS datestamp, max(CASE WHEN o_orderdate = latest THEN o_orderkey % 3 = 0 ELSE false END) AS deleted, 's' AS sets
FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS latest FROM orders) GROUP BY o_custkey""")
def harvest_files(t: Tables) -> DataFrame:
    path = _folder(t.spark)
    header = F.struct(_string("o_custkey").alias("identifier"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("datestamp"), F.array(F.lit("s")).alias("setSpec"), F.when(F.col("o_orderkey") % 3 == 0, "deleted").alias("_status"))
    t.orders.select(header.alias("header")).write.format("xml").option("rootTag", "ListRecords").option("rowTag", "record").save(path)
    return formats.read_harvest(t.spark, path).withColumn("sets", F.array_join("sets", ","))


@query("""SELECT 'r' || n_regionkey AS section, n_name AS name, n_nationkey || ' # "x"' AS value FROM nation UNION ALL SELECT 'all', 'a', '1' UNION ALL SELECT 'r' || r_regionkey, 'a', '1' FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)""")
def section_files(t: Tables) -> DataFrame:
    path = _folder(t.spark)
    entry = F.concat(F.regexp_replace("n_name", r"[\[\]]", ""), F.lit(' = "'), _string("n_nationkey"), F.lit(' # \\"x\\"" ; note'))
    per = t.nation.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(entry)), "\n").alias("lines"))
    section = F.concat(F.lit("[r"), _string("n_regionkey"), F.lit(']\n@inherit "all"\n'), "lines")
    per.agg(F.concat(F.lit("[all]\na = 1\n"), F.array_join(F.array_sort(F.collect_list(section)), "\n"))).write.text(path)
    return formats.read_sections(t.spark, path)


@query("""SELECT '{"n_regionkey":[' || string_agg(n_regionkey::VARCHAR, ',' ORDER BY n_regionkey, n_name) || '],"n_name":[' || string_agg('"' || n_name || '"', ',' ORDER BY n_regionkey, n_name) || ']}' AS json FROM nation""")
def column_report(t: Tables) -> DataFrame:
    return formats.column_json(t.nation, ["n_regionkey", "n_name"], ["n_regionkey", "n_name"])


@query("""SELECT 'c' || c_custkey || '@x' AS sender, TIMESTAMP '2026-01-03 01:05:34' AS received, c_name || ' folded' AS subject, c_mktsegment AS body FROM customer""")
def mailbox_files(t: Tables) -> DataFrame:
    path = _folder(t.spark)
    message = F.concat(F.lit("From c"), _string("c_custkey"), F.lit("@x Sat Jan  3 01:05:34 2026\nSubject: "), "c_name", F.lit("\n folded\nTo: me\n\n"), "c_mktsegment")
    t.customer.select(message).write.text(path)
    return messages.read_mailbox(t.spark, path).select("sender", "received", "subject", F.trim(F.regexp_replace("body", r"\n+\z", "")).alias("body"))


@query("""SELECT p_partkey::VARCHAR AS reference, '10.1/' || p_partkey AS doi, '978' || p_size AS isbn, p_name AS title, p_type AS subtitle, p_brand || ', A|Corp' AS contributors FROM part""")
def product_messages(t: Tables) -> DataFrame:
    path, lit, null = _folder(t.spark), F.lit, F.lit(None).cast("string")
    number = lambda kind, value: F.struct(lit(kind).alias("ProductIDType"), value.alias("IDValue"))
    title = lambda kind, a, b: F.struct(lit(kind).alias("TitleType"), F.array(F.struct(a.alias("TitleText"), b.alias("Subtitle"))).alias("TitleElement"))
    person = F.struct(F.concat("p_brand", lit(", A")).alias("PersonNameInverted"), null.alias("CorporateName"))
    detail = F.struct(F.array(title("02", lit("other"), lit("none")), title("01", F.col("p_name"), F.col("p_type"))).alias("TitleDetail"), F.array(person, F.struct(null.alias("PersonNameInverted"), lit("Corp").alias("CorporateName"))).alias("Contributor"))
    products = t.part.select(_string("p_partkey").alias("RecordReference"), F.array(number("15", F.concat(lit("978"), _string("p_size"))), number("06", F.concat(lit("10.1/"), _string("p_partkey")))).alias("ProductIdentifier"), detail.alias("DescriptiveDetail"))
    products.write.format("xml").option("rootTag", "ONIXMessage").option("rowTag", "Product").save(path)
    return messages.read_onix(t.spark, path).select("reference", "doi", "isbn", "title", "subtitle", F.array_join("contributors", "|").alias("contributors"))


@query("SELECT p_partkey, p_name || ' & ' || replace(p_type, ' ', '') AS words FROM part")
def transcriptions(t: Tables) -> DataFrame:
    spans = F.concat(F.lit('<p><span x="1">'), "p_name", F.lit(" &amp;</span><b>no</b><span>"), F.replace("p_type", F.lit(" "), F.lit("¬</span> <span>")), F.lit("</span></p>"))
    return t.part.select("p_partkey", messages.tei_text(spans).alias("words"))


# Streams and alerts.


@query("SELECT user_id AS item_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def stored_items(t: Tables) -> DataFrame:
    """Items of a stream, stored once for each key; a second run of the stream adds nothing."""
    path, schema = _folder(t.spark), t.events.schema
    for run in range(2):
        items = t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/events.parquet*").select(F.col("user_id").alias("item_id"), "event_id")
        incremental.store_new_items(items, f"{path}/items", f"{path}/checkpoint-{run}").awaitTermination()
    return t.spark.read.parquet(f"{path}/items")


_ALERTS = "WITH s AS (SELECT c_custkey, TIMESTAMP '1992-01-01' + INTERVAL (c_nationkey * 60) DAY AS seen FROM customer) "


def _subscriptions(t: Tables) -> tuple[DataFrame, DataFrame]:
    seen = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_nationkey") * 60).cast("int")).cast("timestamp").cast("timestamp_ntz")
    return t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("ts")), t.customer.select("c_custkey", seen.alias("seen"))


@query(_ALERTS + "SELECT c_custkey, o_orderkey FROM s JOIN orders ON o_custkey = c_custkey AND o_orderdate > seen")
def item_alerts(t: Tables) -> DataFrame:
    return events.alerts(*_subscriptions(t), "c_custkey", "ts", "seen").select("c_custkey", "o_orderkey")


@query(_ALERTS + "SELECT c_custkey, greatest(any_value(seen), max(CASE WHEN o_orderdate > seen THEN o_orderdate ELSE seen END)) AS seen FROM s LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def advanced_marks(t: Tables) -> DataFrame:
    items, subscriptions = _subscriptions(t)
    sent = events.alerts(items, subscriptions, "c_custkey", "ts", "seen")
    return events.advanced(subscriptions, sent, "c_custkey", "ts", "seen").select("c_custkey", "seen")


# Options of the query languages.


@query("""WITH k AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS n FROM part WHERE p_size < 30) SELECT p_partkey AS control_number, 0 AS place, '260a' AS label, p_brand AS value FROM k JOIN part USING (p_partkey) WHERE n % 3 = 0""")
def grep_options(t: Tables) -> DataFrame:
    """Only listed records, of which every third."""
    listed = t.part.where("p_size < 30").select(F.col("p_partkey").alias("control_number"))
    return grep.grep(_parts(t), '"260a"', control_numbers=listed, every=3)


@query("SELECT p_partkey AS control_number FROM part WHERE regexp_matches(p_partkey::VARCHAR, '^1.*[02468]$') AND p_brand <> 'Brand#2' AND p_size % 2 = 0")
def control_number_ops(t: Tables) -> DataFrame:
    """Records kept by a pattern of their keys, dropped by a value, and kept by level."""
    kept = edits.apply_ops(_parts(t).withColumn("control_number", _string("control_number")), "keep 001:^1.*[02468]$\ndrop 260a:^Brand#2$\nkeep-level s")
    return kept.select(F.col("control_number").cast("bigint").alias("control_number"))


@query("SELECT p_partkey AS control_number FROM part WHERE p_size % 2 = 0 AND (p_brand = 'Brand#1' OR p_size >= 40)")
def query_functions(t: Tables) -> DataFrame:
    condition = compile_query('IsSerial() AND (HasValue("260a", "Brand#1") OR 300a == /^[45]./) AND NOT IsMonograph()')
    return _parts(t).where(condition).select("control_number")


@query(r"""WITH w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '(\p{L}+)')) AS w FROM documents WHERE lang IS NOT NULL), c AS (SELECT doc_id, lang, '_' || w || '_' AS w, count(*) AS n FROM w GROUP BY ALL),
g AS (SELECT doc_id, lang, n, substr(w, i, k) AS ngram FROM (SELECT *, unnest(range(1, length(w) - k + 2)) AS i FROM (SELECT *, unnest(range(1, 6)) AS k FROM c) WHERE length(w) >= k)),
d AS (SELECT doc_id, lang, ngram, sum(n) AS n FROM g WHERE ngram <> '_' GROUP BY ALL), s AS (SELECT lang, ngram, sum(n) AS n FROM d GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, ngram) AS r FROM s),
m AS (SELECT lang, ngram, n / sqrt(sum(n::DOUBLE * n) OVER (PARTITION BY lang)) AS weight FROM r WHERE r <= 400), x AS (SELECT doc_id, m.lang, sum(d.n * weight) AS dot FROM d JOIN m USING (ngram) GROUP BY ALL),
y AS (SELECT doc_id, sqrt(sum(n::DOUBLE * n)) AS norm FROM d GROUP BY doc_id) SELECT doc_id, arg_max(lang, dot) AS lang, round(max(dot) / any_value(norm), 6) AS score FROM x JOIN y USING (doc_id) GROUP BY doc_id""")
def profiled_languages(t: Tables) -> DataFrame:
    rows = t.documents.where("lang is not null")
    got = language.candidates(rows.select("doc_id", "text"), language.profiles(rows, "lang", "text"), "doc_id", "text", "lang")
    shared = got.where("score > 0").groupBy("doc_id").agg(F.min("lang").alias("lang"), F.max("score").alias("score"))  # of equal ones the first
    return shared.select("doc_id", "lang", F.round("score", 6).alias("score"))
