"""Links, local holdings and made records: URLs of a record once each, headings from other scripts, notations and flags from local blocks, records of archives."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.records import checks, model
from folioframe.records.further import _fields, _first

#: Where URNs resolve, and the scripts of headings in field 880 by its link.
RESOLVERS = {"urn:": "https://nbn-resolving.org/"}
SCRIPTS = {"750-01/Hant": "hant", "750-01/Hans": "hans"}
#: Prefixes of titles of records made for archives, by the first kind that is there.
ARCHIVES = {"Nachlass": "Nachlass von ", "Teilnachlass": "Teilnachlass von "}


def authority_references(fields: Column, tags: Sequence[str] = (), prefix: str = "(DE-588)") -> Column:
    """Distinct sorted numbers in $0 of subject (6..) and local (L..) fields, of some tags or all."""
    asked = F.filter(fields, lambda f: f["tag"].rlike("^[6L]") & (f["tag"].isin(*tags) if tags else F.lit(True)))
    numbers = F.flatten(F.transform(asked, lambda f: F.transform(F.filter(f["subfields"], lambda s: (s["code"] == "0") & s["value"].startswith(prefix)), lambda s: F.substr(s["value"], F.lit(len(prefix) + 1)))))
    return F.array_sort(F.array_distinct(numbers))


def translated_headings(fields: Column, scheme: str) -> Column:
    """fields with a 750 behind them for each 880 of the scheme in a script of SCRIPTS: its $a, the scheme, and language and Z: in $9."""
    asked = F.filter(_fields(fields, "880"), lambda f: F.exists(f["subfields"], lambda s: (s["code"] == "2") & (s["value"] == scheme)))

    def heading(f: Column) -> Column:
        links = F.transform(F.filter(f["subfields"], lambda s: s["code"] == "6"), lambda s: s["value"])
        script = F.lit(None).cast("string")
        for link, code in SCRIPTS.items():
            script = F.coalesce(script, F.when(F.array_contains(links, link), code))
        shown = F.get(F.transform(F.filter(f["subfields"], lambda s: (s["code"] == "9") & s["value"].startswith("Z:")), lambda s: s["value"]), F.lit(0))
        return F.when(script.isNotNull(), _with(model.field("750", {"a": _first(f, "a"), "2": F.lit(scheme)}, " ", "7"), [F.concat(F.lit("L:"), script), shown]))

    return F.concat(fields, F.array_compact(F.transform(asked, heading)))


def _with(field: Column, nines: Sequence[Column]) -> Column:
    more = F.filter(F.array(*(F.struct(F.lit("9").alias("code"), v.alias("value")) for v in nines)), lambda s: s["value"].isNotNull())
    return F.struct(field["tag"].alias("tag"), field["ind1"].alias("ind1"), field["ind2"].alias("ind2"), F.concat(field["subfields"], more).alias("subfields"))


def _tail(url: Column) -> Column:
    return F.regexp_replace(url, r"^(?:(?!://).)*://", "")


def unique_links(fields: Column, resolvers: Mapping[str, str] = RESOLVERS) -> Column:
    """856 fields once for each target, in record order, and one added for each DOI of 024.

    A DOI under embargo, named in $x of a local 866, adds none. A link without http is completed by the resolver of its beginning (as a repository's own for its keys), else by http://. A target that was seen, or that
    ends like one seen (or it like the target) but for the scheme, takes its field away. A 856 without $u stays. The fold appends a field a step: quadratic in a record's fields.
    """
    embargo = F.flatten(F.transform(F.filter(_fields(fields, "LOK"), lambda f: _first(f, "0").startswith("866")), lambda f: F.transform(F.filter(f["subfields"], lambda s: s["code"] == "x"), lambda s: s["value"])))
    dois = F.filter(F.transform(F.filter(_fields(fields, "024"), lambda f: _first(f, "2") == "doi"), lambda f: _first(f, "a")), lambda d: (d != "") & ~F.exists(embargo, lambda x: F.contains(x, d)))
    added = F.transform(dois, lambda d: model.field("856", {"u": F.concat(F.lit("https://doi.org/"), d), "x": F.lit("doi"), "3": F.lit("Volltext")}))
    is_web = lambda u: u.rlike("^https?://")

    def step(s: Column, f: Column) -> Column:
        u = F.trim(_first(f, "u"))
        like = F.exists(s["seen"], lambda v: (is_web(v) | is_web(u)) & (_tail(v).endswith(_tail(u)) | _tail(u).endswith(_tail(v))))
        full = F.when(is_web(u), u)
        for prefix, resolver in resolvers.items():
            full = full.when(u.startswith(prefix), F.concat(F.lit(resolver), u))
        full = full.otherwise(F.concat(F.lit("http://"), u))
        again = F.array_contains(s["seen"], u) | like | F.array_contains(s["seen"], full)
        first_u = F.transform(f["subfields"], lambda x, i: F.when((x["code"] == "u") & (F.size(F.filter(F.slice(f["subfields"], 1, i), lambda y: y["code"] == "u")) == 0) & ~is_web(u), F.struct(x["code"].alias("code"), full.alias("value"))).otherwise(x))
        changed = F.struct(f["tag"].alias("tag"), f["ind1"].alias("ind1"), f["ind2"].alias("ind2"), first_u.alias("subfields"))
        link = (f["tag"] == "856") & (u != "")
        kept = F.when(~link, F.array(f)).when(again, F.array().cast(f"array<{model.FIELD}>")).otherwise(F.array(changed))
        new = F.when(link & ~F.array_contains(s["seen"], u), F.array(F.when(like, u).otherwise(full))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.concat(s["kept"], kept).cast(f"array<{model.FIELD}>").alias("kept"), F.concat(s["seen"], new).cast("array<string>").alias("seen"))

    start = F.struct(F.array().cast(f"array<{model.FIELD}>").alias("kept"), F.array().cast("array<string>").alias("seen"))
    return F.aggregate(F.concat(fields, added), start, step, lambda s: s["kept"])


# Local blocks.


def _blocks(fields: Column) -> Column:
    return F.filter(F.zip_with(fields, checks.block_starts(fields), lambda f, b: F.struct(f.alias("f"), b.alias("b"))), lambda p: p["b"] >= 0)


def local_values(fields: Column, owners: Sequence[str], local: str, code: str) -> Column:
    """Values of a code in local fields (as `936ln`) of blocks whose 852 $a is an owner's."""
    blocks = _blocks(fields)
    owned = F.transform(F.filter(blocks, lambda p: _first(p["f"], "0").startswith("852") & F.exists(p["f"]["subfields"], lambda s: (s["code"] == "a") & s["value"].isin(*owners))), lambda p: p["b"])
    asked = F.filter(blocks, lambda p: _first(p["f"], "0").startswith(local) & F.array_contains(owned, p["b"]))
    return F.filter(F.transform(asked, lambda p: _first(p["f"], code)), lambda v: v != "")


def with_notations(fields: Column, owners: Sequence[str], known: Mapping[str, str] | Sequence[str]) -> Column:
    """fields with a 652 $a of the known notations of the owners' blocks, sorted, each once, divided by colons; none adds nothing."""
    notations = F.array_sort(F.array_distinct(F.filter(local_values(fields, owners, "936ln", "a"), lambda v: v.isin(*known))))
    return F.when(F.size(notations) > 0, model.insert_field(fields, model.field("652", {"a": F.array_join(notations, ":")}), "652")).otherwise(fields)


def held_by_alone(fields: Column, owner: str) -> Column:
    """Whether local 852 $a name the owner and no other place, in any block."""
    places = F.flatten(F.transform(F.filter(_fields(fields, "LOK"), lambda f: _first(f, "0").startswith("852")), lambda f: F.transform(F.filter(f["subfields"], lambda s: s["code"] == "a"), lambda s: s["value"])))
    return (F.size(places) > 0) & F.forall(places, lambda p: p == owner)


# Made records.


def archive_records(authorities: DataFrame, kind: str = "lr", key: str = "control_number") -> DataFrame:
    """A record for each person with links to archives: BEA fields with $0 kind, whose $a names the archive, $u the target and $v kinds of material.

    Persons without a 100 $a or a number in 035 are left out; of several records with one number the one with the least key names the person, and the links of all
    count. The title says what the first link's archive holds. Persons are few; a person's links are one row.
    """
    from folioframe.records.further import authority_number

    f = F.col("fields")
    name_field = F.get(_fields(f, "100"), F.lit(0))
    part = lambda code, before="", after="": F.when(_first(name_field, code) == "", "").otherwise(F.concat(F.lit(before), _first(name_field, code), F.lit(after)))
    name = F.concat(part("a"), part("b", " "), part("c", " (", ")"))
    links = F.transform(
        F.filter(_fields(f, "BEA"), lambda b: _first(b, "0") == kind),
        lambda b: F.struct(_first(b, "u").alias("url"), _first(b, "a").alias("archive"), F.transform(F.filter(b["subfields"], lambda s: s["code"] == "v"), lambda s: s["value"]).alias("kinds")),
    )
    people = authorities.select(F.col(key).alias("k"), authority_number(f).alias("number"), name.alias("name"), F.coalesce(_first(name_field, "d"), F.lit("")).alias("dates"), links.alias("links"), _first(name_field, "a").alias("a"))
    people = people.where((F.col("a") != "") & (F.col("number") != "") & (F.size("links") > 0))
    one = people.groupBy("number").agg(F.array_sort(F.collect_list(F.struct("k", "name", "dates", "links"))).alias("p")).select("number", F.get("p", F.lit(0)).alias("first"), F.flatten(F.transform("p", lambda x: x["links"])).alias("links"))
    kinds = F.get("links", F.lit(0))["kinds"]
    opening = F.lit("Archivmaterialien zu ")
    for word, text in reversed(ARCHIVES.items()):
        opening = F.when(F.array_contains(kinds, word), text).otherwise(opening)
    who, dates = F.col("first.name"), F.col("first.dates")
    turned = F.regexp_replace(who, r"^\s*([^,(]*?)\s*,\s*([^(]*?)\s*( \(.*)?$", "$2 $1$3")
    title = F.concat(opening, turned, F.lit(","), F.when(dates == "", "").otherwise(F.concat(F.lit(" "), dates)), F.when(F.size(kinds) > 1, F.concat(F.lit(" ("), F.array_join(kinds, ", "), F.lit(")"))).otherwise(""))
    new_key = F.concat(F.lit("LR"), F.col("number"))
    zero = lambda source, value: F.struct(F.lit("0").alias("code"), F.concat(F.lit(source), value).alias("value"))
    person = model.field("100", {"a": who})
    subfields = F.concat(person["subfields"], F.array(zero("(DE-588)", F.col("number")), zero("(DE-627)", F.col("first.k"))), F.when(dates != "", F.array(F.struct(F.lit("d").alias("code"), dates.alias("value")))).otherwise(F.array().cast(f"array<{model.SUBFIELD}>")))
    main = F.struct(F.lit("100").alias("tag"), F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"), subfields.alias("subfields"))
    targets = F.transform("links", lambda x: model.field("856", {"u": x["url"], "3": F.concat(F.lit("Archivdatenbank ("), x["archive"], F.lit(")"))}))
    fields = F.concat(F.array(model.field("001", {"": new_key}, "", ""), main, model.field("245", {"a": title})), targets, F.array(model.field("ELC", {"a": F.lit("1")})))
    return one.select(new_key.alias(key), F.lit("00000npc a2200000 u 4500").alias("leader"), fields.alias("fields"))


def bundle_records(records: DataFrame, bundles: DataFrame, names: DataFrame, key: str = "control_number") -> DataFrame:
    """records with a BSP field that lists their bundles (bundle, member), sorted, and a serial record for each bundle of names (bundle, title)."""
    member = bundles.groupBy(F.col("member").alias(key)).agg(F.array_sort(F.collect_set("bundle")).alias("__b"))
    mark = F.struct(F.lit("BSP").alias("tag"), F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"), F.transform("__b", lambda b: F.struct(F.lit("a").alias("code"), b.alias("value"))).alias("subfields"))
    marked = records.join(member, key, "left").withColumn("fields", F.when(F.col("__b").isNull(), F.col("fields")).otherwise(F.concat("fields", F.array(mark))))
    made = names.select(F.col("bundle").alias(key), F.lit("00000nas a2200000 u 4500").alias("leader"), F.array(model.field("001", {"": F.col("bundle")}, "", ""), model.field("245", {"a": F.col("title")}), model.field("SPR", {"a": F.lit("1")})).alias("fields"))
    return marked.select(key, "leader", "fields").unionByName(made)
