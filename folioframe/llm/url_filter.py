"""URL filters: host and path rules, and a character language-model ratio for what no rule decides.

Everything is DataFrame and SQL expressions. The symbols of all of a URL behind its scheme, query and fragment
included (letters, one symbol for all digits, dot, slash, hyphen, one for all else), are modelled by two Markov models of order
two, one learnt from accepted URLs and one from rejected ones. Each model interpolates the orders: the
estimate of an order is smoothed towards that of the next lower one by KAPPA pseudo-counts, so the
order in effect varies with how often a context was seen. A URL's score is the difference of the
log-likelihoods divided by its symbols.

The alphabet has 32 symbols, so the table of log-ratios has 32,768 entries whatever the corpus; it and the
threshold are scalar subqueries. The threshold is calibrated on a fifth of the decided URLs (by MD5) that
training leaves out: the bin edge with the least sum of error rates. Counting grams is a hash
aggregation with map-side combine over at most 65,536 keys.

Edge cases: a null url has empty host and path, no rule, and score 0; one without :// has empty host and path, but is scored as it stands; without
accepted or without rejected URLs every score is 0 and the threshold 0, so the method allows; repeated
rows are judged each; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Symbols by number: the start, the letters, all digits, and the rest. Texts are written with the digit of base 32 for each.
ALPHABET = "^abcdefghijklmnopqrstuvwxyz0./-_"
SIZE = len(ALPHABET)
DIGITS = "0123456789abcdefghijklmnopqrstuv"
KAPPA = 4.0
#: Score bins of the calibration: a hundredth each, from -BINS to BINS.
BINS = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(host, _UPPER, _LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The rule that fits and is longest (of equals, the first): struct<rule, verdict>, null if none fits."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule: string, verdict: string>")


def text_of(url: Column) -> Column:
    """What the models see: all behind the scheme, or the url itself where there is no ://."""
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(url)


def symbols(url: Column) -> Column:
    """The symbols of a url as digits of base 32."""
    text = F.regexp_replace(F.translate(url, _UPPER, _LOWER), r"[^a-z0-9./-]", "_")
    return F.translate(F.regexp_replace(text, r"[0-9]", "0"), ALPHABET[1:], DIGITS[1:])


def grams(text: Column) -> Column:
    """Each symbol with the two before it, as three digits: found by the regex engine, so no expression runs for each character."""
    return F.regexp_extract_all(F.concat(F.lit(DIGITS[0] * 2), text), F.lit("(?=(...))"), F.lit(1))


def code_of(gram: Column) -> Column:
    return F.conv(gram, SIZE, 10).cast("int")


def log_ratios(decided: DataFrame) -> DataFrame:
    """One row `model`: log p(accepted) - log p(rejected) of each gram code, from rows (text, accepted boolean)."""
    spark = decided.sparkSession
    seen = decided.select("accepted", F.explode(grams(F.col("text"))).alias("gram"))
    counts = seen.groupBy(code_of(F.col("gram")).alias("code")).agg(
        F.count_if("accepted").cast("double").alias("good"), F.count_if(~F.col("accepted")).cast("double").alias("bad")
    )
    grid = spark.range(0, SIZE**3, 1, 1).select(F.col("id").cast("int").alias("code")).join(F.broadcast(counts), "code", "left").na.fill(0.0)
    code = F.col("code")
    sums = {
        "ab": Window.partitionBy(F.floor(code / SIZE)),
        "bc": Window.partitionBy(code % (SIZE * SIZE)),
        "b": Window.partitionBy(F.floor(code / SIZE) % SIZE),
        "c": Window.partitionBy(code % SIZE),
        "n": Window.partitionBy(F.lit(0)),
    }
    kinds = ("good", "bad")
    # Over the grid alone, whose size is fixed.
    grid = grid.select("code", *(F.col(k).alias(f"{k}_abc") for k in kinds), *(F.sum(k).over(window).alias(f"{k}_{name}") for name, window in sums.items() for k in kinds))

    def log_p(kind: str) -> Column:
        p = (F.col(f"{kind}_c") + 1) / (F.col(f"{kind}_n") + SIZE)
        p = (F.col(f"{kind}_bc") + KAPPA * p) / (F.col(f"{kind}_b") + KAPPA)
        return F.ln((F.col(f"{kind}_abc") + KAPPA * p) / (F.col(f"{kind}_ab") + KAPPA))

    both = (F.col("good_n") > 0) & (F.col("bad_n") > 0)
    ratio = F.when(both, log_p("good") - log_p("bad")).otherwise(F.lit(0.0))
    pairs = grid.agg(F.sort_array(F.collect_list(F.struct("code", ratio.alias("ratio")))).alias("pairs"))
    return pairs.select(F.transform("pairs", lambda p: p["ratio"]).alias("model"))


def score(text: Column, model: Column) -> Column:
    """Mean log-ratio of the symbols of text; 0 for empty text. model: array<double> by gram code."""
    total = F.aggregate(grams(text), F.lit(0.0), lambda total, gram: total + F.get(model, code_of(gram)))
    return F.when(F.length(text) > 0, total / F.length(text)).otherwise(F.lit(0.0))


def threshold_of(scored: DataFrame) -> DataFrame:
    """One row `threshold` from rows (score, accepted): scores from it on are allowed."""
    binned = scored.groupBy(F.greatest(F.lit(-BINS), F.least(F.lit(BINS), F.floor(F.col("score") * 100))).alias("bin")).agg(
        F.count_if("accepted").alias("good"), F.count_if(~F.col("accepted")).alias("bad")
    )
    everything, before = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    lost = F.coalesce(F.sum("good").over(before), F.lit(0)) / F.greatest(F.sum("good").over(everything), F.lit(1))
    passed = (F.sum("bad").over(everything) - F.coalesce(F.sum("bad").over(before), F.lit(0))) / F.greatest(F.sum("bad").over(everything), F.lit(1))
    best = binned.select((F.col("bin") / 100).alias("edge"), (lost + passed).alias("cost"))
    return best.agg(F.coalesce(F.min_by("edge", F.struct("cost", F.abs("edge"))), F.lit(0.0)).alias("threshold"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, score) of each row. rules: (verdict, 'host/path') pairs, verdict allow or block."""
    url = F.col(url_col).cast("string")
    parts = pages.select(
        F.col(id_col).alias("id"), F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"), F.coalesce(text_of(url), F.lit("")).alias("whole")
    )
    rows = parts.select("id", "host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("fit"), symbols(F.col("whole")).alias("text"))
    decided = rows.where("fit is not null").select("text", (F.col("fit.verdict") == "allow").alias("accepted"))
    aside = F.conv(F.left(F.md5(F.col("text").cast("binary")), F.lit(4)), 16, 10).cast("int") % 5 == 0
    # A subquery may not stand inside a higher-order function, so the model is a column first.
    model = log_ratios(decided.where(~aside)).scalar().alias("model")
    tried = decided.where(aside).select("*", model).select("accepted", score(F.col("text"), F.col("model")).alias("score"))
    threshold = threshold_of(tried).scalar()
    scored = rows.select("*", model).select("*", score(F.col("text"), F.col("model")).alias("score"))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("score") >= threshold, "allow").otherwise("block"))
    return scored.select(
        F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.col("score").alias("score")
    )
