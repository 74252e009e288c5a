"""Quality rules by weak supervision, in Spark SQL functions only.

Eight rules look at counts of a text and vote +1 (good), -1 (bad) or 0 (abstain). How often
each vote pattern occurs is counted over all documents; there are at most 3^8 patterns, so
expectation-maximisation runs on that one bounded row. It estimates the share of good
documents and, for every rule, how often it votes right on good and on bad documents. A
document is kept where its posterior probability of being good is at least one half and the
base rules do not fail it.

Parameters are rounded to nine decimals in each step, so engines agree. All counts are
integers; the thresholds are in ``RULES``.

Defined results: null or empty text has no words, fails the base rules and is not kept;
very long texts are taken whole; repeated rows are counted and returned each; an empty table gives no rows; columns named in
``keep`` come back unchanged, others are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import WHITE, staged, text_or_empty, words

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
ITERATIONS = 25
# Frequent function words of some languages with Latin letters
FUNCTION_WORDS = ("the of and to in is that for it with as on by this are was be at or from "
                  "der die das und ein eine ist nicht mit den von zu auf für "
                  "le la les des du et un une est que qui dans pour sur "
                  "el los las de y en con por para se una no").split()

# name: (good condition, bad condition) as SQL text over the integer counts; neither: abstain
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words >= 40", "n_words < 20"),
    "symbols": ("100 * n_symbols <= 5 * n_words", "100 * n_symbols > 25 * n_words"),
    "lines": ("10 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    "repeats": ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "letters": ("100 * n_letters >= 90 * word_chars", "100 * n_letters < 75 * word_chars"),
    "capitals": ("100 * n_capitals <= 10 * word_chars", "100 * n_capitals > 40 * word_chars"),
    "function_words": ("100 * n_function >= 8 * n_words", "100 * n_function < 3 * n_words"),
    "variety": ("100 * n_distinct >= 40 * n_words", "100 * n_distinct < 15 * n_words"),
}
START_PRIOR, START_GOOD, START_BAD = 0.8, 0.9, 0.7
BASE_FAILED = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


def with_counts(df: DataFrame) -> DataFrame:
    """Adds the counts the rules look at, all from the whole text, as columns of ``__c``."""
    text = text_or_empty()
    d = df.withColumn("__t", text).withColumn("__w", words(F.col("__t")))
    d = d.withColumn("__wh", F.transform("__w", lambda w: F.xxhash64(w)))
    n = F.size("__wh")
    # hashes of all windows of eight words; positions are only sorted where a window repeats
    windows = F.when(n >= WINDOW_WORDS,
                     F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW_WORDS + 1, F.lit(1))),
                                 lambda i: F.xxhash64(F.slice("__wh", i, WINDOW_WORDS)))
                     ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("__h", windows)
    d = d.withColumn("__p", F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))

    def same(e: Column, j: Column) -> Column:  # as the neighbour before or after it
        return (F.get("__p", j - 1)["h"].eqNullSafe(e["h"])) | (F.get("__p", j + 1)["h"].eqNullSafe(e["h"]))

    d = d.withColumn("__r", F.array_sort(F.transform(F.filter("__p", same), lambda e: e["p"])))
    covered = F.aggregate(
        F.transform("__r", lambda p, j: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("__r", j + 1) - p, F.lit(WINDOW_WORDS)))),
        F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))
    d = d.withColumn("__l", lines)
    bare = F.regexp_replace("__t", f"[{WHITE}]+", "")
    counts = {
        "n_words": n,
        "word_chars": F.length(bare),
        "n_symbols": F.length("__t") - F.length(F.translate("__t", SYMBOLS, "")),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("__l"),
        "n_letters": F.length(F.regexp_replace("__t", r"[^\p{L}]+", "")),
        "n_capitals": F.length(F.regexp_replace("__t", r"[^\p{Lu}]+", "")),
        "n_function": F.size(F.filter("__w", lambda w: F.lower(w).isin(FUNCTION_WORDS))),
        "n_distinct": F.size(F.array_distinct("__wh")),
    }
    return d.select(*df.columns, F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]).alias("__c"))


def vote_code() -> Column:
    """The votes as one number in base 3: digit 0 bad, 1 abstain, 2 good, first rule lowest."""
    return F.expr(vote_sql(lambda c: f"CAST(({c}) AS INT)"))


def vote_sql(as_int=lambda c: f"CAST(({c}) AS INT)") -> str:
    return " + ".join(f"{3 ** i} * (1 + {as_int(good)} - {as_int(bad)})" for i, (good, bad) in enumerate(RULES.values()))


def _logit(m: Column, vote, rules: range) -> Column:
    """Log odds of good for one vote pattern under the parameters ``m``."""
    parts = [F.when(vote(i) == 1, F.log(m["good"][i] / (1 - m["bad"][i])))
             .when(vote(i) == -1, F.log((1 - m["good"][i]) / m["bad"][i])).otherwise(F.lit(0.0)) for i in rules]
    return reduce(lambda a, b: a + b, parts, F.log(m["prior"] / (1 - m["prior"])))


def _digit(code: Column, i: int) -> Column:
    return F.floor(code / F.lit(3 ** i)).cast("int") % 3 - 1


def posteriors(patterns: DataFrame, iterations: int = ITERATIONS) -> DataFrame:
    """(code, n) of all vote patterns -> (code, posterior). One row of at most 3^rules patterns."""
    rules = range(len(RULES))
    one = patterns.agg(F.array_sort(F.collect_list(F.struct("code", "n"))).alias("ps"))
    param = lambda right, all_: F.round(F.least(F.lit(0.999), F.greatest(F.lit(0.001), (right + 1.0) / (all_ + 2.0))), 9)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def step(m: Column, _i: Column) -> Column:
        # q: expected number of good documents of each pattern
        qs = F.transform("ps", lambda p: F.struct(
            p["code"].alias("code"), p["n"].cast("double").alias("n"),
            (p["n"] / (1 + F.exp(-_logit(m, lambda i: _digit(p["code"], i), rules)))).alias("q")))
        # the sums of all rules in one pass over the patterns
        zero = F.array(*[F.lit(0.0)] * (2 + 4 * len(rules)))

        def add(s: Column, p: Column) -> Column:
            q, b = p["q"], p["n"] - p["q"]
            out = [s[0] + q, s[1] + p["n"]]
            for i in rules:
                v = _digit(p["code"], i)
                out += [s[2 + 4 * i] + F.when(v == 1, q).otherwise(F.lit(0.0)),
                        s[3 + 4 * i] + F.when(v != 0, q).otherwise(F.lit(0.0)),
                        s[4 + 4 * i] + F.when(v == -1, b).otherwise(F.lit(0.0)),
                        s[5 + 4 * i] + F.when(v != 0, b).otherwise(F.lit(0.0))]
            return F.array(*out)

        return F.aggregate(qs, zero, add, lambda s: F.struct(
            param(s[0], s[1]).alias("prior"),
            F.array(*[param(s[2 + 4 * i], s[3 + 4 * i]) for i in rules]).alias("good"),
            F.array(*[param(s[4 + 4 * i], s[5 + 4 * i]) for i in rules]).alias("bad")))

    start = F.struct(F.lit(START_PRIOR).alias("prior"), F.array(*[F.lit(START_GOOD)] * len(rules)).alias("good"),
                     F.array(*[F.lit(START_BAD)] * len(rules)).alias("bad"))
    fitted = one.select("ps", F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step).alias("m"))
    return (fitted.select("m", F.explode("ps").alias("p"))
            .select(F.col("p.code").alias("code"),
                    F.round(1 / (1 + F.exp(-_logit(F.col("m"), lambda i: _digit(F.col("p.code"), i), rules))), 9)
                    .alias("posterior")))


def score_quality(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: doc_id) and a struct ``__q``: the counts, base_failed, posterior, kept."""
    keep = ["doc_id"] if keep is None else keep
    counted = with_counts(docs.select(*dict.fromkeys([*keep, "text"]))).select(*keep, "__c")
    scored = staged(counted, "quality").withColumn("__code", F.expr(_over_struct(vote_sql())))
    post = posteriors(scored.groupBy(F.col("__code").alias("code")).agg(F.count(F.lit(1)).alias("n")))
    post = post.select(F.col("code").alias("__code"), F.col("posterior").alias("__posterior"))
    failed = F.expr(_over_struct(BASE_FAILED))
    return (scored.join(F.broadcast(post), "__code")  # at most 3^8 rows
            .select(*keep, F.struct("__c.*", failed.alias("base_failed"), F.col("__posterior").alias("posterior"),
                                    (~failed & (F.col("__posterior") >= 0.5)).alias("kept")).alias("__q")))


def _over_struct(sql: str) -> str:
    import re

    return re.sub(r"\b(n_\w+|word_chars)\b", r"__c.\1", sql)
