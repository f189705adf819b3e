"""Quality rules whose cutoffs carry a guarantee: few good documents of any stratum are rejected.

Everything on this path is DataFrame expressions.

* ``features`` counts words, symbols, repeated lines and repeated 3-word windows of whole texts.
* ``certified_cutoffs`` chooses, for each stratum and rule, a cutoff out of a fixed grid. Half of
  the labelled documents certify: a cutoff counts only if the exact binomial test rejects
  "more than ``max_false_rejection`` of the good documents lie above it" at level
  ``delta / (strata * rules)``; inside a rule the cutoffs are tested from lenient to strict and
  testing ends at the first that fails (fixed-sequence testing), so that all the certified
  cutoffs hold together with probability ``1 - delta``. The other half of the labels picks the
  most useful of the certified ones. No certified cutoff: the rule doesn't apply in that stratum.
* ``judge`` applies base rules and cutoffs.

Defined results: a null text has no words, fails the base rule and is not kept; a null stratum is
a stratum of its own; repeated rows are judged each for itself; repeated labels count once a
document (a document with any bad label is bad), and repeated rows of a document certify once; an empty table gives an empty result; with
no labels only the base rule holds; columns beside the named ones are passed on, but for those that the
features, base_failed and kept replace.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.text import GAP, unused, words
from kinfold.storage import stage

#: Characters that count as symbols: fixed by the contract.
SYMBOLS = "#*$%&|<>"

#: Strata up to which the cutoffs are part of the plan as literals; beyond, they are joined.
LITERAL_STRATA = 500

#: Labelled ids up to which they are broadcast (16 bytes each), so that texts are read once and no text is moved; beyond, features are joined.
BROADCAST_LABELS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Reject documents whose ``numerator / n_words`` is above a cutoff; the grid runs from lenient to strict."""

    name: str
    numerator: str
    grid: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols", (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("shouting", "n_bangs", (2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("capitals", "n_capitals", (6.0, 5.0, 4.0, 3.5, 3.0, 2.5, 2.0, 1.5, 1.2, 1.0)),
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def _repeated(w: Column) -> Column:
    """Words inside 3-word windows that the text holds twice or more.

    Windows are sorted by (hash, place) packed into one long; equal neighbours are compared by
    their words, so a collision of hashes doesn't count.
    """
    n = F.size(w)

    def count(bits: Column) -> Column:
        # The hash keeps the high bits; the low ones hold the place.
        window = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        packed = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(window(i)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))))

        def covered(keys: Column) -> Column:
            place = lambda k: k.bitwiseAND(mask).cast("int")
            same = lambda a, b: a.bitwiseXOR(b).between(F.lit(0), mask) & (window(place(a)) == window(place(b)))
            hit = lambda k, i: (F.when(i > 0, same(k, F.get(keys, i - 1))).otherwise(False)) | F.coalesce(same(k, F.get(keys, i + 1)), F.lit(False))
            starts = F.sort_array(F.transform(F.filter(keys, hit), place))
            return _let(starts, lambda s: F.aggregate(F.transform(s, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, b: a + b))

        return _let(packed, covered)

    return F.when(n < 4, F.lit(0)).otherwise(_let(F.length(F.bin(n)), count)).cast("long")


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: line.rlike("[^\\x20\\x09-\\x0D]")
    lines = F.filter(F.split(t, "\n", -1), has_word)
    return cheap_features(docs, text).withColumns(
        {
            "word_chars": F.length(F.regexp_replace(t, GAP, "")).cast("long"),
            "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": _let(words(F.col(text)), _repeated),
        }
    )


def cheap_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """What the rules divide: words, symbols, exclamation marks, capitals."""
    t = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    return docs.withColumns(
        {
            "n_words": F.regexp_count(t, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long"),
            "n_symbols": without(SYMBOLS).cast("long"),
            "n_bangs": without("!").cast("long"),
            "n_capitals": (F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}", ""))).cast("long"),
        }
    )


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), summed exactly in logarithms from the largest term down.

    The terms fall from i = k downwards while k <= n * p, which holds wherever the result matters:
    beyond the mean the tail is over a third and 1 is returned.
    """
    import math

    odds = math.log1p(-p) - math.log(p)
    n, k = n.cast("double"), k.cast("double")
    # log of the term at k: log C(n, k) as a sum of k logarithms.
    log_choose = F.aggregate(F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>")), F.lit(0.0), lambda a, i: a + F.log(n - k + i) - F.log(i.cast("double")))
    top = log_choose + k * math.log(p) + (n - k) * math.log1p(-p)
    # term(i - 1) / term(i) = i / (n - i + 1) * (1 - p) / p
    state = F.struct(F.lit(1.0).alias("sum"), F.lit(0.0).alias("log"))
    down = F.aggregate(
        F.when(k >= 1, F.sequence(k.cast("long"), F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>")),
        state,
        lambda a, i: _let(a["log"] + F.log(i.cast("double")) - F.log(n - i + 1) + F.lit(odds), lambda x: F.struct((a["sum"] + F.exp(x)).alias("sum"), x.alias("log"))),
        lambda a: a["sum"],
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(top) * down))


def certified_cutoffs(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    rules: tuple[Rule, ...] = RULES,
    max_false_rejection: float = 0.02,
    delta: float = 0.1,
    good_weight: int = 20,
) -> DataFrame:
    """stratum, rule, cutoff, n_good, n_false, p_value: the chosen cutoff for each stratum and rule that has one.

    ``labels`` holds doc_id and quality (1 good, 0 bad). Every labelled document of every stratum takes part. Rows of one id
    and text are one document.
    """
    judged = labels.where(F.col("quality").isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.min("quality").alias("_good"))
    judged = stage(judged, "judged")
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text), F.col(stratum).alias("stratum"))
    share = [F.col(r.numerator) / F.greatest(F.col("n_words"), F.lit(1)) for r in rules]
    same = F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_same")
    columns = ["_id", "stratum", same, *[x.alias(f"_x{i}") for i, x in enumerate(share)]]
    if judged.count() <= BROADCAST_LABELS:
        small = cheap_features(texts.join(F.broadcast(judged), "_id"), text).select("_good", *columns)
    else:
        small = cheap_features(texts.where(F.col("_id").isNotNull()), text).select(*columns).join(judged, "_id")
    # The test needs documents: a row that is repeated counts once.
    shares = [F.max(f"_x{i}").alias(f"_x{i}") for i in range(len(rules))]
    rows = stage(small.groupBy("stratum", "_id", "_same").agg(F.min("_good").alias("_good"), *shares), "labelled")
    part = F.pmod(F.xxhash64("_id", F.lit("split")), F.lit(2))
    long = rows.select(
        "stratum", "_good", (part == 0).alias("_certify"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(j).alias("step"), F.lit(c).cast("double").alias("cutoff"), (F.col(f"_x{i}") > c).alias("above")) for i, r in enumerate(rules) for j, c in enumerate(r.grid)])).alias("t"),
    )
    hit = lambda *conditions: F.sum(F.when(reduce(lambda a, b: a & b, conditions), 1).otherwise(0))
    good, bad, certify, above = F.col("_good") >= 1, F.col("_good") < 1, F.col("_certify"), F.col("t.above")
    tested = long.groupBy("stratum", "t.rule", "t.step", "t.cutoff").agg(
        hit(good, certify).alias("n_good"), hit(good, certify, above).alias("n_false"), (hit(bad, ~certify, above) - good_weight * hit(good, ~certify, above)).alias("gain")
    )
    level = delta / (max(rows.select("stratum").distinct().count(), 1) * len(rules))
    tested = tested.withColumn("p_value", binomial_tail(F.col("n_false"), F.col("n_good"), max_false_rejection)).withColumn("_pass", F.col("p_value") <= level)
    # At most len(grid) rows a stratum and rule: the first failure ends the sequence.
    tried = tested.groupBy("stratum", "rule").agg(
        F.coalesce(F.min(F.when(~F.col("_pass"), F.col("step"))), F.lit(1 << 20)).alias("_end"), F.collect_list(F.struct("step", "cutoff", "n_good", "n_false", "p_value", "gain")).alias("_steps")
    )
    valid = F.filter("_steps", lambda s: (s["step"] < F.col("_end")) & (s["gain"] > 0))
    best = F.array_max(F.transform(valid, lambda s: F.struct(s["gain"].alias("gain"), (-s["step"]).alias("lenient"), s["cutoff"].alias("cutoff"), s["n_good"].alias("n_good"), s["n_false"].alias("n_false"), s["p_value"].alias("p_value"))))
    return tried.select("stratum", "rule", best.alias("b")).where(F.col("b").isNotNull()).select("stratum", F.array(*[F.lit(r.name) for r in rules])[F.col("rule")].alias("rule"), "b.cutoff", "b.n_good", "b.n_false", "b.p_value")


def judge(docs: DataFrame, cutoffs: DataFrame, *, text: str = "text", stratum: str = "lang", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the features, ``base_failed`` and ``kept``."""
    out = features(docs, text)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    other, *limits = unused(out.columns, "_stratum", *(f"_c{i}" for i in range(len(rules))))
    wide = cutoffs.groupBy(F.col("stratum").alias(other)).agg(*[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(c) for r, c in zip(rules, limits)])
    few = wide.limit(LITERAL_STRATA + 1).collect()
    if len(few) <= LITERAL_STRATA:
        limit = lambda c: F.coalesce(*[F.when(F.col(stratum).eqNullSafe(F.lit(x[other])), F.lit(x[c]).cast("double")) for x in few], F.lit(None).cast("double"))
    else:
        out = out.join(wide, F.col(stratum).eqNullSafe(F.col(other)), "left")
        limit = F.col
    over = reduce(lambda a, b: a | b, [F.coalesce(F.col(r.numerator) / F.greatest(F.col("n_words"), F.lit(1)) > limit(c), F.lit(False)) for r, c in zip(rules, limits)])
    return out.withColumn("base_failed", base).withColumn("kept", ~(base | over)).drop(other, *limits)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, certified_cutoffs(docs, labels)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
