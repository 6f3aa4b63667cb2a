"""Quality rules with risk-controlled thresholds.

Fixed base rules come first. Then each rule of ``RULES`` measures a share or a mean of a
document, and the cutoff from which it rejects is learned for each stratum (language)
from labelled documents: candidate cutoffs are tried from the mildest on, and a cutoff
holds if an exact binomial test shows, at a level corrected for all strata and rules
tested, that it rejects at most ``risk`` of the good documents. The first failure ends
the walk (fixed-sequence testing, so cutoffs within a walk need no further correction);
strata and rules are corrected by Bonferroni. A stratum with too few good labels to prove
anything keeps all its documents.

Only DataFrame functions are used. Words are runs of other than space, tab, line feed,
vertical tab, form feed and carriage return.

Defined cases: a null text has no words and fails the base rules; documents without a
language form a stratum of their own; labels without a document, or with a null quality,
are not used; repeated labels of a document count once, and a document is good only if all
its labels say so; repeated documents each get their row. Extra columns pass through.
Further columns named like a measure are replaced in the measured result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyrill.llm.storage import materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_echoes"]


@dataclass(frozen=True)
class Rule:
    """Reject where ``value`` is above a cutoff; ``cutoffs`` run from mild to strict."""

    name: str
    value: str
    cutoffs: tuple[float, ...]


def _steps(first: float, last: float, n: int) -> tuple[float, ...]:
    return tuple(round(first + (last - first) * i / (n - 1), 6) for i in range(n))


RULES = (
    Rule("symbols_per_word", "n_symbols / n_words", _steps(3.0, 0.05, 60)),
    Rule("upper_share", "n_upper / word_chars", _steps(1.0, 0.1, 46)),
    Rule("dup_line_share", "n_dup_lines / n_lines", _steps(0.9, 0.1, 33)),
    Rule("echo_share", "n_echoes / n_words", _steps(0.9, 0.05, 35)),
    Rule("mean_word_chars", "word_chars / n_words", _steps(40.0, 10.0, 61)),
)
RISK = 0.02
LEVEL = 0.05


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``MEASURES``, all long."""
    squeezed = F.translate(F.coalesce(F.col(text), F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    words = F.filter(F.split(squeezed, " "), lambda w: w != "")
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.translate(line, SPACES, "") != "")
    kept = [c for c in docs.columns if c not in MEASURES]
    step = docs.select(
        *kept,
        words.alias("_words"),
        lines.alias("_lines"),
        F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", ""))).cast("long").alias("n_upper"),
    )
    n = F.size("_words")
    hashes = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    step = step.select(
        *kept,
        "word_chars", "n_symbols", "n_upper",
        n.cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda w, i: F.coalesce(F.get("_words", i - 1) == w, F.lit(False)))).cast("long").alias("n_echoes"),
        hashes.alias("_hashes"),
    )
    repeated = F.size("_hashes") > F.size(F.array_distinct("_hashes"))
    return step.withColumn("n_repeat_words", F.when(repeated, _covered("_hashes")).otherwise(F.lit(0)).cast("long")).select(
        *kept, *MEASURES
    )


def _covered(hashes: str) -> Column:
    """Words in windows that occur twice or more, each word once.

    Windows are sorted with their positions, so equal ones are neighbours; the positions
    of those with an equal neighbour, sorted again, each add the words up to the next.
    """
    pairs = F.sort_array(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    keys = F.transform(pairs, lambda p: p["h"])

    def positions(both: Column) -> Column:
        ordered, key = both["p"], both["k"]
        again = F.filter(
            F.transform(ordered, lambda p, i: F.struct(
                p["i"].alias("i"),
                ((F.get(key, i - 1) == p["h"]) | (F.get(key, i + 1) == p["h"])).alias("twice"),
            )),
            lambda x: F.coalesce(x["twice"], F.lit(False)),
        )
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    # One-element arrays hold a value that the inner functions use many times.
    both = F.array(F.struct(pairs.alias("p"), keys.alias("k")))
    return F.get(F.transform(F.transform(both, positions), total), F.lit(0))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _log_gamma(x: Column) -> Column:
    """Stirling's series for x + 8, carried down to x by the recurrence."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    down = x
    for k in range(1, 8):
        down = down * (x + k)
    return (y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727) + series - F.log(down)


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """P(at most k of n) where each happens with probability ``risk``; 1 from the mean on.

    Terms are summed downwards from k, where each is smaller than the one before; those
    beyond 12 standard deviations cannot change the result.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = F.exp(
        _log_gamma(nd + 1) - _log_gamma(kd + 1) - _log_gamma(nd - kd + 1)
        + kd * F.log(F.lit(risk)) + (nd - kd) * F.log(F.lit(1 - risk))
    )
    terms = F.least(k, (12 * F.sqrt(nd * risk) + 50).cast("long"))
    odds = (1 - risk) / risk
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), terms),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, i: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * (kd - i) * odds / (nd - kd + i + 1)).alias("term"),
        ),
        lambda a: a["sum"],
    )
    return F.when(kd >= nd * risk, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * total))


def _first_exceeded(rule: Rule) -> Column:
    """Index of the mildest cutoff that rejects the document; their number if none does."""
    value = F.expr(rule.value)
    return F.size(F.filter(F.array(*[F.lit(c) for c in rule.cutoffs]), lambda c: ~(value > c)))


def cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    stratum: str = "lang",
    key: str = "doc_id",
    risk: float = RISK,
    level: float = LEVEL,
) -> DataFrame:
    """One row per stratum with the cutoff of each rule, null where none could be proven.

    Of the cutoffs proven safe, the one with the largest surplus of rejected bad over
    rejected good labelled documents, the mildest of equals.
    Each rule may reject ``risk / len(rules)`` of the good documents, so together they
    reject ``risk`` at most, with probability ``1 - level`` for all strata at once.
    """
    verdicts = (
        labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col(key).alias("_key")).agg((F.min("quality") == 1).alias("_good"))
    )
    tried = [F.struct(F.lit(r.name).alias("rule"), _first_exceeded(r).alias("step")) for r in rules]
    counted = materialize(
        measured.filter(~base_failed())
        .select(F.col(key), F.col(stratum).alias("_stratum"), F.explode(F.array(*tried)).alias("t"))
        .join(verdicts, F.col(key) == F.col("_key"))
        .groupBy("_stratum", F.col("t.rule").alias("rule"), F.col("t.step").alias("step"))
        .agg(F.count_if("_good").alias("good"), F.count_if(~F.col("_good")).alias("bad")),
        "quality-counts",
    )
    tests = max(1, counted.select("_stratum").distinct().count() * len(rules))
    grid = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), F.lit(0).alias("good"), F.lit(0).alias("bad"))
        for r in rules for i, c in enumerate(r.cutoffs)
    ])
    every = counted.select("_stratum").distinct().select("_stratum", F.explode(grid).alias("g")).select("_stratum", "g.*")
    walk = Window.partitionBy("_stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_stratum", "rule")
    per_rule = risk / len(rules)
    steps = (
        every.unionByName(counted.withColumn("cutoff", F.lit(None).cast("double")))
        .groupBy("_stratum", "rule", "step")
        .agg(F.max("cutoff").alias("cutoff"), F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        .withColumns({
            "n": F.sum("good").over(whole),
            "rejected": F.sum("good").over(walk),
            "caught": F.sum("bad").over(walk),
        })
        .filter(F.col("cutoff").isNotNull())
    )
    proven = (
        steps.withColumn("fails", (binomial_tail(F.col("rejected"), F.col("n"), per_rule) > level / tests).cast("int"))
        .withColumn("failed", F.max("fails").over(walk))
        .filter("failed = 0")
    )
    best = proven.groupBy("_stratum", "rule").agg(
        F.min_by("cutoff", F.struct(F.col("rejected") - F.col("caught"), F.col("step"))).alias("cutoff")
    )
    strata = every.select("_stratum").distinct()
    chosen = best.groupBy("_stratum").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{r.name}") for r in rules]
    )
    return strata.join(
        chosen.withColumnRenamed("_stratum", "_s"), F.col("_stratum").eqNullSafe(F.col("_s")), "left"
    ).drop("_s").withColumnRenamed("_stratum", "cut_stratum")


def decide(
    measured: DataFrame, cuts: DataFrame, rules: tuple[Rule, ...] = RULES, stratum: str = "lang", most: int = 100_000
) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``.

    The cutoffs, a row per stratum, are broadcast while their counted number is at most
    ``most`` and joined by a shuffle beyond it.
    """
    side = F.broadcast(cuts) if cuts.count() <= most else cuts
    over = F.lit(False)
    for r in rules:
        over = over | F.coalesce(F.expr(r.value) > F.col(f"cut_{r.name}"), F.lit(False))
    checked = measured.withColumn("base_failed", base_failed())
    joined = checked.join(side, F.col(stratum).eqNullSafe(F.col("cut_stratum")), "left")
    return joined.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~over)).drop(*cuts.columns)


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Every column of ``docs`` with measures, ``base_failed`` and ``kept``.

    Documents are measured once, into the shared folder.
    """
    measured = materialize(measures(docs), "quality")
    cuts = materialize(cutoffs(measured, labels, **options), "quality-cutoffs")
    return decide(measured, cuts, options.get("rules", RULES), options.get("stratum", "lang"))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: its measures and whether it is kept."""
    slim = docs.select("doc_id", "text", "lang")
    measured = materialize(measures(slim).drop("text"), "quality")
    cuts = materialize(cutoffs(measured, labels), "quality-cutoffs")
    return decide(measured, cuts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
