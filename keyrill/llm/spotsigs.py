"""Document fingerprints by SpotSigs.

Common words are anchors. Each occurrence of one, with the chain of the next ``CHAIN`` content
words (words that are not anchors) after it, is a signature; the set of a text's signatures, as
hashes in order, is its fingerprint. Two fingerprints are compared by the Jaccard
coefficient of their sets. ``similar`` finds all pairs from a threshold on: sets are
partitioned by length, since sets whose lengths differ by more than the threshold allows
cannot reach it, and within neighbouring partitions only sets that share one of their
smallest signatures (as many as leave too few others) are candidates; those whose lengths
prune them go before the coefficient is computed. Texts with the same set are compared once.

Only DataFrame functions are used.

Defined cases: a null text is empty. A text without any signature (no anchor followed by enough
content words) has the hash of the whole text as its only signature, so equal texts agree and
others do not. Documents of one doc_id are ordered by a hash of the text; documents without
doc_id come last in descending order; the only document of a table is followed by itself.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 2
DIGITS = 8  # hexadecimal digits of a signature in a fingerprint
DOCS_PER_RANGE = 512
MOST_RANGES = 10_000

# Common words of English, German, French and Spanish.
ANCHORS = tuple(
    (
        "a an and are as at be but by for from had has have he her his in is it not of on or she that the their they this to "
        "was were which with you "
        "als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es hat ich im ist mit nach nicht "
        "oder sich sie sind um und von vor war wie wird zu zum zur über "
        "au aux avec ce ces cette dans de des du elle en est et il je la le les leur lui mais ne nous on ou par pas pour que "
        "qui sa se ses son sur un une vous à "
        "al como con de del el ella en era es esta este ha la las lo los más me mi no para pero por que se sin su sus un una y"
    ).split()
)


def signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> Column:
    """The sorted set of a text's signatures as numbers of ``DIGITS`` hexadecimal digits."""
    known = sorted(set(anchors))

    def of_words(words: Column) -> Column:
        anchor = lambda w: w.isin(known)
        spots = F.filter(F.transform(words, lambda w, i: F.when(anchor(w), i)), lambda i: i.isNotNull())
        return F.struct(words.alias("words"), spots.alias("spots"), F.filter(words, lambda w: ~anchor(w)).alias("content"))

    def of_spots(p: Column) -> Column:
        # The j-th anchor stands at word i, so i - j content words precede it.
        chains = F.transform(p["spots"], lambda i, j: F.when(
            i - j + chain <= F.size(p["content"]),
            F.xxhash64(F.get(p["words"], i), *[F.get(p["content"], i - j + k) for k in range(chain)]).bitwiseAND(
                F.lit((1 << 4 * DIGITS) - 1).cast("long")),
        ))
        return F.array_sort(F.array_distinct(F.filter(chains, lambda x: x.isNotNull())))

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    found = F.get(F.transform(F.transform(F.array(words), of_words), of_spots), F.lit(0))
    whole = F.array(F.xxhash64(text).bitwiseAND(F.lit((1 << 4 * DIGITS) - 1).cast("long")))
    return F.get(F.transform(F.array(found), lambda s: F.when(F.size(s) > 0, s).otherwise(whole)), F.lit(0))


def as_text(found: Column) -> Column:
    return F.concat_ws("", F.transform(found, lambda s: F.lpad(F.lower(F.hex(s)), DIGITS, "0")))


def jaccard(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return shared / (F.size(a) + F.size(b) - shared)


def _ranges(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_range``, rising as ``_d`` falls.

    Bounds are quantiles of the ids, a bounded number of them; equal ids stay together.
    """
    n = docs.count()
    parts = max(1, min(MOST_RANGES, n // DOCS_PER_RANGE))
    key = docs.withColumn("_k", -F.col("_d").cast("double"))
    if parts == 1:
        return key.withColumn("_range", F.lit(0.0)).drop("_k")
    cuts = key.select(F.percentile_approx("_k", [i / parts for i in range(1, parts)], 4 * parts)).head()[0]
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    return Bucketizer(splits=splits, inputCol="_k", outputCol="_range").transform(key).drop("_k")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, next): each document with the text of the next one by descending doc_id.

    Texts are shuffled once, by ranges of ids; within a range the next text is the following row's. Only
    the last row of a range looks into another one: the first text of each range, one row
    per range, is joined to the range before it.
    """
    lowest = -(1 << 63)
    slim = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("_d")
    )
    ranged = _ranges(slim)
    order = Window.partitionBy("_range").orderBy(F.desc("_d"), F.xxhash64("text"))
    inside = ranged.withColumns({"_next": F.lead("text").over(order)})

    # The first document of each range: found by id and hash, at most ``MOST_RANGES`` rows, so these
    # are broadcast; then its text by a join on those.
    heads = ranged.groupBy("_range").agg(
        F.min_by(F.struct("_d", F.xxhash64("text").alias("_h")), F.struct(-F.col("_d").cast("double"), F.xxhash64("text"))).alias("head")
    )
    around = Window.orderBy("_range")
    follower = heads.select(
        "_range",
        F.coalesce(F.lead("head").over(around), F.first("head").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("f"),
    ).select(F.col("_range").alias("_of"), F.col("f._d").alias("_d"), F.col("f._h").alias("_h"))
    first_text = (
        slim.withColumn("_h", F.xxhash64("text")).join(F.broadcast(follower), ["_d", "_h"])
        .groupBy("_of").agg(F.first("text").alias("_first"))
    )
    joined = inside.join(first_text, (F.col("_range") == F.col("_of")) & F.col("_next").isNull(), "left")
    return joined.select("doc_id", "text", F.coalesce("_next", "_first").alias("next"))


def spotsigs_digest(docs: DataFrame) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text, and their likeness."""
    n = F.length("text").cast("int")
    half = F.floor(n / 2).cast("int")
    paired = with_next(docs.select("doc_id", "text")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "next",
        F.concat(F.left("text", n - half), F.left("next", half)).alias("edited"),
    )
    found = paired.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("other"), signatures(F.col("next")).alias("next"),
    )
    return found.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        jaccard(F.col("own"), F.col("other")).alias("near_edited"), jaccard(F.col("own"), F.col("next")).alias("near_next"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, signatures)."""
    return docs.select("doc_id", signatures(F.coalesce("text", F.lit(""))).alias("signatures"))


def similar(prints: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """All pairs of different sets with a coefficient of ``threshold`` or more, and the sets' members.

    Gives (a, b, jaccard) between classes of equal sets and (class_id, doc_id).
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    members = prints.select(F.md5(F.concat_ws(",", F.transform("signatures", lambda s: s.cast("string")))).alias("class_id"), "doc_id", "signatures")
    sets = members.groupBy("class_id").agg(F.first("signatures").alias("set"))
    size = F.size("set")
    # Partition p holds lengths from (1 / threshold) ** p on; a length meets its own partition and the next.
    length_part = F.floor(F.log(size.cast("double")) / math.log(1 / threshold) if threshold < 1 else size).cast("int")
    prefix = F.slice("set", F.lit(1), size - F.ceil(size * F.lit(threshold)).cast("int") + 1)
    posted = sets.select("class_id", size.alias("n"), length_part.alias("part"), F.explode(prefix).alias("signature"))
    right = posted.select(
        F.col("class_id").alias("b"), F.col("n").alias("m"), "signature",
        F.explode(F.array("part", F.col("part") - 1)).alias("part"),
    )
    met = (
        posted.withColumnRenamed("class_id", "a").join(right, ["signature", "part"])
        .filter((F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("a") < F.col("b"))))
        .filter(F.col("n") >= F.col("m") * F.lit(threshold))
        .select("a", "b").distinct()
    )
    scored = (
        met.join(sets.select(F.col("class_id").alias("a"), F.col("set").alias("_a")), "a")
        .join(sets.select(F.col("class_id").alias("b"), F.col("set").alias("_b")), "b")
        .select("a", "b", jaccard(F.col("_a"), F.col("_b")).alias("jaccard"))
        .filter(F.col("jaccard") >= threshold)
    )
    return scored, members.select("class_id", "doc_id")
