"""Session windows over one or two inputs, their join and their cogroup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from keyrill.functions.ordering import Key, names, with_keys
from keyrill.plans.running import Among, Scan, scanned, since_reset, upto
from keyrill.plans.slices import SlicePlan, plan_slices

SESSION = "session_start"
SIDE = "side"


def _session_scan(time: str, gap: int) -> Scan:
    """``session_start`` of each row, ``opens`` (it begins one), and its ``arrival`` within the key; of the session so far
    ``n_left`` and ``n_all``.

    In a slice its first row begins a session for the time being. Whether it does shows in the last time before the slice; if not, the rows
    up to the next beginning belong to the session carried here, with what it holds so far.
    """
    is_left = (F.when(F.col(SIDE) == "left", 1).otherwise(0)).cast("long")

    def local(rows: DataFrame, w: WindowSpec) -> DataFrame:
        boxed = F.struct(F.col(time).alias("value"))
        held = rows.withColumns({
            "_before": F.lag(boxed).over(w), "arrival": F.row_number().over(w).cast("long"),
            "_left": F.sum(is_left).over(upto(w)) if SIDE in rows.columns else F.lit(0).cast("long"),
        })
        far = F.col(time) - F.col("_before.value") > gap
        one = is_left if SIDE in rows.columns else F.lit(0).cast("long")
        marked = held.withColumns({
            "opens": F.coalesce(F.col("_before").isNull() | far, F.lit(False)),
            "_outside": F.when(F.col("_before").isNull() | far, F.struct(
                F.col(time).alias("time"), (F.col("_left") - one).alias("left"), (F.col("arrival") - 1).alias("all"))),
        })
        begun = marked.withColumns({
            "_base": F.last("_outside", ignorenulls=True).over(upto(w)),
            "_inner": F.max(F.col("opens") & F.col("_before").isNotNull()).over(upto(w)),
        })
        return begun.withColumns({
            SESSION: F.col("_base.time"), "n_left": F.col("_left") - F.col("_base.left"), "n_all": F.col("arrival") - F.col("_base.all"),
        }).drop("_left", "_base", "_outside")

    def summary(order: Column) -> dict[str, Column]:
        last = F.struct(F.col(time).alias("time"), SESSION, "n_left", "n_all")
        return {
            "_rows": F.count(F.lit(1)), "_first": F.min_by(F.struct(F.col(time).alias("time")), order),
            "_last": F.max_by(last, order), "_begins": F.max("_inner"),
        }

    def carry(summaries: DataFrame, among: Among) -> DataFrame:
        last = F.lag(F.struct("_last.time")).over(among.in_order)
        apart = F.coalesce(last.isNull() | (F.col("_first.time") - last["time"] > gap), F.lit(False))
        known = summaries.withColumn("_apart", apart).withColumn("_reset", F.col("_apart") | F.col("_begins"))
        own = F.when(F.col("_reset"), F.struct(F.when(F.col("_begins"), F.col(f"_last.{SESSION}")).otherwise(F.col("_first.time")).alias("value")))
        placed = known.withColumns({
            "_c_apart": F.col("_apart"), "_c_start": F.last(own, ignorenulls=True).over(among.before),
            "_c_rows": F.sum("_rows").over(among.before),
        })
        return since_reset(placed, among, F.col("_reset"), _c_left=F.col("_last.n_left"), _c_all=F.col("_last.n_all"))

    def finish(rows: DataFrame) -> DataFrame:
        goes_on = ~F.col("_inner") & ~F.coalesce("_c_apart", F.lit(True))
        more = lambda c: F.when(goes_on, F.coalesce(F.col(c), F.lit(0))).otherwise(0)
        return rows.withColumns({
            SESSION: F.when(goes_on, F.col("_c_start.value")).otherwise(F.col(SESSION)),
            "n_left": F.col("n_left") + more("_c_left"), "n_all": F.col("n_all") + more("_c_all"),
            "arrival": F.col("arrival") + F.coalesce("_c_rows", F.lit(0)),
            "opens": F.col("opens") & ~(F.col("_before").isNull() & goes_on),
        })

    return Scan(local, summary, carry, ["_c_apart", "_c_start", "_c_rows", "_c_left", "_c_all"], finish)


def _start_sessions(df: DataFrame, plan: SlicePlan, time: str, gap: int) -> DataFrame:
    return scanned(df, plan, _session_scan(time, gap))


def sessionize(
    df: DataFrame, keys: Key | Sequence[Key], time: str, gap: int, order_by=None, rows_per_slice: int | None = None
) -> DataFrame:
    """Each row with the time its session began.

    Rows of a key not more than ``gap`` apart share a session. ``time`` is a number
    (epoch milliseconds, say) in the unit of ``gap``.
    """
    df, key_names = with_keys(df, keys)
    plan = plan_slices(df, key_names, [time, *names(order_by)], rows_per_slice)
    return _start_sessions(plan.assign(df), plan, time, gap).select(*df.columns, SESSION)


def _both(left: DataFrame, right: DataFrame, keys: list[str], time: str, tie: list[str]) -> DataFrame:
    """The rows of both sides, tagged; their own columns stay whole in one struct.

    Sides with equal columns share the struct ``row``, so that later plans for either
    side read the same columns and Spark shuffles and sorts the rows once for both.
    """
    shared = [*keys, time, *tie]
    alike = left.dtypes == right.dtypes

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*shared, F.lit(side).alias(SIDE), F.struct(*df.columns).alias("row" if alike else side))

    return tagged(left, "left").unionByName(tagged(right, "right"), allowMissingColumns=True)


def two_sided_sessions(
    left: DataFrame, right: DataFrame, keys, time: str, gap: int, order_by, rows_per_slice: int | None = None
) -> tuple[DataFrame, SlicePlan]:
    """The rows of both inputs with their side and session; either side extends a session."""
    key_names = names(keys)
    both = _both(left, right, key_names, time, names(order_by))
    plan = plan_slices(both, key_names, [time, *names(order_by)], rows_per_slice)
    return _start_sessions(plan.assign(both), plan, time, gap), plan


def _pairs(rows: DataFrame, keys: list[str], *extra: str) -> DataFrame:
    same = [*keys, SESSION]

    def one_side(side: str) -> DataFrame:
        payload = F.col("row" if "row" in rows.columns else side).alias(side)
        kept = [F.col(e).alias(f"{side}_{e}") for e in extra]
        return rows.filter(F.col(SIDE) == side).select(*same, payload, *kept)

    return one_side("left").join(one_side("right"), same)


def session_join(left: DataFrame, right: DataFrame, keys, time: str, gap: int, order_by, rows_per_slice=None) -> DataFrame:
    """Every pair of a left and a right row within one session, as ``left`` and ``right`` structs."""
    rows, _ = two_sided_sessions(left, right, keys, time, gap, order_by, rows_per_slice)
    return _pairs(rows, names(keys))


def session_join_per_element(
    left: DataFrame, right: DataFrame, keys, time: str, gap: int, order_by, rows_per_slice=None
) -> DataFrame:
    """Every pair, emitted once, at the arrival of its later row in the session.

    ``arrival`` is the position of that row within its key. The pairs so far at an arrival are
    those up to it, so emitting each again at every later one would add rows only.
    """
    rows, _ = two_sided_sessions(left, right, keys, time, gap, order_by, rows_per_slice)
    pairs = _pairs(rows, names(keys), "arrival")
    return pairs.withColumn("arrival", F.greatest("left_arrival", "right_arrival")).drop("left_arrival", "right_arrival")


def session_cogroup(left: DataFrame, right: DataFrame, keys, time: str, gap: int, order_by, *aggregates: Column, rows_per_slice=None) -> DataFrame:
    """One row per session with the number of rows of each side; one side may be empty.

    ``aggregates`` may use ``side`` and the row as a struct: ``row`` if both sides have
    the same columns, else ``left`` and ``right``, the one of the other side being null.
    """
    rows, _ = two_sided_sessions(left, right, keys, time, gap, order_by, rows_per_slice)
    return rows.groupBy(*names(keys), SESSION).agg(
        F.count_if(F.col(SIDE) == "left").alias("n_left"),
        F.count_if(F.col(SIDE) == "right").alias("n_right"),
        *aggregates,
    )


def session_cogroup_per_element(
    left: DataFrame, right: DataFrame, keys, time: str, gap: int, order_by, rows_per_slice=None
) -> DataFrame:
    """The sizes of both groups so far, emitted at each arrival in the session."""
    rows, _ = two_sided_sessions(left, right, keys, time, gap, order_by, rows_per_slice)
    return rows.select(
        *names(keys), time, *names(order_by), SIDE, SESSION, "arrival",
        "n_left", (F.col("n_all") - F.col("n_left")).alias("n_right"),
    )


def cogroup_text(key: Column, value: Column, n_left: Column, n_right: Column) -> Column:
    """Both groups as text: a title for each side, then one line per element."""
    line = F.concat(key.cast("string"), F.lit("<->"), value.cast("string"), F.lit("\n"))
    return F.concat(
        F.lit("Data in stream1: \n"),
        F.repeat(line, n_left.cast("int")),
        F.lit("Data in stream2: \n"),
        F.repeat(line, n_right.cast("int")),
    )
