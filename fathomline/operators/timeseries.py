"""Time-series operators over irregular samples: as-of and interpolating joins, gap filling, sessions, islands, rolling.

Every operator works on series, told apart by the columns `by`, in the order of the columns `order`. A series can hold
any share of all rows: rows are split into blocks of the first order column as well, windows run within blocks, and
what has to pass from block to block is summed up in one row for each block. So no task gets a whole series. The sum is
a second pass over the input, so inputs that are costly are best written first; series that are known to be sparse take
one window over the whole series with width=None.

NULL is the only missing value; sources turn NaN into it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import cut

#: Width of a block in units of the first order column: twelve days of seconds.
BLOCK = float(1 << 20)

_BLOCK = "__block"


def blocked(df: DataFrame, order: str, width: float | None = BLOCK) -> DataFrame:
    return df.withColumn(_BLOCK, F.floor(F.col(order) / width))


def carry(df: DataFrame, by: list[str], order: list[str], add: dict[str, tuple[Column, str]], width: float | None = BLOCK, back: list[str] | None = None) -> DataFrame:
    """Adds columns that hold a value of another row of the series.

    add: name -> (value, which). Of the rows whose value isn't null: "last" is that of the last row up to this one,
    "before" of the last before it, "next" of the first from this one on, "after" of the first after it. back: the order
    for "next" and "after", if it is another one; both begin with the same column, so one shuffle serves both.
    """
    orders = {True: order, False: back or order}
    if width is None:
        up, down = (Window.partitionBy(*by).orderBy(*(F.col(c) if way else F.desc(c) for c in orders[way])) for way in (True, False))
        plain = {n: F.last(v, ignorenulls=True).over((up if w in ("last", "before") else down).rowsBetween(Window.unboundedPreceding, 0 if w in ("last", "next") else -1)) for n, (v, w) in add.items()}
        return df.withColumns(plain)
    df = blocked(df, order[0], width)
    ascending = Window.partitionBy(*by, _BLOCK).orderBy(*order)
    descending = Window.partitionBy(*by, _BLOCK).orderBy(*(F.desc(c) for c in orders[False]))
    blocks_up = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks_down = Window.partitionBy(*by).orderBy(F.desc(_BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    own, ends, carried = {}, [], []
    for name, (value, which) in add.items():
        forward, upto = which in ("last", "before"), 0 if which in ("last", "next") else -1
        window = (ascending if forward else descending).rowsBetween(Window.unboundedPreceding, upto)
        own[f"__own_{name}"] = F.last(value, ignorenulls=True).over(window)
        at = F.when(value.isNotNull(), F.struct(*orders[forward]))
        ends.append((F.max_by(value, at) if forward else F.min_by(value, at)).alias(f"__end_{name}"))
        carried.append(F.last(f"__end_{name}", ignorenulls=True).over(blocks_up if forward else blocks_down).alias(f"__carried_{name}"))
    summary = df.groupBy(*by, _BLOCK).agg(*ends).select(*by, _BLOCK, *carried)
    keys = [*by, _BLOCK]
    right = summary.select(*(F.col(k).alias(f"__key_{k}") for k in keys), *(c for c in summary.columns if c not in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys))
    out = df.withColumns(own).join(right, same, "left")
    return out.select(*(c for c in df.columns if c != _BLOCK), *(F.coalesce(f"__own_{n}", f"__carried_{n}").alias(n) for n in add))


def _wrapped(value: Column) -> Column:
    """A struct that isn't null, around a value that may be."""
    return F.struct(value.alias("v"))


def lag_lead(df: DataFrame, by: list[str], order: list[str], lag: dict[str, Column] | None = None, lead: dict[str, Column] | None = None, width: float | None = BLOCK) -> DataFrame:
    """Adds values of the row before and of the row after, nulls included."""
    add = {n: (_wrapped(c), "before") for n, c in (lag or {}).items()} | {n: (_wrapped(c), "after") for n, c in (lead or {}).items()}
    return carry(df, by, order, add, width).withColumns({n: F.col(f"{n}.v") for n in add})


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "n", width: float | None = BLOCK) -> DataFrame:
    """Adds the number of each row within its series, from 1."""
    if width is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long"))
    df = blocked(df, order[0], width)
    size = df.groupBy(*by, _BLOCK).count()
    before = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, _BLOCK]
    offset = size.select(*(F.col(k).alias(f"__key_{k}") for k in keys), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__within", within).join(offset, same, "left").select(*(c for c in df.columns if c != _BLOCK), (F.col("__within") + F.col("__offset")).alias(name))


def running_count(df: DataFrame, by: list[str], order: list[str], flag: Column, name: str, width: float | None = BLOCK) -> DataFrame:
    """Adds how many rows up to this one, itself included, have the flag."""
    if width is None:
        all_before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(F.when(F.coalesce(flag, F.lit(False)), 1).otherwise(0)).over(all_before))
    df = blocked(df, order[0], width)
    keys = [*by, _BLOCK]
    one = F.when(F.coalesce(flag, F.lit(False)), 1).otherwise(0)
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    total = df.groupBy(*keys).agg(F.sum(one).alias("__c"))
    offset = total.select(*(F.col(k).alias(f"__key_{k}") for k in keys), F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__offset"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys))
    return df.withColumn("__within", F.sum(one).over(upto)).join(offset, same, "left").select(*(c for c in df.columns if c != _BLOCK), (F.col("__within") + F.col("__offset")).alias(name))


def _tagged(left: DataFrame, right: DataFrame, by: list[str], time: str, values: list[str]) -> DataFrame:
    """Rows of both sides in one frame: left rows whole in __left, right rows as __right (time, values)."""
    a = left.select(*by, time, F.lit(1).alias("__side"), F.struct(*left.columns).alias("__left"), F.lit(None).cast(right.select(F.struct(time, *values)).schema[0].dataType).alias("__right"))
    b = right.where(F.col(time).isNotNull()).select(*by, time, F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__left"].dataType).alias("__left"), F.struct(time, *values).alias("__right"))
    return a.unionByName(b)


def locf_join(left: DataFrame, right: DataFrame, values: list[str], by: list[str], time: str = "time", width: float | None = BLOCK) -> DataFrame:
    """left with the values of the last right row at or before its time; null before the first (as-of backward)."""
    both = carry(_tagged(left, right, by, time, values), by, [time, "__side"], {"__r": (F.col("__right"), "last")}, width)
    return both.where("__side = 1").select("__left.*", *(F.col(f"__r.{v}").alias(v) for v in values))


def next_join(left: DataFrame, right: DataFrame, values: list[str], by: list[str], time: str = "time", width: float | None = BLOCK) -> DataFrame:
    """left with the values of the first right row at or after its time; null after the last (as-of forward)."""
    both = _tagged(left, right, by, time, values).withColumn("__late", F.lit(1) - F.col("__side"))  # a report at the time comes after
    both = carry(both, by, [time, "__late"], {"__r": (F.col("__right"), "next")}, width)
    return both.where("__side = 1").select("__left.*", *(F.col(f"__r.{v}").alias(v) for v in values))


def interpolate(t: Column, t0: Column, y0: Column, t1: Column, y1: Column) -> Column:
    """Linear between two points, the first where both are at one time; null where one is missing."""
    return F.when(t1 == t0, y0).otherwise(y0 + (y1 - y0) * ((t - t0) / F.nullif(t1 - t0, F.lit(0.0))))


def interp_join(left: DataFrame, right: DataFrame, values: list[str], by: list[str], time: str = "time", skip_nulls: bool = False, width: float | None = BLOCK) -> DataFrame:
    """left with the right side's values interpolated to its times; nothing outside the right side's times.

    A null in a bracketing row gives null, unless skip_nulls: then each value is bracketed by its own non-null rows.
    Times of the right side have to be unique within a series. A value of one name on both sides is the right one.
    """
    both = _tagged(left, right, by, time, values).withColumn("__late", F.lit(1) - F.col("__side"))
    names = {v: (f"__p{i}", f"__n{i}") for i, v in enumerate(values)} if skip_nulls else {v: ("__p", "__n") for v in values}
    point = lambda v: F.when(F.col(f"__right.{v}").isNotNull(), F.struct(F.col(f"__right.{time}").alias(time), F.col(f"__right.{v}").alias(v))) if skip_nulls else F.col("__right")
    add = {names[v][0]: (point(v), "last") for v in values} | {names[v][1]: (point(v), "next") for v in values}
    both = carry(both, by, [time, "__side"], add, width, [time, "__late"])  # a right row of the same time counts either way
    got = [interpolate(F.col(time), F.col(f"{p}.{time}"), F.col(f"{p}.{v}"), F.col(f"{n}.{time}"), F.col(f"{n}.{v}")).alias(v) for v, (p, n) in names.items()]
    kept = [F.col(f"__left.{c}").alias(c) for c in left.columns if c not in values]
    return both.where("__side = 1").select(*kept, *got)


def nearest_gap(left: DataFrame, right: DataFrame, by: list[str], name: str, time: str = "time", width: float | None = BLOCK) -> DataFrame:
    """left with the time to the nearest right row on either side; null without one."""
    both = _tagged(left, right, by, time, []).withColumn("__late", F.lit(1) - F.col("__side"))
    at = F.col(f"__right.{time}")
    both = carry(both, by, [time, "__side"], {"__p": (at, "last"), "__n": (at, "next")}, width, [time, "__late"])
    gap = F.least(F.col(time) - F.col("__p"), F.col("__n") - F.col(time))
    return both.where("__side = 1").select("__left.*", gap.alias(name))


def join_null_safe(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """An equi-join by columns of which nulls are equal, too."""
    right = right.withColumnsRenamed({b: f"__key_{b}" for b in by})
    same = reduce(lambda a, b: a & b, (F.col(b).eqNullSafe(F.col(f"__key_{b}")) for b in by))
    return left.join(right, same, how).drop(*(f"__key_{b}" for b in by))


def interval_join(left: DataFrame, spans: DataFrame, values: list[str], by: list[str], time: str = "time", start: str = "start", end: str = "end", width: float = 3600.0) -> DataFrame:
    """left with the values of every span that holds its time, both ends included: a row for each of them, none without.

    Spans may overlap. Each is dealt to the slots of time that it touches, each left row to the one slot that it is in;
    rows of one slot meet by an equi-join. Slots of a width near that of a span make a few rows of each.
    """
    slots = F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))
    dealt = spans.where(F.col(start) <= F.col(end)).select(*by, F.col(start).alias("__start"), F.col(end).alias("__end"), F.struct(*values).alias("__span"), F.explode(slots).alias("__slot"))
    met = join_null_safe(left.withColumn("__slot", F.floor(F.col(time) / width)), dealt, [*by, "__slot"])
    kept = met.where(F.col(time).between(F.col("__start"), F.col("__end")))
    return kept.select(*(c for c in left.columns if c not in values), *(F.col(f"__span.{v}").alias(v) for v in values))


#: Values of a group that one task may sort.
SORTED = 1 << 20


def grouped_median(df: DataFrame, by: list[str], value: str, most: int = SORTED, parts: int = 1024) -> DataFrame:
    """(by, value): the exact median of each group's values, the mean of the middle two; null for a group without any.

    Groups of at most `most` values are sorted, each in one task. Of larger ones the middle values are selected: values
    between bounds are counted in parts of equal width, and the part that holds the rank gives closer bounds, until few
    enough are left or all are equal. Counting is summed up within tasks, so a group of any size is no burden to one. df
    is read some times; write a costly one first.
    """
    clean = df.select(*by, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL")
    groups = cut(df.groupBy(*by).agg(F.count(value).alias("__n"), F.min(value).cast("double").alias("__low"), F.max(value).cast("double").alias("__high")))
    large = groups.where(F.col("__n") > most)
    if large.isEmpty():
        return df.groupBy(*by).agg(F.median(value).alias(value))
    small = join_null_safe(df, large.select(*by), by, "left_anti").groupBy(*by).agg(F.median(value).alias(value))
    ranks = F.array_distinct(F.array(F.expr("(__n - 1) div 2"), F.expr("__n div 2")))
    probes = cut(large.select(*by, F.explode(ranks).alias("__rank"), F.lit(0).cast("bigint").alias("__below"), "__n", "__low", "__high"))
    open_ = (F.col("__low") < F.col("__high")) & (F.col("__n") > most)
    upto = Window.partitionBy(*by, "__rank").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    while (count := probes.where(open_).count()) > 0:
        # two probes for each large group; sides of a checked size are broadcast, so no group is one task's
        asked = probes.where(open_)
        asked = F.broadcast(asked) if count <= 100_000 else asked
        hits = join_null_safe(clean, asked, by).where("__v BETWEEN __low AND __high")
        part = F.least(F.floor((F.col("__v") - F.col("__low")) / (F.col("__high") - F.col("__low")) * parts), F.lit(parts - 1))
        counted = hits.groupBy(*by, "__rank", "__below", part.alias("__part")).agg(F.count("*").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high"))
        counted = counted.withColumn("__below", F.col("__below") + F.coalesce(F.sum("__n").over(upto), F.lit(0)))
        closer = counted.where("__rank >= __below AND __rank < __below + __n").select(*probes.columns)
        probes = cut(probes.where(~open_).unionByName(closer))
    ready = probes.where("__low = __high").select(*by, "__rank", F.col("__low").alias(value))
    few = probes.where("__low < __high")
    near = join_null_safe(clean, F.broadcast(few) if probes.count() <= 100_000 else few, by).where("__v BETWEEN __low AND __high")
    place = F.row_number().over(Window.partitionBy(*by, "__rank").orderBy("__v"))
    picked = near.withColumn("__place", place + F.col("__below") - 1).where("__place = __rank").select(*by, "__rank", F.col("__v").alias(value))
    return small.unionByName(ready.unionByName(picked).groupBy(*by).agg(F.avg(value).alias(value)))


def fill_gaps(df: DataFrame, max_gap: dict[str, float | None], by: list[str], time: str = "time", order: list[str] | None = None, width: float | None = BLOCK) -> DataFrame:
    """Missing values interpolated between the valid ones around them, if those are at most max_gap apart (None: any).

    <name>_filled tells which were filled. Nothing is filled outside the valid values.
    """
    point = {c: F.when(F.col(c).isNotNull(), F.struct(F.col(time).alias("t"), F.col(c).alias("v"))) for c in max_gap}
    add = {f"__p_{c}": (x, "last") for c, x in point.items()} | {f"__n_{c}": (x, "next") for c, x in point.items()}
    got = carry(df, by, order or [time], add, width)
    out = {}
    for c, gap in max_gap.items():
        p, n = f"__p_{c}", f"__n_{c}"
        near = F.lit(True) if gap is None else F.col(f"{n}.t") - F.col(f"{p}.t") <= gap
        filled = F.when(near, interpolate(F.col(time), F.col(f"{p}.t"), F.col(f"{p}.v"), F.col(f"{n}.t"), F.col(f"{n}.v")))
        out[c] = F.coalesce(F.col(c), filled)
        out[f"{c}_filled"] = F.col(c).isNull() & F.coalesce(filled.isNotNull(), F.lit(False))
    return got.select(*(c for c in df.columns if c not in out), *(x.alias(c) for c, x in out.items()))


def sessionize(df: DataFrame, gap: float, by: list[str], time: str = "time", order: list[str] | None = None, start: str = "session_start", width: float | None = BLOCK) -> DataFrame:
    """Adds the time at which each row's session began; a difference beyond the gap begins a session."""
    order = order or [time]
    got = lag_lead(df, by, order, lag={"__before": F.col(time)}, width=width)
    begins = F.col("__before").isNull() | (F.col(time) - F.col("__before") > gap)
    return carry(got, by, order, {start: (F.when(begins, F.col(time)), "last")}, width).drop("__before")


def last_of_session(df: DataFrame, gap: float, by: list[str], time: str = "time", order: list[str] | None = None, width: float | None = BLOCK) -> DataFrame:
    """The last row of each session."""
    got = sessionize(df, gap, by, time, order, "__start", width)
    last = got.groupBy(*by, "__start").agg(F.max_by(F.struct(*df.columns), F.struct(*(order or [time]))).alias("r"))
    return last.select("r.*")


def islands(df: DataFrame, condition: Column, by: list[str], order: list[str], name: str = "island", width: float | None = BLOCK) -> DataFrame:
    """Adds a number of the run of rows of equal condition that a row is in: from 1, true and false runs in turn."""
    flagged = df.withColumn("__c", F.coalesce(condition, F.lit(False)))
    got = lag_lead(flagged, by, order, lag={"__before": F.col("__c")}, width=width)
    turns = F.col("__before").isNull() | (F.col("__before") != F.col("__c"))
    return running_count(got, by, order, turns, name, width).drop("__c", "__before")


def island_summary(df: DataFrame, condition: Column, by: list[str], order: list[str], aggs: list[Column], width: float | None = BLOCK) -> DataFrame:
    """A row for each run of rows with the condition."""
    got = islands(df.withColumn("__keep", F.coalesce(condition, F.lit(False))), F.col("__keep"), by, order, "island", width)
    return got.where("__keep").groupBy(*by, "island").agg(*aggs)


def rolling_stats(df: DataFrame, value: str, half: int, by: list[str], order: list[str], width: float | None = BLOCK, rows: int = 1 << 18) -> DataFrame:
    """Adds <value>_count, _mean and _std (of the population) over the rows up to `half` before and after.

    Rows are numbered and split by number; each part also gets the rows that its ends look at.
    """
    n = numbered(df, by, order, "__i", width).withColumn("__part", F.floor((F.col("__i") - 1) / rows))
    edge = (F.col("__i") - 1) % rows
    # a part's first rows also go to the one before, its last to the one after; rows of half below the size
    halo = F.array_compact(F.array(F.lit(0), F.when(edge < half, F.lit(-1)), F.when(edge >= rows - half, F.lit(1))))
    spread = n.withColumn("__to", F.explode(halo)).withColumn("__at", F.col("__part") + F.col("__to"))
    w = Window.partitionBy(*by, "__at").orderBy("__i").rowsBetween(-half, half)
    out = spread.withColumns({f"{value}_count": F.count(value).over(w), f"{value}_mean": F.avg(value).over(w), f"{value}_std": F.stddev_pop(value).over(w)})
    return out.where("__to = 0").drop("__i", "__part", "__to", "__at")


def gradient(df: DataFrame, y: str, x: str, by: list[str], name: str = "gradient", width: float | None = BLOCK) -> DataFrame:
    """Adds dy/dx: second order within, for uneven steps; one-sided at the ends; null next to a repeated x."""
    got = lag_lead(df, by, [x], {"__y0": F.col(y), "__x0": F.col(x)}, {"__y1": F.col(y), "__x1": F.col(x)}, width)
    y0, y1, x0, x1, yy, xx = (F.col(c) for c in ("__y0", "__y1", "__x0", "__x1", y, x))
    a, b = F.nullif(xx - x0, F.lit(0.0)), F.nullif(x1 - xx, F.lit(0.0))
    inner = (a * a * y1 + (b * b - a * a) * yy - b * b * y0) / (a * b * (a + b))
    slope = F.when(x0.isNull(), (y1 - yy) / b).when(x1.isNull(), (yy - y0) / a).otherwise(inner)
    return got.withColumn(name, slope).drop("__y0", "__y1", "__x0", "__x1")


def midpoints(df: DataFrame, x: str, by: list[str], order: list[str], name: str = "mid", width: float | None = BLOCK) -> DataFrame:
    """A row for each pair of neighbours, with their mean."""
    got = lag_lead(df, by, order, lead={"__next": F.col(x)}, width=width)
    return got.where(F.col("__next").isNotNull()).withColumn(name, (F.col(x) + F.col("__next")) / 2).drop("__next")


def edges(df: DataFrame, x: str, by: list[str], name: str = "edge", width: float | None = BLOCK) -> DataFrame:
    """(by, edge): the edges of cells around centres: the midpoints, and half a step beyond the first and the last.

    A lone centre has no step and gives no edge.
    """
    got = lag_lead(df.select(*by, x), by, [x], {"__x0": F.col(x)}, {"__x1": F.col(x)}, width)
    c, x0, x1 = F.col(x), F.col("__x0"), F.col("__x1")
    below = F.when(x0.isNull(), c - (x1 - c) / 2)
    above = F.when(x1.isNull(), c + (c - x0) / 2).otherwise((c + x1) / 2)
    return got.select(*by, F.explode(F.array_compact(F.array(below, above))).alias(name))


def interpolate_angle(t: Column, t0: Column, y0: Column, t1: Column, y1: Column) -> Column:
    """Linear along the shorter way round, in degrees from 0 to 360: an option for headings."""
    turn = F.pmod(y1 - y0 + 180, F.lit(360.0)) - 180
    return F.pmod(interpolate(t, t0, y0, t1, y0 + turn), F.lit(360.0))
