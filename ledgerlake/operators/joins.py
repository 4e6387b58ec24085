"""Joins of the retail star: as-of versions, intervals, spines, orphans, identities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.dates import month_index


def orphans(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str, nullable: bool = False) -> DataFrame:
    """(fk, n): foreign key values without a dimension row, and how many facts carry them.

    The fact side is reduced to its distinct keys before the shuffle, so a hot or NULL key
    costs one row. A NULL key matches nothing and counts as an orphan unless `nullable`.
    """
    fk = fact.select(F.col(fact_col).alias("fk"))
    if nullable:
        fk = fk.filter("fk IS NOT NULL")
    fk = fk.groupBy("fk").agg(F.count(F.lit(1)).alias("n"))
    pk = dim.select(F.col(dim_col).alias("pk"))
    return fk.join(pk, F.col("fk") == F.col("pk"), "left_anti")


def orphan_count(fact: DataFrame, fact_col: str, dim: DataFrame, dim_col: str, nullable: bool = False) -> DataFrame:
    return orphans(fact, fact_col, dim, dim_col, nullable).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_count"))


def without_current(source: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose keys have no row in `current`."""
    return source.join(current.select(*keys), keys, "left_anti")


def version_ranges(versions: DataFrame, key: str, effective: str, tie: str | None) -> DataFrame:
    """Half-open validity [effective, next_effective) per version; one version per key and day."""
    from .windows import one_per_day

    single = one_per_day(versions, key, effective, tie) if tie else versions
    nxt = F.lead(effective).over(Window.partitionBy(key).orderBy(effective))
    return single.withColumn("next_effective", nxt)


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, day: str, effective: str, take: list[str],
               tie: str | None = None, horizon: Column | None = None, by_month: bool = True) -> DataFrame:
    """Each fact with the version of its key valid on its day; earlier facts get NULLs.

    Of two versions on one day the higher `tie` wins; without `tie`, versions hold one row
    per key and day.

    by_month   match on (key, month): a hot key is spread over its months and a fact is
               compared only with the versions of its month. Without it, match on the key
               alone, which suits a dimension that is small enough for Spark to broadcast.
    horizon    all months from this day on share one slot, so a stray far-away date costs
               nothing; the result does not depend on it. Default: the last start of any
               version, after which nothing changes any more.
    """
    needed = list(dict.fromkeys([key, effective, *([tie] if tie else []), *take]))
    versions = versions.select(*needed)
    ranges = version_ranges(versions, key, effective, tie).filter(F.col(effective).isNotNull())
    picked = [
        F.col(key).alias("__vkey"), F.col(effective).alias("__from"), F.col("next_effective").alias("__to"),
        *[F.col(c).alias(f"__v_{c}") for c in take]]
    tagged = facts.withColumn("__day", F.col(day).cast("date"))
    valid = (
        (F.col(key) == F.col("__vkey")) & (F.col("__day") >= F.col("__from"))
        & (F.col("__to").isNull() | (F.col("__day") < F.col("__to")))
    )
    if by_month:
        last = month_index(horizon if horizon is not None else versions.agg(F.max(effective)).scalar())

        def slot(d: Column) -> Column:
            return F.least(month_index(d), last)

        ends = F.when(F.col("next_effective").isNull(), last).otherwise(slot(F.date_sub("next_effective", 1)))
        slots = F.explode(F.sequence(slot(F.col(effective)), ends)).alias("__vslot")
        # The planner does not see how far the slots multiply the versions, so it must not
        # broadcast them on its estimate.
        side = ranges.select(*picked, slots).hint("merge")
        tagged = tagged.withColumn("__slot", slot(F.col("__day")))
        valid = valid & (F.col("__slot") == F.col("__vslot"))
    else:
        side = ranges.select(*picked)
    return tagged.join(side, valid, "left").select(*facts.columns, *[F.col(f"__v_{c}").alias(c) for c in take])


def point_in_time_join(facts: DataFrame, versions: DataFrame, key: str, day: str, take: list[str],
                       tie: str | None = None, effective: str = "effective_date", expiry: str = "expiry_date",
                       horizon: Column | None = None, by_month: bool = True) -> DataFrame:
    """Late facts get the attributes valid on their own day, not today's.

    Ranges are inclusive on both ends. The version valid on a day is the latest one that has
    started, unless it has expired: a fact after the end of a closed last version, or in a gap
    between versions, gets NULLs. A NULL expiry is open.
    """
    until = "__until"
    found = as_of_join(facts, versions.withColumn(until, F.col(expiry)), key, day, effective, [*take, until], tie, horizon, by_month)
    valid = F.col(until).isNull() | (F.col(day).cast("date") <= F.col(until))
    return found.select(*facts.columns, *[F.when(valid, F.col(c)).alias(c) for c in take])


def current_lookup(facts: DataFrame, dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Natural key to the current version's surrogate key; NULL if there is none."""
    current = dim.filter("is_current").select(F.col(natural).alias("__nk"), F.col(surrogate))
    return facts.join(current, F.col(natural) == F.col("__nk"), "left").drop("__nk")


def active_days(intervals: DataFrame, start: str, end: Column | str, day: str = "date") -> DataFrame:
    """One row per interval and day it covers, both ends included; empty intervals vanish.

    The planner does not see how far the days multiply the intervals, so a join must not
    broadcast them on its estimate: the hint asks for a merge join.
    """
    last = end if isinstance(end, Column) else F.col(end)
    days = intervals.filter(F.col(start) <= last).withColumn(day, F.explode(F.sequence(F.col(start), last)))
    return days.hint("merge")


DAY_BITS, INSTANT_BITS = 23, 61


def _position(value: Column, kind: str) -> tuple[Column, int]:
    """(place on a line of 2^bits points, bits) of a date, an instant or a whole number."""
    if kind == "date":
        return F.unix_date(value).cast("bigint") + F.lit(1 << (DAY_BITS - 1)), DAY_BITS
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")) + F.lit(1 << (INSTANT_BITS - 1)), INSTANT_BITS
    return value.cast("bigint") + F.lit(1 << (INSTANT_BITS - 1)), INSTANT_BITS


def dyadic_blocks(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals with __level and __block: the aligned blocks of 2^level points that cover them exactly.

    Both ends belong to an interval; a NULL end is open, an empty interval and one without a start vanish. There are at
    most two blocks of a size, so an interval of n points has fewer than 2 log2(n) + 2 rows.
    """
    kind = intervals.schema[start].dataType.simpleString()
    low, bits = _position(F.col(start), kind)
    stop = F.coalesce(_position(F.col(end), kind)[0] + 1, F.lit(1 << bits))

    def of_level(k: Column) -> Column:
        first = F.call_function("shiftright", F.col("__low") + F.call_function("shiftleft", F.lit(1).cast("bigint"), k) - 1, k)
        beyond = F.call_function("shiftright", F.col("__stop"), k)
        left = F.when((first < beyond) & (first % 2 == 1), F.struct(k.alias("level"), first.alias("block")))
        right = F.when((first < beyond) & (beyond % 2 == 1), F.struct(k.alias("level"), (beyond - 1).alias("block")))
        return F.array(left, right)

    levels = F.sequence(F.lit(0), F.lit(bits))
    cover = F.explode(F.array_compact(F.flatten(F.transform(levels, of_level))))
    placed = intervals.withColumns({"__low": low, "__stop": stop}).filter(F.col("__low") < F.col("__stop"))
    return placed.withColumn("__in", cover).select(*intervals.columns, F.col("__in.level").alias("__level"), F.col("__in.block").alias("__block"))


def in_interval(facts: DataFrame, day: str, intervals: DataFrame, start: str, end: str,
                how: str = "inner") -> DataFrame:
    """Facts with every interval that contains their day or instant, both ends included, a NULL end open.

    An equality join on dyadic blocks: an interval is there once per block that covers it, a fact once per size of
    block that occurs, whatever the intervals' lengths. Exactly one block of an interval holds a point, so no pair is
    made twice. The blocks are written first, so the planner broadcasts them only by their real size. `how` is inner or left.
    """
    from ..sources.scratch import materialize

    if how not in ("inner", "left"):
        raise ValueError(f"how {how!r}: inner or left")
    blocks = materialize(dyadic_blocks(intervals, start, end), "interval-blocks")
    sizes = blocks.agg(F.sort_array(F.collect_set("__level"))).scalar()
    place = _position(F.col(day), facts.schema[day].dataType.simpleString())[0]
    sought = facts.withColumn("__level", F.explode(sizes)).withColumn("__block", F.call_function("shiftright", place, F.col("__level")))
    found = sought.join(blocks, ["__level", "__block"]).select(*facts.columns, *intervals.columns)
    if how == "inner":
        return found
    # points that some interval holds, once each
    held = sought.select(F.col(day).alias("__held"), "__level", "__block").distinct().join(
        blocks.select("__level", "__block").distinct(), ["__level", "__block"], "left_semi").select("__held").distinct()
    alone = facts.join(held, F.col(day) == F.col("__held"), "left_anti")
    return found.unionByName(alone.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema.fields]))


def open_on(days: DataFrame, day: str, stores: DataFrame, horizon: Column | None = None,
            opened: str = "open_date", closed: str = "close_date") -> DataFrame:
    """Stores open on each day; a NULL closing date is open for ever, or up to the horizon."""
    until = "__until"
    ends = F.col(closed) if horizon is None else F.least(F.coalesce(F.col(closed), horizon), horizon)
    return in_interval(days, day, stores.withColumn(until, ends), opened, until).drop(until)


def campaign_channels(campaign_type: Column | str) -> Column:
    """Array of the channels a campaign type spends on."""
    kind = F.col(campaign_type) if isinstance(campaign_type, str) else campaign_type
    out = None
    for name, channels in fixed.CAMPAIGN_CHANNELS.items():
        arr = F.array(*[F.lit(c).cast("bigint") for c in channels])
        out = F.when(kind == name, arr) if out is None else out.when(kind == name, arr)
    return out.otherwise(F.array(*[F.lit(c).cast("bigint") for c in fixed.DEFAULT_CAMPAIGN_CHANNELS]))


def spend_spine(campaigns: DataFrame, calendar: DataFrame) -> DataFrame:
    """campaign x active day x channel; campaigns with no day in the calendar vanish."""
    days = active_days(campaigns, "start_date", "end_date", "date").join(
        calendar.select("date", "date_key"), "date")
    return days.withColumn("channel_key", F.explode(campaign_channels("campaign_type")))


def product_stores(products: DataFrame, stores: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every product with every store (and its columns `keep`).

    This product is the result itself. Products are dealt to shelves by hash, as many as the session has shuffle
    partitions, and every store is there once per shelf: a join on the shelf, spread over all tasks.
    """
    shelves = int(products.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    goods = products.select("product_key", F.pmod(F.xxhash64("product_key"), F.lit(shelves)).alias("__shelf")).hint("merge")
    doors = stores.select("store_key", *keep, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shelves - 1).cast("bigint"))).alias("__shelf"))
    return goods.join(doors, "__shelf").drop("__shelf")


def _open_days(first_day: Column, last_day: Column, step: str, opened: str | None, closed: str | None) -> tuple[Column, Column]:
    """(any, days): whether a store is open at all in the span, and the days."""
    start = F.greatest(F.col(opened), first_day) if opened else first_day
    stop = F.least(F.coalesce(F.col(closed), last_day), last_day) if closed else last_day
    return start <= stop, F.sequence(start, stop, F.expr(step))


def inventory_spine(products: DataFrame, stores: DataFrame, first_day: Column, last_day: Column,
                    step: str = "interval 1 day", opened: str | None = None,
                    closed: str | None = None) -> DataFrame:
    """Every (day, product, store) an inventory snapshot must have.

    Only pairs of product and store are shuffled; each unfolds into its days where it is. Stores take part
    only while open if their dates are given.
    """
    dates = tuple(c for c in (opened, closed) if c)
    some, days = _open_days(first_day, last_day, step, opened, closed)
    return product_stores(products, stores, dates).filter(some).select(F.explode(days).alias("date"), "product_key", "store_key")


def inventory_cells(products: DataFrame, stores: DataFrame, snapshots: DataFrame, first_day: Column, last_day: Column, fill: dict[str, object],
                    step: str = "interval 1 day", opened: str | None = None, closed: str | None = None) -> DataFrame:
    """`inventory_spine` with the columns `fill` of the snapshots of each cell, or their defaults.

    Equal to `densify` of the spine, without shuffling the spine: the snapshots of a pair, at most one per day of
    the calendar, meet the pair as a map from day to values and the days are looked up in place.
    """
    dates = tuple(c for c in (opened, closed) if c)
    some, days = _open_days(first_day, last_day, step, opened, closed)
    pairs = product_stores(products, stores, dates).filter(some)
    values = F.struct(*[F.col(c) for c in fill])
    seen = snapshots.filter(F.col("date").isNotNull()).groupBy("product_key", "store_key").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("date"), values))).alias("__seen"))
    cells = pairs.join(seen, ["product_key", "store_key"], "left").select("product_key", "store_key", "__seen", F.explode(days).alias("date"))
    found = F.try_element_at("__seen", F.col("date"))
    return cells.select("date", "product_key", "store_key", *[F.coalesce(found[c], F.lit(v)).alias(c) for c, v in fill.items()])


def densify(spine: DataFrame, facts: DataFrame, keys: list[str], fill: dict[str, object]) -> DataFrame:
    """Left join facts onto a spine and fill what is absent."""
    out = spine.join(facts, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def lookup_with_default(facts: DataFrame, dim: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left lookup on a unique key; missing attributes take their default."""
    attrs = dim.select(key, *defaults)
    out = facts.join(attrs, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def star_join(facts: DataFrame, *dims: tuple[DataFrame, str, list[str]]) -> DataFrame:
    """Fact with attributes of many dimensions, each (dim, key, attributes), missing kept."""
    return reduce(lambda acc, d: acc.join(d[0].select(d[1], *d[2]), d[1], "left"), dims, facts)


def drill_back(returns: DataFrame, sales: DataFrame, take: list[str]) -> DataFrame:
    """Each return with columns of the sale line it undoes."""
    original = sales.select("sale_key", *[F.col(c).alias(f"sale_{c}") for c in take])
    return returns.join(original, "sale_key")


def connected_identities(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): the smallest node reachable over shared identifiers.

    Alternating large-star and small-star contraction until nothing changes, which always comes.
    Neighbourhoods are only ever reduced to their minimum, which combines before the shuffle and
    is written before it is joined: then both sides of the join are plain shuffles, and AQE splits
    the edges of an identifier that a third of all records share. Each round is written to shared
    storage, so lineage stays short and a lost executor costs one round.
    """
    from ..sources.scratch import materialize
    from .compare import row_differences

    a, b = F.col(left), F.col(right)
    pairs = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = materialize(pairs.distinct(), "identity-pairs")
    nodes = edges.select(a.alias("node")).union(edges.select(b.alias("node"))).filter("node IS NOT NULL").distinct()
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")), "identity-low")
        large = materialize(both.join(low.select("u", F.least("m", "u").alias("m")), "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")), "identity-pairs")
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "identity-low")
        small = materialize((
            large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .filter("u <> v").distinct()
        ), "identity-pairs")
        settled = row_differences(small, pairs).isEmpty()
        pairs = small
        if settled:
            return nodes.join(pairs, F.col("node") == F.col("u"), "left").select(
                "node", F.coalesce("v", "node").alias("component"))


def extend_identities(stored: DataFrame, links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) of the nodes that new links bring or move, given the stored (node, component).

    Links are folded onto the roots that their ends are stored under; only these are contracted. A component that no
    link touches has no row in the result, and one that keeps its smallest node has only its new nodes. Merged
    into what is stored by node, the result equals `connected_identities` of all links at once. With `stored` laid out by
    node (`sources.keyed`) its rows are not shuffled to find the ends of the links.
    """
    from ..sources.scratch import materialize

    own = links.select(F.col(left).alias("a"), F.col(right).alias("b"))
    ends = own.select(F.explode(F.array("a", "b")).alias("node")).filter("node IS NOT NULL").distinct()
    ends = materialize(ends.join(stored.select("node", F.col("component").alias("root")), "node", "left"), "identity-ends")
    root = ends.select(F.col("node"), F.coalesce("root", "node").alias("root"))
    folded = own.join(root.select(F.col("node").alias("a"), F.col("root").alias("left")), "a", "left").join(
        root.select(F.col("node").alias("b"), F.col("root").alias("right")), "b", "left")
    moved = materialize(connected_identities(folded.select("left", "right"), "left", "right").withColumnRenamed("node", "root"), "identity-roots")
    fresh = ends.filter("root IS NULL").select("node", F.col("node").alias("root")).join(moved, "root").select("node", "component")
    # a stored root that is no longer the smallest: all its nodes move, found by their component
    gone = moved.filter("root <> component")
    rest = stored.select("node", F.col("component").alias("root")).join(gone, "root").select("node", "component")
    return fresh.unionByName(rest)
