"""Event enrichment: interval joins of ticks with economic events, event
impact factors, hour-of-day profile, pair reference lookups, calendar
proximity.

Interval join plan.  An event is active for a tick when
``start <= ts <= end`` (closed) and it lists the tick's base or quote
currency.  Events are exploded to the time buckets they cover, packed into
arrays of a few hundred with the same bucket and currency list, and the arrays are equi-joined,
per currency, with the ticks' own bucket and currencies and exploded after the join, so the join
itself handles arrays and not tick/event pairs; the bucket is the
largest grid that the events last on average, so an event has few entries and a tick
meets few events that are not active.  If the number of event entries is proven
small they are broadcast (no tick shuffle), else both sides are shuffled (AQE
splits hot buckets).  An event listing both currencies of a pair is kept only
on its base-currency row.

``event_impact`` needs one row per tick and makes no tick/event pairs: it sweeps over
event edges.  Each event adds one to the running counts of its pairs where it starts and
takes one away after it ends; ticks and edges are put in one order, cut into balanced chunks, and
the chunks' totals carry the counts over.  There is a count for each distinct multiplier value, so
factors are powers of exact counts.  The work is linear in ticks plus events, however many
events are active at once.  With too many distinct values for that, an event is a range in the order of
its pair's instants, split into nodes of a binary tree; factors multiply along the tree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.constants import HOUR_VOLUME_PROFILE, PAIR_CONFIG, PAIR_SEED_ROWS, PEAK_HOUR_MULTIPLIER
from candlewick.functions.columns import bucket, interval_minutes, micros_between, scale_effect, scale_shock
from candlewick.operators.windows import balanced_chunks, null_safe_left_join
from candlewick.plans.joins import DEFAULT_BROADCAST_ROWS, has_at_most
from candlewick.schemas import CURRENCY_PAIRS_SEED

EVENT_FIELDS = ("event_id", "event_type", "event_timestamp", "severity", "start_timestamp", "end_timestamp",
                "affected_currencies", "spread_multiplier", "volatility_multiplier", "volume_multiplier")

FACTORS = {"spread_multiplier": "spread_factor", "volatility_multiplier": "volatility_factor", "volume_multiplier": "volume_factor"}
#: Distinct multiplier values that the sweep keeps a count for; beyond it factors are multiplied along a tree of instants.
MAX_FACTOR_VALUES = 64
#: Levels of that tree that an instant looks up; nodes above them are passed down to the highest of these.
NODE_LEVELS = 5
#: Events that an array of the interval join holds, about.
EVENTS_PER_ARRAY = 256


def _grid(events: DataFrame, start: str, end: str) -> str:
    """The largest time bucket that the events last on average."""
    minutes = events.where(F.col(start) <= F.col(end)).agg(F.avg(micros_between(start, end) / F.lit(60e6))).first()[0] or 0
    return max((g for g in ("15min", "1h", "4h", "1d") if interval_minutes(g) <= minutes), key=interval_minutes, default="15min")


def _event_struct(events: DataFrame, fields) -> Column:
    return F.struct(*[F.col(c).alias(c) for c in fields if c in events.columns])


def _entries(events: DataFrame, start: str, end: str, grid: str, fields=EVENT_FIELDS) -> DataFrame:
    """(bucket, affected currencies, event): one row per bucket that an event overlaps."""
    buckets = F.sequence(bucket(start, grid), bucket(end, grid), F.expr(f"INTERVAL {interval_minutes(grid)} MINUTES"))
    return (events.where(F.col(start) <= F.col(end))
            .select(F.explode(buckets).alias("_bucket"), F.col("affected_currencies").alias("_affected"), _event_struct(events, fields).alias("_ev")))


def _packed(entries: DataFrame, keys: list[str], most: int) -> DataFrame:
    """(keys, events): the events of each key in arrays of about ``most``, however many a key has."""
    largest = entries.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    part = F.pmod(F.xxhash64("_ev"), F.lit(largest // most + 1)).alias("_part")
    dealt = entries.select(*keys, part, "_ev").repartition(*keys, "_part")  # single rows are shuffled, so no task packs more than its share
    return dealt.groupBy(*keys, "_part").agg(F.collect_list("_ev").alias("_evs")).drop("_part")


def _array_pairs(ticks: DataFrame, events: DataFrame, ts: str, start: str, end: str,
                 fields=EVENT_FIELDS, max_broadcast_rows: int = 0) -> DataFrame:
    """(bucket, currency) equi-join of ticks with arrays of events, then explode + residual interval test.  A tick meets only
    the events of its own bucket and currencies; the arrays are broadcast if the number of event entries is proven small,
    else both sides are shuffled.  All events of an array list the same currencies, so that test is made once per array."""
    grid = _grid(events, start, end)
    entries = _entries(events, start, end, grid, [c for c in fields if c != "affected_currencies"])
    each = F.explode(F.array_distinct("_affected")).alias("_cur")
    small = max_broadcast_rows > 0 and has_at_most(entries.select(each), max_broadcast_rows)
    ev = _packed(entries, ["_bucket", "_affected"], EVENTS_PER_ARRAY).select("_bucket", "_affected", "_evs", each)
    t = (ticks.withColumn("_bucket", bucket(ts, grid))
         .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
         .withColumn("_cur", F.when(F.col("_side") == 0, F.col("base_currency")).otherwise(F.col("quote_currency"))))
    j = t.join(F.broadcast(ev) if small else ev.hint("merge"), ["_bucket", "_cur"], "inner")  # beyond the broadcast bound, whatever Spark's estimate
    once = (F.col("_side") == 0) | ~F.coalesce(F.array_contains("_affected", F.col("base_currency")), F.lit(False))
    pairs = j.where(once).select(*[F.col(c) for c in ticks.columns], F.explode("_evs").alias("_ev"))
    return pairs.where((F.col(f"_ev.{start}") <= F.col(ts)) & (F.col(ts) <= F.col(f"_ev.{end}")))


def active_events_join(ticks: DataFrame, events: DataFrame, ts: str = "transaction_timestamp",
                       start: str = "start_timestamp", end: str = "end_timestamp",
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """One row per (tick, active event): tick columns + ``event_*`` columns."""
    pairs = _array_pairs(ticks, events, ts, start, end, max_broadcast_rows=max_broadcast_rows)
    ev_cols = [F.col(f"_ev.{c}").alias(c if c.startswith("event_") else f"event_{c}")
               for c in EVENT_FIELDS if c != "affected_currencies" and c in events.columns]
    return pairs.select(*[F.col(c) for c in ticks.columns], *ev_cols)


def _factor_values(events: DataFrame, most: int) -> dict[str, list[float]] | None:
    """The distinct values of each multiplier, or None if there are more than ``most`` in all."""
    told = events.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in FACTORS])).alias("f"))
    rows = told.select("f.*").where("value is not null").distinct().limit(most + 1).collect()
    if len(rows) > most:
        return None
    return {c: sorted(r["value"] for r in rows if r["name"] == c) for c in FACTORS}


def _event_pairs(ticks: DataFrame, events: DataFrame, start: str, end: str, max_broadcast_rows: int) -> DataFrame:
    """(base, quote, from, to, multipliers): one row per event and pair of the ticks that it affects."""
    pairs = ticks.select("base_currency", "quote_currency").distinct()
    sides = pairs.select(F.col("base_currency").alias("_base"), F.col("quote_currency").alias("_quote"),
                         F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("base_currency").alias("cur")),
                                           F.struct(F.lit(1).alias("side"), F.col("quote_currency").alias("cur")))).alias("_s"))
    sides = sides.select("_base", "_quote", F.col("_s.side").alias("_side"), F.col("_s.cur").alias("_cur"))
    sides = F.broadcast(sides) if max_broadcast_rows > 0 and has_at_most(sides, max_broadcast_rows) else sides.hint("merge")
    ev = (events.where(F.col(start) <= F.col(end))
          .select(F.col(start).alias("_from"), F.col(end).alias("_to"), "affected_currencies", *FACTORS,
                  F.explode(F.array_distinct("affected_currencies")).alias("_cur")))
    once = (F.col("_side") == 0) | ~F.coalesce(F.array_contains("affected_currencies", F.col("_base")), F.lit(False))
    return ev.join(sides, "_cur").where(once).select("_base", "_quote", "_from", "_to", *FACTORS)


def _edges(ticks: DataFrame, events: DataFrame, start: str, end: str, max_broadcast_rows: int) -> DataFrame:
    """(base, quote, at, kind, sign, multipliers): two rows per event and pair of the ticks that it affects.

    Ticks are of kind 1, starts come before them at an instant and ends after, so intervals are closed."""
    edge = F.explode(F.array(*[F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind"), F.lit(sign).alias("sign"))
                               for at, kind, sign in (("_from", 0, 1), ("_to", 2, -1))])).alias("_e")
    return _event_pairs(ticks, events, start, end, max_broadcast_rows).select("_base", "_quote", edge, *FACTORS).select(
        "_base", "_quote", F.col("_e.at").alias("_at"), F.col("_e.kind").alias("_kind"), F.col("_e.sign").alias("_sign"), *FACTORS)


def _impact_by_sweep(ticks: DataFrame, events: DataFrame, ts: str, start: str, end: str, values: dict[str, list[float]],
                     max_broadcast_rows: int, n_chunks: int | None) -> DataFrame:
    rows = ticks.select(F.col("base_currency").alias("_base"), F.col("quote_currency").alias("_quote"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"),
                        F.lit(0).alias("_sign"), *[F.lit(None).cast("double").alias(c) for c in FACTORS],
                        F.struct(*[F.col(c) for c in ticks.columns]).alias("_tick"))
    edges = _edges(ticks, events, start, end, max_broadcast_rows)
    both = rows.unionByName(edges, allowMissingColumns=True)
    by = ["_base", "_quote"]
    both = balanced_chunks(both, by, ["_at", "_kind"], n_chunks)
    counts = {"_n": F.col("_sign")}
    for c, own in values.items():
        counts |= {f"_{c}_{i}": F.when(F.col(c) == F.lit(v), F.col("_sign")).otherwise(F.lit(0)) for i, v in enumerate(own) if v != 1.0}
    running = Window.partitionBy(*by, "_chunk").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    inner = both.select("*", *[F.sum(x).over(running).alias(name) for name, x in counts.items()]).where(F.col("_kind") == 1)
    totals = both.groupBy(*by, "_chunk").agg(*[F.sum(x).alias(f"{name}_t") for name, x in counts.items()])
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*by, "_chunk", *[F.coalesce(F.sum(f"{name}_t").over(earlier), F.lit(0)).alias(f"{name}_c") for name in counts])
    out = null_safe_left_join(inner, carry, [*by, "_chunk"])
    n = {name: F.col(name) + F.col(f"{name}_c") for name in counts}
    factors = [reduce(lambda a, b: a * b, [F.pow(F.lit(v), n[f"_{c}_{i}"]) for i, v in enumerate(own) if v != 1.0], F.lit(1.0)).alias(FACTORS[c])
               for c, own in values.items()]
    return out.select("_tick.*", n["_n"].cast("long").alias("active_events"), *factors)


def _pushed_down(held: DataFrame, by) -> DataFrame:
    """The nodes with those above level ``NODE_LEVELS`` given to all nodes below them on that level, so a key never has more than 2^NODE_LEVELS instants."""
    up = F.greatest(F.col("_level") - NODE_LEVELS, F.lit(0))
    first = F.call_function("shiftleft", F.col("_node"), up)
    last = F.call_function("shiftleft", F.col("_node") + 1, up) - 1
    low = held.select(*by, F.least(F.col("_level"), F.lit(NODE_LEVELS)).alias("_level"), F.explode(F.sequence(first, last)).alias("_node"), "_n", *FACTORS)
    return low.groupBy(*by, "_level", "_node").agg(F.sum("_n").alias("_n"), *[F.product(c).alias(c) for c in FACTORS])


def _nodes_of(a: Column, b: Column) -> Column:
    """The binary tree nodes (level, node) that make up the range [a, b): at most two on a level."""
    def on(level):
        one = F.lit(1).cast("long")
        low = F.call_function("shiftright", a + F.call_function("shiftleft", one, level) - 1, level)  # full nodes on this level: [low, high)
        high = F.call_function("shiftright", b, level)
        return F.array(F.when((low < high) & (low % 2 == 1), F.struct(level.alias("level"), low.alias("node"))),
                       F.when((low < high) & (high % 2 == 1), F.struct(level.alias("level"), (high - 1).alias("node"))))

    levels = F.sequence(F.lit(0), F.ceil(F.log2(b - a)).cast("int"))
    return F.filter(F.flatten(F.transform(levels, on)), lambda x: x.isNotNull())


def _impact_by_nodes(ticks: DataFrame, events: DataFrame, ts: str, start: str, end: str,
                     max_broadcast_rows: int, n_chunks: int | None) -> DataFrame:
    """For multipliers of very many distinct values: products over a binary tree of the instants of each pair.

    Impact depends on the instant and the two currencies alone, so it is computed once for each of these and joined back: repeated
    ticks neither multiply nor merge.  Instants and event edges are put in one order, which numbers the instants; an event is a range
    of these numbers, and that is at most two tree nodes per level.  A node multiplies the events that have it, an instant the
    nodes above it.  Nothing is divided and no tick meets an event: rows grow with the logarithm of an event's instants."""
    by, span = ["_base", "_quote"], ["_base", "_quote", "_from", "_to"]
    instants = ticks.select(F.col("base_currency").alias("_base"), F.col("quote_currency").alias("_quote"), F.col(ts).alias("_at"),
                            F.lit(1).alias("_kind")).distinct()
    own = _event_pairs(ticks, events, start, end, max_broadcast_rows).groupBy(*span).agg(
        F.count(F.lit(1)).alias("_n"), *[F.product(c).alias(c) for c in FACTORS])
    edges = own.select("*", F.explode(F.array(*[F.struct(F.col(at).alias("at"), F.lit(kind).alias("kind")) for at, kind in (("_from", 0), ("_to", 2))])).alias("_e"))
    edges = edges.select(*span, "_n", *FACTORS, F.col("_e.at").alias("_at"), F.col("_e.kind").alias("_kind"))
    both = balanced_chunks(instants.unionByName(edges, allowMissingColumns=True), by, ["_at", "_kind"], n_chunks)
    one = F.when(F.col("_kind") == 1, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
    running = Window.partitionBy(*by, "_chunk").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    totals = both.groupBy(*by, "_chunk").agg(F.sum(one).alias("_own"))
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*by, "_chunk", F.coalesce(F.sum("_own").over(earlier), F.lit(0)).alias("_before"))
    placed = null_safe_left_join(both.withColumn("_seen", F.sum(one).over(running)), carry, [*by, "_chunk"])
    placed = placed.withColumn("_seen", F.col("_seen") + F.col("_before"))  # the pair's instants up to this row
    ranges = placed.where(F.col("_kind") != 1).groupBy(*span).agg(
        F.max(F.when(F.col("_kind") == 0, F.col("_seen"))).alias("_a"), F.max(F.when(F.col("_kind") == 2, F.col("_seen"))).alias("_b"),
        *[F.max(c).alias(c) for c in ("_n", *FACTORS)]).where(F.col("_a") < F.col("_b"))
    held = ranges.select(*by, F.explode(_nodes_of(F.col("_a"), F.col("_b"))).alias("_e"), "_n", *FACTORS)
    held = held.groupBy(*by, F.col("_e.level").alias("_level"), F.col("_e.node").alias("_node")).agg(
        F.sum("_n").alias("_n"), *[F.product(c).alias(c) for c in FACTORS])
    above = placed.where(F.col("_kind") == 1).select(*by, "_at", (F.col("_seen") - 1).alias("_i"),
                                                     F.explode(F.sequence(F.lit(0), F.lit(NODE_LEVELS))).alias("_level"))
    above = above.select(*by, "_at", "_level", F.call_function("shiftright", F.col("_i"), F.col("_level")).alias("_node"))
    keys = [*by, "_level", "_node"]
    low = _pushed_down(held, by).select(*[F.col(k).alias(f"_held{k}") for k in keys], "_n", *FACTORS)
    met = above.join(low.hint("merge"), reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_held{k}")) for k in keys]))
    agg = met.groupBy(*by, "_at").agg(F.sum("_n").alias("active_events"), *[F.product(c).alias(name) for c, name in FACTORS.items()])
    back = {"_base": "base_currency", "_quote": "quote_currency", "_at": ts}
    agg = agg.select(*[F.col(k).alias(f"_k{k}") for k in back], "active_events", *FACTORS.values())
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k{k}")) for k, c in back.items()])
    return (ticks.join(agg.hint("merge"), same, "left")
            .select(*[F.col(c) for c in ticks.columns], F.coalesce("active_events", F.lit(0).cast("long")).alias("active_events"),
                    *[F.coalesce(c, F.lit(1.0)).alias(c) for c in FACTORS.values()]))


def event_impact(ticks: DataFrame, events: DataFrame, ts: str = "transaction_timestamp",
                 start: str = "start_timestamp", end: str = "end_timestamp",
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, n_chunks: int | None = None,
                 max_factor_values: int = MAX_FACTOR_VALUES) -> DataFrame:
    """Per tick: number of active events and the products of their spread /
    volatility / volume multipliers (1.0 when none; a NULL multiplier counts as none), plus the effective
    volatility = pair volatility x hour multiplier x volatility product.

    ``max_broadcast_rows`` bounds the table of distinct pairs that meets the events; 0 shuffles it."""
    values = _factor_values(events, max_factor_values)
    out = (_impact_by_sweep(ticks, events, ts, start, end, values, max_broadcast_rows, n_chunks) if values is not None
           else _impact_by_nodes(ticks, events, ts, start, end, max_broadcast_rows, n_chunks))
    return (with_hour_profile(with_pair_reference(out, ["volatility"]), ts)
            .withColumn("effective_volatility",
                        F.col("pair_volatility") * F.col("hour_volume_multiplier") * F.col("volatility_factor")))


def scaled_effects(events: DataFrame) -> DataFrame:
    """Severity-scaled spread / volatility multipliers (1 + (m-1)*sev/5) and,
    when present, the price shock (shock*sev/5, NULL stays NULL); volume is
    not scaled."""
    out = (events.withColumn("scaled_spread_multiplier", scale_effect("spread_multiplier", "severity"))
           .withColumn("scaled_volatility_multiplier", scale_effect("volatility_multiplier", "severity")))
    if "price_shock_percent" in events.columns:
        out = out.withColumn("scaled_price_shock_percent", scale_shock("price_shock_percent", "severity"))
    return out


# ------------------------------------------------------------ lookups
def hour_multiplier(ts) -> Column:
    """Volume multiplier of the tick's UTC hour (1.0 outside the profile)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    profile = F.array(*[F.lit(float(x)) for x in HOUR_VOLUME_PROFILE])
    return F.coalesce(F.try_element_at(profile, F.hour(ts) + 1), F.lit(1.0))


def with_hour_profile(df: DataFrame, ts: str = "transaction_timestamp") -> DataFrame:
    """Adds ``hour``, ``hour_volume_multiplier`` and ``is_peak_hour`` (>= 1.2).
    The 24-entry profile is a literal array: no join at all."""
    return (df.withColumn("hour", F.hour(ts).cast("long"))
            .withColumn("hour_volume_multiplier", hour_multiplier(ts))
            .withColumn("is_peak_hour", F.col("hour_volume_multiplier") >= F.lit(PEAK_HOUR_MULTIPLIER)))


def pairs_reference(spark: SparkSession) -> DataFrame:
    """The currency_pairs seed (6 rows, declared types)."""
    from decimal import Decimal
    rows = [tuple(Decimal(x) if i in (3, 4, 5, 7, 8) else x for i, x in enumerate(r)) for r in PAIR_SEED_ROWS]
    return spark.createDataFrame(rows, CURRENCY_PAIRS_SEED)


def calendar_reference(spark: SparkSession, base_date) -> DataFrame:
    """The 5-row economic calendar seed, scheduled base_date + 3/7/10/14/21
    days; ``created_at`` defaults to the current timestamp."""
    import datetime as _dt
    from candlewick.constants import CALENDAR_SEED_ROWS
    rows = [(eid, name, etype, base_date + _dt.timedelta(days=d), list(cur), impact, desc)
            for eid, name, etype, d, cur, impact, desc in CALENDAR_SEED_ROWS]
    df = spark.createDataFrame(rows, "event_id string, event_name string, event_type string, "
                                     "scheduled_timestamp timestamp, affected_currencies array<string>, "
                                     "expected_impact string, description string")
    return df.withColumn("created_at", F.current_timestamp())


_PAIR_REF_DDL = ("currency_pair string, min_spread_bps double, max_spread_bps double, pair_volatility double, "
                 "base_price double, typical_trade_size double, primary_exchange string")


def pair_reference_table(spark: SparkSession) -> DataFrame:
    """Pair configuration + seed attributes, one row per pair (fixed, 6 rows)."""
    exchange = {r[2]: r[9] for r in PAIR_SEED_ROWS}
    rows = [(p, float(a), float(b), float(v), float(bp), float(ts), exchange.get(p))
            for p, (a, b, v, bp, ts) in PAIR_CONFIG.items()]
    return spark.createDataFrame(rows, _PAIR_REF_DDL)


_REF_FIELDS = {"min_spread_bps": "min_spread_bps", "max_spread_bps": "max_spread_bps",
               "volatility": "pair_volatility", "primary_exchange": "primary_exchange",
               "base_price": "base_price", "typical_trade_size": "typical_trade_size"}


def with_pair_reference(df: DataFrame, fields=("min_spread_bps", "max_spread_bps", "volatility",
                                               "primary_exchange")) -> DataFrame:
    """Left lookup of pair attributes by ``currency_pair``.  The reference is
    a 6-row literal, so the broadcast is bounded by construction; columns
    that already exist in ``df`` come back prefixed ``ref_``."""
    cols = [_REF_FIELDS[f] for f in fields]
    ref = pair_reference_table(df.sparkSession).select(
        "currency_pair", *[F.col(c).alias(f"ref_{c}" if c in df.columns else c) for c in cols])
    return df.join(F.broadcast(ref), "currency_pair", "left")


def calendar_context(candles: DataFrame, events: DataFrame, minutes: int = 60,
                     when: str = "event_timestamp", max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Candles paired with scheduled events within +/- ``minutes`` of the candle
    start that affect the pair's base or quote currency."""
    span = F.make_dt_interval(mins=F.lit(minutes))
    win = (events.withColumn("start_timestamp", F.col(when) - span)
           .withColumn("end_timestamp", F.col(when) + span))
    pairs = active_events_join(candles, win, ts="candle_timestamp",
                               max_broadcast_rows=max_broadcast_rows)
    return pairs
