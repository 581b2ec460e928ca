"""Data-quality checks.  Every check returns the FAILING rows (NULL passes
every check except ``not_null``); ``dq_report`` counts failures of many
checks in one scan per table plus one aggregation per uniqueness check."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlewick.constants import (CURRENCIES, CURRENCY_PAIRS, FRESHNESS_ERROR_MINUTES,
                                  FRESHNESS_WARN_MINUTES, PRICE_MAX, PRICE_MIN, TRADER_TYPES)
from candlewick.functions.columns import micros_between, ntz_lit


@dataclass(frozen=True)
class Check:
    name: str                      # not_null, unique, accepted_values, between, expression, unique_combination
    columns: tuple = ()
    severity: str = "error"        # error | warn
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    expr: str | None = None
    label: str = field(default="")

    @property
    def column(self) -> str:
        return self.label or ",".join(self.columns) or (self.expr or "")

    def failing(self, resolve=None) -> Column | None:
        """Row predicate that marks a failure (None for group checks).
        ``resolve`` maps a column name to a Column (layered reports)."""
        resolve = resolve or F.col
        c = resolve(self.columns[0]) if self.columns else None
        if self.name == "not_null":
            return c.isNull()
        if self.name == "accepted_values":
            return c.isNotNull() & ~c.isin(*self.values)
        if self.name == "between":
            cond = F.lit(False)
            if self.low is not None:
                cond = cond | (c < F.lit(self.low))
            if self.high is not None:
                cond = cond | (c > F.lit(self.high))
            return c.isNotNull() & cond
        if self.name == "expression":
            if resolve is not F.col:
                raise ValueError("expression checks run on their own table (dq_report), not in a layered report")
            e = F.expr(self.expr)
            return e.isNotNull() & ~e
        return None


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    pred = check.failing()
    if pred is not None:
        return df.where(pred)
    if check.name in ("unique", "unique_combination"):
        keys = list(check.columns)
        nonnull = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return (df.where(nonnull).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"))
                .where(F.col("n_records") > 1))
    raise ValueError(f"unknown check {check.name}")


def _report_rows(row, names) -> DataFrame:
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
                 F.lit(c.severity).alias("severity"),
                 F.coalesce(F.col(col), F.lit(0)).cast("long").alias("failures"))
        for c, col in names])).alias("r")).select("r.*")


def _nonnull(keys) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def dq_report(df: DataFrame, checks, model: str = "") -> DataFrame:
    """(model, check, column, severity, failures) for every check.

    All row-level checks are one global aggregate (a row per task is all that
    moves).  The first uniqueness check rides along: rows are grouped by its key with their
    failures summed, so the table is read once; each further one groups by its key alone."""
    spark = df.sparkSession
    row_checks = [c for c in checks if c.failing() is not None]
    rest = [c for c in checks if c.failing() is None]
    names = [(c, f"f{i}") for i, c in enumerate(row_checks)]
    sums = [F.sum(F.when(c.failing(), 1).otherwise(0)).alias(name) for c, name in names]
    parts = []
    if rest:
        keys = list(rest[0].columns)
        per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *sums)
        repeated = F.sum(F.when(_nonnull(keys) & (F.col("_n") > 1), 1).otherwise(0)).alias("u0")
        parts.append(_report_rows(per_key.agg(repeated, *[F.sum(name).alias(name) for _, name in names]), [(rest[0], "u0"), *names]))
    elif row_checks:
        parts.append(_report_rows(df.agg(*sums), names))
    for c in rest[1:]:
        f = failing_rows(df, c).agg(F.count(F.lit(1)).cast("long").alias("failures"))
        parts.append(f.select(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
                              F.lit(c.severity).alias("severity"), "failures"))
    if not parts:
        return spark.createDataFrame([], "model string, check string, column string, severity string, failures long")
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.select(F.lit(model).alias("model"), "*")


# ------------------------------------------------- mergeable check states
def row_states(df: DataFrame, checks, partition: str) -> DataFrame:
    """(partition, check number, failures) of the row-level checks: counts that add up over partitions."""
    held = [(i, c) for i, c in enumerate(checks) if c.failing() is not None]
    sums = df.groupBy(partition).agg(*[F.sum(F.when(c.failing(), 1).otherwise(0)).cast("long").alias(f"f{i}") for i, c in held])
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("no"), F.col(f"f{i}").alias("failures")) for i, _ in held])).alias("s")
    return sums.select(partition, each).select(partition, "s.*")


def key_states(df: DataFrame, checks, partition: str) -> DataFrame:
    """(partition, check number, key digest, rows) of the uniqueness checks: digests of 128 bits in place of the keys."""
    parts = []
    for i, c in enumerate(checks):
        if c.failing() is not None:
            continue
        text = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{j}") for j, k in enumerate(c.columns)]))
        keyed = df.where(_nonnull(c.columns)).select(partition, F.unhex(F.md5(text.cast("binary"))).alias("key"))
        parts.append(keyed.groupBy(partition, "key").agg(F.count(F.lit(1)).alias("n")).select(partition, F.lit(i).alias("no"), "key", "n"))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def refresh_check_states(df: DataFrame, checks, path: str, partition: str = "partition", partitions=None) -> None:
    """Write the states of ``df`` under ``path``, or of the listed ``partitions`` alone: only their folders are read and replaced."""
    if partitions is not None:
        df = df.where(F.col(partition).isin(list(partitions)))
    for name, states in (("rows", row_states(df, checks, partition)), ("keys", key_states(df, checks, partition))):
        if states is not None:
            (states.withColumnRenamed(partition, "partition").hint("rebalance", "partition").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("partition").parquet(f"{path}/{name}"))


def report_from_states(spark, path: str, checks, model: str = "") -> DataFrame:
    """The ``dq_report`` of a table from its stored states: sums of counts, and keys whose rows come to more than one over all partitions."""
    held = spark.read.parquet(f"{path}/rows").groupBy("no").agg(F.sum("failures").alias("failures"))
    if any(c.failing() is None for c in checks):
        per_key = spark.read.parquet(f"{path}/keys").groupBy("no", "key").agg(F.sum("n").alias("n"))
        held = held.unionByName(per_key.groupBy("no").agg(F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("failures")))
    names = spark.createDataFrame([(i, c.name, c.column, c.severity) for i, c in enumerate(checks)], "no int, check string, column string, severity string")
    return F.broadcast(names).join(held, "no", "left").select(  # one row per check
        F.lit(model).alias("model"), "check", "column", "severity", F.coalesce("failures", F.lit(0)).cast("long").alias("failures"))


def store_failures(df: DataFrame, checks, path: str, model: str = "", fmt: str = "parquet") -> None:
    """Persist the failing rows of every check under ``path/<model>/<check>_<n>``
    (overwrite), like a test run that stores its failures for inspection."""
    base = f"{path.rstrip('/')}/{model or 'model'}"
    for i, c in enumerate(checks):
        failing_rows(df, c).write.mode("overwrite").format(fmt).save(f"{base}/{c.name}_{i}")


def dq_report_layers(base: DataFrame, layers, key) -> DataFrame:
    """Several tables that are narrow projections of one base (e.g. raw and
    staged ticks): one global aggregate holds every layer's row-level failure
    sums, and one grouping by the shared uniqueness ``key`` alone counts each
    layer's member rows per key (uniqueness = keys with more than one member).  ``layers``: (model, checks, resolve, member) with
    ``resolve(name) -> Column`` and ``member`` the layer's row filter (None =
    every row).  Uniqueness checks must be on ``key``."""
    key = [key] if isinstance(key, str) else list(key)
    sums, rows, members = [], [], []
    for li, (model, checks, resolve, member) in enumerate(layers):
        m = F.lit(True) if member is None else F.coalesce(member, F.lit(False))
        members.append(F.sum(F.when(m, 1).otherwise(0)).alias(f"m{li}"))
        for ci, c in enumerate(checks):
            pred = c.failing(resolve)
            if pred is None:
                if list(c.columns) != key:
                    raise ValueError(f"uniqueness check on {c.columns} != layered key {key}")
                rows.append((model, c, f"u{li}"))
                continue
            sums.append(F.sum(F.when(m & pred, 1).otherwise(0)).alias(f"f{li}_{ci}"))
            rows.append((model, c, f"f{li}_{ci}"))
    key_cols = [layers[0][2](k).alias(f"_k{i}") for i, k in enumerate(key)]
    nonnull = reduce(lambda a, b: a & b, [F.col(f"_k{i}").isNotNull() for i in range(len(key))])
    per_key = base.groupBy(*key_cols).agg(*members)
    totals = per_key.agg(*[F.sum(F.when(nonnull & (F.col(f"m{li}") > 1), 1).otherwise(0)).alias(f"u{li}")
                           for li in range(len(layers))])

    def listed(frame: DataFrame, which) -> DataFrame:
        return frame.select(F.explode(F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit(c.name).alias("check"), F.lit(c.column).alias("column"),
                     F.lit(c.severity).alias("severity"), F.coalesce(F.col(a), F.lit(0)).cast("long").alias("failures"))
            for model, c, a in which])).alias("r")).select("r.*")

    groups, single = [r for r in rows if r[2].startswith("u")], [r for r in rows if r[2].startswith("f")]
    parts = ([listed(totals, groups)] if groups else []) + ([listed(base.agg(*sums), single)] if single else [])
    return reduce(lambda a, b: a.unionByName(b), parts)


def dq_report_ticks(raw: DataFrame, raw_checks=None, stg_checks=None, raw_model: str = "raw_ticks",
                    stg_model: str = "stg_fx_ticks") -> DataFrame:
    """Source and staging checks of the tick table in one scan: the staged
    rows are the raw rows that pass the quality filter after typing, so both
    layers are columns of one projection (raw values under ``_raw_``)."""
    from candlewick.operators.staging import quality_predicate, typed_ticks
    raw_checks = source_checks() if raw_checks is None else raw_checks
    stg_checks = staging_checks() if stg_checks is None else stg_checks
    carried = [f"_raw_{c}" for c in raw.columns]
    base = typed_ticks(raw.select("*", *[F.col(c).alias(f"_raw_{c}") for c in raw.columns]), keep=carried)
    layers = [(raw_model, raw_checks, lambda n: F.col(f"_raw_{n}"), None),
              (stg_model, stg_checks, F.col, quality_predicate())]
    return dq_report_layers(base, layers, key="tick_id")


def run_checks(df: DataFrame, checks, model: str = "", raise_on_error: bool = False) -> DataFrame:
    """``dq_report`` with an optional hard stop when an error-level check fails."""
    rep = dq_report(df, checks, model)
    if raise_on_error:
        bad = rep.where((F.col("severity") == "error") & (F.col("failures") > 0)).limit(1).collect()
        if bad:
            raise AssertionError(f"data-quality error: {bad[0].asDict()}")
    return rep


# ----------------------------------------------------------- check suites
def source_checks() -> list[Check]:
    """Raw tick source contract."""
    return [
        Check("unique", ("tick_id",)), Check("not_null", ("tick_id",)),
        Check("not_null", ("transaction_timestamp",)),
        Check("not_null", ("currency_pair",)),
        Check("accepted_values", ("currency_pair",), values=tuple(CURRENCY_PAIRS)),
        Check("not_null", ("bid_price",)),
        Check("between", ("bid_price",), "warn", low=PRICE_MIN, high=PRICE_MAX),
        Check("not_null", ("ask_price",)), Check("not_null", ("mid_price",)),
        Check("not_null", ("trade_price",)), Check("not_null", ("volume",)),
    ]


def staging_checks() -> list[Check]:
    """Staged tick contract."""
    return [
        Check("unique", ("tick_id",)), Check("not_null", ("tick_id",)),
        Check("not_null", ("transaction_timestamp",)),
        Check("not_null", ("currency_pair",)),
        Check("accepted_values", ("currency_pair",), values=tuple(CURRENCY_PAIRS)),
        Check("not_null", ("base_currency",)),
        Check("accepted_values", ("base_currency",), values=tuple(CURRENCIES)),
        Check("not_null", ("quote_currency",)),
        Check("accepted_values", ("quote_currency",), values=tuple(CURRENCIES)),
        Check("not_null", ("bid_price",)),
        Check("between", ("bid_price",), "warn", low=PRICE_MIN, high=PRICE_MAX),
        Check("not_null", ("ask_price",)),
        Check("between", ("ask_price",), "warn", low=PRICE_MIN, high=PRICE_MAX),
        Check("not_null", ("mid_price",)), Check("not_null", ("trade_price",)),
        Check("not_null", ("volume",)), Check("between", ("volume",), low=0),
        Check("accepted_values", ("trader_type",), "warn", values=tuple(TRADER_TYPES)),
        Check("expression", (), "error", expr="ask_price >= bid_price", label="ask_price >= bid_price"),
        Check("expression", (), "warn", expr="mid_price >= bid_price and mid_price <= ask_price",
              label="bid <= mid <= ask"),
    ]


def candle_checks(interval: str) -> list[Check]:
    """Candle table contract of a grain; the 1-minute table has the widest one."""
    base = ["candle_timestamp", "currency_pair", "open_price", "high_price", "low_price", "close_price", "total_volume"]
    extra = ["base_currency", "quote_currency", "trade_count", "calculated_at"] if interval == "1min" else []
    checks = [Check("not_null", (c,)) for c in base + extra]
    checks += [Check("accepted_values", ("candle_interval",), values=(interval,)),
               Check("unique_combination", ("currency_pair", "candle_timestamp"))]
    if interval != "1min":
        return checks
    rules = ("low_price <= high_price", "low_price <= open_price", "low_price <= close_price", "high_price >= open_price")
    return checks + [
        Check("accepted_values", ("currency_pair",), values=tuple(CURRENCY_PAIRS)),
        Check("between", ("open_price",), low=PRICE_MIN, high=PRICE_MAX),
        Check("between", ("total_volume",), low=0),
        *[Check("expression", (), expr=rule, label=rule) for rule in rules]]


def ohlc_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Union of OHLC invariant violations (incl. NULL prices) over candle tables."""
    bad = ((F.col("low_price") > F.col("open_price")) | (F.col("low_price") > F.col("high_price")) |
           (F.col("low_price") > F.col("close_price")) | (F.col("high_price") < F.col("open_price")) |
           (F.col("high_price") < F.col("close_price")) | F.col("open_price").isNull() |
           F.col("high_price").isNull() | F.col("low_price").isNull() | F.col("close_price").isNull())
    parts = [t.where(bad).select(F.lit(name).alias("model_name"), "currency_pair", "candle_timestamp",
                                 "open_price", "high_price", "low_price", "close_price")
             for name, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def freshness(df: DataFrame, now, loaded_at: str = "event_time", warn_minutes: int = FRESHNESS_WARN_MINUTES,
              error_minutes: int = FRESHNESS_ERROR_MINUTES) -> DataFrame:
    """Age of the newest ``loaded_at`` value at ``now`` -> pass / warn / error."""
    now_c = ntz_lit(now)
    g = df.agg(F.max(loaded_at).alias("max_loaded_at"))
    age = micros_between(F.col("max_loaded_at"), now_c) / F.lit(60e6)
    return (g.withColumn("age_minutes", age)
            .withColumn("status", F.when(F.col("max_loaded_at").isNull(), "error")
                        .when(F.col("age_minutes") > error_minutes, "error")
                        .when(F.col("age_minutes") > warn_minutes, "warn").otherwise("pass")))


def orphan_values(df: DataFrame, column: str, allowed) -> DataFrame:
    """Rows whose ``column`` value is not in the reference list (left anti
    join against the reference; the reference is a literal, bounded)."""
    spark = df.sparkSession
    ref = spark.createDataFrame([(v,) for v in allowed], f"{column} string")
    return df.where(F.col(column).isNotNull()).join(F.broadcast(ref), column, "left_anti")


def trade_outside_quote(ticks: DataFrame) -> DataFrame:
    """Ticks whose trade price lies outside their own bid/ask."""
    return ticks.where(~F.col("trade_price").between(F.col("bid_price"), F.col("ask_price")))


def schema_changes(actual: StructType, expected: StructType) -> dict:
    """added (non-breaking), removed / retyped (breaking) columns."""
    a = {f.name: f.dataType for f in actual.fields}
    e = {f.name: f.dataType for f in expected.fields}
    return {"added": sorted(set(a) - set(e)), "removed": sorted(set(e) - set(a)),
            "retyped": sorted(k for k in set(a) & set(e) if a[k] != e[k])}


def schema_report(stored: DataFrame, update: DataFrame) -> DataFrame:
    """(column, change, breaking, rows): how an update's columns break a table's contract, with the rows that hold a value there."""
    change = schema_changes(update.schema, stored.schema)
    kinds = [(c, kind, kind != "added", stored if kind != "added" else update) for kind in ("added", "removed", "retyped") for c in change[kind]]
    parts = [df.agg(F.count(F.col(c)).alias("rows")).select(F.lit(c).alias("column"), F.lit(kind).alias("change"), F.lit(bad).alias("breaking"), "rows")
             for c, kind, bad, df in kinds]
    empty = stored.sparkSession.createDataFrame([], "column string, change string, breaking boolean, rows long")
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else empty
