"""As-of join: the lookup row in force at a fact's time.

Facts and lookup rows are merged in time order and each fact takes the last
lookup row before it, so no pair of rows is ever formed. A key is cut into time
ranges that different tasks handle, however many facts it has: what is in force
where a range begins is found first, from one row per key and range.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEED, _LOOKUP, _FACT = range(3)


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def _last_known(keys: list[str]) -> Column:
    ordered = Window.partitionBy(*keys).orderBy("_t", "_kind")
    return F.last("_v", ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def asof_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    at: str,
    since: str,
    columns: list[str],
    range_seconds: int = 86_400 * 30,
    tolerance_seconds: int | None = None,
) -> DataFrame:
    """Facts with `columns` of the lookup row whose key is equal and whose `since` is the latest not after `at`.

    All facts stay; the columns are NULL where the key or time is NULL, no lookup
    row is early enough or, with a tolerance, the latest is older than that. Of
    lookup rows with equal key and time the greatest by `columns` counts; those
    without key or time never match. `keys` name columns of both sides; added
    columns must not be columns of the facts. `range_seconds` is the length of the
    time ranges: choose it so that the busiest key's facts of one range fit a task.
    """
    clash = sorted(set(columns) & set(facts.columns))
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    step = range_seconds * 1_000_000
    first_of = F.floor(F.col("_t") / F.lit(step)).cast("bigint")

    known = lookup.where(F.col(since).isNotNull())
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    value = F.struct(*columns, _micros(F.col(since)).alias("_since"))
    known = known.select(*keys, _micros(F.col(since)).alias("_t"), value.alias("_v")).groupBy(*keys, "_t").agg(F.max("_v").alias("_v"))

    missing = F.col(at).isNull()
    for key in keys:
        missing = missing | F.col(key).isNull()
    payload = [name for name in facts.columns if name not in keys]
    rows = facts.select(
        *keys,
        F.when(~missing, _micros(F.col(at))).alias("_t"),
        F.struct(*payload).alias("_row") if payload else F.struct(F.lit(1).alias("_")).alias("_row"),
        # Facts that cannot match need no neighbours: they stay spread as they came.
        F.when(missing, -1 - F.spark_partition_id()).alias("_apart"),
    ).withColumn("_range", F.coalesce(first_of, F.col("_apart").cast("bigint")))

    places = rows.where("_apart IS NULL").select(*keys, "_range").distinct()
    begins = places.select(*keys, "_range", (F.col("_range") * F.lit(step)).alias("_t"), F.lit(_SEED).alias("_kind"))
    merged = begins.unionByName(known.withColumn("_kind", F.lit(_LOOKUP)), allowMissingColumns=True)
    seeds = merged.withColumn("_v", _last_known(keys)).where((F.col("_kind") == _SEED) & F.col("_v").isNotNull())

    dated = known.withColumns({"_range": first_of, "_kind": F.lit(_LOOKUP)})
    merged = rows.withColumn("_kind", F.lit(_FACT)).unionByName(dated, allowMissingColumns=True).unionByName(seeds, allowMissingColumns=True)
    found = merged.withColumn("_found", _last_known([*keys, "_range", "_apart"])).where(F.col("_kind") == _FACT)
    usable = F.col("_apart").isNull()
    if tolerance_seconds is not None:
        usable = usable & (F.col("_t") - F.col("_found._since") <= tolerance_seconds * 1_000_000)
    own = [F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in facts.columns]
    return found.select(*own, *[F.when(usable, F.col("_found")[name]).alias(name) for name in columns])
