"""Joins and ordered windows that keep working when one key holds a large share of all rows.

A key is *hot* when it holds at least about ``1/share`` of the rows, so there are only a few thousand hot keys whatever
the size of the input, and tables with a few rows per piece of a hot key are safe to broadcast. Hot keys are looked for before
the plan is built, in a sample of the key columns, the way a range partitioner finds its bounds. The sample only
decides how the work is spread: every row is kept, and the result is exact for any set of hot keys. Where no key is
hot, operators take their plain form.

The search runs at every size; in an input where no key reaches ``SkewPolicy.min_rows`` it finds none.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled rows expected per piece of a hot key: enough to tell a hot key from a cold one.
SAMPLE_PER_PIECE = 250
SEED = 17


@dataclass(frozen=True)
class SkewPolicy:
    """When to treat a key as hot.

    share:    a hot key holds at least about ``1/share`` of the rows, and is cut into pieces of that size. About the
              cores of a large cluster: no piece is then more than one core's part of the work.
    min_rows: keys below this many rows are left alone; one task handles them without trouble.
    rows:     rows of the input, where known; otherwise each operator counts its own.
    """

    share: int = 4096
    min_rows: int = 1_000_000
    rows: int = 0

    def piece(self, df: DataFrame) -> int:
        return max((self.rows or df.count()) // self.share, self.min_rows, 1)


DEFAULT_SKEW = SkewPolicy()


def policy_for(*tables: DataFrame, skew: SkewPolicy = DEFAULT_SKEW) -> SkewPolicy:
    """The policy for operators over these tables, whatever their size.

    Counting a stored table reads no column, only the row counts in the file footers.
    """
    rows = max(table.count() for table in tables)
    return replace(skew, rows=rows)


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of an input: (keys, _slices[, _bounds, _step, _firsts]), at most some 1.25 * share rows.

    ``table`` is None where no key is hot.
    """

    keys: tuple[str, ...]
    table: DataFrame | None

    def renamed(self, *names: str) -> HotKeys:
        """The same hot values for other key columns: good for rows that are at most as many per key."""
        if self.table is None:
            return HotKeys(names, None)
        return HotKeys(names, self.table.withColumnsRenamed(dict(zip(self.keys, names, strict=True))))


def hot_keys(df: DataFrame, keys: Sequence[str], skew: SkewPolicy, order: Sequence[str] = ()) -> HotKeys:
    """Find the hot keys of ``df``; with ``order``, also the values that cut each of them into even ranges.

    Runs one job over the key columns. What reaches the driver is bounded by the policy: a few thousand keys and about
    as many cut points. Every ``_step``-th cut point is in ``_firsts`` too, for a search in two short steps.
    """
    piece = skew.piece(df)
    fraction = min(1.0, SAMPLE_PER_PIECE / piece)
    columns = df.select(*keys, *[c for c in order if c not in keys])
    sampled = columns.sample(fraction, SEED) if fraction < 1 else columns
    slices = F.ceil(F.col("_n") / (piece * fraction)).cast("int")
    counted = sampled.groupBy(*keys)
    if order:
        counted = counted.agg(
            F.count(F.lit(1)).alias("_n"), F.array_sort(F.collect_list(F.struct(*order))).alias("_sorted")
        )
    else:
        counted = counted.agg(F.count(F.lit(1)).alias("_n"))
    found = counted.filter(F.col("_n") >= 0.8 * piece * fraction).select(
        *keys, slices.alias("_slices"), *(["_sorted"] if order else [])
    )
    if order:
        found = found.select(
            *keys,
            "_slices",
            F.array_distinct(
                F.filter(
                    F.transform(
                        F.sequence(F.lit(1), F.greatest(F.col("_slices") - 1, F.lit(1))),
                        lambda i: F.get("_sorted", F.floor(i * F.size("_sorted") / F.col("_slices")).cast("int")),
                    ),
                    lambda b: b.isNotNull(),
                )
            ).alias("_bounds"),
        ).withColumn("_step", F.greatest(F.ceil(F.sqrt(F.size("_bounds"))), F.lit(1)).cast("int"))
        found = found.withColumn(
            "_firsts", F.filter("_bounds", lambda _, i: F.pmod(i, F.col("_step")) == 0)
        )
    rows = found.collect()
    table = df.sparkSession.createDataFrame(rows, found.schema) if rows else None
    return HotKeys(tuple(keys), table)


def hot_keys_together(df: DataFrame, key_sets: Sequence[Sequence[str]], skew: SkewPolicy) -> list[HotKeys]:
    """``hot_keys`` for several sets of key columns at once: one job over one sample of ``df``."""
    piece = skew.piece(df)
    fraction = min(1.0, SAMPLE_PER_PIECE / piece)
    names = list(dict.fromkeys(c for keys in key_sets for c in keys))
    columns = df.select(*names)
    sampled = columns.sample(fraction, SEED) if fraction < 1 else columns
    slices = F.ceil(F.col("_n") / (piece * fraction)).cast("int")
    counted = sampled.groupingSets([[F.col(c) for c in keys] for keys in key_sets], *names).agg(
        F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set")
    )
    rows = counted.filter(F.col("_n") >= 0.8 * piece * fraction).select(*names, slices.alias("_slices"), "_set").collect()
    out = []
    for keys in key_sets:
        number = sum((c not in set(keys)) << (len(names) - 1 - i) for i, c in enumerate(names))
        of_set = [(*[r[c] for c in keys], r["_slices"]) for r in rows if r["_set"] == number]
        schema = T.StructType([*[df.schema[c] for c in keys], T.StructField("_slices", T.IntegerType())])
        out.append(HotKeys(tuple(keys), df.sparkSession.createDataFrame(of_set, schema) if of_set else None))
    return out


def _beside(df: DataFrame, hot: HotKeys, columns: Sequence[str]) -> DataFrame:
    """``df`` with columns of its hot key, null for every other row. Null keys count as keys."""
    names = {k: f"_hot_{i}" for i, k in enumerate(hot.keys)}
    small = F.broadcast(hot.table.select(*[F.col(k).alias(n) for k, n in names.items()], *columns))
    same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in names.items()])
    return df.join(small, same, "left").drop(*names.values())


def _spread(df: DataFrame) -> Column:
    """An even number per row that stays the same when the row's task runs again. Maps cannot be hashed."""
    hashable = [F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind]
    return F.xxhash64(F.spark_partition_id(), *hashable)


def with_slice(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Add ``_slice``: rows of a hot key are spread over its slices, all other rows are in slice 0."""
    number = _spread(df)
    return (
        _beside(df, hot, ["_slices"])
        .withColumn(
            "_slice", F.when(F.col("_slices").isNotNull(), F.pmod(number, F.col("_slices"))).otherwise(0).cast("int")
        )
        .drop("_slices")
    )


def lookup_join(
    rows: DataFrame,
    attrs: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    skew: SkewPolicy | None = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join ``rows`` with ``attrs``, which has at most one row per key.

    Rows of a hot key are spread over slices, and the one ``attrs`` row of that key is repeated once per slice. ``hot``
    may name the hot keys when the caller can tell them from a cheaper table.
    """
    keys = list(keys)
    if skew is None:
        return rows.join(attrs, keys, how)
    hot = hot_keys(rows, keys, skew) if hot is None else hot
    if hot.table is None:
        return rows.join(attrs, keys, how)
    copies = (
        _beside(attrs, hot, ["_slices"])
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices")
    )
    return with_slice(rows, hot).join(copies, [*keys, "_slice"], how).drop("_slice")


def with_last(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the ``value`` of the last row of each key to all its rows. ``hot`` may name the hot keys, where they are known.

    One shuffle by key. For the few hot keys the last value is aggregated beforehand, on the map side, and broadcast;
    their rows take part in the shuffle spread over slices.
    """
    keys = list(keys)
    last = F.max_by(value, F.struct(*order))
    if skew is None:
        hot = HotKeys(tuple(keys), None)
    elif hot is None:
        hot = hot_keys(df, keys, skew)
    if hot.table is None:
        return df.withColumn(out, last.over(Window.partitionBy(*keys)))
    of_hot = (
        _beside(df, hot, ["_slices"])
        .filter(F.col("_slices").isNotNull())
        .groupBy(*keys)
        .agg(last.alias("_last"), F.lit(True).alias("_is_hot"))
    )
    sliced = _beside(with_slice(df, hot), HotKeys(tuple(keys), of_hot), ["_last", "_is_hot"])
    in_slice = last.over(Window.partitionBy(*keys, "_slice"))
    return sliced.withColumn(out, F.when(F.col("_is_hot"), F.col("_last")).otherwise(in_slice)).drop(
        "_last", "_is_hot", "_slice"
    )


def _with_parts(df: DataFrame, hot: HotKeys, order: Sequence[str]) -> DataFrame:
    """Add ``_part``: rows of a hot key are cut into ranges of the order columns; equal values stay together."""
    value = F.struct(*order)

    def passed(bounds: Column | str) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= value))

    start = (passed("_firsts") - 1) * F.col("_step")
    in_step = F.slice("_bounds", F.greatest(start + 1, F.lit(1)), F.col("_step"))
    return (
        _beside(df, hot, ["_bounds", "_step", "_firsts"])
        .withColumn("_hot", F.col("_bounds").isNotNull())
        .withColumn("_part", F.when(F.col("_hot") & (start >= 0), start + passed(in_step)).otherwise(F.lit(0)))
        .drop("_bounds", "_step", "_firsts")
    )


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos", skew: SkewPolicy | None = DEFAULT_SKEW
) -> DataFrame:
    """Add the 0-based position of each row within its key. ``order`` must be total within a key."""
    keys = list(keys)
    hot = HotKeys(tuple(keys), None) if skew is None else hot_keys(df, keys, skew, order)
    if hot.table is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1)
    parts = _with_parts(df, hot, order)
    in_part = Window.partitionBy(*keys, "_part").orderBy(*order)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range of a hot key
    offsets = (
        parts.filter("_hot")
        .groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    )
    return (
        _beside(
            parts.withColumn(out, F.row_number().over(in_part).cast("long") - 1),
            HotKeys((*keys, "_part"), offsets),
            ["_offset"],
        )
        .withColumn(out, F.col(out) + F.coalesce("_offset", F.lit(0)))
        .drop("_offset", "_part", "_hot")
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int,
    out: str,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Add an array of the ``n`` preceding values of each row within its key, oldest first.

    Within a hot key each range of rows gets the last ``n`` values before it from the earlier ranges, so no task needs
    the whole key.
    """
    keys = list(keys)
    hot = HotKeys(tuple(keys), None) if skew is None else hot_keys(df, keys, skew, order)
    if hot.table is None:
        before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-n, -1)
        return df.withColumn(out, F.collect_list(value).over(before))
    parts = _with_parts(df, hot, order)
    part_keys = [*keys, "_part"]
    in_part = Window.partitionBy(*part_keys).orderBy(*order)
    from_end = Window.partitionBy(*part_keys).orderBy(*[F.desc(c) for c in order])
    tails = (
        parts.filter("_hot")
        .withColumn("_back", F.row_number().over(from_end))
        .filter(F.col("_back") <= n)
        .select(*part_keys, "_back", value)
    )
    across = Window.partitionBy(*keys).orderBy("_part", F.desc("_back"))
    # one row with at most n values per range of a hot key
    carried = (
        tails.withColumn("_carry", F.collect_list(value).over(across.rowsBetween(-n, -1)))
        .withColumn("_first", F.row_number().over(Window.partitionBy(*part_keys).orderBy(F.desc("_back"))))
        .filter(F.col("_first") == 1)
    )
    own = F.collect_list(value).over(in_part.rowsBetween(-n, -1))
    nothing = F.array().cast(f"array<{dict(df.dtypes)[value]}>")
    return (
        _beside(parts.withColumn("_own", own), HotKeys(tuple(part_keys), carried), ["_carry"])
        .withColumn("_all", F.concat(F.coalesce("_carry", nothing), "_own"))
        .withColumn(out, F.slice("_all", F.greatest(F.size("_all") - n + 1, F.lit(1)), n))
        .drop("_own", "_all", "_carry", "_part", "_hot")
    )
