"""Sharding: a uniform shuffle of all rows into shards of exact sizes, by a hypergeometric communication matrix.

Every input partition permutes its rows. How many of them go to each shard is drawn beforehand for all partitions at once,
with the law that a uniform shuffle of the whole table would give (multivariate hypergeometric), so that every shard gets
exactly its rows. The first rows of a permuted partition then go to the first shard, the next to the second and so on; they
are exchanged once, and every shard permutes what it got. All of it is DataFrame and SQL functions.

The matrix is drawn in a tree over the partition numbers: a node shares its quotas among at most 16 children, each of which
draws shard by shard from what is left, and all nodes of a level are drawn in parallel. A draw inverts the distribution
function from the mode outwards, which takes as many steps as the distribution is wide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionflow.llm.frames import hand_off, new_folder, partitions

#: Children of a node are 2 to this power.
FAN_BITS = 4
#: Bits of the row number in what monotonically_increasing_id gives; the partition number is above them.
ROW_BITS = 33
#: Rows that a shard permutes in one group; it has as many groups as it needs.
GROUP_ROWS = 20_000
#: Standard deviations around the mode that a draw looks at; beyond lies less than 10^-30 of the probability.
REACH = 12


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def uniform(*parts: Column) -> Column:
    """A double from 0 to below 1 that depends on the parts only."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0**-53)


def _steps(begin: Column, end: Column, by: int) -> Column:
    some = (begin < end) if by > 0 else (begin > end)
    return F.when(some, F.sequence(begin, end - by, F.lit(by).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def _up(d: Column, w: Column, x: Column) -> Column:
    """The weight of x + 1, given that of x."""
    return w * ((d["marked"] - x).cast("double") * (d["drawn"] - x)) / ((x + 1).cast("double") * (d["size"] - d["marked"] - d["drawn"] + x + 1))


def _down(d: Column, w: Column, x: Column) -> Column:
    """The weight of x - 1, given that of x."""
    return w * (x.cast("double") * (d["size"] - d["marked"] - d["drawn"] + x)) / ((d["marked"] - x + 1).cast("double") * (d["drawn"] - x + 1))


def _total(d: Column, steps: Column, weight) -> Column:
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
    step = lambda s, x: _let(weight(d, s["w"], x), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")))
    return F.aggregate(steps, start, step, lambda s: s["sum"])


def _reached(d: Column, steps: Column, weight, by: int, target: Column) -> Column:
    """The value at which the weights passed on the way from the mode exceed ``target``."""
    start = F.struct(F.lit(1.0).alias("w"), target.alias("rest"), d["mode"].alias("at"))
    move = lambda s, x, w: F.struct(w.alias("w"), (s["rest"] - w).alias("rest"), (x + by).alias("at"))
    step = lambda s, x: F.when(s["rest"] < 0, s).otherwise(_let(weight(d, s["w"], x), lambda w: move(s, x, w)))
    return F.aggregate(steps, start, step, lambda s: s["at"])


def hypergeometric(size: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows from ``size``, of which ``marked`` are marked, are marked; ``u`` is uniform from 0 to 1."""
    zero = F.lit(0).cast("bigint")
    all_rows = F.greatest(size, F.lit(1).cast("bigint")).cast("double")
    wide = F.sqrt(drawn / all_rows * marked * ((size - marked) / all_rows) * (size - drawn) / F.greatest(all_rows - 1, F.lit(1.0)))
    reach = (F.ceil(wide * REACH) + 20).cast("bigint")
    low, high = F.greatest(zero, drawn + marked - size), F.least(drawn, marked)
    mode = F.greatest(low, F.least(high, F.floor((drawn + 1) / (all_rows + 2) * (marked + 1)).cast("bigint")))
    asked = F.struct(size.alias("size"), marked.alias("marked"), drawn.alias("drawn"), u.alias("u"), mode.alias("mode"), low.alias("low"), high.alias("high"), reach.alias("reach"))

    def found(d: Column) -> Column:
        above = _steps(d["mode"], F.least(d["high"], d["mode"] + d["reach"]), 1)
        below = _steps(d["mode"], F.greatest(d["low"], d["mode"] - d["reach"]), -1)
        sums = F.struct(_total(d, above, _up).alias("up"), _total(d, below, _down).alias("down"))

        def walk(s: Column) -> Column:
            target = d["u"] * (s["up"] + s["down"] + 1)
            up = _reached(d, above, _up, 1, target - 1)
            down = _reached(d, below, _down, -1, target - 1 - s["up"])
            return F.when(target < 1, d["mode"]).when(target < 1 + s["up"], up).otherwise(down)

        return _let(sums, walk)

    return _let(asked, found)


def _shares(quotas: Column, n: Column, *seeds: Column) -> Column:
    """How many of ``n`` rows drawn from those of ``quotas`` come from each entry."""
    bigint = lambda c: c.cast("bigint")
    total = F.aggregate(quotas, bigint(F.lit(0)), lambda s, q: s + q)
    start = F.struct(total.alias("size"), n.alias("n"), F.array().cast("array<bigint>").alias("out"))

    def step(s: Column, entry: Column) -> Column:
        q = entry["q"]
        draw = hypergeometric(s["size"], q, s["n"], uniform(*seeds, entry["i"]))
        return _let(draw, lambda x: F.struct((s["size"] - q).alias("size"), (s["n"] - x).alias("n"), F.concat(s["out"], F.array(x)).alias("out")))

    return F.aggregate(F.transform(quotas, lambda q, i: F.struct(q.alias("q"), i.alias("i"))), start, step, lambda s: s["out"])


def _dealt(quotas: Column, children: Column, seed: int, level: int) -> Column:
    """(node, quotas) for every child (node, n); each draws from what those before it have left."""
    empty = F.array().cast("array<struct<node:bigint,quotas:array<bigint>>>")
    start = F.struct(quotas.alias("left"), empty.alias("out"))

    def step(s: Column, child: Column) -> Column:
        def taken(x: Column) -> Column:
            left = F.zip_with(s["left"], x, lambda a, b: a - b)
            return F.struct(left.alias("left"), F.concat(s["out"], F.array(F.struct(child["node"].alias("node"), x.alias("quotas")))).alias("out"))

        return _let(_shares(s["left"], child["n"], F.lit(seed), F.lit(level), child["node"]), taken)

    return F.aggregate(children, start, step, lambda s: s["out"])


def communication_matrix(blocks: DataFrame, quotas: list[int], depth: int, seed: int) -> DataFrame:
    """(node, quotas): for each input partition of ``blocks`` (node, n) how many of its n rows go to each shard.

    ``quotas`` are the shards' sizes and add up to all rows; partition numbers have at most ``depth`` * FAN_BITS bits.
    """
    tree = blocks.sparkSession.createDataFrame([(0, quotas)], "node bigint, quotas array<bigint>")
    for level in reversed(range(depth)):
        sizes = blocks.groupBy(F.shiftright("node", FAN_BITS * level).alias("child")).agg(F.sum("n").alias("n"))
        child = F.struct(F.col("child").alias("node"), "n")
        sizes = sizes.groupBy(F.shiftright("child", FAN_BITS).alias("node")).agg(F.sort_array(F.collect_list(child)).alias("children"))
        tree = tree.join(sizes, "node").select(F.explode(_dealt(F.col("quotas"), F.col("children"), seed, level)).alias("c")).select("c.*")
    return tree


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(row, shard, slot) per row of ``df``: a uniform shuffle into ``shards`` shards whose sizes differ by at most one.

    row holds all columns of ``df``, whatever their names. slot is the row's place in its shard, from 0 without gaps. Every
    arrangement of the rows is as likely as any other, so equal or repeated rows are placed apart from one another like any
    rows, and nulls in any column are values like others. With fewer rows than shards the last shards stay empty; an empty
    table gives no rows. The permuted input is written once to the shared folder, with its partition and place: whatever
    runs again later finds the same rows there.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = df.sparkSession
    permuted = df.select(F.struct(*df.columns).alias("row")).sortWithinPartitions(F.rand(seed))
    placed = hand_off(permuted.select("row", F.monotonically_increasing_id().alias("at")), "shards-permuted")
    block = F.shiftright("at", ROW_BITS)
    blocks = hand_off(placed.groupBy(block.alias("node")).agg(F.count("*").alias("n")), "shards-blocks")
    seen = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.max("node"), F.lit(0)).alias("last")).first()
    quotas = [seen.n // shards + (i < seen.n % shards) for i in range(shards)]
    depth = max(1, -(-int(seen.last).bit_length() // FAN_BITS))
    matrix = hand_off(communication_matrix(blocks, quotas, depth, seed), "shards-matrix")

    running = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out"))
    onwards = lambda s, q: F.struct((s["sum"] + q).alias("sum"), F.concat(s["out"], F.array(s["sum"] + q)).alias("out"))
    ends = matrix.select("node", F.aggregate("quotas", running, onwards, lambda s: s["out"]).alias("ends"))
    groups = max(-(-seen.n // (shards * GROUP_ROWS)), -(-4 * partitions(spark) // shards))

    def dealt(rows: DataFrame) -> DataFrame:
        """The rows with their shard, and with a uniform place of which the group within the shard is the leading part."""
        place = F.col("at") - F.shiftleft(block, ROW_BITS)
        joined = rows.withColumn("node", block).withColumn("place", place).join(ends, "node")
        found = joined.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("place")))).withColumn("u", uniform(F.lit(seed), F.lit("slot"), F.col("at")))
        return found.withColumn("part", F.floor(F.col("u") * groups).cast("int")).drop("node", "place", "ends")

    sizes = dealt(placed.select("at")).groupBy("shard", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("u", "at"))
    numbered = dealt(placed).withColumn("number", inside).join(sizes, ["shard", "part"])
    return numbered.select("row", "shard", (F.col("before") + F.col("number") - 1).alias("slot"))


def write_shards(shuffled: DataFrame, folder: str | None = None) -> str:
    """Writes the result of ``shuffle_into_shards`` as Parquet, a folder per shard, in order of slot within each file."""
    folder = folder or new_folder(shuffled.sparkSession, "shards")
    shuffled.write.partitionBy("shard").parquet(folder)
    return folder
