"""Uniform sharding by a hypergeometric communication matrix, in DataFrame functions only.

All rows are shuffled uniformly into shards whose row counts differ by one at most (the
law ``rows``):

* Local permutation: each task of the input puts its rows in a random order (sorted by a
  seeded hash of their place) and the rows are written with their task and place.
* Communication matrix: how many rows of task p go to block t of a shard. For a uniform
  permutation, rows of the matrix are multivariate hypergeometric given what the tasks
  before them have left of the blocks' exact sizes; each entry is one exact hypergeometric
  draw by inversion outward from the mode. Tasks are grouped ``FAN`` at a time into a
  tree, whose nodes are drawn from the root down, so no row of the plan holds more than
  ``FAN`` tasks.
* Exchange: the first rows of a task's order go to the first block, and so on, by the
  counts of its row of the matrix.
* Second permutation: a block's rows are sorted by another seeded hash; the slot is the
  rows of the shard's blocks before it plus the place.

A shard has one block per ``BLOCK_ROWS`` rows, so tasks after the exchange have equal
sizes however many rows a shard has. Order depends on places only, never on texts:
equal texts (a hot group of copies) are spread as any rows are. The result is a function
of the stored first order, so a task that is run again gives the same rows; another
split of the input into tasks gives another, equally uniform shuffle.

Nulls and empty texts are rows like others, of size 1 and checksum 0 in ``shard_digests``;
null and repeated ids, repeated rows and very long texts are carried along whole. Columns
named ``shard`` or ``slot`` are replaced, others are kept whatever their names. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SHARDS, SEED = 16, 13
BLOCK_ROWS, FAN = 1 << 22, 256
LOCAL = (1 << 33) - 1  # monotonically_increasing_id(): task above these bits, place within it
#: Reach of a draw around its mode: so many standard deviations and values more.
DEVIATIONS, VALUES = 12, 40


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def counting(least: Column, n: Column) -> Column:
    """[least, least + 1, ...] of ``n`` numbers, perhaps none."""
    return F.when(n > 0, F.sequence(least, least + n - 1)).otherwise(F.array().cast("array<bigint>"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 53 bits, from a hash."""
    return F.xxhash64(*parts).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))


def hypergeometric(pool: Column, marked: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` taken from ``pool`` are among its ``marked``, by inversion of ``u``.

    Weights relative to the mode follow from exact ratios of neighbouring values; their
    sum takes the place of the normalising constant.
    """
    def drawn(v: Column) -> Column:
        n, k, m = v["pool"].cast("double"), v["marked"].cast("double"), v["draws"].cast("double")
        spread = F.sqrt(F.greatest(F.lit(0.0), m * k * (n - k) * (n - m) / F.greatest(F.lit(1.0), n * n * (n - 1))))
        lo = F.greatest(F.lit(0).cast("bigint"), v["draws"] - (v["pool"] - v["marked"]))
        hi = F.least(v["draws"], v["marked"])
        mode = F.greatest(lo, F.least(hi, F.floor((m + 1) * (k + 1) / (n + 2))))
        reach = F.ceil(spread * DEVIATIONS) + VALUES
        return let(F.struct(v["pool"].alias("pool"), v["marked"].alias("marked"), v["draws"].alias("draws"), v["u"].alias("u"), mode.alias("mode"),
                            F.least(hi - mode, reach).alias("above"), F.least(mode - lo, reach).alias("under")), walked)

    def walked(v: Column) -> Column:
        rest = v["pool"] - v["marked"] - v["draws"]
        up = lambda x: (v["marked"] - x + 1).cast("double") * (v["draws"] - x + 1) / (x.cast("double") * (rest + x))  # noqa: E731  weight of x over that of x - 1
        down = lambda x: (x + 1).cast("double") * (rest + x + 1) / ((v["marked"] - x).cast("double") * (v["draws"] - x))  # noqa: E731  of x over x + 1
        ups, downs = counting(v["mode"] + 1, v["above"]), F.reverse(counting(v["mode"] - v["under"], v["under"]))

        def total(places: Column, ratio: Callable) -> Column:
            return F.aggregate(places, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")),
                               lambda a, x: let(a["w"] * ratio(x), lambda w: F.struct(w.alias("w"), (a["sum"] + w).alias("sum"))), lambda a: a["sum"])

        def walk(places: Column, ratio: Callable, left: Column) -> Column:
            # the first place at which the weights reach what is left, or the last one
            return F.aggregate(places, F.struct(F.lit(1.0).alias("w"), left.alias("left"), v["mode"].alias("at")),
                               lambda a, x: F.when(a["left"] <= 0, a).otherwise(let(a["w"] * ratio(x), lambda w: F.struct(
                                   w.alias("w"), (a["left"] - w).alias("left"), x.alias("at")))), lambda a: a["at"])

        def chosen(t: Column) -> Column:
            return (F.when(t["goal"] <= 1, v["mode"]).when(t["goal"] <= 1 + t["over"], walk(ups, up, t["goal"] - 1))
                    .otherwise(walk(downs, down, t["goal"] - 1 - t["over"])))

        sums = F.struct(total(ups, up).alias("over"), total(downs, down).alias("below"))
        return let(sums, lambda s: let(F.struct((v["u"] * (1 + s["over"] + s["below"])).alias("goal"), s["over"].alias("over")), chosen))

    return let(F.struct(pool.alias("pool"), marked.alias("marked"), draws.alias("draws"), u.alias("u")), drawn)


def dealt(left: Column, size: Column, seed: list[Column]) -> Column:
    """A multivariate hypergeometric row: how many of ``size`` rows each block gets, of the places ``left`` in them."""
    start = F.struct(size.alias("need"), F.aggregate(left, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("pool"),
                     F.array().cast("array<bigint>").alias("row"))

    def block(a: Column, t: Column) -> Column:
        free = F.get(left, t)
        return let(hypergeometric(a["pool"], free, a["need"], uniform(*seed, t)), lambda k: F.struct(
            (a["need"] - k).alias("need"), (a["pool"] - free).alias("pool"), F.array_append(a["row"], k).alias("row")))

    return F.aggregate(F.sequence(F.lit(0), F.size(left) - 1), start, block, lambda a: a["row"])


def communication_matrix(tasks: DataFrame, blocks: list[int] | Column, seed: int) -> DataFrame:
    """(node, row): for each task (node, size) how many of its rows go to each block; ``blocks`` are their sizes.

    Row sums are the tasks' sizes and column sums the blocks'.
    """
    levels = [stored(tasks.select("node", "size"), "shard-tasks")]
    most = levels[0].agg(F.max("node")).first()[0] or 0
    while most > 0:
        most //= FAN
        levels.append(stored(levels[-1].groupBy(F.floor(F.col("node") / FAN).alias("node")).agg(F.sum("size").alias("size")), "shard-tasks"))
    row = blocks if isinstance(blocks, Column) else F.array(*[F.lit(b).cast("bigint") for b in blocks])
    given = tasks.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("node"), row.alias("row"))
    for depth in range(len(levels) - 2, -1, -1):
        kids = levels[depth].groupBy(F.floor(F.col("node") / FAN).alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("node", "size"))).alias("kids"))
        start = F.struct(F.col("row").alias("left"), F.array().cast("array<array<bigint>>").alias("rows"))

        def kid(a: Column, x: Column) -> Column:
            own = dealt(a["left"], x["size"], [F.lit(seed), F.lit(depth), x["node"]])
            return let(own, lambda r: F.struct(F.zip_with(a["left"], r, lambda p, q: p - q).alias("left"), F.array_append(a["rows"], r).alias("rows")))

        drawn = (kids.join(given.withColumnRenamed("node", "parent"), "parent")
                 .select("kids", F.aggregate("kids", start, kid, lambda a: a["rows"]).alias("rows")))
        given = stored(drawn.select(F.explode(F.arrays_zip("kids", "rows")).alias("x")).select("x.kids.node", F.col("x.rows").alias("row")), "shard-matrix")
    return given


def ends(counts: Column) -> Column:
    """Running sums, each with its own value."""
    return F.aggregate(counts, F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out")),
                       lambda a, x: let(a["sum"] + x, lambda s: F.struct(s.alias("sum"), F.array_append(a["out"], s).alias("out"))), lambda a: a["out"])


def share(n: Column, parts: int, k: Column) -> Column:
    """Size of the ``k``-th of ``parts`` parts of ``n`` that are at most one apart."""
    return F.floor(n / parts) + (k < n % parts).cast("bigint")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (from 0 in each shard, without gaps), in that order within a task."""
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    placed = (docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.monotonically_increasing_id().alias("at"))
              .sortWithinPartitions(F.xxhash64(F.lit(seed), "at"), "at").select("row", F.monotonically_increasing_id().alias("at")))
    placed = stored(placed, "shard-rows").select("row", F.shiftright("at", 33).alias("task"), F.col("at").bitwiseAND(LOCAL).alias("place"))
    tasks = stored(placed.groupBy(F.col("task").alias("node")).agg(F.count("*").alias("size")), "shard-sizes")
    n = tasks.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-n // (shards * block_rows)))
    total, blocks = F.lit(n).cast("bigint"), shards * parts
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
    sizes = F.transform(numbers, lambda t: share(share(total, shards, F.floor(t / parts)), parts, t % parts))
    matrix = communication_matrix(tasks, sizes, seed)
    # where a block begins in its shard, and where each shard and block ends in a task's order
    begin = F.transform(numbers, lambda t: let(share(total, shards, F.floor(t / parts)), lambda k: (
        F.floor(k / parts) * (t % parts) + F.least(t % parts, k % parts))))
    matrix = (matrix.select(F.col("node").alias("task"), ends("row").alias("block_ends"))
              .withColumn("shard_ends", F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda s: F.get("block_ends", s * parts - 1)))
              .withColumn("begin", begin))
    passed = lambda x: F.size(F.filter(x, lambda e: e <= F.col("place")))
    sent = (placed.join(matrix, "task").withColumn("shard", passed("shard_ends"))
            .withColumn("block", F.col("shard") * parts + passed(F.slice("block_ends", F.col("shard") * parts + 1, F.lit(parts))))
            .select("row", "task", "place", "shard", "block", F.get("begin", F.col("block")).alias("begin")))
    again = F.xxhash64(F.lit(seed + 1), "task", "place")
    done = (sent.repartitionById(blocks, "block").sortWithinPartitions(again, "task", "place")
            .withColumn("slot", F.col("begin") + F.monotonically_increasing_id().bitwiseAND(LOCAL)))
    return done.select("row.*", "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write the shards under ``path``, a folder each; a task writes one block's rows in slot order."""
    sharded(docs, **options).write.partitionBy("shard").parquet(path)


def shard_digests(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return sharded(docs.select("doc_id", "text"), shards).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).cast("bigint").alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
