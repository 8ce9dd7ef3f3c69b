"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

The rows of a table lie in partitions. How many rows each partition sends to each shard is drawn first, so that the
matrix has the partitions' sizes as row sums and the shards' exact sizes as column sums: its law is that of a
uniformly random permutation of all rows. Partitions are the leaves of a tree; the counts of a node are dealt
to its children by hypergeometric draws, so no task sees more than one node. Every partition is permuted locally and cut by its
row of the matrix, rows are exchanged once, and every shard is permuted again: a hash deals it into cells of about
``cell_rows`` rows, each cell is put in random order, and cells follow each other. A row's ``slot`` is its place in its shard.

All of it is DataFrame expressions. Rows and their local order are written to the shared folder first, so that a lost executor
cannot change what is counted and what is sent; the random numbers are hashes of that order and of ``seed``.

Shard sizes differ by one at most, the first shards having the larger ones. Nothing depends on values: nulls, empty and very long texts,
ties and repeated rows are rows like others, and a value that a third of the rows have is spread evenly. Fewer
rows than shards leave the last shards empty; an empty table gives an empty result. All columns are kept;
those named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulbook.llm.common import fresh, written

SHARDS = 24
SEED = 17
CELL_ROWS = 8192
BRANCH = 16  # children of a node of the tree of partitions
REACH = 10.0  # standard deviations to either side of the mode; beyond, a double holds no probability
LOCAL = (1 << 33) - 1  # the bits of monotonically_increasing_id() that count within a partition


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11) * F.lit(2.0**-53)


def _let(body, **values: Column) -> Column:
    """``body`` of a struct of the values, each of them computed once."""
    held = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.transform(F.array(held), body)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` items, out of ``total`` of which ``marked`` are marked, are marked: the draw that belongs to ``u``.

    The probabilities relative to the mode's are products of ratios of neighbours; they are summed to either side, and the
    outcome is that at which the running sum passes ``u`` of the total. The steps are in proportion to the standard deviation.
    """
    n, k, d = (x.cast("double") for x in (total, marked, drawn))
    return _let(_from_mode, n=n, k=k, d=d, u=u, rest=n - k - d)


def _from_mode(x: Column) -> Column:
    n, k, d = x["n"], x["k"], x["d"]
    least, most = F.greatest(F.lit(0.0), -x["rest"]), F.least(d, k)
    mode = F.least(most, F.greatest(least, F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")))
    share = F.coalesce(F.try_divide(k, n), F.lit(0.0))
    variance = d * share * (1 - share) * F.coalesce(F.try_divide(n - d, n - 1), F.lit(0.0))
    reach = F.ceil(F.lit(REACH) * F.sqrt(F.greatest(F.lit(0.0), variance)) + REACH).cast("double")
    steps = {"up": F.least(reach, most - mode).cast("int"), "down": F.least(reach, mode - least).cast("int")}
    return _let(_summed, k=k, d=d, u=x["u"], rest=x["rest"], mode=mode, **steps)


def _weight(x: Column, w: Column, i: Column, way: int) -> Column:
    """The weight of the outcome ``i`` steps from the mode, from that of the one before."""
    at = x["mode"] + i - 1 if way > 0 else x["mode"] - i
    up, down = (x["k"] - at) * (x["d"] - at), (at + 1) * (x["rest"] + at + 1)
    return w * up / down if way > 0 else w * down / up


def _ahead(steps: Column) -> Column:
    return F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))


def _summed(x: Column) -> Column:
    def mass(way: int, steps: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))

        def step(s: Column, i: Column) -> Column:
            return _let(lambda y: F.struct(y["w"].alias("w"), (y["sum"] + y["w"]).alias("sum")), w=_weight(x, s["w"], i, way), sum=s["sum"])

        return F.aggregate(_ahead(steps), start, step, lambda s: s["sum"])

    names = {c: x[c] for c in ("k", "d", "u", "rest", "mode", "up", "down")}
    return _let(_picked, **names, above=mass(1, x["up"]), below=mass(-1, x["down"]))


def _picked(x: Column) -> Column:
    def walk(way: int, steps: Column, left: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), left.alias("left"), F.lit(0).alias("gone"))

        def step(s: Column, i: Column) -> Column:
            gone = F.when(s["left"] < 0, s["gone"]).otherwise(i)
            moved = lambda y: F.struct(y["w"].alias("w"), (y["left"] - y["w"]).alias("left"), y["gone"].alias("gone"))
            return _let(moved, w=_weight(x, s["w"], i, way), left=s["left"], gone=gone)

        return F.aggregate(_ahead(steps), start, step, lambda s: s["gone"]) * way

    target = x["u"] * (1 + x["above"] + x["below"])
    up, down = walk(1, x["up"], target - 1), walk(-1, x["down"], target - 1 - x["above"])
    moved = F.when(target < 1, 0).when(target < 1 + x["above"], up).otherwise(down)
    return (x["mode"] + moved).cast("long")


def _dealt(rest: Column, n: Column, seed: int, node: Column) -> Column:
    """How ``n`` rows, drawn from shards that have ``rest`` rows left each, fall on the shards."""
    none = F.array().cast("array<long>")
    left = F.aggregate(rest, F.lit(0).cast("long"), lambda s, x: s + x)
    start = F.struct(left.alias("total"), n.alias("drawn"), none.alias("counts"))

    def step(s: Column, marked: Column) -> Column:
        settled = lambda x: F.struct(
            (x["total"] - x["marked"]).alias("total"), (x["drawn"] - x["found"]).alias("drawn"), F.concat(x["counts"], F.array(x["found"])).alias("counts")
        )
        found = hypergeometric(s["total"], marked, s["drawn"], uniform(seed, node, F.size(s["counts"])))
        return _let(settled, total=s["total"], marked=marked, drawn=s["drawn"], counts=s["counts"], found=found)

    return F.aggregate(rest, start, step, lambda s: s["counts"])


def communication_matrix(sizes: DataFrame, quotas: list[int], seed: int = SEED) -> DataFrame:
    """(block, counts): for each partition of ``sizes`` (block from 0, n), the rows that go to each shard.

    ``quotas`` are the sizes of the shards, as many rows as the blocks have together. Blocks are dealt 16 at a time, level by level.
    """
    blocks = (sizes.agg(F.max("block")).first()[0] or 0) + 1
    levels = 1
    while BRANCH**levels < blocks:
        levels += 1
    spark = sizes.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = spark.range(1).select(F.col("id").alias("node"), F.array(*[F.lit(q).cast("long") for q in quotas]).alias("rest"))
    for level in range(levels):
        width = BRANCH ** (levels - level - 1)
        child = F.floor(F.col("block") / F.lit(width)).cast("long")
        kids = sizes.groupBy(child.alias("child")).agg(F.sum("n").alias("n"))
        kids = kids.groupBy(F.floor(F.col("child") / BRANCH).cast("long").alias("node"))
        kids = kids.agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("kids"))  # at most 16

        def deal(s: Column, kid: Column) -> Column:
            counts = _dealt(s["rest"], kid["n"], salt, kid["child"])  # noqa: B023 (called at once)
            dealt = lambda x: F.struct(
                F.zip_with(x["rest"], x["counts"], lambda a, b: a - b).alias("rest"),
                F.concat(x["rows"], F.array(F.struct(x["child"].alias("node"), x["counts"].alias("rest")))).alias("rows"),
            )
            return _let(dealt, rest=s["rest"], rows=s["rows"], child=kid["child"], counts=counts)

        salt = seed + 1 + level
        start = F.struct(F.col("rest"), F.array().cast("array<struct<node:bigint,rest:array<bigint>>>").alias("rows"))
        rows = F.aggregate("kids", start, deal, lambda s: s["rows"])
        nodes = nodes.join(kids, "node").select(F.explode(rows).alias("x")).select("x.node", "x.rest")
        if level + 1 < levels:  # the nodes of a level are drawn by as many tasks
            nodes = nodes.repartition(min(BRANCH ** (level + 1), most), "node")
    return nodes.select(F.col("node").alias("block"), F.col("rest").alias("counts"))


def into_shards(df: DataFrame, shards: int = SHARDS, seed: int = SEED, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``df`` with the shard of each row and its slot there, from 0 without gaps; every arrangement is equally likely."""
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")])
    names = kept.columns
    block, at, mix = (fresh(df, x) for x in ("block", "at", "mix"))
    order = F.xxhash64(F.lit(seed), F.spark_partition_id(), F.monotonically_increasing_id())
    local = kept.withColumn(mix, order).sortWithinPartitions(mix)  # the local permutation
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(LOCAL))
    placed = written(local.select(*[F.col(f"`{c}`") for c in names], F.spark_partition_id().alias(block), place.alias(at)), "placed")

    sizes = written(placed.groupBy(F.col(block).alias("block")).agg(F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    cells = max(1, -(-total // shards // cell_rows))
    matrix = communication_matrix(sizes, quotas, seed)
    grow = lambda s, x: F.concat(s, F.array(F.coalesce(F.element_at(s, -1), F.lit(0)) + x))
    none = F.array().cast("array<long>")
    ends = F.aggregate("counts", none, lambda s, x: F.when(F.size(s) == 0, F.array(x)).otherwise(grow(s, x)))
    cut = fresh(df, "ends")
    matrix = written(matrix.select(F.col("block").alias(block), ends.alias(cut)), "matrix")  # a table of known size

    def sent(rows: DataFrame) -> DataFrame:
        shard = F.size(F.filter(cut, lambda e: e <= F.col(at))).alias("shard")
        cell = F.pmod(F.xxhash64(F.lit(seed + 101), block, at), F.lit(cells)).cast("int").alias(mix)
        return rows.join(matrix, block).select(*[F.col(f"`{c}`") for c in rows.columns], shard, cell)

    counts = sent(placed.select(block, at)).groupBy("shard", mix).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(mix).rowsBetween(Window.unboundedPreceding, -1)
    first = fresh(df, "first")
    offsets = counts.select("shard", mix, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    offsets = written(offsets, "offsets")
    shuffled = Window.partitionBy("shard", mix).orderBy(F.xxhash64(F.lit(seed + 202), block, at), block, at)
    rank = fresh(df, "rank")
    ranked = sent(placed).withColumn(rank, F.row_number().over(shuffled))
    slot = (F.col(first) + F.col(rank) - 1).alias("slot")
    return ranked.join(offsets, ["shard", mix]).select(*[F.col(f"`{c}`") for c in names], "shard", slot)


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, cell_rows: int = CELL_ROWS) -> None:
    """The shards as Parquet under ``path``, a folder ``shard=N`` each, whose files hold runs of slots in order."""
    rows = into_shards(df, shards, seed, cell_rows)
    run = F.floor(F.col("slot") / cell_rows)
    rows.repartition("shard", run).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
