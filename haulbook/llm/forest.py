"""Approximate nearest neighbours with a hash-prefix forest.

Each tree hashes a vector to a string of symbols: the axis, with its sign, that is nearest to the vector after a
random rotation, once per symbol. Vectors that are near copies of each other share these symbols in most trees; where the first
``SYMBOLS`` of a string are so frequent that the rows which have them may be more than the candidates of a query, the further
symbols are of the vector's difference from the mean of such rows, which tells copies apart as well as other vectors.
If more rows than that have one whole string all the same, its queries are compared with all rows. A tree is the array of all strings
in order. A query descends to its own place in each tree, where the rows around it share the longest prefixes with it, and
ascends, in all trees alike, from longer to shorter prefixes until it has its share of candidates in each tree or comes to the rows that
do not share its first symbol. Cosines of all candidates are then computed in double precision.

The arrays are spread over blocks of about ``block_rows`` rows, cut at quantiles of the strings of a sample that grows with the number of
blocks; a query visits its block and the two beside it. Candidates are gathered by query and part of the nodes, and a part meets
``AT_ONCE`` queries or so at a time, so no row or group grows with the table. Equal vectors are one row of the index. The number of candidates
per query and tree is ``candidates(rows)`` over a quarter of the trees, which grows as the rows to the power 0.7; recall is measured against
brute force in the tests.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, and neither do those of another length
than most (the longest of equals): a cosine with them has no meaning. Vectors are scaled by a power of two before their norms are
taken, which changes no digit of a cosine and keeps extreme ones from overflowing. A row with a null id takes no part. Rows that repeat
an id with an equal vector count once; with different vectors each counts, but none is found for its own id. Ties
go to the smaller id. Fewer than ``k`` candidates are all returned. Empty tables give an empty result. Only the two named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulbook.llm.common import skew_join, written

NEAREST = 5
TREES = 48
SYMBOLS, FURTHER = 3, 3
SEED = 11
SAMPLE, SAMPLE_OF_BLOCK = 4096, 8  # vectors of the sample at least, and for each block
BLOCK_ROWS = 20_000
PART_ROWS = 8_192
AT_ONCE = 4096
QUERIES_AT_ONCE = 20_000
AROUND = 8


def candidates(rows: int) -> int:
    """Candidates per query for a table of so many vectors."""
    return max(512, int(1.6 * rows**0.7))


class Forest:
    """The hash strings of all trees, the same in every process."""

    def __init__(self, dimensions: int, trees: int = TREES, seed: int = SEED, rotate: bool = True):
        self.bits = max(1, int(2 * dimensions - 1).bit_length())
        self.symbols = max(1, min(SYMBOLS + FURTHER, 48 // self.bits))
        self.plain = min(SYMBOLS, self.symbols)  # symbols of the vector itself
        self.trees, self.tail = trees, 62 - self.symbols * self.bits
        self.means: list[dict[int, np.ndarray]] = [{} for _ in range(trees)]
        if rotate:
            rng = np.random.default_rng(seed)
            shape = (trees * self.symbols, dimensions, dimensions)
            self.rotations = np.linalg.qr(rng.normal(size=shape))[0].astype(np.float32)

    def learn(self, sample: np.ndarray, most: float) -> list[dict[int, np.ndarray]]:
        """The means of the rows of a sample whose first symbols in a tree are the same, where these are over ``most`` rows."""
        for tree in range(self.trees):
            strings = self._symbols(sample, tree, 0, self.plain)
            found, at, count = np.unique(strings, return_inverse=True, return_counts=True)
            self.means[tree] = {int(found[i]): sample[at == i].mean(0) for i in np.flatnonzero(count > most)}
        return self.means

    def _symbols(self, vectors: np.ndarray, tree: int, start: int, end: int) -> np.ndarray:
        out = np.zeros(len(vectors), np.int64)
        for s in range(start, end):
            turned = vectors @ self.rotations[tree * self.symbols + s]
            axis = np.abs(turned).argmax(1)
            sign = turned[np.arange(len(vectors)), axis] > 0
            out = out << self.bits | axis * 2 + sign
        return out

    def strings(self, vectors: np.ndarray, tree: int) -> np.ndarray:
        """The strings of one tree, as integers whose high bits are the first symbols."""
        first = self._symbols(vectors, tree, 0, self.plain)
        if self.means[tree]:
            vectors = vectors.copy()
            for string, mean in self.means[tree].items():
                vectors[first == string] -= mean
        further = self._symbols(vectors, tree, self.plain, self.symbols)
        return first << (self.symbols - self.plain) * self.bits | further

    def keys(self, strings: np.ndarray, ids: np.ndarray, tree: int) -> np.ndarray:
        """Places in a tree's array: the string, then the tree's own hash of the id, so that equal strings can be cut apart."""
        return strings << self.tail | _mix(ids ^ _mix(np.array([tree + 1]))) & ((1 << self.tail) - 1)


def _planted(shape: tuple[int, int], means: list[dict[int, np.ndarray]]) -> Forest:
    out = Forest(*shape)
    out.means = means
    return out


def _mix(ids: np.ndarray) -> np.ndarray:
    """A hash of integers, positive."""
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(2)).astype(np.int64)


def _scaled(vectors: list) -> np.ndarray:
    """Vectors times a power of two each, so that their largest components are between 1/2 and 1."""
    out = np.array(vectors, np.float64)
    return np.ldexp(out, -np.frexp(np.abs(out).max(1, keepdims=True))[1])


def _unit(vectors: list) -> np.ndarray:
    out = _scaled(vectors)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, v): distinct rows whose vectors take part, of the most frequent length."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x)))  # one kind of zero
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n"))
    most = sizes.first()
    return rows.filter(F.size("v") == (most["n"] if most else 0)).distinct()


def nearest(
    df: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = NEAREST,
    trees: int = TREES,
    block_rows: int = BLOCK_ROWS,
    per_query: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each row where ``is_query`` (a condition on ``id``) holds."""
    spark = df.sparkSession
    rows = written(usable(df, id_column, vector).withColumn("h", F.xxhash64("v")), "vectors")
    # one node per distinct vector, named by its smallest id, with the k + 1 smallest ids that have it
    least = Window.partitionBy("h", "v").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(least)).filter(F.col("n") <= k + 1)
    nodes = few.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = rows.filter(is_query).select("h", "v").distinct().withColumn("asked", F.lit(True))
    nodes = nodes.join(asked, ["h", "v"], "left").select(
        F.element_at("ids", 1).alias("node"), "v", "h", "ids", F.col("asked").isNotNull().alias("asked")
    )
    nodes = written(nodes, "nodes")
    count = nodes.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions = len(nodes.select("v").first()["v"])
    budget = per_query or candidates(count)
    around = max(AROUND, k + 1)
    share = max(around, 4 * budget // trees)  # candidates to either side of a query in one tree
    blocks, parts = max(1, count // block_rows), max(1, count // PART_ROWS)
    wanted = max(SAMPLE, SAMPLE_OF_BLOCK * blocks)
    sample = nodes.filter(F.pmod("h", F.lit(max(1, count // wanted))) == 0).select("node", "v")
    few = sample.orderBy(F.xxhash64("node"), "node").limit(2 * SAMPLE).select("v").collect()
    few = _unit([r["v"] for r in few] or [nodes.select("v").first()["v"]])
    shape = (dimensions, trees)
    forest = Forest(*shape)
    means = forest.learn(few, max(around, len(few) * budget / count / 2))

    def keyed(forest: Forest, frame: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        vectors, ids = _unit(frame["v"].tolist()), frame["node"].to_numpy()
        for tree in range(trees):
            yield tree, forest.keys(forest.strings(vectors, tree), ids, tree)

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = _planted(shape, means)
        for frame in frames:
            for tree, keys in keyed(forest, frame):
                yield pd.DataFrame({"tree": tree, "key": keys})

    cuts = np.zeros((trees, 0), np.int64)
    if blocks > 1:  # some numbers per block and tree
        seen = sample.mapInPandas(look, "tree int, key long").toPandas()
        cuts = np.zeros((trees, blocks - 1), np.int64)
        for tree, keys in seen.groupby("tree")["key"]:
            keys = np.sort(keys.to_numpy())
            cuts[tree] = keys[np.linspace(0, len(keys), blocks + 1).astype(int)[1:-1]]

    def plant(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each node's place in each tree; the places of queries also in the blocks beside."""
        forest = _planted(shape, means)
        for frame in frames:
            for start in range(0, len(frame), AT_ONCE):
                part = frame.iloc[start : start + AT_ONCE]
                ids, asked = part["node"].to_numpy(), part["asked"].to_numpy()
                for tree, keys in keyed(forest, part):
                    block = np.searchsorted(cuts[tree], keys, "right")
                    found = [pd.DataFrame({"block": tree * blocks + block, "key": keys, "node": ids, "role": 0})]
                    for step in (-1, 0, 1):
                        at = asked & (block + step >= 0) & (block + step < blocks)
                        place = tree * blocks + block[at] + step
                        found.append(pd.DataFrame({"block": place, "key": keys[at], "node": ids[at], "role": 1}))
                    yield pd.concat(found)

    def descend(frame: pd.DataFrame) -> pd.DataFrame:
        """The rows around each query in one block that share its first symbol, at most ``share`` and at
        least ``around`` to either side, by the part of the nodes they are in; part -1 tells that more than ``budget`` rows
        have the query's whole string."""
        forest = Forest(dimensions, rotate=False)
        members = frame[frame["role"] == 0].sort_values(["key", "node"])
        keys, nodes = members["key"].to_numpy(), members["node"].to_numpy()
        queries = frame[frame["role"] == 1]
        key, query = queries["key"].to_numpy(), queries["node"].to_numpy()
        step = 1 << (forest.tail + (forest.symbols - 1) * forest.bits)
        at, first, string = np.searchsorted(keys, key), key // step * step, key >> forest.tail << forest.tail
        low = np.maximum(np.minimum(np.maximum(np.searchsorted(keys, first), at - share), at - around), 0)
        high = np.minimum(np.maximum(np.minimum(np.searchsorted(keys, first + step), at + share + 1), at + around + 1), len(keys))
        equal = np.searchsorted(keys, string + (1 << forest.tail)) - np.searchsorted(keys, string)
        many = (equal > budget) | ((equal == len(keys)) & (blocks > 1))  # in blocks beyond, too
        empty = np.zeros(0, np.int64)
        out = [(q, -1, empty) for q in query[many].tolist()]
        part = _mix(nodes) % parts
        for q, a, b in zip(query[~many].tolist(), low[~many].tolist(), high[~many].tolist(), strict=True):
            here, ids = part[a:b], nodes[a:b]
            order = np.argsort(here, kind="stable")
            cut = np.flatnonzero(np.diff(here[order])) + 1
            for some in np.split(order, cut):
                if len(some):
                    out.append((q, int(here[some[0]]), ids[some]))
        return pd.DataFrame(out, columns=["query", "part", "found"])

    places = nodes.select("node", "v", "asked").mapInPandas(plant, "block long, key long, node long, role int")
    met = places.groupBy("block").applyInPandas(descend, "query long, part int, found array<long>")
    met = met.groupBy("query", "part").agg(F.flatten(F.collect_list("found")).alias("found"))
    met = written(met, "candidates")
    flooded = met.filter("part = -1").select("query").distinct()
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    every = flooded.select("query", all_parts, F.lit(None).cast("array<long>").alias("found"))
    met = met.join(flooded, "query", "left_anti").unionByName(every)
    asking = nodes.filter("asked").select(F.col("node").alias("query"), F.col("v").alias("own"))
    met = skew_join(met, asking, ["query"])
    chunks = max(1, -(-asking.count() // QUERIES_AT_ONCE))
    met = met.withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series((_mix(ids.to_numpy()) % parts).astype(np.int32))

    def verify(frame: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """The best ``k + 1`` of the candidates in one part of the nodes, for each query."""
        out: list[tuple] = []
        if len(frame) and len(asked):
            frame = frame.sort_values("node")
            ids, vectors = frame["node"].to_numpy(), _scaled(frame["v"].tolist())
            norms = np.linalg.norm(vectors, axis=1)
            for query, found, v in zip(asked["query"].tolist(), asked["found"], _scaled(asked["own"].tolist()), strict=True):
                at = np.arange(len(ids)) if found is None else np.searchsorted(ids, np.unique(np.asarray(found, np.int64)))
                score = (vectors[at] * v).sum(1) / (norms[at] * np.sqrt((v * v).sum()))
                best = np.lexsort((ids[at], -score))[: k + 1]
                out += [(query, int(ids[at][i]), float(score[i])) for i in best]
        return pd.DataFrame(out, columns=["query", "node", "score"])

    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    dealt = nodes.select("node", "v", part_of("node").alias("part"), every_chunk)
    scored = dealt.groupBy("part", "chunk").cogroup(met.groupBy("part", "chunk")).applyInPandas(
        verify, "query long, node long, score double"
    )
    first = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    best = scored.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    names = nodes.select("node", "ids")
    best = skew_join(best.select("query", "node", "score"), names, ["node"])
    best = best.select("query", "score", F.explode("ids").alias("id"))
    best = best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))).alias("all"))
    # at most (k + 1) squared entries; each query row leaves itself out
    owner = skew_join(nodes.select(F.col("node").alias("query"), "h", "v"), best, ["query"]).select("h", "v", "all")
    own = skew_join(rows.filter(is_query), owner, ["h", "v"]).select("id", "all").distinct()
    others = F.slice(F.filter("all", lambda x: x["id"] != F.col("id")), 1, k)
    listed = own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x"))
    return listed.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score")
    )
