"""Mixing overlapping sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to). A network routes each
pattern's words to the quotas of its sources; a pattern's words may be taken several times, each
repetition at a higher cost, so first copies are used up before second ones. The whole copies of a
pattern go to all its documents; the rest goes to documents in the order of a seeded hash, each that fits in
what is left by then, until none does, and at last to one that overshoots if that comes nearer.

A null text has size 0. A null source is a source of its own, last in order. Documents of size 0 are
never taken. Equal rows with equal doc_id share a hash and are taken together where they meet the cut.
An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from haulbook.llm.common import fresh, written

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 40
STEPS = (16, 16, 8)  # bits of the hash whose ranges are summed in one pass over the documents
WINDOW_BITS = 8
LAST_HASH = 1 << HASH_BITS


def words(text: str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[int], most: int = MAX_COPIES) -> list[float]:
    """Shares of the whole by weight, none above ``most`` times its size; the excess is shared again by weight."""
    whole, out = float(sum(sizes)), [0.0] * len(sizes)
    free = [i for i, s in enumerate(sizes) if s > 0]
    left = whole
    while free:
        weight = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def flow(capacity: dict[tuple, int], quota: dict, copies: int = MAX_COPIES) -> dict[tuple, int]:
    """Words taken of each pattern (a tuple of sources), at most ``copies`` times its own.

    Successive shortest paths on: start -> layer r of a pattern (its words, cost 2r + 1: convex) ->
    its sources -> end (the quota). All quotas that can be met are, at the least total cost.
    """
    graph: dict = defaultdict(dict)  # node -> {node: [capacity, cost]}

    def arc(a, b, room: int, cost: int) -> None:
        graph[a][b] = [room, cost]
        graph[b].setdefault(a, [0, -cost])

    unlimited = sum(quota.values()) + 1
    for pattern, room in capacity.items():
        for r in range(copies):
            arc("start", ("layer", pattern, r), room, 2 * r + 1)
            arc(("layer", pattern, r), ("pattern", pattern), room, 0)
        for source in pattern:
            arc(("pattern", pattern), ("source", source), unlimited, 0)
    for source, room in quota.items():
        arc(("source", source), "end", room, 0)
    potential: dict = defaultdict(int)
    while True:
        cost, back, heap, n = {"start": 0}, {}, [(0, 0, "start")], 0
        done = set()
        while heap:
            d, _, a = heapq.heappop(heap)
            if a in done:
                continue
            done.add(a)
            for b, (room, price) in graph[a].items():
                if room > 0 and (c := d + price + potential[a] - potential[b]) < cost.get(b, float("inf")):
                    cost[b], back[b], n = c, a, n + 1
                    heapq.heappush(heap, (c, n, b))
        if "end" not in cost:
            break
        for a in list(graph):
            potential[a] += min(cost.get(a, cost["end"]), cost["end"])
        path, a = [], "end"
        while a != "start":
            path.append((back[a], a))
            a = back[a]
        room = min(graph[a][b][0] for a, b in path)
        for a, b in path:
            graph[a][b][0] -= room
            graph[b][a][0] += room
    taken = {}
    for pattern, room in capacity.items():
        left = sum(graph["start"][("layer", pattern, r)][0] for r in range(copies)) if room else 0
        taken[pattern] = copies * room - left
    return taken


def seeded_hash(*columns: str, seed: int = SEED) -> Column:
    """HASH_BITS bits of the MD5 of the seed and the columns as text; null counts as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("/", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def mix(docs: DataFrame, quota: dict, copies: int = MAX_COPIES, seed: int = SEED, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (default: ``docs``) with ``copies``: how often each is taken; no shuffle of ``rows``.

    ``docs`` has doc_id, size and pattern, an array of source names (sorted, each once; a null stands for a
    source without name); ``rows`` has these and any other columns. ``quota`` has the words wanted of
    each source. The driver gets one row per pattern. The first document in the hash order that does not fit is found from sums
    over ranges of the hash, then over ranges of the one range that holds it, and once more, so no task sorts documents;
    then the same again for the documents after it that are no larger than what is left.
    A source named in no quota gives nothing.
    """
    rows = docs if rows is None else rows
    tag, value = F.xxhash64("pattern"), seeded_hash("doc_id", seed=seed)
    found = docs.groupBy(tag.alias("tag"), "pattern").agg(F.sum("size").alias("words")).collect()
    capacity = {tuple(r["pattern"]): int(r["words"] or 0) for r in found}
    taken = flow(capacity, {s: round(q) for s, q in quota.items()}, copies)
    plan = []
    for r in found:
        words_of, wanted = capacity[tuple(r["pattern"])], taken[tuple(r["pattern"])]
        plan.append((r["tag"], *(divmod(wanted, words_of) if words_of else (0, 0))))
    spark = docs.sparkSession
    sized = docs.filter("size > 0").select(tag.alias("tag"), value.alias("hash"), "size")
    sized = written(sized, "hashes") if any(rest for _, _, rest in plan) else sized
    left, spans = {t: rest for t, _, rest in plan}, {t: [] for t, _, _ in plan}
    after = {t: -1 for t, rest in left.items() if rest}
    while after:  # a row per pattern in all that the driver sends and gets
        table = spark.createDataFrame([(t, h, left[t]) for t, h in after.items()], "tag long, after long, left long")
        fits = sized.join(F.broadcast(table), "tag").filter("hash > after and size <= left")
        words, misfits = _first_over(fits, {t: left[t] for t in after})
        for t, total in words.items():
            end, rest = misfits.get(t, (LAST_HASH, left[t] - total))
            spans[t].append((after[t], end, left[t]))
            left[t] = rest
        after = {t: end for t, (end, rest) in misfits.items() if rest}
    kind = "array<struct<after:long,before:long,most:long>>"

    def taken_by(spans: str, value: Column) -> Column:
        inside = lambda x: (value > x["after"]) & (value < x["before"]) & (F.col("size") <= x["most"])
        return F.exists(spans, inside)

    open_ones = [(t, n, spans[t]) for t, n in left.items() if n]
    if open_ones:
        table = spark.createDataFrame(open_ones, f"tag long, left long, spans {kind}")
        rest = sized.join(F.broadcast(table), "tag").filter(~taken_by("spans", F.col("hash")) & (F.col("size") < 2 * F.col("left")))
        rest = rest.groupBy("tag", "left", "hash").agg(F.sum("size").alias("words"), F.max("size").alias("most"))
        off = F.abs(F.col("words") - F.col("left")).alias("off")
        best = rest.filter(off < F.col("left")).groupBy("tag").agg(F.min(F.struct(off, "hash", "most")).alias("best"))
        for t, r in best.collect():
            spans[t].append((r["hash"] - 1, r["hash"] + 1, r["most"]))
    name = {c: fresh(rows, c) for c in ("tag", "base", "spans")}
    plan = [(t, base, spans[t]) for t, base, _ in plan]
    schema = f"{name['tag']} long, {name['base']} long, {name['spans']} {kind}"
    marked = rows.withColumn(name["tag"], tag).join(F.broadcast(spark.createDataFrame(plan, schema)), name["tag"], "left")
    in_rest = F.coalesce(taken_by(name["spans"], value), F.lit(False))
    times = F.coalesce(F.col(name["base"]), F.lit(0)) + F.when(in_rest, 1).otherwise(0)
    times = F.when(F.col("size") > 0, F.least(times, F.lit(copies))).otherwise(0)
    return marked.withColumn("copies", times.cast("int")).drop(*name.values())


def _first_over(fits: DataFrame, most: dict[int, int]) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """The words of each tag's rows (tag, hash, size), and where their running sum by hash first passes ``most``: the
    hash there and the words still wanted before it.

    The hash is found from its high bits to its low ones. Each step sums the words of ranges within the range found by the
    step before; the sums, not the documents, are then gone through ``WINDOW_BITS`` at a time, so that a task of a window sees
    256 rows of a tag, however many rows have it.
    """
    spark, words, below = fits.sparkSession, {}, HASH_BITS
    found = {t: (0, n) for t, n in most.items()}  # the high bits, and the words wanted from there on
    marks = "tag long, high long, need long"
    for bits in STEPS:
        if not found:
            break
        table = F.broadcast(spark.createDataFrame([(t, *x) for t, x in found.items()], marks))
        inside = fits.select("tag", "hash", "size").join(table, "tag").filter(F.shiftright("hash", below) == F.col("high"))
        low = below - bits
        sums = inside.groupBy("tag", F.shiftright("hash", low).alias("part")).agg(F.sum("size").alias("words"))
        sums = written(sums, "sums")
        for end in range(bits - WINDOW_BITS, -1, -WINDOW_BITS):
            table = F.broadcast(spark.createDataFrame([(t, *x) for t, x in found.items()], marks))
            here = sums.join(table, "tag").filter(F.shiftright("part", end + WINDOW_BITS) == F.col("high"))
            ranged = here.groupBy("tag", "need", F.shiftright("part", end).alias("part")).agg(F.sum("words").alias("words"))
            until = Window.partitionBy("tag").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
            ranged = ranged.withColumn("before", F.coalesce(F.sum("words").over(until), F.lit(0)))
            over = F.col("before") + F.col("words") > F.col("need")
            cut = F.min(F.when(over, F.struct("part", (F.col("need") - F.col("before")).alias("rest")))).alias("cut")
            rows = ranged.groupBy("tag").agg(F.sum("words").alias("words"), cut).collect()
            words = words or {r["tag"]: int(r["words"]) for r in rows}
            found = {r["tag"]: (r["cut"]["part"], int(r["cut"]["rest"])) for r in rows if r["cut"]}
            if not found:
                break
        below = low
    return words, found


def source_targets(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> dict:
    """(size, target) of each source of rows (source, size); weights repeat over the sources in order."""
    found = docs.groupBy("source").agg(F.sum("size").alias("size")).collect()
    rows = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))  # Python orders text by code point
    sizes = [int(r["size"]) for r in rows]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], most)
    return {r["source"]: (s, t) for r, s, t in zip(rows, sizes, wanted, strict=True)}


def mix_sources(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies per row, each document in its one source."""
    docs = df.select(F.col(id_column).alias("doc_id"), words(text).alias("size"), F.col(source).alias("source"))
    docs = written(docs.withColumn("pattern", F.array("source")), "sizes")
    known = source_targets(docs, weights)
    schema = "name string, source_size long, target double"
    table = docs.sparkSession.createDataFrame([(s, n, t) for s, (n, t) in known.items()], schema)  # a row per source
    mixed = mix(docs, {s: t for s, (_, t) in known.items()}, seed=seed)
    joined = mixed.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("name")))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return joined.select("doc_id", "size", "source_size", "target", taken, "copies")


def repeated(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """The mix as rows of ``df``: each as often as it is taken."""
    docs = df.select(F.col(id_column).alias("doc_id"), words(text).alias("size"), F.col(source).alias("source"))
    docs = written(docs.withColumn("pattern", F.array("source")), "sizes")
    quota = {s: t for s, (_, t) in source_targets(docs, weights).items()}
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    rows = df.select(
        whole, F.col(id_column).alias("doc_id"), words(text).alias("size"), F.array(source).alias("pattern")
    )
    mixed = mix(docs, quota, seed=seed, rows=rows).filter("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
