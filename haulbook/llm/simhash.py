"""SimHash near-duplicates: fingerprints, pivot distance tables, groups.

Rows: one per input row. A null or empty text, or one without words, has fingerprint zero and is linked
like any other; a null doc_id stays null and names a group only if all its doc_ids are null; equal
texts and repeated rows share a fingerprint and so a group. An empty table gives an empty result. Only
the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from haulbook.llm.common import add_columns, fresh, give_back, skew_join, word_chunks, written
from haulbook.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
FREE_SEGMENTS = 3  # segments that must agree; more make the blocks smaller and the copies of a row more
SEGMENT_PIVOTS = 16
GLOBAL_PIVOTS = 32
BATCH = 1 << 16
BLOCK_ROWS = 4096  # distinct fingerprints that are compared in one task; larger blocks are split


def text_fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash as an unsigned integer: a bit is 1 if it is set in over half of the shingles' XXH64."""
    counts, total = np.zeros(64, np.int64), 0
    short: list[bytes] = []
    for words in word_chunks(text, keep=shingle_words - 1):
        if len(words) < shingle_words:
            short = words
            continue
        short = []
        joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle_words + 1]
        spans = zip(starts.tolist(), ends[shingle_words - 1 :].tolist(), strict=True)
        hashed = [xxhash.xxh64_intdigest(joined[a:b], HASH_SEED) for a, b in spans]
        for i in range(0, len(hashed), BATCH):
            part = np.array(hashed[i : i + BATCH], np.dtype("<u8"))
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(hashed)
    if not total and short:
        return xxhash.xxh64_intdigest(b" ".join(short), HASH_SEED)
    return sum(1 << i for i, c in enumerate(counts.tolist()) if 2 * c > total)


def with_fingerprints(
    df: DataFrame, text: str = "text", name: str = "_fp", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``df`` with the fingerprint of each whole text as a signed long (the same 64 bits)."""

    def work():
        def apply(texts: list) -> list[pa.Array]:
            bits = np.array([text_fingerprint(t, shingle_words) for t in texts], np.uint64)
            return [pa.array(bits.view(np.int64))]

        return apply

    return add_columns(df, text, [T.StructField(name, T.LongType())], work)


class PivotTable:
    """Distances to reference fingerprints, and what they say about a pair.

    A base reference, for each of ``max_bits + 3`` segments of the 64 bits some that differ from the base
    inside that segment only, and some random ones. Distances obey |d(x,p) - d(y,p)| <= d(x,y), so
    a pair with any larger coordinate difference is no link. The coordinates of a segment's references
    less the base's depend on that segment's bits alone, and ``max_bits`` differing bits leave three
    segments untouched: a link agrees on those coordinates for some three segments. Their combinations
    are the block keys, so no link is lost and only rows of a block are compared.

    A block with too many rows is split again in the same way: the bits on which its rows need not agree are cut into
    ``max_bits + 1`` parts, of which a link leaves one untouched. References that differ from the base in one bit each have a
    coordinate for every bit, so agreeing on those of a part is having the same bits there.
    """

    def __init__(self, max_bits: int = MAX_BITS, seed: int = 7):
        rng, count = np.random.default_rng(seed), max_bits + FREE_SEGMENTS
        if count > 64:
            raise ValueError("max_bits is too large for 64 bits")
        self.max_bits = max_bits
        base = rng.integers(0, 1 << 64, dtype=np.uint64)
        cuts = np.linspace(0, 64, count + 1).astype(int)
        pivots = [base]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            masks = rng.integers(1, 1 << int(high - low), SEGMENT_PIVOTS, dtype=np.uint64)
            pivots += [base ^ (m << np.uint64(low)) for m in masks]
        pivots += list(rng.integers(0, 1 << 64, GLOBAL_PIVOTS, dtype=np.uint64))
        self.pivots = np.array(pivots, np.uint64)
        self.segments, self.base = count, base
        self.combos = list(combinations(range(count), FREE_SEGMENTS))
        inside = [((1 << int(high)) - 1) ^ ((1 << int(low)) - 1) for low, high in zip(cuts[:-1], cuts[1:], strict=True)]
        every = (1 << 64) - 1
        #: for each combination the bits on which rows of a block may differ
        self.free = np.array([every ^ sum(inside[g] for g in combo) for combo in self.combos], np.uint64)
        self.mix = rng.integers(1, 1 << 64, (count, SEGMENT_PIVOTS), dtype=np.uint64) | np.uint64(1)

    def distances(self, bits: np.ndarray) -> np.ndarray:
        return np.bitwise_count(bits[:, None] ^ self.pivots[None, :]).astype(np.int8)

    def keys(self, bits: np.ndarray) -> np.ndarray:
        """One block key per row and combination of three segments."""
        table = self.distances(bits)
        inner = (table[:, 1 : 1 + self.segments * SEGMENT_PIVOTS] - table[:, :1]).astype(np.int64).view(np.uint64)
        family = inner.reshape(len(bits), self.segments, SEGMENT_PIVOTS)
        segment = (family * self.mix[None]).sum(2, dtype=np.uint64)
        segment ^= segment >> np.uint64(29)
        out = np.empty((len(bits), len(self.combos)), np.uint64)
        for j, combo in enumerate(self.combos):
            key = np.full(len(bits), j + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for g in combo:
                key = (key ^ segment[:, g]) * np.uint64(0xBF58476D1CE4E5B9)
                key ^= key >> np.uint64(31)
            out[:, j] = key
        return out

    def split(self, key: int, free: int, bits: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """For each part of the bits ``free`` the keys of the smaller blocks and the bits that stay free there."""
        places = [i for i in range(64) if free >> i & 1]
        for j, part in enumerate(np.array_split(np.array(places, np.uint64), self.max_bits + 1)):
            mask = sum(1 << int(i) for i in part)
            if not mask:
                continue
            seed = np.uint64((key * 0x9E3779B97F4A7C15 + j + 1) & ((1 << 64) - 1))
            mixed = ((bits ^ self.base) & np.uint64(mask)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ mixed >> np.uint64(29) ^ seed) * np.uint64(0x94D049BB133111EB)
            yield mixed ^ mixed >> np.uint64(32), free & ~mask

    def links(self, bits: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links that connect what is linked among the rows of one block: a spanning forest, not all pairs."""
        table = self.distances(bits)
        order = np.argsort(table[:, 0], kind="stable")
        bits, table = bits[order], table[order]
        todo = np.arange(len(bits))  # kept in order of the first coordinate
        while len(todo):
            front = [todo[0]]
            todo = todo[1:]
            while front and len(todo):
                x = front.pop()
                near = table[todo, 0].astype(np.int16)
                low = np.searchsorted(near, table[x, 0] - self.max_bits, "left")
                high = np.searchsorted(near, table[x, 0] + self.max_bits, "right")
                window = todo[low:high]
                gap = np.abs(table[window].astype(np.int16) - table[x].astype(np.int16)).max(1, initial=0)
                window = window[gap <= self.max_bits]
                found = window[np.bitwise_count(bits[window] ^ bits[x]) <= self.max_bits]
                if len(found):
                    yield from ((int(bits[x].view(np.int64)), int(bits[y].view(np.int64))) for y in found)
                    front.extend(found.tolist())
                    todo = np.setdiff1d(todo, found, assume_unique=True)


def _block_links(max_bits: int):
    """Partitions sorted by key to links; the last block of a batch waits for the next batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, key, fp = PivotTable(max_bits), np.empty(0, np.int64), np.empty(0, np.int64)

        def linked(key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(starts, len(key)))
            bits, found = fp.view(np.uint64), []
            two = starts[sizes == 2]
            if len(two):
                x, y = bits[two], bits[two + 1]
                gap = np.abs(table.distances(x).astype(np.int16) - table.distances(y)).max(1)
                ok = (gap <= max_bits) & (np.bitwise_count(x ^ y) <= max_bits)
                found.append(np.stack([fp[two][ok], fp[two + 1][ok]], 1))
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
                pairs = list(table.links(bits[s : s + n]))
                if pairs:
                    found.append(np.array(pairs, np.int64))
            pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for frame in frames:
            key, fp = frame["key"].to_numpy(), frame["fp"].to_numpy()
            if not len(key):
                continue
            last = len(key) - int(np.argmax((key != key[-1])[::-1])) if key[0] != key[-1] else 0
            if held and key[0] == held[0][0][0] and not last:
                held.append((key, fp))
                continue
            whole = [*held, (key[:last], fp[:last])] if last else held
            if whole:
                yield linked(*(np.concatenate(x) for x in zip(*whole, strict=True)))
            held = [(key[last:], fp[last:])]
        if held:
            yield linked(*(np.concatenate(x) for x in zip(*held, strict=True)))
        give_back()

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``) at ``max_bits`` or fewer bits.

    Blocks of more than ``block_rows`` fingerprints are split into overlapping smaller ones, as often as it takes: every time
    there are fewer bits left on which rows may differ, and so fewer fingerprints that a block can have.
    """

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = PivotTable(max_bits)
        for frame in frames:
            fp = frame["fp"].to_numpy(np.int64)
            for i in range(0, len(fp), BATCH):
                part = fp[i : i + BATCH]
                keys = table.keys(part.view(np.uint64)).view(np.int64)
                free = np.tile(table.free.view(np.int64), len(part))
                yield pd.DataFrame({"key": keys.ravel(), "fp": np.repeat(part, keys.shape[1]), "free": free})
        give_back()

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, mask = PivotTable(max_bits), (1 << 64) - 1
        for frame in frames:
            for (key, free), rows in frame.groupby(["key", "free"]):
                fp = rows["fp"].to_numpy(np.int64)
                for keys, left in table.split(int(key) & mask, int(free) & mask, fp.view(np.uint64)):
                    yield pd.DataFrame({"key": keys.view(np.int64), "fp": fp, "free": np.uint64(left).view(np.int64)})
        give_back()

    def linked(blocks: DataFrame) -> DataFrame:
        together = blocks.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        return together.mapInPandas(_block_links(max_bits), "a long, b long")

    shape = "key long, fp long, free long"
    blocks, found = written(fps.mapInPandas(spread, shape), "blocks"), []
    while True:
        large = blocks.groupBy("key").agg(F.count("*").alias("n"), F.max(F.bit_count("free")).alias("left"))
        large = written(large.filter((F.col("n") > block_rows) & (F.col("left") > max_bits)).select("key"), "large")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*found, linked(blocks)])
        found.append(linked(blocks.join(large, "key", "left_anti")))
        blocks = written(blocks.join(large, "key", "left_semi").mapInPandas(split, shape), "blocks")


def fingerprint_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id, keeper) from rows (doc_id, fp): the group of each distinct fingerprint.

    component_id is the smallest doc_id of the group; keeper says whether this fingerprint has it.
    """
    fps = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(fingerprint_links(fps.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    member = skew_join(fps, roots, ["fp"], "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", "fp"))
    group = member.groupBy("root").agg(first.alias("first"))
    return skew_join(member, group, ["root"]).select(
        "fp", F.col("first.least").alias("component_id"), (F.col("fp") == F.col("first.fp")).alias("keeper")
    )


def simhash_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    rows = df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    docs = written(with_fingerprints(rows, "text", "fp", shingle_words).select("doc_id", "fp"), "simhash")
    grouped = skew_join(docs, fingerprint_groups(docs, max_bits), ["fp"])
    return grouped.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``df`` that are the one with the smallest doc_id of their group, one row for each group."""
    fp, keep, row = fresh(df, "fp"), fresh(df, "keep"), fresh(df, "row")
    marked = written(with_fingerprints(df, text, fp, shingle_words), "simhash")
    docs = marked.select(F.col(id_column).alias("doc_id"), F.col(fp).alias("fp"))
    keepers = fingerprint_groups(docs, max_bits).filter("keeper")
    keepers = keepers.select(F.col("fp").alias(fp), F.col("component_id").alias(keep))
    kept = skew_join(marked, keepers, [fp]).filter(F.col(id_column).eqNullSafe(F.col(keep)))
    first = Window.partitionBy(fp).orderBy(F.xxhash64(text), text)
    one = kept.withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1)
    return one.select(*[F.col(f"`{c}`") for c in df.columns])
