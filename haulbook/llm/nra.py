"""Ranked lexical search by sequential reads of impact-sorted lists: no random access (NRA).

The index deals documents into blocks and holds, for every block and term, the places of the documents that have the term,
the greatest impact first. Lists of the terms that queries have are brought together by block. A query reads its lists of a block
from the top, all to the same depth, deeper each time. What is read of a document is the lower end of its score interval; the
upper end adds, for each list in which it has not been met, the impact at which that list stands. Reading goes on until no
document that was never met can reach the ``k`` best, and every document that can reach them has an interval of one
point: membership, ties and scores are then known. The k-th best score carries over from block to block of a task, so a
block whose lists cannot reach it is left unread. The best of each task meet in a final ranking.

Scores are integers. Terms are the maximal runs of ASCII letters and digits and of any other characters beyond ASCII, A-Z in
lower case. N is the number of documents with a term, L the number of their terms, n that of one document, df the documents
that have a term, tf its number in the document, m = 50 + 50 * n * N div L: a document's score is the sum over the query's
distinct terms of floor(1000 * ln((2N + 2) / (2df + 1))) * (10**9 * tf div (1000 * tf + 20 * m)).

Queries are taken in blocks of about ``QUERY_TERMS`` terms, so what the driver and each task hold of them is bounded; rows that share an
item id, also a null one, are one item with the terms of all. Null and empty texts have no terms: such documents are never
found and such items find nothing. Very long texts are cut into terms piece by piece. Equal scores go to the smaller doc_id, null
ids last; rows that repeat a document are each ranked. Empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulbook.llm.common import give_back, slices, written

BEST = 50
BLOCK_CHARS = 8_000_000  # bytes of text in a block of the index, at most
QUERY_TERMS = 100_000
FIRST_DEPTH = 64
DEEPER = 4
CHUNK = 4 << 20
ALL = ""  # in place of a term, which is never empty: the list of a block's documents
TERM = b"abcdefghijklmnopqrstuvwxyz0123456789" + bytes(range(0x80, 0x100))
FOLD = bytes(c if c in TERM else 32 for c in bytes(range(256)).lower())  # UTF-8 byte to byte; what separates is a space
INDEX = "block long, term string, df long, places array<int>, gains array<int>, docs array<long>"


def terms(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, some MB of it at a time."""
    rest = b""
    for start in range(0, len(text or ""), CHUNK):
        data = rest + text[start : start + CHUNK].encode().translate(FOLD)
        end = len(data) if start + CHUNK >= len(text) else data.rfind(b" ") + 1
        rest = data[end:]
        yield data[:end].split()


def corpus_size(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """N and L: the documents with a term and all terms of documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = every = 0
        for batch in batches:
            for part in slices(batch, text):
                for value in part.column(0).to_pylist():
                    n = sum(map(len, terms(value)))
                    some, every = some + (n > 0), every + n
        yield pa.RecordBatch.from_pydict({"some": [some], "every": [every]})

    sums = docs.select(text).mapInArrow(count, "some long, every long").agg(F.sum("some"), F.sum("every")).first()
    return int(sums[0] or 0), int(sums[1] or 0)


def gain(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term's weight is multiplied with, for documents of ``n`` terms."""
    m = np.array([50 + 50 * int(x) * documents // total for x in n], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def impact_index(
    docs: DataFrame,
    documents: int,
    total: int,
    id_column: str = "doc_id",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """INDEX: per block and term its documents by descending gain, and under ALL the block's doc_ids by place. No shuffle."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text", block_chars):
                words: list[bytes] = []
                counts: list[int] = []
                distinct, lengths = [], []
                for value in part.column(1).to_pylist():
                    tf: Counter = Counter()
                    for some in terms(value):
                        tf.update(some)
                    words += tf.keys()
                    counts += tf.values()
                    distinct.append(len(tf))
                    lengths.append(tf.total())
                coded = pa.array(words, pa.binary()).dictionary_encode()
                code, tf = coded.indices.to_numpy(), np.array(counts, np.int64)
                place = np.repeat(np.arange(len(distinct)), distinct)
                got = gain(tf, np.array(lengths, np.int64)[place], documents, total) if len(tf) else tf
                order = np.lexsort((place, -got, code))
                sizes = np.bincount(code, minlength=len(coded.dictionary))
                edges = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
                none = pa.nulls(len(sizes), pa.list_(pa.int64()))
                lists = [
                    pa.array(np.full(len(sizes), block), pa.int64()),
                    coded.dictionary.cast(pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(edges, pa.array(place[order], pa.int32())),
                    pa.ListArray.from_arrays(edges, pa.array(got[order], pa.int32())),
                    none,
                ]
                names = ["block", "term", "df", "places", "gains", "docs"]
                yield pa.RecordBatch.from_arrays(lists, names=names)
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                empty = pa.array([[]], pa.list_(pa.int32()))
                one = [pa.array([block], pa.int64()), pa.array([ALL]), pa.array([part.num_rows], pa.int64()), empty, empty, ids]
                yield pa.RecordBatch.from_arrays(one, names=names)
                block += 1
            give_back()

    return rows.mapInArrow(build, INDEX)


def query_terms(items: DataFrame, id_column: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item."""
    rows = items.select(F.col(id_column).alias("item"), F.col(text).alias("text"))
    kind = rows.schema["item"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t for some in terms(x) for t in some}) for x in batch.column(1).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            flat = pa.array([t for x in found for t in x], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), flat], names=["item", "term"])

    return rows.mapInArrow(split, f"item {kind}, term string").distinct()


class Block:
    """The lists of one block, impact-sorted: ``starts`` and ``sizes`` by term number."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, places: np.ndarray, impacts: np.ndarray, docs: pa.Array):
        self.list_of = {int(t): i for i, t in enumerate(numbers)}
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.places, self.impacts, self.docs = places, impacts, docs

    def search(self, query: np.ndarray, k: int, reached: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the documents that are among the ``k`` best of this block or tie with them, and score no
        less than ``reached``, the k-th best score elsewhere (0 if there is none)."""
        lists = np.array([self.list_of[t] for t in query.tolist() if t in self.list_of], np.int64)
        starts, sizes = self.starts[lists], self.sizes[lists]
        nothing = np.zeros(0, np.int64)
        depth, n = FIRST_DEPTH, len(self.docs)
        if not len(lists) or self.impacts[starts].sum() < max(reached, 1):
            return nothing, nothing
        while True:
            read = np.minimum(sizes, depth)
            at = np.repeat(starts - (np.cumsum(read) - read), read) + np.arange(read.sum())
            stands = np.where(read < sizes, self.impacts[np.minimum(starts + read, len(self.impacts) - 1)], 0)
            place, rest = self.places[at], int(stands.sum())
            met = np.flatnonzero(np.bincount(place, minlength=n))
            # sums of integers far below 2**53: exact
            lower = np.bincount(place, self.impacts[at], n)[met].astype(np.int64)
            upper = lower + rest - np.bincount(place, np.repeat(stands, read), n)[met].astype(np.int64)
            least = int(np.partition(lower, len(met) - k)[len(met) - k]) if len(met) >= k else 0
            least = max(least, reached, 1)
            may = upper >= least
            if rest < least and (upper[may] == lower[may]).all():
                return met[may], lower[may]
            depth *= DEEPER


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    block_chars: int = BLOCK_CHARS,
    terms_at_once: int = QUERY_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest scores above 0 for each item."""
    spark = docs.sparkSession
    asked = written(query_terms(items, item_id, text), "queries")
    kind = asked.schema["item"].dataType.simpleString()
    documents, total = corpus_size(docs, text)
    pairs = asked.count()
    if not (total and pairs):
        return spark.createDataFrame([], f"{item_id} {kind}, rank int, {doc_id} long, score long")
    index = written(impact_index(docs, documents, total, doc_id, text, block_chars), "impacts")
    parts = max(1, -(-pairs // terms_at_once))
    found = [_ranked(index, asked.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == p), documents, k) for p in range(parts)]
    found = reduce(DataFrame.unionByName, found)
    return found.select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


def _ranked(index: DataFrame, asked: DataFrame, documents: int, k: int) -> DataFrame:
    """The result for one block of queries, whose terms the driver holds."""
    spark = index.sparkSession
    by_item: dict = {}
    for r in asked.collect():
        by_item.setdefault(r["item"], []).append(r["term"])
    names = sorted({t for ts in by_item.values() for t in ts})
    number = {t: i for i, t in enumerate(names)}
    queries = [np.array([number[t] for t in ts], np.int64) for ts in by_item.values()]
    vocabulary = spark.createDataFrame([(ALL, -1), *number.items()], "term string, number int")
    vocabulary = written(vocabulary, "vocabulary")  # a table of known size: the index is not shuffled for it
    asked_for = index.select("term", "df").join(vocabulary.filter("number >= 0"), "term")  # few of all terms
    weights = np.zeros(len(names), np.int64)
    for r in asked_for.groupBy("number").agg(F.sum("df").alias("df")).collect():
        weights[r["number"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), pa.nulls(0, pa.int64())) for _ in queries]
        for block in _blocks(batches, weights):
            for i, query in enumerate(queries):
                scores, ids = best[i]
                place, score = block.search(query, k, int(scores[-1]) if len(scores) == k else 0)
                if len(place):
                    ids = pa.concat_arrays([ids, block.docs.take(pa.array(place))])
                    scores = np.concatenate([scores, score])
                    unknown = ids.is_null().to_numpy(zero_copy_only=False)
                    order = np.lexsort((ids.fill_null(0).to_numpy(), unknown, -scores))[:k]
                    best[i] = scores[order], ids.take(pa.array(order))
        item = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
        arrays = [pa.array(item, pa.int32()), pa.concat_arrays([x for _, x in best])]
        arrays.append(pa.array(np.concatenate([s for s, _ in best]), pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, names=["number", "doc", "score"])

    lists = index.join(vocabulary, "term").select("block", "number", "places", "gains", "docs")
    together = lists.repartition("block").sortWithinPartitions("block", "number")
    tops = together.mapInArrow(read, "number int, doc long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    ranked = tops.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    kind = asked.schema["item"].dataType.simpleString()
    items = spark.createDataFrame(list(enumerate(by_item)), f"number int, item {kind}")
    return ranked.join(items, "number").select("item", "rank", "doc", "score")


def _blocks(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[Block]:
    """The blocks of the batches, whose rows come block by block, the list of documents first."""
    held: list[pa.RecordBatch] = []

    def made() -> Block:
        rows = pa.Table.from_batches(held).combine_chunks()
        docs = rows["docs"].chunk(0).slice(0, 1).flatten()
        rows = rows.slice(1)
        number = rows["number"].to_numpy().astype(np.int64)
        sizes = np.diff(_offsets(rows["places"])) if len(rows) else np.zeros(0, np.int64)
        places, gains = (_flat(rows[c]) for c in ("places", "gains"))
        return Block(number, sizes, places, gains * np.repeat(weights[number], sizes), docs)

    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if held and held[-1].column(0)[0].as_py() != block[a]:
                yield made()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield made()


def _offsets(lists: pa.ChunkedArray) -> np.ndarray:
    return pa.concat_arrays(lists.chunks).offsets.to_numpy().astype(np.int64)


def _flat(lists: pa.ChunkedArray) -> np.ndarray:
    if not len(lists):
        return np.zeros(0, np.int64)
    return pa.concat_arrays(lists.chunks).flatten().to_numpy().astype(np.int64)
