"""Document fingerprints: bottom-k sketches of shingle hashes.

The sketch of a text is the k smallest distinct hashes of its word shingles. Sketches of parts merge
into the sketch of the whole, and two sketches estimate resemblance, containment and the number of
distinct shingles. Words are what white space separates, with A-Z in lower case; a text of fewer words than a
shingle has one shingle, its whole sequence; a null or empty text, or one without words, has none and
an empty sketch. Two empty sketches resemble each other fully, an empty and another one not at all. Equal
texts have equal sketches. An empty table gives an empty result. Other columns are kept; one with the
name of the result is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import add_columns, slices, word_chunks

K = 128
SHINGLE_WORDS = 5
AT_ONCE = 1 << 16
BUCKETS_PER_PARTITION = 8
MANY_BUCKETS = 2000
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def merge(*sketches: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the parts' shingles together."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *sketches]))[:k]


def sketch(text: str | None, k: int = K, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted sketch of a whole text, merged over parts of it."""
    out, short = np.empty(0, np.uint64), []
    for words in word_chunks(text, keep=shingle_words - 1):
        if len(words) < shingle_words:
            short = words
            continue
        short = []
        joined, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle_words + 1]
        ends = ends[shingle_words - 1 :]
        for i in range(0, len(ends), AT_ONCE):
            spans = zip(starts[i : i + AT_ONCE].tolist(), ends[i : i + AT_ONCE].tolist(), strict=True)
            hashes = np.array([xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in spans], np.uint64)
            out = merge(out, hashes, k=k)
    if not len(out) and short:
        out = np.array([xxhash.xxh3_64_intdigest(b" ".join(short))], np.uint64)
    return out


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of |A and B| / |A or B|."""
    both = merge(a, b, k=k)
    if not len(both):
        return 1.0
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum()) / len(both)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimate of |A and B| / |A|: of the smallest shingles of either, those of A that are also in B."""
    both = merge(a, b, k=k)
    in_a = np.isin(both, a, assume_unique=True)
    if not in_a.any():
        return 1.0 if not len(a) else 0.0
    return float((in_a & np.isin(both, b, assume_unique=True)).sum()) / int(in_a.sum())


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimate of |A|: exact below k, else from the k-th smallest hash."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / 2.0**64)


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def from_text(value: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(value), "<u8").astype(np.uint64)


def with_sketch(
    df: DataFrame, text: str = "text", name: str = "fingerprint", k: int = K, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``df`` with the sketch of each whole text as base64 of its hashes; no shuffle."""

    def work():
        return lambda texts: [pa.array([to_text(sketch(t, k, shingle_words)) for t in texts], pa.string())]

    return add_columns(df, text, [T.StructField(name, T.StringType())], work)


def merged_sketches(df: DataFrame, keys: list[str], name: str = "fingerprint", k: int = K) -> DataFrame:
    """One sketch per group of ``keys``: partial merges per task, so a hot group ships k hashes a task.

    A null sketch counts as empty.
    """
    values = df.select(*keys, F.col(name).alias("_sketch"))
    key_schema = df.select(*keys).schema

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            rows = [dict(zip(keys, key, strict=True)) | {"_sketch": to_text(v)} for key, v in held.items()]
            columns = [pa.array([r[c] for r in rows], batch.schema.field(c).type) for c in [*keys, "_sketch"]]
            return pa.RecordBatch.from_arrays(columns, names=[*keys, "_sketch"])

        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[c] for c in keys)
                held[key] = merge(held.get(key, np.empty(0, np.uint64)), from_text(row["_sketch"] or ""), k=k)
            if len(held) > AT_ONCE:
                yield out()
                held = {}
        if held:
            yield out()

    schema = T.StructType([*key_schema.fields, T.StructField("_sketch", T.StringType())])

    @F.pandas_udf("string")
    def whole(sketches):
        return sketches.map(lambda parts: to_text(merge(*map(from_text, parts), k=k)))

    parts = values.mapInArrow(partial, schema).groupBy(*keys).agg(F.collect_list("_sketch").alias("_all"))
    return parts.select(*keys, whole("_all").alias(name))


def edited(text: str, following: str) -> str:
    """``text`` with its last third of code points replaced by the first as many of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (bucket by bucket, each closed by the head of the next bucket) to results."""
    held: tuple | None = None
    for batch in batches:
        for part in slices(batch, "text"):
            out: list[tuple] = []
            for row in part.to_pylist():
                text = row["text"] or ""
                own = sketch(text)
                if held is not None:
                    doc_id, before, fp = held
                    new = edited(before, text)
                    new_fp = fp if new == before else sketch(new)
                    out.append(
                        (
                            doc_id,
                            len(before),
                            sha256(new.encode()).hexdigest(),
                            to_text(fp),
                            to_text(new_fp),
                            resemblance(fp, new_fp),
                            resemblance(fp, own),
                        )
                    )
                held = None if row["closing"] else (row["doc_id"], text, own)
            columns = list(zip(*out, strict=True)) or [[] for _ in SCHEMA]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=SCHEMA.names)


def edit_report(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprints of every text and of its edited text, with the next document by descending id.

    Documents are ordered by integer id, largest first, null ids last, equal ids by a hash of the text;
    after the last comes the first. They are dealt into ranges of ids; each range ends with a copy of the
    first document of the next one, so every text is shuffled once and compared while it streams by.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(parts, min(BUCKETS_PER_PARTITION * parts, MANY_BUCKETS))  # several ranges per task even out
    shares = F.array(*[F.lit(i / count) for i in range(count)])
    cuts = docs.agg(
        F.percentile_approx("doc_id", shares, F.lit(5 * count)).alias("cuts"), F.count_if(F.isnull("doc_id")).alias("none")
    ).first()
    bounds = np.unique(np.array(cuts["cuts"] or [], np.int64))  # ids of the table, so no range is empty
    lowest, highest = (-1 if cuts["none"] or not len(bounds) else 0), len(bounds) - 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False)
            at = np.maximum(np.searchsorted(bounds, ids, "right") - 1, 0)
            at = np.where(batch.column(0).is_null().to_numpy(zero_copy_only=False), -1, at)
            arrays = [*batch.columns, pa.array(at, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "bucket"])

    dealt = docs.mapInArrow(place, "doc_id long, text string, bucket int")
    dealt = dealt.withColumn("tie", F.xxhash64("text"))
    ends = docs.select("doc_id", F.lit("").alias("text")).mapInArrow(place, "doc_id long, text string, bucket int")
    first_id = ends.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    close = F.when(F.col("bucket") == highest, lowest).otherwise(F.col("bucket") + 1).cast("int")
    same = [F.col("a.bucket") == F.col("b.bucket"), F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))]
    heads = dealt.alias("a").join(F.broadcast(first_id).alias("b"), same).select("a.*")  # a row per range
    heads = heads.groupBy("bucket").agg(F.max(F.struct("tie", "text")).alias("head"))
    closing = heads.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("head.text").alias("text"), close.alias("bucket"),
        F.lit(0).cast("long").alias("tie"), F.lit(True).alias("closing"),
    )
    rows = dealt.withColumn("closing", F.lit(False)).unionByName(closing)
    ordered = rows.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "closing", F.desc_nulls_last("doc_id"), F.desc("tie")
    )
    return ordered.select("doc_id", "text", "closing").mapInArrow(_with_next, SCHEMA)
