"""Helpers the operators share: the shared folder, joins that Spark can split, passes over whole texts."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACKAGE = Path(__file__).resolve().parent.parent
SLICE_CHARS = 4_000_000  # texts are worked on in slices of about this many characters, whole texts each
WHITE = b" \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_haulbook_shipped", False):
        return
    path = Path(tempfile.mkdtemp(prefix="haulbook-")) / "haulbook.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    sc.addPyFile(str(path))
    sc._haulbook_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only for a local master that names none."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^-]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="haulbook-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/haulbook-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and still there if executors are lost."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken, name = {c.lower() for c in df.columns}, f"_{base}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` whose sides are both shuffled for this join alone.

    A side that is already partitioned by ``keys`` (an aggregate) would be used as it is, and adaptive
    execution splits a hot key only between two fresh shuffles. A hash of the keys as a further join
    column makes Spark shuffle both. Keys must hash alike where they are equal: no floating-point zeros of either sign.
    """
    kinds = left.select(*keys).union(right.select(*keys)).schema  # the types in which both are compared
    tag, name = F.xxhash64(*[F.col(f.name).cast(f.dataType) for f in kinds]), "_tag"
    while name in left.columns or name in right.columns:
        name = f"_{name}"
    return left.withColumn(name, tag).join(right.withColumn(name, tag), [name, *keys], how).drop(name)


def crc_fold(column: str, parts: int) -> Column:
    """``crc32(column as text) mod parts``; null for a null value."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have about ``limit`` bytes; a longer text is a run alone."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from task to task and would keep the most they ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def add_columns(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    work: Callable[[], Callable[[list | pa.Array], list[pa.Array]]],
    limit: int = SLICE_CHARS,
    arrow: bool = False,
    keep_text: bool = True,
) -> DataFrame:
    """``df`` with columns computed in Python from the whole texts in ``text``; no shuffle.

    ``work()`` is called once per task and gives the function from a list of texts (or nulls), with ``arrow``
    an Arrow array of them, to one Arrow array per field. Columns of ``df`` with the name of a new one are replaced.
    Without ``keep_text`` the texts are not sent back.
    """
    new = {f.name.lower() for f in fields}
    if text.lower() in new:
        raise ValueError(f"{text} is both read and written")
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in new])
    stay = [f for f in kept.schema.fields if keep_text or f.name.lower() != text.lower()]
    schema = T.StructType([*stay, *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply, names = work(), schema.names
        for batch in batches:
            for part in slices(batch, text, limit):
                place = part.schema.get_field_index(text)
                texts = part.column(place)
                arrays = [c for i, c in enumerate(part.columns) if keep_text or i != place]
                arrays += apply(texts if arrow else texts.to_pylist())
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                del texts, arrays
                give_back()

    return kept.mapInArrow(run, schema)


def word_chunks(text: str | None, keep: int = 0, size: int = 4 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text in UTF-8 with A-Z in lower case, a few MB at a time.

    Every chunk after the first begins with the last ``keep`` words of the one before, so windows of
    ``keep + 1`` words are met exactly once.
    """
    if not text:
        return
    if len(text) <= size:
        yield text.encode().lower().split()
        return
    tail: list[bytes] = []
    rest = b""
    for start in range(0, len(text), size):
        data = rest + text[start : start + size].encode().lower()
        if start + size < len(text):
            cut = max(data.rfind(WHITE[i : i + 1]) for i in range(len(WHITE))) + 1
            data, rest = data[:cut], data[cut:]
        else:
            rest = b""
        words = tail + data.split()
        if len(words) > len(tail):
            yield words
        tail = words[-keep:] if keep else []
