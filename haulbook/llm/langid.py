"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors, each
rotated by its place, by elementwise product; a text's vector bundles (sums) those of its n-grams; a
language's prototype is the sum over its training texts. A text gets the language of the largest cosine.

Letters are lower-cased code points; a run of others counts as one space. A null text or one
without a letter is ``und`` with score 0, as is every text if nothing could be learned. Ties go to the
smallest language name. Repeated rows count as often as they occur. An empty table gives an empty
result. The columns ``lang_pred`` and ``score`` (or what they are to be called) replace any of these names; others stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import add_columns, give_back, slices

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
PIECE = 1 << 20  # characters of one text worked on at a time
GRAMS_AT_ONCE = 1 << 12
FOLDS, HELD_OUT_FOLD = 3, 1
REJECT_BELOW = 0.05


@lru_cache(maxsize=1 << 16)
def _letter(code: int, dimensions: int) -> np.ndarray:
    """The random vector of a code point, the same in every process."""
    return np.random.default_rng((20240, code)).integers(0, 2, dimensions, np.int8) * 2 - 1


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Of each code point its lower-case letter, or 32 if it is none."""
    out = np.full(0x110000, 32, np.int32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def _grams(text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (rows of code points) of the whole text and their counts; none without a letter."""
    table, seen = _letter_table(), {}
    tail = np.array([32], np.int32)
    letters = False
    for start in range(0, len(text), PIECE):
        piece = text[start : start + PIECE]
        codes = table[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
        letters = letters or bool((codes != 32).any())
        end = np.full(int(start + PIECE >= len(text)), 32, np.int32)
        codes = np.concatenate((tail, codes, end))
        codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
        if len(codes) >= n:
            keys = np.zeros(len(codes) - n + 1, np.int64)
            for i in range(n):
                keys = keys << 21 | codes[i : len(codes) - n + 1 + i]
            values, counts = np.unique(keys, return_counts=True)
            if len(text) <= PIECE:
                return (values, counts) if letters else (values[:0], counts[:0])
            for v, c in zip(values.tolist(), counts.tolist(), strict=True):
                seen[v] = seen.get(v, 0) + c
        tail = codes[-(n - 1) :] if n > 1 else codes[:0]
    if not letters:
        seen = {}
    keys = np.array(sorted(seen), np.int64)
    return keys, np.array([seen[k] for k in keys.tolist()], np.int64)


def _bind(keys: np.ndarray, n: int, dimensions: int) -> np.ndarray:
    """The vectors of n-grams: the letters' vectors, the first rotated most, multiplied."""
    out = None
    for i in range(n):
        codes, inverse = np.unique(keys >> (21 * (n - 1 - i)) & 0x1FFFFF, return_inverse=True)
        letters = np.stack([np.roll(_letter(c, dimensions), n - 1 - i) for c in codes.tolist()])[inverse]
        out = letters if out is None else out * letters
    return out


def encode(texts: list, n: int = GRAM, dimensions: int = DIMENSIONS) -> np.ndarray:
    """One bundle per text, exact integers in double precision; zeros if the text has no letter."""
    out = np.zeros((len(texts), dimensions))
    group: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if not group:
            return
        keys, inverse = np.unique(np.concatenate([g[1] for g in group]), return_inverse=True)
        rows = np.repeat(np.arange(len(group)), [len(g[1]) for g in group])
        counts = np.concatenate([g[2] for g in group])
        kind = np.float32 if max(int(g[2].sum()) for g in group) < 1 << 24 else np.float64  # exact sums
        for low in range(0, len(keys), GRAMS_AT_ONCE):
            high = min(low + GRAMS_AT_ONCE, len(keys))
            here = (inverse >= low) & (inverse < high)
            dense = np.zeros((len(group), high - low), kind)
            dense[rows[here], inverse[here] - low] = counts[here]
            part = dense @ _bind(keys[low:high], n, dimensions).astype(kind)
            out[[g[0] for g in group]] += np.rint(part)
        group.clear()

    for i, text in enumerate(texts):
        if not text:
            continue
        keys, counts = _grams(text, n)
        if len(keys):
            group.append((i, keys, counts))
            size += len(keys)
        if size > 1 << 16:
            flush()
            size = 0
    flush()
    return out


def learn(
    df: DataFrame, train: Column, text: str = "text", lang: str = "lang", n: int = GRAM, dimensions: int = DIMENSIONS
) -> dict[str, np.ndarray]:
    """Prototype of each language, from all rows where ``train`` holds and text and language are not null.

    Each task adds up its texts; the driver gets one vector per language.
    """
    rows = df.filter(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                vectors = encode(part.column(0).to_pylist(), n, dimensions)
                langs = part.column(1).to_numpy(zero_copy_only=False)
                for name in pd.unique(langs):
                    sums[name] = sums.get(name, 0) + vectors[langs == name].sum(0)
        names = sorted(sums)
        values = [np.rint(sums[k]).astype(np.int64).tolist() for k in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(values, pa.list_(pa.int64()))], names=["lang", "bundle"]
        )
        give_back()

    parts = rows.mapInArrow(bundle, "lang string, bundle array<long>")
    place = parts.select("lang", F.posexplode("bundle").alias("i", "v"))
    total = place.groupBy("lang", "i").agg(F.sum("v").alias("v"))
    whole = total.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("b"))
    found = {r["lang"]: np.array([x["v"] for x in r["b"]], float) for r in whole.collect()}
    return {k: found[k] for k in sorted(found) if found[k].any()}


def with_language(
    df: DataFrame,
    prototypes: dict[str, np.ndarray],
    text: str = "text",
    n: int = GRAM,
    dimensions: int = DIMENSIONS,
    lang_pred: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (the cosine, not below 0); no shuffle."""
    names = list(prototypes)
    matrix = np.stack([prototypes[k] / np.linalg.norm(prototypes[k]) for k in names]) if names else None
    fields = [T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())]

    def work():
        def apply(texts: list) -> list[pa.Array]:
            if matrix is None:
                return [pa.array([UNKNOWN] * len(texts), pa.string()), pa.array([0.0] * len(texts), pa.float64())]
            vectors = encode(texts, n, dimensions)
            norms = np.linalg.norm(vectors, axis=1)
            cosines = (vectors @ matrix.T) / np.where(norms > 0, norms, 1)[:, None]
            best = cosines.argmax(1)
            has = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
            langs = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has.tolist(), strict=True)]
            scores = np.where(has, np.clip(cosines.max(1), 0, 1), 0.0).round(12)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return apply

    return add_columns(df, text, fields, work)


def accepted(
    df: DataFrame, reject_below: float = REJECT_BELOW, lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Rows with a language: not ``und``, and not so far from every prototype that it means nothing."""
    return df.filter((F.col(lang_pred) != UNKNOWN) & (F.col(score) >= reject_below))
