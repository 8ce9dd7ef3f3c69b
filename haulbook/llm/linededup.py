"""Line dedup across documents by pairwise alignment.

Documents are paired by rare lines: a line that at most ``rare`` documents have pairs all of them. Passages without any rare line
are known by the hashes of their shortest runs of lines with ``min_words`` words; such a run pairs each document with the
first one that has it. The shared lines of a pair are aligned by patience diff; lines that follow each other in both documents,
blank ones aside, form common blocks. What patience diff leaves out, because it crosses or has no line that occurs once, is looked
for in the other document by its shortest runs. Blocks of at least ``min_words`` words are deleted from the later
document, the one with the larger doc_id.

So a line goes exactly if it is in a passage of that many words that any earlier document has in one piece, whatever the
number of sharers: every line of such a passage is in a shortest run inside the passage, the first holder of that
run is paired with the document, by a rare line of the run or by the run, and the pair's alignment finds the run.

Lines are what ``\\n`` separates, compared without ASCII white space at their ends; blank lines pair
nothing, and those between two lines that go, with no line between them that stays, go too. A null text stays null and an empty one empty; a document
all of whose lines go becomes empty. Documents with a null doc_id stay as they are. Rows that repeat a
doc_id hold the same document for pairing: none is deleted against another, and each loses its own lines only. An
empty table gives an empty result. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import fresh, give_back, skew_join, slices, written

MIN_WORDS = 20
RARE = 8
BLANK = b" \t\x0b\x0c\r"


def line_hashes(text: str) -> tuple[list[int | None], list[int]]:
    """The hash (signed, None for a blank line) and the number of words of each line."""
    hashes, words = [], []
    for line in text.encode().split(b"\n"):
        bare = line.strip(BLANK)
        hashes.append(xxhash.xxh3_64_intdigest(bare) - (1 << 63) if bare else None)
        words.append(len(bare.split()))
    return hashes, words


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Index pairs of equal items of ``a`` and ``b``, increasing in both, by patience diff.

    Common ends are matched first; then the items that occur once in either are put in the longest
    increasing order and the parts between them are aligned in the same way. Parts without such an item
    match nothing more.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = _once(a, a0, a1), _once(b, b0, b1)
        anchors = _increasing([(i, once_b[x]) for x, i in once_a.items() if x in once_b])
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)], strict=True):
            if i + 1 < k and j + 1 < m:
                todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def _once(items: list[int], start: int, end: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for i in range(start, end):
        seen[items[i]] = -1 if items[i] in seen else i
    return {x: i for x, i in seen.items() if i >= 0}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of ``pairs`` (sorted by the first) that increases in the second."""
    ends: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect.bisect_left(ends, j)
        ends[k : k + 1], at[k : k + 1] = [j], [n]
        back.append(at[k - 1] if k else -1)
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def common_lines(
    places: list[int], hashes: list[int], words: list[int], other_places: list[int], other_hashes: list[int], min_words: int
) -> set[int]:
    """Places of the lines of a document in blocks of ``min_words`` words or more that the other document has in one piece.

    The lines of either, in order, with their places among its lines; those that are not shared cannot be in a block.
    """
    both = set(hashes) & set(other_hashes)
    mine = [x for x in zip(places, hashes, words, strict=True) if x[1] in both]
    if sum(w for _, _, w in mine) < min_words:
        return set()
    other = [x for x in zip(other_places, other_hashes, strict=True) if x[1] in both]
    out: set[int] = set()
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience([h for _, h, _ in mine], [h for _, h in other]), (None, None)]:
        at = None if i is None else (mine[i][0], other[j][0])
        if at is None or at != (last[0] + 1, last[1] + 1):
            if sum(mine[n][2] for n in block) >= min_words:
                out.update(mine[n][0] for n in block)
            block = []
        if at is not None:
            block.append(i)
            last = at
    if len(out) < len(mine):
        size = {h: w for _, h, w in mine}
        known = set(_run_hashes([p for p, _ in other], [h for _, h in other], [size[h] for _, h in other], min_words).values())
        found = _run_hashes([p for p, _, _ in mine], [h for _, h, _ in mine], [w for _, _, w in mine], min_words)
        for (start, end), run in found.items():
            if run in known:
                out.update(p for p, _, _ in mine[start:end])
    return out


def runs(words: list[int], min_words: int) -> set[tuple[int, int]]:
    """Start and end of the shortest runs of at least ``min_words`` words from each line on, and up to each line."""
    out, n = set(), len(words)
    for way in (1, -1):
        items, total, end = words[::way], 0, 0
        for start in range(n):
            while end < n and total < min_words:
                total, end = total + items[end], end + 1
            if total < min_words:
                break
            out.add((start, end) if way == 1 else (n - end, n - start))
            total -= items[start]
    return out


def _run_hashes(places: list[int], hashes: list[int], words: list[int], min_words: int) -> dict[tuple[int, int], int]:
    """Start, end and hash of the shortest runs among lines that follow each other."""
    gaps = [i for i in range(1, len(places)) if places[i] != places[i - 1] + 1]
    data, out = np.array(hashes, "<i8"), {}
    for a, b in zip([0, *gaps], [*gaps, len(places)], strict=True):
        for start, end in runs(words[a:b], min_words):
            out[a + start, a + end] = xxhash.xxh3_64_intdigest(data[a + start : a + end].tobytes()) - (1 << 63)
    return out


def _row(text: str) -> Column:
    """Which text of a doc_id a row has."""
    return F.xxhash64(text).alias("row")


def _lines(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(doc, row, hash, places, words): each distinct line of each text, its places among the lines that are not blank."""
    rows = df.select(F.col(id_column).alias("doc"), F.col(text).alias("text"), _row(text)).filter("doc is not null")
    kind = rows.schema["doc"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows, hashes, places, words = [], [], [], []
                for i, value in enumerate(part.column(1).to_pylist()):
                    found: dict[int, tuple[list[int], int]] = {}
                    lines = [x for x in zip(*line_hashes(value or ""), strict=True) if x[0] is not None]
                    for n, (h, w) in enumerate(lines):
                        found.setdefault(h, ([], w))[0].append(n)
                    rows += [i] * len(found)
                    hashes += found
                    places += [p for p, _ in found.values()]
                    words += [w for _, w in found.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows, pa.int64())),
                        part.column(2).take(pa.array(rows, pa.int64())),
                        pa.array(hashes, pa.int64()),
                        pa.array(places, pa.list_(pa.int32())),
                        pa.array(words, pa.int32()),
                    ],
                    names=["doc", "row", "hash", "places", "words"],
                )
        give_back()

    return rows.mapInArrow(split, f"doc {kind}, row long, hash long, places array<int>, words int")


def _held(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """``_lines`` that several documents or texts have, with the number of holders."""
    lines = written(_lines(df, id_column, text), "lines")
    known = lines.groupBy("hash").agg(F.count("*").alias("holders")).filter("holders > 1")
    return written(skew_join(lines, known, ["hash"]), "shared")


def _texts(held: DataFrame) -> DataFrame:
    """(doc, row, places, hashes, words, holders): the shared lines of each text, in order."""
    one = held.select("doc", "row", F.explode("places").alias("place"), "hash", "words", "holders")
    every = one.groupBy("doc", "row").agg(F.array_sort(F.collect_list(F.struct("place", "hash", "words", "holders"))).alias("all"))
    names = {"places": "place", "hashes": "hash", "words": "words", "holders": "holders"}
    return every.select("doc", "row", *[F.col(f"all.{field}").alias(name) for name, field in names.items()])


def _frequent_runs(texts: DataFrame, min_words: int, rare: int) -> DataFrame:
    """(doc, run): the shortest runs of each text in which every line is frequent."""
    kind = texts.schema["doc"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, (places, hashes, words, holders) in enumerate(zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)):
                keep = [n for n, h in enumerate(holders) if h > rare]
                some = ([x[n] for n in keep] for x in (places, hashes, words))
                names = set(_run_hashes(*some, min_words).values())
                at += [i] * len(names)
                found += names
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.int64())], names=["doc", "run"])

    some = texts.filter(F.exists("holders", lambda h: h > rare)).select("doc", "places", "hashes", "words", "holders")
    return some.mapInArrow(find, f"doc {kind}, run long")


def paired(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", rare: int = RARE, min_words: int = MIN_WORDS
) -> DataFrame:
    """(later, earlier): the pairs of documents that are aligned."""
    held = _held(df, id_column, text)
    return _pairs(held, _texts(held), rare, min_words)


def _pairs(held: DataFrame, texts: DataFrame, rare: int, min_words: int) -> DataFrame:
    few = held.filter(F.col("holders") <= rare).groupBy("hash").agg(F.collect_set("doc").alias("docs"))  # at most ``rare``
    few = few.filter(F.size("docs") > 1).select("docs", F.explode("docs").alias("later"))
    few = few.select("later", F.explode("docs").alias("earlier")).filter("earlier < later")
    found = written(_frequent_runs(texts, min_words, rare), "runs")
    first = found.groupBy("run").agg(F.min("doc").alias("earlier"), F.count("*").alias("n")).filter("n > 1").drop("n")
    often = skew_join(found, first, ["run"]).filter("doc > earlier").select(F.col("doc").alias("later"), "earlier")
    return few.unionByName(often).distinct()


def repeated_lines(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", rare: int = RARE, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc, row, places): the lines of each text in blocks that an earlier document has, by their places among its lines."""
    held = _held(df, id_column, text)
    texts = written(_texts(held), "texts")
    pairs = _pairs(held, texts, rare, min_words)
    mine = texts.select(F.col("doc").alias("later"), "row", "places", "hashes", "words")
    theirs = texts.select(F.col("doc").alias("earlier"), F.col("places").alias("other_places"), F.col("hashes").alias("other_hashes"))
    both = skew_join(skew_join(pairs, theirs, ["earlier"]), mine, ["later"])  # a row per pair of texts
    kind = both.schema["later"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, pair in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)):
                places = sorted(common_lines(*pair, min_words))
                at += [i] * len(places)
                found += places
            rows = pa.array(at, pa.int64())
            arrays = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(found, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "row", "place"])

    columns = ["later", "row", "places", "hashes", "words", "other_places", "other_hashes"]
    gone = both.select(*columns).mapInArrow(align, f"doc {kind}, row long, place int").distinct()
    return gone.groupBy("doc", "row").agg(F.collect_list("place").alias("places"))


def without_repeated_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    rare: int = RARE,
    n_chars: str | None = None,
    stats: bool = False,
) -> DataFrame:
    """``df`` with the aligned blocks deleted from ``text``.

    ``n_chars`` names a column to set to the new length; ``stats`` adds n_lines and removed_lines.
    """
    lines, doc, row = fresh(df, "lines"), fresh(df, "doc"), fresh(df, "row")
    found = repeated_lines(df, id_column, text, rare, min_words)
    found = found.select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("places").alias(lines))
    plain = df.withColumns({doc: F.col(id_column), row: _row(text)})
    marked = skew_join(plain, found, [doc, row], "left").drop(doc, row)
    added = ["n_lines", "removed_lines"] if stats else []
    kept = marked.select(*[F.col(f"`{c}`") for c in marked.columns if c not in added])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept.drop(lines).schema])
    for name in added:
        schema = schema.add(name, T.IntegerType())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                at = part.schema.get_field_index(text)
                texts, counts, gone = [], [], []
                repeated = part.column(part.schema.get_field_index(lines)).to_pylist()
                for value, some in zip(part.column(at).to_pylist(), repeated, strict=True):
                    pieces = value.split("\n") if value else []
                    drop: set[int] = set()
                    if some:
                        full = [i for i, piece in enumerate(pieces) if piece.strip(BLANK.decode())]
                        for x in sorted(some):
                            last = full[x - 1] if x else -1
                            drop.update(range(last + 1 if last in drop else full[x], full[x] + 1))
                    texts.append("\n".join(p for i, p in enumerate(pieces) if i not in drop) if drop else value)
                    counts.append(len(pieces))
                    gone.append(len(drop))
                columns = dict(zip(part.schema.names, part.columns, strict=True))
                columns[text] = pa.array(texts, columns[text].type)
                if n_chars:
                    lengths = [None if t is None else len(t) for t in texts]
                    columns[n_chars] = pa.array(lengths, pa.int64()).cast(columns[n_chars].type)
                if stats:
                    columns |= {"n_lines": pa.array(counts, pa.int32()), "removed_lines": pa.array(gone, pa.int32())}
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], names=schema.names)
        give_back()

    return kept.mapInArrow(cut, schema)
