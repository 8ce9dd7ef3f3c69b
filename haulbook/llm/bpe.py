"""Byte-level BPE encoding and decoding with DuckDB inside the tasks.

A text is cut by the tokenizer's pattern into words. The words a batch has not met before are encoded
together by one recursive DuckDB query: rows are token positions; each step joins neighbouring tokens with
the merge table, takes each word's pair of least rank (the leftmost of equals) and contracts it, until no
word has a pair. Decoding joins ids with the vocabulary and aggregates their bytes in order.

The result is that of the tiktoken library without special tokens, whose texts are ordinary text here. A null
or empty text has no ids and decodes to no bytes; a null list of ids decodes to no bytes; an id outside the
vocabulary raises ValueError. Repeated rows give equal results. An empty table gives an empty result.
Other columns are kept; those named like a result are replaced.

Each batch of texts is reduced to its distinct words first. A word of over LONG_WORD bytes (base64, a text without spaces) would take one recursion per
merge over all its positions, so it is contracted with a heap instead: same order, same result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import pairwise

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import add_columns

RANKS = "byte_bpe_50k.tiktoken"
LONG_WORD = 512
WORDS_AT_ONCE = 10_000
LONGEST_CUT = 4096
SLICE = 2_000_000  # bytes of text worked on together, so that common words are encoded once
SLICE_OF_DIGESTS = 8_000_000  # the same where ids are digested at once and only digests are kept
CHUNK = 4 << 20  # characters of one text cut by the pattern at a time
DUCKDB_MEMORY = "200MB"
SPACE = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD_PIECE = rf"^ (?:\z|{SPACE})|{SPACE}\z"
SAFE_CUT = regex.compile(r"(?<=[^\s\x1c-\x1f])(?= [^\s\x1c-\x1f])")

ENCODE = """
with recursive state(step, word, spot, token, next_token, next_spot) as (
    select 0, word, spot, token, next_token, next_spot from start
    union all
    select s.step + 1, s.word, s.spot,
        case when s.spot = b.next_spot then b.merged else s.token end,
        case when s.next_spot = b.spot then b.merged else s.next_token end,
        case when s.next_spot = b.spot then b.next_spot else s.next_spot end
    from state s join (
        select word, (least >> 32)::int as merged, (least & 4294967295)::int as spot, next_spot
        from (
            select word, min(m.rank::bigint << 32 | s.spot) as least,
                arg_min(s.next_spot, m.rank::bigint << 32 | s.spot) as next_spot
            from state s join merges m on m.pair = (s.token::bigint << 32 | s.next_token)
            where s.next_token >= 0
            group by word)
    ) b on b.word = s.word
    where s.spot <> b.spot
)
select word, token from state join (select word, max(step) as step from state group by word) using (word, step)
order by word, spot
"""
# a contracted pair lives on in its right half: the left row goes, the right one gets the merged token

DECODE = """
select list, string_agg(bytes, '' order by place) as text
from tokens join vocabulary using (token) group by list order by list
"""


class Codec:
    """Encoder and decoder of one vocabulary; one for each Python worker. Lists are pairs of offsets and values."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_lines.splitlines())}
        self.pattern = regex.compile(pattern)
        merges = [
            (self.ranks[t[:i]] << 32 | self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        pairs = pa.table({"pair": pa.array([m[0] for m in merges], pa.int64()), "rank": [m[1] for m in merges]})
        ids = pa.array(list(self.ranks.values()), pa.int32())
        vocabulary = pa.table({"token": ids, "bytes": [t.decode("latin-1") for t in self.ranks]})
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": ""})
        self.db.execute("create table merges as select * from pairs")
        self.db.execute("create table vocabulary as select * from vocabulary")
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.tokens = pa.array(list(self.ranks), pa.binary())
        self.token_ids = np.array(list(self.ranks.values()), np.uint32)
        self.starts_word = np.zeros(int(self.token_ids.max()) + 1, bool)
        self.known = np.zeros(len(self.starts_word), bool)
        self.known[self.token_ids] = True
        self.starts_word[[rank for token, rank in self.ranks.items() if token[:1] == b" "]] = True

    # --- encoding

    def _long(self, word: bytes) -> np.ndarray:
        """Contract a long word pair by pair with a heap of (rank, position)."""
        token, n = [int(self.single[b]) for b in word], len(word)
        size, left, right = [1] * n, list(range(-1, n - 1)), list(range(1, n + 1))
        alive, rank_of = [True] * n, self.ranks.get
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = right[i]
            if j < n and (rank := rank_of(word[i : j + size[j]])) is not None:
                heapq.heappush(heap, (rank, i, size[i], size[j]))

        for i in range(n):
            push(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or size[i] != a or j >= n or size[j] != b:
                continue
            token[i], size[i], alive[j], right[i] = rank, a + b, False, right[j]
            if right[i] < n:
                left[right[i]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return np.array([t for t, ok in zip(token, alive, strict=True) if ok], np.uint32)

    def _contract(self, lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids and ids of words, given one after another as bytes, by the recursive query."""
        token, ends = self.single[data], np.cumsum(lengths)
        spot = np.arange(len(token)) - np.repeat(ends - lengths, lengths)
        next_token, next_spot = np.append(token[1:], -1), spot + 1
        next_token[ends - 1] = next_spot[ends - 1] = -1
        columns = {"word": np.repeat(np.arange(len(lengths)), lengths), "spot": spot, "token": token}
        columns |= {"next_token": next_token, "next_spot": next_spot}
        start = pa.table({k: pa.array(v.astype(np.int32)) for k, v in columns.items()})
        self.db.register("start", start)
        out = self.db.execute(ENCODE).fetchnumpy()
        self.db.unregister("start")
        return np.bincount(out["word"], minlength=len(lengths)), np.asarray(out["token"]).astype(np.uint32)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: a word in the vocabulary is one token, the others are contracted."""
        words = words.cast(pa.binary())
        found = pc.fill_null(pc.index_in(words, value_set=self.tokens), -1).to_numpy()
        counts = np.ones(len(words), np.int64)
        lengths = pc.binary_length(words).to_numpy().astype(np.int64)
        long = np.flatnonzero((found < 0) & (lengths > LONG_WORD))
        ids = {int(i): self._long(words[int(i)].as_py()) for i in long}
        for i, x in ids.items():
            counts[i] = len(x)
        todo = np.flatnonzero((found < 0) & (lengths <= LONG_WORD))
        parts = []
        for start in range(0, len(todo), WORDS_AT_ONCE):
            at = todo[start : start + WORDS_AT_ONCE]
            some = words.take(pa.array(at))
            offsets, data = _buffers(some)
            counts[at], values = self._contract(np.diff(offsets), data)
            parts.append(values)
        offsets = np.concatenate(([0], np.cumsum(counts)))
        out = np.zeros(offsets[-1], np.uint32)
        direct = np.flatnonzero(found >= 0)
        out[offsets[direct]] = self.token_ids[found[direct]]
        for i, x in ids.items():
            out[offsets[i] : offsets[i + 1]] = x
        if parts:
            out[_places(offsets, todo)] = np.concatenate(parts)
        return offsets, out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of whole texts (nulls are empty).

        Between two characters that are not white space a single space starts a word, so texts are split at spaces
        and each distinct piece is cut by the pattern once; a text with other spaces is cut as a whole.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(texts, " ")
        starts, pieces = np.asarray(split.offsets), split.values
        first = np.zeros(len(pieces), bool)
        first[starts[:-1]] = True
        blank = [pa.scalar(x, pa.large_string()) for x in ("", " ")]
        rest = pc.binary_join_element_wise(blank[0], pieces.filter(pa.array(~first)), blank[1])
        rest, heads = rest.dictionary_encode(), pieces.filter(pa.array(first)).dictionary_encode()
        at = np.empty(len(pieces), np.int64)
        at[~first] = rest.indices.to_numpy()
        at[first] = heads.indices.to_numpy() + len(rest.dictionary)
        odd = [pc.match_substring_regex(x, ODD_PIECE).to_numpy(zero_copy_only=False) for x in (rest.dictionary, heads.dictionary)]
        odd_text = np.add.reduceat(np.concatenate(odd)[at], starts[:-1]) > 0 if len(texts) else np.zeros(0, bool)

        # the words of each distinct piece, of pieces that start texts, and of texts cut as a whole
        plain = rest.dictionary.filter(pa.array(~odd[0]))
        words = self.pattern.findall(_buffers(plain)[1].tobytes().decode())
        joined = pa.array(words, pa.large_string())
        begins = np.flatnonzero(pc.starts_with(joined, " ").to_numpy(zero_copy_only=False))
        sizes = np.zeros(len(rest.dictionary) + len(heads.dictionary) + int(odd_text.sum()), np.int64)
        sizes[np.flatnonzero(~odd[0])] = np.diff(np.append(begins, len(words)))
        more: list[str] = []
        for i, (head, skip) in enumerate(zip(heads.dictionary.to_pylist(), odd[1], strict=True)):
            found = [] if skip else self.pattern.findall(head)
            sizes[len(rest.dictionary) + i] = len(found)
            more += found
        for i, n in enumerate(np.flatnonzero(odd_text).tolist()):
            before = len(more)
            for chunk in _chunks(texts[n].as_py()):
                more += self.pattern.findall(chunk)
            sizes[len(sizes) - int(odd_text.sum()) + i] = len(more) - before
        known = pa.concat_arrays([joined, pa.array(more, pa.large_string())]).dictionary_encode()
        offsets, ids = self._words(known.dictionary)
        offsets, ids = _gather(offsets, ids, known.indices.to_numpy(), sizes)

        keep = np.repeat(~odd_text, np.diff(starts))
        counts = np.where(odd_text, 1, np.diff(starts))
        where = np.empty(int(counts.sum()), np.int64)
        ends = np.cumsum(counts)
        whole = (ends - counts)[odd_text]
        mask = np.ones(len(where), bool)
        mask[whole] = False
        where[mask] = at[keep]
        where[whole] = np.arange(len(sizes) - len(whole), len(sizes))
        return _gather(offsets, ids, where, counts)

    # --- decoding

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """Bytes of lists of ids. Lists are cut where a token starts with a space, and each distinct cut is joined once."""
        ids = np.asarray(ids)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id outside the vocabulary")
        if not len(ids):
            return pa.array([b""] * (len(offsets) - 1), pa.large_binary())
        begin = self.starts_word[ids]
        begin[offsets[:-1][offsets[:-1] < len(ids)]] = True
        begin[::LONGEST_CUT] = True
        cuts = np.flatnonzero(begin)
        data = pa.py_buffer(np.ascontiguousarray(ids, "<u4").tobytes())
        edges = pa.py_buffer(np.append(cuts, len(ids)).astype(np.int64) * 4)
        lists = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, edges, data]).dictionary_encode()
        joined = []
        for start in range(0, len(lists.dictionary), WORDS_AT_ONCE):
            edge, some = _buffers(lists.dictionary.slice(start, WORDS_AT_ONCE))
            edge, token = edge // 4, some.view("<u4").astype(np.int32)
            place = np.arange(len(token)) - np.repeat(edge[:-1], np.diff(edge))
            rows = {"list": np.repeat(np.arange(len(edge) - 1), np.diff(edge)), "place": place, "token": token}
            self.db.register("tokens", pa.table({k: pa.array(v.astype(np.int32)) for k, v in rows.items()}))
            joined.append(self.db.sql(DECODE).to_arrow_table().column("text").combine_chunks())
            self.db.unregister("tokens")
        text = pa.concat_arrays([j.cast(pa.large_string()) for j in joined])
        sizes = np.cumsum(pc.utf8_length(text).to_numpy())  # a character stands for a byte
        plain = _buffers(text)[1].tobytes().decode().encode("latin-1")
        edges = pa.py_buffer(np.concatenate(([0], sizes)).astype(np.int64))
        found = pa.Array.from_buffers(pa.large_binary(), len(text), [None, edges, pa.py_buffer(plain)])
        found = found.take(lists.indices)
        edge, _ = _buffers(found)
        edges = edge[np.searchsorted(cuts, offsets)]  # every list begins a cut
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(edges), found.buffers()[2]])


def _buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of an array of texts or binaries."""
    large = array.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64 if large else np.int32)[array.offset :][: len(array) + 1]
    if not len(offsets):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64) - offsets[0], data[offsets[0] : offsets[-1]]


def _places(offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the values of these rows of a list array are, one row after another."""
    counts = np.diff(offsets)[rows]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, int(offsets[-1])) < 1 << 31 else np.int64
    out = np.repeat((offsets[:-1][rows] - (ends - counts)).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out


def _gather(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists that are each made of the next ``sizes`` of the given rows."""
    ends = np.concatenate(([0], np.cumsum(np.diff(offsets)[rows])))
    return ends[np.concatenate(([0], np.cumsum(sizes)))], values[_places(offsets, rows)]


def _chunks(text: str) -> Iterator[str]:
    """Parts of a long text, cut where a word ends whatever follows."""
    while len(text) > CHUNK:
        found = SAFE_CUT.search(text, CHUNK)
        if not found:
            break
        yield text[: found.start()]
        text = text[found.start() :]
    if text:
        yield text


@lru_cache(maxsize=2)
def codec(rank_lines: bytes, pattern: str) -> Codec:
    return Codec(rank_lines, pattern)


def rank_file(path: str | None = None) -> bytes:
    """The rank file (some hundred kB), read on the driver and sent along with the tasks."""
    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        return f.read()


def with_tokens(
    df: DataFrame,
    path: str | None = None,
    text: str = "text",
    ids: str = "token_ids",
    pattern: str | None = None,
    digest: str | None = None,
    keep_text: bool = True,
) -> DataFrame:
    """``df`` with the ids of each whole text as array<int>; no shuffle.

    ``digest`` names a column for the SHA-256 of the bytes that the ids are decoded to; without ``keep_text`` the
    column of texts goes.
    """
    lines, cut = rank_file(path), pattern or public_tokenizers.PATTERN
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if digest:
        fields.append(T.StructField(digest, T.StringType()))

    def work():
        both = codec(lines, cut)

        def apply(texts: pa.Array) -> list[pa.Array]:
            offsets, values = both.encode(texts)
            out = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32)))]
            if digest:
                edges, data = _buffers(both.decode(offsets, values))
                data = memoryview(data.tobytes())
                out.append(pa.array([sha256(data[a:b]).hexdigest() for a, b in pairwise(edges.tolist())], pa.string()))
            return out

        return apply

    return add_columns(df, text, fields, work, limit=SLICE, arrow=True, keep_text=keep_text)


def with_decoded(df: DataFrame, path: str | None = None, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each list of ids stands for; no shuffle."""
    lines = rank_file(path)
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != decoded.lower()])
    schema = T.StructType([*kept.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = codec(lines, public_tokenizers.PATTERN)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                lists = part.column(part.schema.get_field_index(ids))
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                found = decoder.decode(offsets, lists.flatten().to_numpy()).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=schema.names)

    return kept.mapInArrow(run, schema)


def token_digests(df: DataFrame, path: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256: texts are encoded and their
    ids decoded in one pass."""
    lines = rank_file(path)
    rows = df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    fields = [T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]

    def work():
        both = codec(lines, public_tokenizers.PATTERN)

        def apply(texts: pa.Array) -> list[pa.Array]:
            offsets, ids = both.encode(texts)
            edges, data = _buffers(both.decode(offsets, ids))
            ids, ends = memoryview(ids.astype("<u4").tobytes()), (offsets * 4).tolist()
            data, edges = memoryview(data.tobytes()), edges.tolist()
            return [
                pa.array(np.diff(offsets), pa.int64()),
                pa.array([sha256(ids[a:b]).hexdigest() for a, b in pairwise(ends)], pa.string()),
                pa.array([sha256(data[a:b]).hexdigest() for a, b in pairwise(edges)], pa.string()),
            ]

        return apply

    return add_columns(rows, "text", fields, work, limit=SLICE_OF_DIGESTS, arrow=True, keep_text=False)
