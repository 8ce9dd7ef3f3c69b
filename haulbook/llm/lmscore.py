"""Cross-entropy difference: how much better a target model than a background model predicts a text.

Both are bigram models over one vocabulary, all words of the whole corpus, with the same smoothing:
p(w|u) = (c(u,w) + m p(w)) / (c(u) + m). The background's counts, of all documents, are scaled
to the size of the target's, so that the smoothing weighs the same in both. A document is left out of the models it is scored
with: its own counts are taken off, so what it says counts only if others say it too, and a document of the target has no
advantage over one that is like it. Counts are of whole texts of all rows. The driver gets three numbers.

Texts are numbered in batches of about ``BATCH_TOKENS`` tokens. A batch sums its bigrams, first words and second words before
they are shuffled, and sends each once, by ranges of a 56-bit hash; a range sums what it gets and answers each
sender with the sums of what it sent. A frequent bigram is thus at most one entry per batch, and a range has about ``RANGE_TOKENS``
entries at most whatever the corpus is. With more than ``FAN`` batches or ranges the sums travel in hops, and the fan is the smallest
that gets there in so many: a batch sends to some fan of wide ranges, a wide range joins what a team of that many batches sent and sends
it on to as many narrower ones, until a range has everything; answers return the same way. So a batch sends at most some ``FAN``
messages in a hop for any corpus, no group has many more, and as a team has about as many batches as there are wide ranges (more only if
batches are small), a group holds about as many entries as a batch in every hop. Nothing is left out: all words and all bigrams count.

A text's score is its mean loss per token under the background model less that under the target
model; positive is like the target. A null or empty text, or one without words, has no tokens and
score 0. Rows of documents that are in no label row, or have a null id, are background only; repeated rows count as often as
they occur. Without any target words the target model is the background model, and all scores are 0. An empty table
gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count as numbers

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulbook.llm.common import give_back, skew_join, slices, word_chunks, written

SMOOTHING = 20.0
FOLDS, HELD_OUT_FOLD = 5, 0
AT_ONCE = 1 << 19
BATCH_TOKENS = 1 << 21
RANGE_TOKENS = 1 << 21
TOKENS_AT_ONCE = 1 << 18
FAN = 1 << 13  # messages that a batch sends, and that a range gets, in one hop at most: some 256 tokens each or more
KEY = (1 << 64) - (1 << 8)  # bits of a hash that make a key: 56, which are shorter to send
START, OTHER = 1, 2  # in place of a word's hash
PAIR, BEGIN, END = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all texts, summed per task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("utf-8") for w in seen]
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column(0).to_pylist():
                    for words in word_chunks(text):
                        seen.update(words)
                        if len(seen) > AT_ONCE:
                            yield out()
                            seen.clear()
        if seen:
            yield out()

    parts = docs.select("text").mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The most frequent words of the column ``text``, ties to the smaller word."""
    return [r["word"] for r in _word_counts(docs).orderBy(F.desc("n"), "word").limit(size).collect()]


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, all first bytes, then all second bytes and so on, compressed."""
    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, count: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, count * size, codec="zstd"), np.uint8).reshape(size, count)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _batches(docs: DataFrame, words: list[str] | None) -> DataFrame:
    """(batch, place, doc, n, tokens): each text's words as numbers of its batch; place -1 has the hashes of the batch's words.

    Words not in ``words`` are one symbol; None keeps all words.
    """
    known = None if words is None else {w.encode() for w in words}
    kind = docs.schema["doc"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["batch", "place", "doc", "n", "tokens"]
        here, held, place = TaskContext.get().partitionId() << 32, 0, 0
        number: defaultdict[bytes, int] = defaultdict(numbers(2).__next__)  # 0 is the start, 1 any other word
        for batch in batches:
            doc_kind = batch.schema.field("doc").type
            for part in slices(batch, "text"):
                found: list[tuple] = []
                for doc, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    pieces = []
                    for ws in word_chunks(text):
                        if known is None:
                            pieces.append(np.array([number[w] for w in ws], "<u4"))
                        else:
                            pieces.append(np.array([number[w] if w in known else 1 for w in ws], "<u4"))
                    tokens = np.concatenate(pieces) if pieces else np.empty(0, "<u4")
                    found.append((here, place, doc, len(tokens), _pack(tokens)))
                    held, place = held + len(tokens), place + 1
                    if held >= BATCH_TOKENS:
                        found.append(hashes(here, number))
                        here, held, place = here + 1, 0, 0
                        number = defaultdict(numbers(2).__next__)
                kinds = [pa.int64(), pa.int32(), doc_kind, pa.int64(), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
        if place:
            arrays = [pa.array([x], k) for x, k in zip(hashes(here, number), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        give_back()

    def hashes(here: int, number: dict[bytes, int]) -> tuple:
        out = np.array([START, OTHER, *(xxhash.xxh3_64_intdigest(w) for w in number)], "<u8")
        return here, -1, None, len(out), _pack(out)

    return docs.select("doc", "text").mapInArrow(run, f"batch long, place int, doc {kind}, n long, tokens binary")


class Batch:
    """The distinct bigrams, first and second words of a batch's texts, in the order of their hashes."""

    def __init__(self, table: pa.Table):
        place, n = table.column("place").to_numpy(), table.column("n").to_numpy()
        data = table.column("tokens").to_pylist()
        at = int(np.flatnonzero(place == -1)[0])
        self.rows = np.flatnonzero(place >= 0)
        self.places, self.sizes = place[self.rows], n[self.rows]
        words = _unpack(data[at], int(n[at]), "<u8")
        texts = [_unpack(data[i], int(n[i]), "<u4") for i in self.rows.tolist()]
        self.ends = np.concatenate(texts).astype(np.int32) if texts else np.empty(0, np.int32)
        self.begins = np.concatenate(([0], self.ends[:-1])).astype(np.int32) if len(self.ends) else self.ends
        del data, texts
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.begins[self.starts[self.sizes > 0]] = 0
        self.width = len(words)
        pairs, at = np.unique(self.begins.astype(np.int64) * self.width + self.ends, return_inverse=True)
        self.at, u, w = at.astype(np.int32), pairs // self.width, pairs % self.width
        del at
        self.pairs = len(pairs)
        two = words[u] * np.uint64(PAIR) ^ _mix(words[w] + np.uint64(PAIR))
        keys = np.concatenate((_mix(two), _mix(words ^ np.uint64(BEGIN)), _mix(words ^ np.uint64(END))))
        self.order = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.order] & np.uint64(KEY)

    def counts(self, chosen: np.ndarray) -> np.ndarray:
        """How often each occurs in the texts whose places are ``chosen``."""
        token = np.repeat(np.isin(self.places, chosen), self.sizes)
        found = ((self.at, self.pairs), (self.begins, self.width), (self.ends, self.width))
        return np.concatenate([np.bincount(x[token], minlength=n) for x, n in found])[self.order]

    def split(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the distinct bigrams, of first words and of second words."""
        out = np.empty(len(counts), np.float64)
        out[self.order] = counts
        n = self.pairs
        return out[:n], out[n : n + self.width], out[n + self.width :]

    def parts(self) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Documents, their tokens, and each token's document, ``TOKENS_AT_ONCE`` tokens or a document at a time."""
        ends, first = np.cumsum(self.sizes), 0
        while first < len(ends):
            start = int(ends[first] - self.sizes[first])
            last = max(first + 1, int(np.searchsorted(ends, start + TOKENS_AT_ONCE, "right")))
            yield slice(first, last), slice(start, int(ends[last - 1])), np.repeat(np.arange(last - first), self.sizes[first:last])
            first = last


def _own(doc: np.ndarray, item: np.ndarray) -> np.ndarray:
    """For each token how often its item occurs in its document."""
    if not len(item):
        return np.zeros(0)
    _, at, count = np.unique(doc * (int(item.max()) + 1) + item.astype(np.int64), return_inverse=True, return_counts=True)
    return count[at].astype(np.float64)


MESSAGE = "at long, range long, sender long, n long, keys binary, target binary, every binary"
ANSWER = "of long, range long, n long, target binary, every binary"


def _hops(number: int) -> int:
    out = 1
    while FAN**out < number:
        out += 1
    return out


def _fan(number: int, hops: int) -> int:
    """The smallest fan that reaches ``number`` in so many hops: a larger one gives large teams few wide ranges."""
    out = 1
    while out**hops < number:
        out += 1
    return out


def _place(range_: int, team: int) -> int:
    """The name of a receiver: its range of hashes and the team of senders that it serves."""
    return range_ << 31 | team


def _messages(
    sender: int, team: int, keys: np.ndarray, target: np.ndarray, every: np.ndarray, ranges: int, width: int
) -> pa.Table:
    """What one sender sends to each range of ``width`` narrow ranges; ``keys`` are sorted."""
    found, wide = [], (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    wide //= np.uint64(width)
    cuts = np.flatnonzero(np.diff(wide, prepend=wide[:1] + np.uint64(1)))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=False):
        gaps, r = np.diff(keys[a:b], prepend=np.uint64(0)), int(wide[a])
        found.append((_place(r, team), r, sender, b - a, *map(_pack, (gaps, target[a:b], every[a:b]))))
    kinds = [*[pa.int64()] * 4, *[pa.binary()] * 3]
    columns = list(zip(*found, strict=True)) or [[]] * 7
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in MESSAGE.split(", ")])


def _joined(table: pa.Table) -> tuple[pa.Table, list[int], np.ndarray, np.ndarray]:
    """A receiver's messages by sender and range, their sizes, the distinct keys, and where each message's keys are among these."""
    table = table.sort_by([("sender", "ascending"), ("range", "ascending")])
    sizes = table.column("n").to_pylist()
    keys = [_unpack(k, n, "<u8").cumsum(dtype=np.uint64) for k, n in zip(table.column("keys").to_pylist(), sizes, strict=True)]
    keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    return table, sizes, keys, at


def _sums(table: pa.Table, sizes: list[int], at: np.ndarray, name: str) -> np.ndarray:
    own = [_unpack(c, n, "<i8") for c, n in zip(table.column(name).to_pylist(), sizes, strict=True)]
    return np.bincount(at, np.concatenate(own)).astype(np.int64)


def _answers(table: pa.Table, sizes: list[int], at: np.ndarray, sums: list[np.ndarray]) -> pa.Table:
    ends = np.cumsum(sizes)[:-1]
    columns = [table.column("sender"), table.column("range"), table.column("n")]
    columns += [pa.array([_pack(x) for x in np.split(s[at], ends)], pa.binary()) for s in sums]
    return pa.Table.from_arrays(columns, names=[x.split()[0] for x in ANSWER.split(", ")])


def _sent(texts: DataFrame, marks: DataFrame, ranges: int, batches: int) -> list[DataFrame]:
    """The messages of every hop (MESSAGE), the first from the batches."""
    hops = _hops(max(ranges, batches))
    fan = _fan(max(ranges, batches), hops)
    team = lambda number, hop: number // fan**hop if hop < hops else 0  # noqa: E731  at last all senders are one team

    def send(table: pa.Table, marked: pa.Table) -> pa.Table:
        give_back()
        batch, name = Batch(table), table.column("batch")[0].as_py()
        target, every = batch.counts(marked.column("mark").to_numpy()), batch.counts(batch.places)
        number = int(_mix(np.array([name], np.int64).view(np.uint64))[0] % np.uint64(batches))
        return _messages(name, team(number, 1), batch.keys, target, every, ranges, fan ** (hops - 1))

    def forward(hop: int):
        def run(table: pa.Table) -> pa.Table:
            give_back()
            at = table.column("at")[0].as_py()
            table, sizes, keys, index = _joined(table)
            target, every = (_sums(table, sizes, index, c) for c in ("target", "every"))
            number = (at & (1 << 31) - 1) * fan**hop  # of the team's first batch
            return _messages(at, team(number, hop + 1), keys, target, every, ranges, fan ** (hops - hop - 1))

        return run

    marked = marks.select("of", F.col("place").alias("mark"))  # a column of its own, also if the marks come from ``texts``
    out = [texts.groupBy("batch").cogroup(marked.groupBy("of")).applyInArrow(send, MESSAGE)]
    for hop in range(1, hops):  # not written: the way back reads the same exchange again, and pages of wide rows take JVM memory
        out.append(out[-1].groupBy("at").applyInArrow(forward(hop), MESSAGE))
    return out


def _answered(sent: list[DataFrame]) -> DataFrame:
    """The sums over all batches of what a batch sent to a range (ANSWER)."""

    def total(table: pa.Table) -> pa.Table:
        give_back()
        table, sizes, _, at = _joined(table)
        return _answers(table, sizes, at, [_sums(table, sizes, at, c) for c in ("target", "every")])

    def back(table: pa.Table, answer: pa.Table) -> pa.Table:
        give_back()
        table, sizes, _, at = _joined(table)
        answer = answer.sort_by("range")
        counts = answer.column("n").to_pylist()
        sums = [
            np.concatenate([_unpack(x, n, "<i8") for x, n in zip(answer.column(c).to_pylist(), counts, strict=True)])
            for c in ("target", "every")
        ]
        return _answers(table, sizes, at, sums)

    found = sent[-1].groupBy("at").applyInArrow(total, ANSWER)
    for messages in sent[-2::-1]:
        found = messages.groupBy("at").cogroup(found.groupBy("of")).applyInArrow(back, ANSWER)
    return found


def _distinct_words(texts: DataFrame) -> int:
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _unpack(data, n, "<u8")[2:].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(words)], names=["word"])

    return texts.filter("place = -1").select("n", "tokens").mapInArrow(unpack, "word long").distinct().count()


def losses(counts: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """-log2 p(w|u) of every pair from a matrix of bigram counts: the definition, for small vocabularies."""
    unigram = counts.sum(0) + 1.0
    unigram /= unigram.sum()
    return -np.log2((counts + smoothing * unigram[None]) / (counts.sum(1, keepdims=True) + smoothing))


def cross_entropy_difference(
    docs: DataFrame,
    targets: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    size: int | None = None,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score; ``targets`` has the ids of the target's documents.

    ``size`` keeps only so many of the most frequent words; None, the default, keeps all.
    """
    rows = docs.select(F.col(id_column).alias("doc"), F.col(text).alias("text"))
    words = None if size is None else vocabulary(rows, size)
    chosen = targets.select(F.col(id_column).alias("doc")).dropna().distinct().withColumn("target", F.lit(True))
    texts = written(_batches(rows, words), "tokens")
    # target ids grow with the corpus, so they are shuffled whatever their number is: the same plan at every size
    ids = texts.filter("place >= 0").select(F.col("batch").alias("of"), "place", "doc", "n")
    marks = written(skew_join(ids, chosen.hint("merge"), ["doc"]).select("of", "place", "n"), "marks")
    n_every = ids.agg(F.sum("n")).first()[0] or 0
    n_target = marks.agg(F.sum("n")).first()[0] or 0
    symbols = (_distinct_words(texts) if size is None else size) + 2  # and the start, and any other word
    batches = texts.filter("place = -1").count()
    answers = _answered(_sent(texts, marks.select("of", "place"), 1 + n_every // RANGE_TOKENS, max(1, batches)))
    schema = T.StructType(
        [
            T.StructField("doc_id", texts.schema["doc"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("target_loss", T.DoubleType()),
            T.StructField("background_loss", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def loss(batch: Batch, counts: np.ndarray, total: int, scale: float, member: np.ndarray) -> np.ndarray:
        """The sum of each document's losses; those of ``member`` are left out of the counts."""
        pair, begin, end = batch.split(counts)
        sums = np.zeros(len(batch.sizes))
        for docs, tokens, doc in batch.parts():
            mine, size = member[docs].astype(np.float64), batch.sizes[docs]
            at, u, w, off = batch.at[tokens], batch.begins[tokens], batch.ends[tokens], mine[doc]
            uw, us, ws = ((c[i] - off * _own(doc, i)) * scale for c, i in ((pair, at), (begin, u), (end, w)))
            share = (ws + 1.0) / ((total - mine * size) * scale + symbols)[doc]
            sums[docs] = np.bincount(doc, -np.log2((uw + smoothing * share) / (us + smoothing)), len(size))
        return sums

    def score(table: pa.Table, answer: pa.Table) -> pa.Table:
        give_back()
        batch, kind = Batch(table), answer.column("range").to_numpy()
        member = np.isin(batch.places, answer.column("n").to_numpy()[kind < 0])
        answer = answer.filter(pa.array(kind >= 0)).sort_by("range")
        sizes = answer.column("n").to_pylist()
        target, every = (
            np.concatenate([_unpack(x, n, "<i8") for x, n in zip(answer.column(c).to_pylist(), sizes, strict=True)])
            for c in ("target", "every")
        )
        scale = n_target / n_every if n_target else 1.0
        del batch.keys, answer
        far = loss(batch, every, n_every, scale, np.ones(len(batch.sizes), bool))
        near = loss(batch, target, n_target, 1.0, member) if n_target else far
        n = np.maximum(batch.sizes, 1)
        columns = [pa.array(x) for x in (batch.sizes, near / n, far / n, (far - near) / n)]
        return pa.Table.from_arrays([table.column("doc").take(pa.array(batch.rows)), *columns], names=schema.names)

    nothing = F.lit(None).cast("binary")
    members = marks.select("of", F.lit(-1).cast("long").alias("range"), F.col("place").cast("long").alias("n"), nothing.alias("target"), nothing.alias("every"))
    answers = answers.unionByName(members)
    return texts.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(score, schema)
