"""Benchmark decontamination with an FM-index per shard of the documents (operator 3).

A shard is a chunk of documents of bounded size. Its words become numbers; words that no
benchmark item holds, and stretches too short to hold a window of any item, become one
separator, which loses no occurrence and leaves a small text. Over that text the shard builds
a suffix order, its Burrows-Wheeler transform as a wavelet matrix, and suffix positions sampled
at every ``SAMPLE``-th place. All windows are searched backwards together, one word per step, by
two ranks each; the rows found are walked back to the next sampled position, which locates
them; occurrences become word spans, and overlapping spans are merged for removal.

The benchmark is a query set: it is read in blocks of bounded size, and each block is one pass
over the documents. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import binaries, in_chunks, lean, stage

SHARD_BYTES = 4_000_000
SAMPLE = 8
# Words of benchmark text in one block.
BLOCK_WORDS = 1_000_000

# ASCII letters and digits and every byte above 0x7F make words; A-Z are lowered.
_WORD_BYTES = bytes(
    x + 32 if 0x41 <= x <= 0x5A
    else x if 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A or x >= 0x80
    else 0x20
    for x in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which the words begin and end."""
    inside = np.frombuffer(text.translate(_WORD_BYTES), np.uint8) != 0x20
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class FMIndex:
    """Backward search and location over a sequence of numbers; 0 separates."""

    def __init__(self, text: np.ndarray, symbols: int):
        """``text`` holds numbers from 0 to ``symbols`` - 1."""
        text = np.concatenate([text.astype(np.int64) + 1, [0]])  # 0: the end, smallest
        order = _suffix_order(text)
        self.n = len(text)
        last = text[order - 1]
        counts = np.bincount(text, minlength=symbols + 1)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        sampled = order % SAMPLE == 0
        self.marked = sampled
        self.rank_marked = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]
        # Wavelet matrix: one bit of all symbols per level, zeros moved to the front.
        self.bits = max(1, int(symbols).bit_length())
        self.levels, self.zeros = [], []
        current = last
        for shift in range(self.bits - 1, -1, -1):
            bit = (current >> shift) & 1
            self.levels.append((bit.astype(bool), np.concatenate([[0], np.cumsum(bit)])))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def _rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first ``upto`` of the transform."""
        start, end = np.zeros_like(upto), upto
        for k, (_, ones) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            start = np.where(one, self.zeros[k] + ones[start], start - ones[start])
            end = np.where(one, self.zeros[k] + ones[end], end - ones[end])
        return end - start

    def _step(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one place further left."""
        at, symbol = row, np.zeros_like(row)
        start = np.zeros_like(row)
        for k, (bit, ones) in enumerate(self.levels):
            one = bit[at]
            symbol = symbol * 2 + one
            start = np.where(one, self.zeros[k] + ones[start], start - ones[start])
            at = np.where(one, self.zeros[k] + ones[at], at - ones[at])
        return self.before[symbol] + at - start

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 row of each pattern (rows of equal length, all above 0)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for j in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, j].astype(np.int64) + 1
            lo = self.before[symbol] + self._rank(symbol, low[alive])
            hi = self.before[symbol] + self._rank(symbol, high[alive])
            low[alive], high[alive] = lo, hi
            alive = alive[hi > lo]
            if not len(alive):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text where the suffixes of the rows begin."""
        place = np.zeros(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        row, alive = rows.copy(), np.arange(len(rows))
        while len(alive):
            done = self.marked[row[alive]]
            found = alive[done]
            place[found] = self.positions[self.rank_marked[row[found]]] + steps[found]
            alive = alive[~done]
            row[alive] = self._step(row[alive])
            steps[alive] += 1
        return place


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; the last symbol is unique and smallest."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, width = len(text), 1
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - width] = rank[width:] if width < n else []
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2


class Windows(NamedTuple):
    """One block of the benchmark: its words numbered from 1, its distinct windows by length,
    and for each window the items (places in ``items``) that hold it."""

    numbers: dict[bytes, int]
    patterns: dict[int, np.ndarray]
    holders: dict[int, list[np.ndarray]]
    items: list[str]
    shortest: int
    pairs: np.ndarray


PAIR_BITS = 22


def _pair_slot(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first * 2654435761 + second * 40503) >> 7 & ((1 << PAIR_BITS) - 1)


def windows_of(items: list[tuple[str, bytes]], window: int) -> Windows:
    numbers: dict[bytes, int] = {}
    found: dict[int, dict[tuple, set[int]]] = {}
    pairs = np.zeros(1 << PAIR_BITS, bool)
    for k, (_, text) in enumerate(items):
        own = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        if not own:
            continue
        size = min(window, len(own))
        for i in range(len(own) - size + 1):
            found.setdefault(size, {}).setdefault(tuple(own[i : i + size]), set()).add(k)
        ids = np.array(own, np.int64)
        pairs[_pair_slot(ids[:-1], ids[1:])] = True
    return Windows(
        numbers,
        {n: np.array(list(w), np.int64) for n, w in found.items()},
        {n: [np.array(sorted(s)) for s in w.values()] for n, w in found.items()},
        [name for name, _ in items],
        min(found, default=window),
        pairs,
    )


def _kept(ids: np.ndarray, owner: np.ndarray, block: Windows) -> np.ndarray:
    """Places in stretches of benchmark words, each followed by one that follows it in some
    item (as far as a hashed table tells), that are long enough for a window."""
    joined = np.zeros(len(ids), bool)  # does place i continue the stretch of i - 1?
    if len(ids) > 1:
        joined[1:] = (
            (owner[1:] == owner[:-1]) & (ids[1:] > 0) & (ids[:-1] > 0)
            & block.pairs[_pair_slot(ids[:-1], ids[1:])]
        )
    stretch = np.cumsum(~joined) - 1
    long_enough = np.bincount(stretch) >= block.shortest if len(ids) else np.zeros(0, bool)
    return np.flatnonzero((ids > 0) & long_enough[stretch]) if len(ids) else np.zeros(0, np.int64)


def search_shard(
    texts: list[bytes], block: Windows
) -> tuple[np.ndarray, list[np.ndarray], list[set[int]]]:
    """Words per text, its merged word spans (k x 2, end exclusive), its items."""
    look = block.numbers.get
    own = [words_of(t) for t in texts]
    lengths = np.fromiter(map(len, own), np.int64, len(own))
    ids = np.fromiter((look(w, 0) for ws in own for w in ws), np.int64, int(lengths.sum()))
    del own
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(texts)), lengths)
    kept = _kept(ids, owner, block)
    spans: list[np.ndarray] = [np.zeros((0, 2), np.int64)] * len(texts)
    items: list[set[int]] = [set() for _ in texts]
    if not len(kept):
        return lengths, spans, items
    # The reduced text: kept words, a separator between stretches that do not touch.
    gap = np.concatenate([[False], (np.diff(kept) > 1) | (np.diff(owner[kept]) > 0)])
    where = np.arange(len(kept)) + np.cumsum(gap)
    reduced = np.zeros(where[-1] + 1, np.int64)
    reduced[where] = ids[kept]
    origin = np.zeros(len(reduced), np.int64)
    origin[where] = kept
    index = FMIndex(reduced, len(block.numbers) + 1)
    firsts, ends = [], []
    for size, patterns in block.patterns.items():
        low, high = index.search(patterns)
        hit = np.flatnonzero(high > low)
        if not len(hit):
            continue
        many = (high - low)[hit]
        rows = np.repeat(low[hit] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        first = origin[index.locate(rows)]
        firsts.append(first)
        ends.append(first + size)
        for k, text in set(zip(np.repeat(hit, many).tolist(), owner[first].tolist())):
            items[text].update(block.holders[size][k].tolist())
    if firsts:
        first, end = np.concatenate(firsts), np.concatenate(ends)
        for text in np.unique(owner[first]).tolist():
            mine = owner[first] == text
            spans[text] = merged(first[mine] - starts[text], end[mine] - starts[text])
    return lengths, spans, items


def merged(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans united where they overlap or touch."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], first[1:] > end[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(first) - 1]])
    return np.stack([first[new], end[last]], 1)


def _search(block, cut: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = windows_of(block.value[0], block.value[1])
        for chunk in in_chunks(batches, "text", SHARD_BYTES):
            texts = binaries(chunk.column("text"))
            n_words, spans, items = search_shard(texts, known)
            old_spans = chunk.column("spans").to_pylist()
            old_items = chunk.column("items").to_pylist()
            for i, (before, named) in enumerate(zip(old_spans, old_items)):
                if before:
                    both = np.concatenate([np.array(before, np.int64).reshape(-1, 2), spans[i]])
                    spans[i] = merged(both[:, 0], both[:, 1])
                items[i] = {known.items[k] for k in items[i]} | set(named)
            if cut:
                texts = pa.array(map(_without, chunk.column(cut).to_pylist(), spans), pa.string())
                chunk = chunk.set_column(chunk.schema.get_field_index(cut), cut, texts)
            columns = [
                *[chunk.column(c) for c in chunk.schema.names if c not in OWN],
                pa.array(n_words, pa.int64()),
                pa.array([s.ravel() for s in spans], pa.list_(pa.int64())),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            names = [c for c in chunk.schema.names if c not in OWN]
            yield pa.RecordBatch.from_arrays(columns, [*names, *OWN])

    return lambda batches: lean(run(batches))


OWN = ("n_words", "spans", "items")


def blocks_of(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, bytes]]]:
    """The items with words, in blocks of BLOCK_WORDS words (or one item), one block at a time
    in the driver. Equal rows are one, and blocks are dealt by hash, so repeated texts do not
    gather."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
        F.col(text).cast("string").alias("text"),
    ).where(F.col("text").isNotNull()).distinct()
    size = rows.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    n = 1 + size // (6 * BLOCK_WORDS)
    if n > 1:
        rows = stage(rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), "items")
    for k in range(n):
        own = rows.where(F.col("block") == k) if n > 1 else rows
        items = [(r["item"], r["text"].encode()) for r in own.select("item", "text").collect()]
        if items or k == 0:
            yield items


def find(
    documents: DataFrame, benchmark: DataFrame, window: int = 10,
    text: str = "text", item_id: str = "item_id", item_text: str = "text", remove: bool = False,
) -> DataFrame:
    """``documents`` with n_words, spans (first and end word of each merged hit, flat) and items
    (ids of items with a window in the text, sorted as strings).

    Columns of these names in the input are replaced. A NULL or empty text has no words; an
    item without words is never found; an item of fewer than ``window`` words is one window;
    equal items are all reported. Empty tables on either side are allowed. With ``remove`` the
    spans are cut out of the text, first word to last; they still count words of the whole text.
    """
    spark = documents.sparkSession
    found = documents.drop(*OWN).withColumn("text", F.col(text).cast("string")).withColumns({
        "n_words": F.lit(0).cast("long"),
        "spans": F.array().cast("array<bigint>"),
        "items": F.array().cast("array<string>"),
    })
    schema = found.schema
    order = type(schema)(
        [f for f in schema if f.name not in OWN] + [f for f in schema if f.name in OWN]
    )
    last = None
    for items in blocks_of(benchmark, item_id, item_text):
        if last is not None:
            found = stage(found.mapInArrow(_search(last, None), order), "spans")
        last = spark.sparkContext.broadcast((items, window))
    return found.mapInArrow(_search(last, "text" if remove else None), order)


def hit_words(spans: Column) -> Column:
    """Words that the flat spans cover."""
    return F.aggregate(
        F.sequence(F.lit(0), F.size(spans).cast("int")), F.lit(0).cast("long"),
        lambda total, i: total + F.coalesce(
            F.when(i % 2 == 1, F.get(spans, i) - F.get(spans, i - 1)), F.lit(0)
        ).cast("long"),
    )


def _without(text: str | None, spans: np.ndarray) -> str | None:
    """A text without the words from the first to the last of each span."""
    if text is None or not len(spans):
        return text
    raw = text.encode()
    begins, ends = word_places(raw)
    kept, at = [], 0
    for first, end in spans.tolist():
        kept.append(raw[at : begins[first]])
        at = int(ends[end - 1])
    kept.append(raw[at:])
    return b"".join(kept).decode()
