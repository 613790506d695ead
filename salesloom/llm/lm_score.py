"""Document probability under a subword lattice (operator 4).

A text is its words, each with one blank in front, and an end mark. The lattice of a word has
an edge for the whole word, if training texts hold it, and an escape into the pieces of a
published byte-level vocabulary; every way to spell the word with pieces counts. The
probability of a word is the sum over all its paths, by a forward recursion in log space, and a
text's is the product over its words and the end mark: no piece holds a blank behind its
first place, so paths never cross words.

All scores are unigram scores. A whole word's is its training count less a discount that is
estimated from the words seen once and twice; what the discounts free is the score of the
escape. The published file ranks its pieces but has no probabilities, so theirs start
from the ranks and are re-estimated by expectation maximisation (forward and backward over
every distinct training word, each weighing its discount). Scores of the pieces that begin a
word add up to one, and so do those of the other pieces and the end of a word.

Words repeat, so work is done once per distinct word. Documents are read once, in blocks; a
block's words are numbered, its documents become (word number, count) pairs. Blocks send their
distinct words, not their tokens, to be counted and scored, and each block gets its own words'
counts and scores back.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import binaries, in_chunks, lean, remainder, stage

BLOCK_BYTES = 16_000_000
LONGEST_ARRAY_WORD = 48
CELLS = 4_000_000
# Added to the expected count of every piece, so that none becomes impossible.
SMOOTHING = 0.01


class Pieces:
    """The vocabulary, with a table from 64-bit hashes of byte strings to piece numbers."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    SPREAD = np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, vocabulary: str):
        import public_tokenizers

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # Words hold no blank but the one in front; other pieces can never be used.
        usable = sorted(
            (p for p in ranks if not set(p[1:]) & set(b"\t\n\x0b\x0c\r ") and p[:1] not in b"\t\n\x0b\x0c\r"),
            key=ranks.get,
        )
        missing = [bytes([b]) for b in range(256) if bytes([b]) not in ranks]
        self.pieces = usable + missing  # any byte can be spelled
        self.number = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))
        self.none = len(self.pieces)
        self.begins = np.array([p[:1] == b" " for p in self.pieces])
        self.keys = np.array([self._hash(p) for p in self.pieces] + [0], np.uint64)
        self.first = np.full(1 << 20, self.none, np.int32)
        own = np.arange(self.none, dtype=np.int32)
        slot = self._slot(self.keys[:-1], self.SPREAD)
        self.first[slot[::-1]] = own[::-1]
        left = own[self.first[slot] != own]
        for seed in range(1, 1000):  # a second table in which the rest do not collide
            self.mixer = np.uint64(2 * seed * 0x632BE59BD9B4E019 + 1 & (1 << 64) - 1)
            slot = self._slot(self.keys[left], self.mixer)
            if len(np.unique(slot)) == len(slot):
                break
        else:
            raise ValueError("the vocabulary is too large for the second table")
        self.second = np.full(1 << 20, self.none, np.int32)
        self.second[slot] = left

    def _hash(self, piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(self.BASE) + b + 1) & (1 << 64) - 1
        return h

    @staticmethod
    def _slot(key: np.ndarray, mixer: np.uint64) -> np.ndarray:
        return ((key ^ (key >> np.uint64(29))) * mixer >> np.uint64(44)).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        one = self.first[self._slot(key, self.SPREAD)]
        two = self.second[self._slot(key, self.mixer)]
        return np.where(self.keys[one] == key, one, np.where(self.keys[two] == key, two, self.none))

    def initial(self) -> np.ndarray:
        """Expected uses from the ranks: frequent merges come first, by a power law."""
        return 1.0 / (np.arange(self.none) + 10.0)

    def scores(self, uses: np.ndarray, words: float) -> tuple[np.ndarray, float]:
        """Log scores of all pieces and of the end of a word."""
        first = uses[self.begins].sum()
        rest = uses[~self.begins].sum() + words
        return np.log(uses / np.where(self.begins, first, rest)), math.log(words / rest)


@lru_cache(maxsize=2)
def pieces_of(vocabulary: str) -> Pieces:
    return Pieces(vocabulary)


def lattice(
    words: list[bytes], pieces: Pieces, scores: np.ndarray, counts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray | None]:
    """Log probability of each word; with ``counts``, also the expected uses of each piece."""
    total = np.zeros(len(words))
    expected = None if counts is None else np.zeros(pieces.none + 1)
    padded = np.append(scores, -np.inf)
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word) + 1, []).append(k)
    for length, members in sorted(by_length.items()):
        if length > LONGEST_ARRAY_WORD:
            for k in members:
                times = 0 if counts is None else counts[k]
                total[k] = _one(b" " + words[k], pieces, scores, expected, times)
            continue
        step = max(1, CELLS // (length * length))
        for at in range(0, len(members), step):
            some = members[at : at + step]
            grid = np.frombuffer(b"".join(b" " + words[k] for k in some), np.uint8)
            grid = grid.reshape(len(some), length).T.astype(np.uint64) + np.uint64(1)
            total[some] = _many(grid, pieces, padded, expected, None if counts is None else counts[some])
    return total, None if expected is None else expected[:-1]


def _many(grid, pieces: Pieces, padded, expected, counts) -> np.ndarray:
    """The recursion for words of one length, side by side."""
    length, n = grid.shape
    held = np.full((length, length + 1, n), pieces.none, np.int32)  # piece at [i, j)
    for i in range(length):
        key = np.zeros(n, np.uint64)
        for j in range(i + 1, min(length, i + pieces.longest) + 1):
            key = key * pieces.BASE + grid[j - 1]
            held[i, j] = pieces.find(key)
    forward = np.full((length + 1, n), -np.inf)
    forward[0] = 0.0
    for j in range(1, length + 1):
        first = max(0, j - pieces.longest)
        forward[j] = _logsum(forward[first:j] + padded[held[first:j, j]])
    if counts is not None:
        backward = np.full((length + 1, n), -np.inf)
        backward[length] = 0.0
        for i in range(length - 1, -1, -1):
            last = min(length, i + pieces.longest)
            own = padded[held[i, i + 1 : last + 1]] + backward[i + 1 : last + 1]
            backward[i] = _logsum(own)
            use = np.exp(own + forward[i] - forward[length]) * counts
            expected += np.bincount(held[i, i + 1 : last + 1].ravel(), use.ravel(), len(expected))
    return forward[length]


def _logsum(x: np.ndarray) -> np.ndarray:
    most = x.max(0)
    return most + np.log(np.exp(x - most).sum(0))


def _one(word: bytes, pieces: Pieces, scores, expected, count) -> float:
    """The recursion for one long word."""
    n, number, longest = len(word), pieces.number, pieces.longest
    held = [
        [(i, number[word[i:j]]) for i in range(max(0, j - longest), j) if word[i:j] in number]
        for j in range(n + 1)
    ]
    forward = [0.0] + [-math.inf] * n
    for j in range(1, n + 1):
        own = [forward[i] + scores[p] for i, p in held[j]]
        most = max(own)
        forward[j] = most + math.log(sum(math.exp(x - most) for x in own))
    if expected is not None and count:
        backward = [-math.inf] * n + [0.0]
        for j in range(n, 0, -1):
            for i, p in held[j]:
                backward[i] = float(np.logaddexp(backward[i], backward[j] + scores[p]))
        for j in range(1, n + 1):
            for i, p in held[j]:
                expected[p] += count * math.exp(forward[i] + scores[p] + backward[j] - forward[n])
    return forward[n]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _packed(which: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending word numbers, as differences, and their counts."""
    steps = np.diff(which, prepend=0).astype("<u4")
    return zlib.compress(steps.tobytes() + times.astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64).reshape(2, -1)
    return np.cumsum(both[0]), both[1]


BLOCKS = (
    "is_word boolean, block long, doc_id long, held_out boolean, counts binary, "
    "number int, word binary, trained long"
)


def _count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the documents of a block, then rows for its distinct words."""
    task = TaskContext.get().partitionId()
    for k, chunk in enumerate(in_chunks(batches, "text", BLOCK_BYTES)):
        block = (task << 24) + k
        known = _Numbers()
        held = chunk.column("held_out").to_pylist()
        counts = []
        trained = np.zeros(0, np.int64)
        for text, out in zip(binaries(chunk.column("text")), held):
            own = np.array(list(map(known.__getitem__, text.lower().split())), np.int64)
            which, times = np.unique(own, return_counts=True)
            counts.append(_packed(which, times))
            if not out and len(which):
                if len(trained) < len(known):
                    trained = np.concatenate([trained, np.zeros(len(known), np.int64)])
                trained[which] += times
        docs, n = chunk.num_rows, len(known)
        if len(trained) < n:
            trained = np.concatenate([trained, np.zeros(n - len(trained), np.int64)])
        yield _rows(
            docs, is_word=pa.array([False] * docs), block=pa.array([block] * docs, pa.int64()),
            doc_id=chunk.column("doc_id"), held_out=chunk.column("held_out"),
            counts=pa.array(counts, pa.binary()),
        )
        words = list(known)
        for at in range(0, n, 50_000):
            some = words[at : at + 50_000]
            yield _rows(
                len(some), is_word=pa.array([True] * len(some)),
                block=pa.array([block] * len(some), pa.int64()),
                number=pa.array(np.arange(at, at + len(some)), pa.int32()),
                word=pa.array(some, pa.binary()),
                trained=pa.array(trained[at : at + len(some)], pa.int64()),
            )


_TYPES = {
    "is_word": pa.bool_(), "block": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(),
    "counts": pa.binary(), "number": pa.int32(), "word": pa.binary(), "trained": pa.int64(),
}


def _rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    every = [columns.get(name, pa.nulls(n, kind)) for name, kind in _TYPES.items()]
    return pa.RecordBatch.from_arrays(every, list(_TYPES))


def _expect(vocabulary: str, scores):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, total = pieces_of(vocabulary), None
        for batch in batches:
            own = lattice(
                batch.column("word").to_pylist(), pieces, scores.value,
                batch.column("weight").to_numpy(),
            )[1]
            total = own if total is None else total + own
        if total is not None:
            used = np.flatnonzero(total > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(total[used], pa.float64())], ["piece", "uses"]
            )

    return run


def train(
    words: DataFrame, discount: float, distinct: int, vocabulary: str, rounds: int
) -> tuple[np.ndarray, float]:
    """Log scores of the pieces and of the end of a word, from (word, trained) rows.

    Each round reads every distinct training word; a sum per piece (at most the size of the
    vocabulary) reaches the driver.
    """
    pieces = pieces_of(vocabulary)
    weight = discount * distinct + SMOOTHING
    scores, end = pieces.scores(pieces.initial(), 1.0)
    weighted = words.where("trained > 0").select("word", F.lit(discount).alias("weight"))
    for _ in range(rounds):
        sent = words.sparkSession.sparkContext.broadcast(scores)
        found = weighted.mapInArrow(_expect(vocabulary, sent), "piece int, uses double").groupBy(
            "piece"
        ).agg(F.sum("uses").alias("uses")).collect()
        uses = np.full(pieces.none, SMOOTHING)
        for row in found:
            uses[row["piece"]] += row["uses"]
        scores, end = pieces.scores(uses, weight)
        sent.unpersist()
    return scores, end


def _score_words(vocabulary: str, sent, discount: float, escape: float, total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(vocabulary)
        scores, end = sent.value
        for batch in batches:
            spelled = lattice(batch.column("word").to_pylist(), pieces, scores)[0] + end
            whole = np.maximum(batch.column("trained").to_numpy() - discount, 0.0)
            with np.errstate(divide="ignore"):
                own = np.logaddexp(np.log(whole), spelled + math.log(escape)) - math.log(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("trained"), pa.array(own / math.log(10))],
                ["word", "trained", "log10_p"],
            )

    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score_block(tokens: int, distinct: int, ends: int, end_log10: float):
    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        order = words.column("at").to_numpy()
        trained, p = np.zeros(len(order), np.int64), np.zeros(len(order))
        trained[order] = words.column("trained").to_numpy()
        p[order] = words.column("log10_p").to_numpy()
        rest = math.log10(tokens + distinct + 1)
        base = np.log10(trained + 1.0) - rest
        known = trained > 0
        n_tokens, n_known, base_score, score = [], [], [], []
        for which, times in map(_unpacked, docs.column("counts").to_pylist()):
            n_tokens.append(int(times.sum()) + 1)
            n_known.append(int(times[known[which]].sum()) + (ends > 0))
            base_score.append(float((times * base[which]).sum()) + math.log10(ends + 1) - rest)
            score.append(float((times * p[which]).sum()) + end_log10)
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
            "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "base_score": pa.array(base_score, pa.float64()), "score": pa.array(score, pa.float64()),
        })

    return run


def score(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    folds: int = 7, held_out_fold: int = 2, rounds: int = 3,
    vocabulary: str = "byte_bpe_50k.tiktoken",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from rows whose fold is not ``held_out_fold``; an id that is NULL counts as ''. A NULL,
    empty or blank text is the end mark alone. Repeated rows count and are scored each; without
    training rows all pieces are equally unlikely. Other columns are not read. Scores are
    base-10 logarithms.
    """
    held = remainder(F.col(doc_id), folds) == held_out_fold
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
        held.alias("held_out"),
    )
    blocks = stage(rows.mapInArrow(lambda batches: lean(_count_blocks(batches)), BLOCKS), "lm-blocks")
    docs = blocks.where(~F.col("is_word")).select(
        "block", "doc_id", "held_out", "counts"
    )
    words = blocks.where(F.col("is_word")).select("block", "number", "word", "trained")
    counted = stage(
        words.groupBy("word").agg(F.sum("trained").alias("trained")), "lm-words"
    )
    times = F.col("trained")
    size = counted.agg(
        F.sum("trained").alias("tokens"), F.count(F.when(times > 0, 1)).alias("distinct"),
        F.count(F.when(times == 1, 1)).alias("once"), F.count(F.when(times == 2, 1)).alias("twice"),
    ).first()
    ends = docs.where(~F.col("held_out")).count()
    tokens = (size["tokens"] or 0) + ends
    once, twice = size["once"], size["twice"]
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    scores, end = train(counted, discount, size["distinct"], vocabulary, rounds)
    # One more escape and one more end than seen, so that neither is ever impossible.
    escape, total = discount * size["distinct"] + 1, tokens + 2.0
    sent = documents.sparkSession.sparkContext.broadcast((scores, end))
    scored = counted.mapInArrow(
        _score_words(vocabulary, sent, discount, escape, total),
        "word binary, trained long, log10_p double",
    )
    looked_up = words.select(
        F.col("block").alias("for_block"), F.col("number").alias("at"), "word"
    ).join(scored, "word").select("for_block", "at", "trained", "log10_p")
    found = docs.groupBy("block").cogroup(looked_up.groupBy("for_block")).applyInArrow(
        _score_block(tokens, size["distinct"] + (ends > 0), ends, math.log10((ends + 1) / total)), SCORED
    )
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
