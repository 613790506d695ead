"""Packing of tokenized documents into sequences by best fit and swaps (operator 9).

Documents become token ids and an end id; only those longer than a sequence are cut, into full
pieces and one shorter piece in front. Full pieces are sequences already. The others are dealt
into blocks of bounded size, and each block is packed on its own: best fit in decreasing
length, then a local search that exchanges pieces one for one, two for one or one for none
between underfull sequences. Every exchange moves length from an emptier sequence to a fuller
one, so the sum of squared fills rises until the emptiest sequences are used up. Sequences
that stay underfull in their block are dealt again into fewer blocks, where pieces of other
blocks can complete them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import in_chunks, lean, stage

CHUNK_BYTES = 2_000_000
# Pieces in a block on average.
BLOCK_PIECES = 8192
# A sequence this full is finished in the first pass.
FULL_ENOUGH = 0.998


@lru_cache(maxsize=1)
def _tokenizers(vocabulary: str):
    """The byte-level vocabulary twice: as published, and, where its ranks are published beside
    it, in an engine that splits and merges alike but is several times as fast."""
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path(vocabulary))
    special = [t.content for t in full.get_added_tokens_decoder().values()]
    beside = vocabulary.removesuffix(".json") + ".tiktoken"
    try:
        place = public_tokenizers.path(beside)
    except (KeyError, FileNotFoundError, ValueError):
        return full, None, special
    if not os.path.exists(place):
        return full, None, special
    with open(place, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return full, fast, special


# Beyond this many characters without a blank the published engine is used: its cost does not
# depend on the length of a word, nor does it give up on one.
LONG_TEXT = 2_000_000


def token_ids(text: str, vocabulary: str) -> np.ndarray:
    full, fast, special = _tokenizers(vocabulary)
    if fast is None or len(text) > LONG_TEXT or any(s in text for s in special):
        return np.array(full.encode(text, add_special_tokens=False).ids, np.uint32)
    try:
        return fast.encode_to_numpy(text, disallowed_special=())
    except BaseException as problem:  # the engine's own panic is no Exception
        if type(problem).__name__ not in ("PanicException", "ValueError"):
            raise
        return np.array(full.encode(text, add_special_tokens=False).ids, np.uint32)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(capacity: int, vocabulary: str, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32)
        for chunk in in_chunks(batches, "text", CHUNK_BYTES):
            owner, piece, start, length, crc = [], [], [], [], []
            docs = chunk.column("doc_id").to_pylist()
            for doc, text in zip(docs, chunk.column("text").to_pylist()):
                ids = np.concatenate([token_ids(text or "", vocabulary), end])
                n = len(ids)
                raw = ids.astype("<u4").tobytes()
                first = n % capacity or capacity
                bounds = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    owner.append(doc)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(owner, pa.int64()), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return lambda batches: lean(cut(batches))


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of lengths: each length, longest first, goes where it leaves least room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r is set if a bin with r left exists
    bins: list[list[int]] = []
    for length in sorted(lengths, reverse=True):
        fits = open_ >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            k = room[left].pop()
            if not room[left]:
                open_ &= ~(1 << left)
            bins[k].append(length)
        else:
            left, k = capacity, len(bins)
            bins.append([length])
        if left > length:
            room[left - length].append(k)
            open_ |= 1 << left - length
    return bins


class _Stock:
    """Lengths in the emptier bins: which exist, and in which bins."""

    def __init__(self):
        self.where: dict[int, list[int]] = {}
        self.mask = 0

    def add(self, length: int, k: int) -> None:
        self.where.setdefault(length, []).append(k)
        self.mask |= 1 << length

    def longest(self, least: int, most: int) -> int:
        """The longest length held from ``least`` to ``most``; 0 if none."""
        if most < least:
            return 0
        part = (self.mask & ((1 << most + 1) - 1)) >> least
        return least + part.bit_length() - 1 if part else 0

    def take(self, length: int) -> int:
        own = self.where[length]
        k = own.pop()
        if not own:
            del self.where[length]
            self.mask &= ~(1 << length)
        return k

    def drop(self, length: int, k: int) -> None:
        own = self.where[length]
        own.remove(k)
        if not own:
            del self.where[length]
            self.mask &= ~(1 << length)


def _gifts(own: list[int]) -> list[tuple[int, ...]]:
    """What a bin can give, told by lengths: nothing, one piece, or two. Different lengths in a
    bin are few however many pieces it has, as their sum is at most its capacity."""
    held = Counter(own)
    lengths = sorted(held)
    pairs = [
        (x, y) for i, x in enumerate(lengths) for y in lengths[i:] if x != y or held[x] > 1
    ]
    return [(), *((x,) for x in lengths), *pairs]


def improve(bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Exchanges between underfull bins, fullest first, until a pass changes nothing.

    A bin with room r gives nothing, one piece or two and takes one longer piece from an
    emptier bin, at most r longer than what it gives. Each exchange raises the sum of squared
    fills, so there is an end.
    """
    changed = True
    while changed:
        full = [b for b in bins if sum(b) == capacity]
        under = sorted((b for b in bins if sum(b) < capacity), key=sum, reverse=True)
        fill = [sum(b) for b in under]
        stock = _Stock()
        for k, own in enumerate(under):
            for length in own:
                stock.add(length, k)
        changed = False
        for k, own in enumerate(under):
            for length in own:
                stock.drop(length, k)
            if not own:
                continue
            while fill[k] < capacity:
                room = capacity - fill[k]
                best = (0, (), 0)  # gain, what is given, what is taken
                for gift in _gifts(own):
                    size = sum(gift)
                    taken = stock.longest(size + 1, min(size + room, capacity))
                    if taken and taken - size > best[0]:
                        best = (taken - size, gift, taken)
                        if best[0] == room:
                            break
                gain, gift, taken = best
                if not gain:
                    break
                other = stock.take(taken)
                under[other].remove(taken)
                own.append(taken)
                for length in gift:
                    own.remove(length)
                    under[other].append(length)
                    stock.add(length, other)
                fill[k] += gain
                fill[other] -= gain
                changed = True
        bins = full + [b for b in under if b]
    return bins


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each piece its bin, its place there, and the fill of its bin."""
    held: dict[int, list[int]] = {}
    for i, length in enumerate(lengths.tolist()):
        held.setdefault(length, []).append(i)
    which = np.zeros(len(lengths), np.int64)
    place = np.zeros(len(lengths), np.int64)
    fill = np.zeros(len(lengths), np.int64)
    for k, own in enumerate(improve(best_fit(lengths.tolist(), capacity), capacity)):
        at, total = 0, sum(own)
        for length in own:
            i = held[length].pop()
            which[i], place[i], fill[i] = k, at, total
            at += length
    return which, place, fill


PLACED = PIECES + ", block long, bin long, offset long, fill long"


def _pack_block(capacity: int):
    def place(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "doc_id", "piece"], kind="stable")
        which, at, fill = pack(block["length"].to_numpy(), capacity)
        return block.assign(bin=which, offset=at, fill=fill)

    return place


def sequences(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 1024,
    vocabulary: str = "byte_bpe_50k.json", end_id: int = 2,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A NULL or empty text is the end id alone. Repeated rows and ids are packed like others,
    each row on its own; a NULL id stays NULL. Other columns are not read; an empty table gives
    an empty result. Memory is bounded by a chunk of texts and by a block of pieces; which
    block a piece goes to depends on its place in the written table, so copies spread.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    pieces = stage(rows.mapInArrow(_pieces(capacity, vocabulary, end_id), PIECES), "pieces")
    number = F.monotonically_increasing_id()
    whole = pieces.where(F.col("length") == capacity).select(
        "*", (-1 - number).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    part = pieces.where(F.col("length") < capacity)
    blocks = 1 + part.count() // BLOCK_PIECES

    def packed(some: DataFrame, n: int, name: str) -> DataFrame:
        dealt = some.withColumn("block", F.pmod(F.xxhash64(number), F.lit(n)).cast("long"))
        return stage(dealt.groupBy("block").applyInPandas(_pack_block(capacity), PLACED), name)

    once = packed(part, blocks, "packed")
    if blocks == 1:
        done = _numbered(once, 0)
    else:
        finished = F.col("fill") >= int(capacity * FULL_ENOUGH)
        rest = once.where(~finished).drop("block", "bin", "offset", "fill")
        fewer = 1 + rest.count() // BLOCK_PIECES
        done = _numbered(once.where(finished), 0).unionByName(
            _numbered(packed(rest, fewer, "packed"), blocks)
        )
    return whole.unionByName(done)


def _numbered(placed: DataFrame, first_block: int) -> DataFrame:
    sequence = (F.col("block") + first_block) * (1 << 24) + F.col("bin")
    return placed.withColumn("sequence_id", sequence).drop("block", "bin", "fill")
