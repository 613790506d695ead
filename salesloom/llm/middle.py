"""Fill-in-middle transformation over a compressed set of cut boundaries (operator 12).

The byte offsets at which a text may be cut are a set of integers: 0 and the end of every unit.
The set is held as one container per 65,536 offsets, in whichever form is smallest: a sorted
array, a bitmap, or runs (a text of ASCII letters is a single run per container). Cumulative
cardinalities over the containers find the container of the k-th boundary; the container then
selects within itself. A cut after k units is the k-th element of the set, counted from 0.

Units are code points, or the matches of a pattern; what no match covers belongs to the unit
before it (at the start: to the first).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import binaries, in_chunks, lean

SPAN = 1 << 16
CHUNK_BYTES = 4_000_000
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class Array:
    def __init__(self, mask: np.ndarray):
        self.values = np.flatnonzero(mask).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class Bitmap:
    def __init__(self, mask: np.ndarray):
        self.words = np.packbits(mask, bitorder="little")
        self.counts = np.cumsum(np.bitwise_count(self.words).astype(np.int64))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.counts, k, "right"))
        before = int(self.counts[word - 1]) if word else 0
        bits = np.flatnonzero(np.unpackbits(self.words[word : word + 1], bitorder="little"))
        return word * 8 + int(bits[k - before])


class Runs:
    def __init__(self, first: np.ndarray, last: np.ndarray):
        self.first = first.astype(np.uint16)
        self.counts = np.cumsum(last - first + 1)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.counts, k, "right"))
        before = int(self.counts[run - 1]) if run else 0
        return int(self.first[run]) + k - before


def container(mask: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest form for the offsets set in ``mask``: 2 bytes an element, 8 KiB, or 4 bytes
    a run."""
    edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
    first, last = edges[::2], edges[1::2] - 1
    size = {Runs: 4 * len(first), Array: 2 * int(np.count_nonzero(mask)), Bitmap: SPAN // 8}
    form = min(size, key=size.__getitem__)
    return Runs(first, last) if form is Runs else form(mask)


class Boundaries:
    """A set of offsets that answers ``select``; ``mask`` tells for each offset if it is in it."""

    def __init__(self, mask: np.ndarray):
        pieces = [(at, mask[at : at + SPAN]) for at in range(0, len(mask), SPAN)]
        filled = [(at, piece) for at, piece in pieces if piece.any()]
        self.base = [at for at, _ in filled]
        self.containers = [container(piece) for _, piece in filled]
        self.cumulative = np.cumsum([np.count_nonzero(piece) for _, piece in filled])

    def __len__(self) -> int:
        return int(self.cumulative[-1])

    def select(self, k: int) -> int:
        """The k-th smallest offset, from 0."""
        at = int(np.searchsorted(self.cumulative, k, "right"))
        before = int(self.cumulative[at - 1]) if at else 0
        return self.base[at] + self.containers[at].select(k - before)


def boundaries(text: bytes, unit: regex.Pattern | None = None) -> Boundaries:
    """Where the UTF-8 text may be cut: 0 and the end of each unit."""
    mask = np.zeros(len(text) + 1, bool)
    if unit is None:
        # A code point ends where the next byte does not continue it.
        mask[:-1] = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
        mask[-1] = True
    else:
        mask[[m.start() for m in unit.finditer(text)]] = True
        mask[0] = mask[-1] = True
    return Boundaries(mask)


def _cut(unit: str | None):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = unit and regex.compile(unit.encode(), regex.V1)
        begin, break_, join = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
        for chunk in in_chunks(batches, "text", CHUNK_BYTES):
            draws = zip(*[chunk.column(f"h{i}").to_pylist() for i in (1, 2)])
            forms = chunk.column("form").to_pylist()
            sizes, shown, prefixes, middles, outputs = [], [], [], [], []
            for text, form, (h1, h2) in zip(binaries(chunk.column("text")), forms, draws):
                cuts = boundaries(text, pattern)
                n = len(cuts) - 1
                form = form if n else "plain"
                sizes.append(n)
                shown.append(form)
                if form == "plain":
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(text)
                    continue
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                a, b = cuts.select(low), cuts.select(high)
                prefix, middle, suffix = text[:a], text[a:b], text[b:]
                prefixes.append(low)
                middles.append(high - low)
                outputs.append(
                    begin + prefix + break_ + suffix + join + middle if form == "psm"
                    else break_ + suffix + begin + prefix + join + middle
                )
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(shown, pa.string()),
                    pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()),
                    # The bytes are those of the text, so they need no second check.
                    pa.array(outputs, pa.binary()).view(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_units", "middle_units", "output"],
            )

    return lambda batches: lean(cut(batches))


def draw(number: int) -> Column:
    """The ``number``-th 8-digit group of a row's hex digest, as an unsigned integer."""
    group = F.substring("_digest", 8 * number - 7, 8)
    return F.conv(group, 16, 10).cast("long")


def transform(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1",
    transformed: int = 90, spm: int = 20, unit: str | None = None,
) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, output) for every input row.

    Cuts and form follow from sha256 of ``seed:doc_id``, so every run gives the same rows: of 100
    texts about ``transformed`` are rearranged, about ``spm`` of these suffix first. ``unit`` is
    a pattern, default code points. A NULL text is empty; a NULL id is hashed as no digits. Empty texts
    and texts that hold a marker stay ``plain``, with NULL counts. Repeated rows give
    repeated results; other columns are not read; an empty table gives an empty result. A text
    is cut within its row, whatever its length, and no row is shuffled.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    form = F.when(marked | (draw(3) % 100 >= transformed), "plain").when(
        draw(4) % 100 < spm, "spm"
    ).otherwise("psm")
    drawn = rows.withColumn("_digest", F.sha2(key.cast("binary"), 256)).select(
        "doc_id", "text", form.alias("form"), draw(1).alias("h1"), draw(2).alias("h2")
    )
    return drawn.mapInArrow(
        _cut(unit),
        "doc_id long, n long, form string, prefix_units long, middle_units long, output string",
    )


def restore(output: Column, form: Column) -> Column:
    """The exact text behind an output.

    A rearranged text holds no marker, and markers cannot arise where pieces meet, as each
    starts with the only '<' it has; so every marker is found where it was written.
    """
    def before(text: Column, marker: str) -> Column:
        return F.substring_index(text, marker, 1)

    def after(text: Column, marker: str) -> Column:
        return F.substr(text, F.length(before(text, marker)) + len(marker) + 1)

    middle = after(output, MIDDLE)
    head = before(output, MIDDLE)
    psm = F.concat(before(after(head, PREFIX), SUFFIX), middle, after(head, SUFFIX))
    spm = F.concat(after(head, PREFIX), middle, before(after(head, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(transformed: DataFrame) -> DataFrame:
    """Digests of outputs and of the texts rebuilt from them."""
    def digest(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    return transformed.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"),
        digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
