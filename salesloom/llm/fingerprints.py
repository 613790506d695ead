"""Fingerprints of texts from content-defined chunks (operator 7).

A gear hash rolls over the UTF-8 bytes of a text; a chunk may end where enough of its leading
bits are zero. Boundaries are normalised: before the usual size more zero bits are asked for than
behind it, and there is a least and a greatest size, so sizes gather around the usual one. A
boundary depends on the WINDOW bytes before it only, so an edit moves the boundaries near it and
no others. The fingerprint lists each distinct chunk once, as digest and length; likeness is the
length of the chunks two fingerprints share over the length of the smaller set (containment).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from salesloom.llm.common import in_chunks, lean, mix64

WINDOW = 32
LEAST, USUAL, GREATEST = 8, 32, 255
STRICT_BITS, LOOSE_BITS = 6, 4
CHUNK_BYTES = 4_000_000
# Documents in one stretch of the order of ids, and the most stretches.
STRETCH = 1024
STRETCHES = 10_000

# 0xFF occurs in no UTF-8 text: it parts texts and adds nothing to the hash.
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_GEAR[255] = 0


def _rolled(data: np.ndarray) -> np.ndarray:
    """The gear hash at every byte: sum of gear values, each shifted by its distance."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def chunk_ends(candidates: list[int], strict: list[bool], size: int) -> list[int]:
    """Ends of chunks, given the places (end exclusive) where the hash allows one."""
    ends, start = [], 0
    for end, sure in zip(candidates, strict):
        while end - start > GREATEST:
            start += GREATEST
            ends.append(start)
        length = end - start
        if length >= LEAST and (sure or length >= USUAL):
            ends.append(end)
            start = end
    while size - start > GREATEST:
        start += GREATEST
        ends.append(start)
    if size > start:
        ends.append(size)
    return ends


def fingerprints(texts: list[bytes]) -> list[str]:
    """One text's distinct chunks, in order: eight hex digits of digest, two of length."""
    pad = b"\xff" * WINDOW
    data = np.frombuffer(pad.join(texts) + pad, np.uint8)
    h = _rolled(data)
    loose = np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = h[loose] >> np.uint32(32 - STRICT_BITS) == 0
    found, at = [], 0
    lengths = [len(t) for t in texts]
    starts = np.cumsum([0] + [n + WINDOW for n in lengths[:-1]])
    low = np.searchsorted(loose, starts)
    high = np.searchsorted(loose, starts + np.array(lengths))
    for k, text in enumerate(texts):
        own = slice(low[k], high[k])
        places = (loose[own] - starts[k] + 1).tolist()
        chunks, at = {}, 0
        for end in chunk_ends(places, strict[own].tolist(), lengths[k]):
            piece = text[at:end]
            chunks[xxhash.xxh3_64_intdigest(piece) & 0xFFFFFFFF] = end - at
            at = end
        found.append("".join([f"{digest:08x}{size:02x}" for digest, size in chunks.items()]))
    return found


def likeness(one: str, other: str) -> float:
    """Shared length over the smaller length; 1 for equal fingerprints, empty ones too."""
    if one == other:
        return 1.0
    a = {one[i : i + 10] for i in range(0, len(one), 10)}
    b = {other[i : i + 10] for i in range(0, len(other), 10)}
    if not a or not b:
        return 0.0

    def weight(chunks: set[str]) -> int:
        return sum(int(c[8:], 16) for c in chunks)

    return weight(a & b) / min(weight(a), weight(b))


def fingerprint(documents: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``documents`` with the fingerprint of each text; a NULL text is empty. An input column
    of that name is replaced."""
    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        out: list[str] = []
        part, size = [], 0
        for t in texts.fillna(""):
            raw = t.encode()
            if part and size + len(raw) > CHUNK_BYTES:
                out += fingerprints(part)
                part, size = [], 0
            part.append(raw)
            size += len(raw)
        return pd.Series(out + fingerprints(part) if part else out, dtype="object")

    return documents.withColumn(name, of(F.col(text).cast("string")))


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; each is paired with the row behind it in its stretch."""
    last: tuple | None = None  # stretch, doc_id, text, fingerprint
    for chunk in in_chunks(batches, "text", CHUNK_BYTES):
        texts = [t or "" for t in chunk.column("text").to_pylist()]
        own = fingerprints([t.encode() for t in texts])
        rows = list(zip(
            chunk.column("stretch").to_pylist(), chunk.column("extra").to_pylist(),
            chunk.column("doc_id").to_pylist(), texts, own,
        ))
        out, edited = [], []
        for stretch, extra, doc, text, mark in rows:
            if last is not None and last[0] == stretch:
                n = len(last[2])
                edited.append((last[2][: n - n // 2] + text[: n // 2]).encode())
                out.append((last[1], n, last[3], likeness(last[3], mark)))
            last = None if extra else (stretch, doc, text, mark)
        marks = fingerprints(edited) if edited else []
        yield pa.RecordBatch.from_pydict({
            "doc_id": pa.array([r[0] for r in out], pa.int64()),
            "n_chars": pa.array([r[1] for r in out], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
            "fingerprint": pa.array([r[2] for r in out], pa.string()),
            "edited_fingerprint": pa.array(marks, pa.string()),
            "near_edited": pa.array([likeness(r[2], m) for r, m in zip(out, marks)], pa.float64()),
            "near_next": pa.array([r[3] for r in out], pa.float64()),
        })


def compare_with_next(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    Next is by descending id, and after the last comes the first; a single row is its own next.
    The edited text ends, in its last half of code points, with the beginning of the next text.
    Rows of one id come in the order of a hash of their text; NULL ids come last, as one id. A
    NULL text is empty. Other columns are not read.

    Ids are cut into stretches at quantiles (at most STRETCHES numbers reach the driver). The
    first row of a stretch is also sent to the end of the stretch before it, so each stretch is
    read in order on its own, one row ahead, and texts are shuffled once.
    """
    smallest = -(1 << 63)
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(smallest)).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    keys = rows.select("key")
    n = min(STRETCHES, 1 + keys.count() // STRETCH)
    cuts: list[int] = []
    if n > 1:
        at = [k / n for k in range(1, n)]
        cuts = sorted(set(keys.agg(F.percentile_approx("key", at, 10 * n)).first()[0]))
    bounds = np.array(cuts, np.int64)

    @F.pandas_udf("long")
    def stretch(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.int64), side="left"))

    firsts = sorted(
        tuple(r) for r in keys.withColumn("stretch", stretch("key")).groupBy("stretch").agg(
            F.max("key").alias("first")
        ).select("stretch", "first").collect()
    )
    heads = np.array([key for _, key in firsts], np.int64)
    # In descending order the first row of a stretch follows the last of the one above it.
    goes_to = np.array([s for s, _ in firsts[1:] + firsts[:1]], np.int64)

    @F.pandas_udf("array<long>")
    def places(key: pd.Series) -> pd.Series:
        own = key.to_numpy(np.int64)
        home = np.searchsorted(bounds, own, side="left")
        k = np.minimum(np.searchsorted(heads, own), len(heads) - 1)
        head = heads[k] == own
        return pd.Series([
            [h, goes_to[i]] if first else [h] for h, i, first in zip(home.tolist(), k, head)
        ])

    dealt = rows.select("doc_id", "key", "text", F.posexplode(places("key")).alias("extra", "stretch"))
    ordered = dealt.repartition("stretch").sortWithinPartitions(
        "stretch", F.col("extra"), F.col("key").desc(), F.xxhash64("text")
    )
    return ordered.select(
        "doc_id", "text", "stretch", (F.col("extra") > 0).alias("extra")
    ).mapInArrow(lambda batches: lean(_compare(batches)), COMPARED)
