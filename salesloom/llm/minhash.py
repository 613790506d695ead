"""MinHash near-duplicate detection (operator 11).

A text's set of word shingles is described by ROWS * BANDS minima of universal hash functions
(multiply-shift with odd multipliers). Two sets agree on a minimum with a chance equal to their similarity. Bands
of ROWS minima are hashed; texts with a common band are candidates. At a similarity of 0.85 no band
is shared in 7 of 1e11 pairs. Then three tests, each on what the one before leaves:

1. sizes allow the similarity;
2. the signatures agree on at least as many minima as similar sets do in all but 1e-10 of cases;
3. the full sets, read again from the texts, have the similarity.

Equal sets are one class before any comparison. The members of a band are not paired with each
other but with one hub, the member with the most bands, and the links make components (alternating
large and small stars). Where a band still holds two components, as near copies of one template do
that are not similar enough, its classes are grouped anew by their rarest shingles: two similar
sets share one of the few rarest of each, so a template's own words bring nobody together.
These groups are compared with hubs again, 8, 64 and so on at a time, until no group
holds two components. Nothing is left out on the way: a pair is skipped only if it is connected
already or a bound rules it out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, Window

from salesloom.llm import hubs
from salesloom.llm.common import binaries, in_chunks, lean, mix64, stage, unstage
from salesloom.llm.ngram_join import shingle_sets
from salesloom.llm.stars import components

ROWS, BANDS = 5, 40
MISSED = 1e-10  # share of similar pairs that the test of signatures may lose
CHUNK_BYTES = 1_000_000
AT_ONCE = 256  # shingles hashed in one step
HUBS = 8  # factor by which hubs at a time grow in groups by rare shingles
FILTER_BITS = 27  # the filter of candidate texts has at most 2 ** 27 bits, 16 MB

_seeds = mix64(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES = (_seeds[: ROWS * BANDS] | np.uint64(1))[:, None]
_PLUS = _seeds[ROWS * BANDS :][:, None]


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set, 32 bits each."""
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), AT_ONCE):
        hashed = shingles[None, at : at + AT_ONCE] * _TIMES + _PLUS
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def bands_of(least: np.ndarray) -> np.ndarray:
    """A 64-bit hash per band, different bands apart."""
    return np.array([
        xxhash.xxh64_intdigest(row.tobytes(), seed) for seed, row in enumerate(least.reshape(BANDS, ROWS))
    ], np.uint64)


def least_agreement(num: int, den: int, n: int = ROWS * BANDS, missed: float = MISSED) -> int:
    """The most agreements that all but ``missed`` of pairs with similarity num/den reach."""
    s, below = num / den, 0.0
    for k in range(n + 1):
        below += comb(n, k) * s**k * (1 - s) ** (n - k)
        if below > missed:
            return k
    return n


def _described(words: int):
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # equal sets are signed once per task
        for chunk in in_chunks(batches, "text", CHUNK_BYTES):
            sizes, digests, low, bands = [], [], [], []
            for own in shingle_sets(binaries(chunk.column("text")), words):
                digest = xxhash.xxh128_digest(own.tobytes())
                sizes.append(len(own))
                digests.append(digest)
                if len(own) and digest not in seen:
                    seen.add(digest)
                    least = minima(own)
                    # A byte of each minimum: others agree by chance on one in 256 at most.
                    low.append(least.astype(np.uint8).tobytes())
                    bands.append(bands_of(least).view(np.int64))
                else:
                    low.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"), chunk.column("at"), pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()), pa.array(low, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "at", "n_shingles", "digest", "signature", "bands"],
            )

    return lambda batches: lean(described(batches))


DESCRIBED = "doc_id long, at long, n_shingles long, digest binary, signature binary, bands array<bigint>"


def _agreeing(least: int) -> hubs.Accept:
    def agree(a: bytes, b: bytes) -> bool:
        same = np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)
        return int(np.count_nonzero(same)) >= least

    return agree


# --- the operator -------------------------------------------------------------------


def _at(doc_id: str, text: str) -> Column:
    """A hash of the row's id and text, by which the row is found again; the id can be NULL."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    words: int = 5, num: int = 80, den: int = 100,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every input row.

    Rows are linked when the similarity of their sets of ``words``-word shingles is at least
    ``num / den``; component_id is the smallest id reachable by links, ``kept`` tells if it is the
    row's own. A text of fewer words is one shingle; NULL, empty and blank texts have none, are linked with
    nothing and keep their own id. Equal sets are linked whatever their ids. Repeated rows give repeated
    results, rows that repeat a kept id are all kept; a NULL id can be a member but names a
    component only if that holds nothing else. Other columns are not read; an empty table gives an
    empty result.
    """
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumn("at", _at("doc_id", "text"))
    described = stage(rows.mapInArrow(_described(words), DESCRIBED), "minhash")
    digests = described.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.min("at").alias("at")
    )
    signed = described.where("signature is not null").dropDuplicates(["digest"])
    # One number per class, fixed once written: 8 bytes stand for a digest from here on.
    classes = stage(
        signed.select("digest", F.col("n_shingles").alias("size"), "signature", "bands")
        .withColumn("cls", F.monotonically_increasing_id()), "minhash-classes",
    )
    members = stage(_members(classes), "minhash-bands")
    roots = None
    if members.take(1):
        roots = _roots(members, classes, digests, rows, words, num, den)

    labelled = digests.join(classes.select("digest", "cls"), "digest").select("digest", "cls", "least")
    if roots is not None:
        labels = labelled.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
        labels = labels.withColumn("root", F.coalesce("root", "cls"))
        smallest = labels.groupBy("root").agg(F.min("least").alias("component_id"))
        labelled = labels.join(smallest, "root").select("digest", "component_id")
    else:
        labelled = labelled.select("digest", F.col("least").alias("component_id"))
    own = described.select("doc_id", "n_shingles", "digest")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.join(labelled, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


GROUPS = ["grp", "cls", "size", "rank", "weight", "root"]


def _members(classes: DataFrame) -> DataFrame:
    """The bands that two classes share, as groups whose members are not connected yet."""
    rows = classes.select(F.explode("bands").alias("grp"), "cls", "size")
    shared = rows.groupBy("grp").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where(
        "low < high"
    ).select("grp")
    return _weighed(rows.join(shared, "grp").withColumns({
        "rank": F.lit(0).cast("long"), "root": F.col("cls"),
    }))


def _weighed(groups: DataFrame) -> DataFrame:
    """With the number of groups of each class: the one that has the most makes the best hub."""
    weights = groups.groupBy("cls").agg(F.count(F.lit(1)).alias("weight"))
    return groups.join(weights, "cls").select(*GROUPS)


def _roots(
    members: DataFrame, classes: DataFrame, digests: DataFrame, rows: DataFrame, words: int,
    num: int, den: int,
) -> DataFrame | None:
    """(node, root) of the classes that links connect; None if there are no links."""
    candidates = members.select("cls").distinct()
    signatures = stage(classes.join(candidates, "cls").select(
        "cls", F.col("signature").alias("payload")
    ), "minhash-signatures")
    sources = stage(classes.join(candidates, "cls").select("cls", "digest").join(
        digests, "digest"
    ).select("cls", "digest", "at"), "minhash-sources")
    sets = stage(_sets(rows, sources, words), "minhash-sets")
    sets = sets.withColumnRenamed("cls", "key")
    tests = (
        (signatures.withColumnRenamed("cls", "key"), _agreeing(least_agreement(num, den))),
        (sets, hubs.similar(num, den)),
    )

    def linked(pairs: DataFrame) -> DataFrame | None:
        """The links among the pairs; each test is made where the one before left something."""
        left = stage(hubs.dealt(pairs), "minhash-pairs")
        for payloads, accept in tests:
            if not left.take(1):
                return None
            before, left = left, stage(hubs.accepted(left, payloads, accept), "minhash-pairs")
            unstage(before)
        return left.select("u", "v") if left.take(1) else None

    pairs, rest = _stars(members, 1, num, den)
    edges = linked(pairs)
    roots = None if edges is None else stage(components(edges), "minhash-roots")
    groups = stage(_open(_rooted(rest, roots)), "minhash-open")
    if not groups.take(1):
        return roots
    remaining = groups.select("cls").distinct()
    groups = stage(_open(_rooted(_rarest(remaining, sets, num, den), roots)), "minhash-rarest")
    at_once = HUBS
    while groups.take(1):
        pairs, rest = _stars(groups, at_once, num, den)
        new = linked(pairs)
        if new is not None:
            roots = stage(_connected(roots, new), "minhash-roots")
            rest = _rooted(rest, roots)
        before, groups = groups, stage(_open(rest), "minhash-rarest")
        unstage(before)
        at_once *= HUBS
    return roots


def _rooted(groups: DataFrame, roots: DataFrame | None) -> DataFrame:
    """With the present root of each class; a class without links is its own."""
    if roots is None:
        return groups.select(*GROUPS)
    known = roots.select(F.col("node").alias("cls"), F.col("root").alias("_root"))
    return groups.join(known, "cls", "left").withColumn(
        "root", F.coalesce("_root", "cls")
    ).select(*GROUPS)


def _connected(roots: DataFrame | None, new: DataFrame) -> DataFrame:
    """The roots after more links: only components that these touch are searched again."""
    if roots is None:
        return components(new)
    ends = new
    for end in ("u", "v"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        ends = ends.join(known, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    moved = stage(components(ends.select(F.col("_u").alias("u"), F.col("_v").alias("v"))), "minhash-moved")
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    kept = roots.join(to, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return kept.unionByName(moved.join(roots.select("node"), "node", "left_anti"))


def _open(groups: DataFrame) -> DataFrame:
    """The groups in which two components meet."""
    apart = groups.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low < high"
    ).select("grp")
    return groups.join(apart, "grp", "left_semi").select(*GROUPS)


def _stars(groups: DataFrame, at_once: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (member u, hub v) of each group's hubs with members of other components to which
    sizes and ranks allow a link, and what is left of the groups without the hubs.

    Components are dealt over ``at_once`` slots; the member with the most groups leads its slot. So a
    large component takes one hub's place, and the many small ones it was not linked to the others.
    """
    slot = F.pmod(F.xxhash64("root", F.lit(at_once)), F.lit(at_once)).alias("slot")
    leaders = stage(groups.groupBy("grp", slot).agg(
        F.max(F.struct("weight", "cls", "size", "rank", "root")).alias("hub")
    ).select("grp", "hub.*"), "minhash-hubs")
    h = leaders.select("grp", *[F.col(c).alias(f"h_{c}") for c in ("cls", "size", "rank", "root")])
    a, b = F.col("size"), F.col("h_size")
    shared = F.ceil((a + b) * num / (num + den))
    pairs = groups.join(h, "grp").where(
        (F.col("cls") != F.col("h_cls")) & (F.col("root") != F.col("h_root"))
        & (F.least(a, b) * den >= F.greatest(a, b) * num)
        & (F.col("rank") <= a - shared + 1) & (F.col("h_rank") <= b - shared + 1)
    ).select(F.col("cls").alias("u"), F.col("h_cls").alias("v")).distinct()
    return pairs, groups.join(leaders.select("grp", "cls"), ["grp", "cls"], "left_anti").select(*GROUPS)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column("payload")]
        for first in range(0, len(sets), 64):
            some = sets[first : first + 64]
            sizes = np.array([len(s) for s in some])
            which = pa.array(np.repeat(np.arange(first, first + len(some)), sizes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(some)), batch.column("key").take(which),
                 pa.array(np.repeat(sizes, sizes))],
                ["grp", "cls", "size"],
            )


def _rarest(remaining: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Groups by single shingles: of each set the rarest that a similar set must share one of.

    Sets with an overlap of i share one of the size - i + 1 rarest shingles of each, in any
    common order; here by holders. A shingle without a second holder leads nowhere and only counts.
    """
    rows = sets.join(remaining.withColumnRenamed("cls", "key"), "key", "left_semi").mapInArrow(
        lambda batches: lean(_exploded(batches)), "grp long, cls long, size long"
    )
    # Written, so that the join below shuffles both sides itself and can split a hot shingle.
    held = stage(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("holders")).where(
        "holders > 1"
    ), "minhash-holders")
    own = Window.partitionBy("cls")  # bounded by the length of one text
    size = F.col("size")
    alone = size - F.count(F.lit(1)).over(own)
    rank = alone + F.row_number().over(own.orderBy("holders", "grp"))
    return _weighed(rows.join(held, "grp").withColumn("rank", rank.cast("long")).where(
        F.col("rank") <= size - F.ceil(size * num / den) + 1
    ).select("grp", "cls", "size", "rank", F.col("cls").alias("root")))


def _sets(rows: DataFrame, sources: DataFrame, words: int) -> DataFrame:
    """(cls, payload): the sorted shingles of each class in ``sources``, from one of its texts.

    Texts are found by the hash of their row. A filter of 16 bits per candidate, at most
    2 ** FILTER_BITS in all, keeps other texts out of the shuffle.
    """
    n = sources.count()
    bits = min(max(16 * n - 1, 1).bit_length(), FILTER_BITS)

    def place(at: Column) -> Column:
        return F.pmod(at, F.lit(1 << bits))

    spot = place(F.col("at"))
    marks = sources.groupBy(F.bitmap_bucket_number(spot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bitmap")
    )
    bit = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substr(
        F.col("bitmap"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1)
    )), 16, 10).cast("int")
    near = rows.join(F.broadcast(marks), F.bitmap_bucket_number(spot) == F.col("bucket")).where(
        F.getbit(byte, (bit % 8).cast("int")) == 1
    ).select("at", "text")
    texts = near.join(sources, "at").select("cls", "digest", "text")
    return texts.mapInArrow(_sets_of(words), "cls long, payload binary").groupBy("cls").agg(
        F.first("payload").alias("payload")
    )


def _sets_of(words: int):
    """The sets of texts that belong to the class they were read for, each class once per task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for chunk in in_chunks(batches, "text", CHUNK_BYTES):
            sets = [s.tobytes() for s in shingle_sets(binaries(chunk.column("text")), words)]
            own = []
            for found, cls, digest in zip(sets, *[chunk.column(c).to_pylist() for c in ("cls", "digest")]):
                own.append(cls not in seen and xxhash.xxh128_digest(found) == digest)
                if own[-1]:
                    seen.add(cls)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("cls"), pa.array(sets, pa.binary())], ["cls", "payload"]
            ).filter(pa.array(own, pa.bool_()))

    return lambda batches: lean(read(batches))
