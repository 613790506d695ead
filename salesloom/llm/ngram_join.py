"""Exact Jaccard join of word-shingle sets by PartEnum signatures (operator 2).

Two sets of sizes a and b with similarity at least num/den differ in at most
(a + b) (den - num) / (den + num) elements. Sets are dealt into bands of near-equal size. For
each band the domain of shingles is partitioned by a hash into more parts than a pair of that
band may have differences, so similar sets agree on whole parts; a signature is the content
of an enumerated subset of parts (two parts where few differences are allowed, one where
many are: the number of signatures then stays linear in the size). Similar sets always share
a signature; an exact comparison of the sets follows.

Which single parts a set needs, for at most d differences:
- its d + 1 non-empty parts whose contents the fewest classes hold. The rarest part on which two
  sets agree has at most d rarer ones in either, as each of those holds a difference. So the
  other parts are spared, and these are the ones that hold nothing but a common passage;
- if it has no d + 1 non-empty parts, all parts, empty ones too. If both sets are such, they
  still agree on some part. If one is not, the argument above holds for it.

Equal sets are one class before any comparison. In a group of classes that share a signature
only star pairs with one hub are compared, the class with the most shared signatures, so a
group of n near copies costs about n comparisons.

Classes that share a signature but are not connected by then are signed again with the finest
partition, one shingle per part, in the order of rarity among them: similar sets agree on one of
the few rarest shingles of each (how few depends on both sizes, so finer size bands are
used), and a common passage is never among these unless it is nearly all of a text. Groups of
that partition are compared pair by pair, as far as ranks allow a pair to be similar; large
ones in stars first, whose hubs leave their groups. No link between different components is
lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, Window

from salesloom.llm import hubs
from salesloom.llm.common import Remembered, binaries, in_chunks, lean, mix64, stage, unstage
from salesloom.llm.components import components

CHUNK_BYTES = 1_000_000
# Groups by rare shingles of up to so many members are compared pair by pair, where their ranks
# allow it; larger ones first in so many rounds of stars.
PAIRED, STAR_ROUNDS = 4096, 4
# Candidate ids are dealt into this many buckets for the filter that precedes the shuffle of
# texts; a table of all buckets is the largest thing that is ever broadcast.
FILTER_BUCKETS = 1 << 20

_word_hashes = Remembered(xxhash.xxh64_intdigest, 1 << 18)


def _multipliers(n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text."""
    split = [t.lower().split() for t in texts]  # bytes: ASCII letters and blanks only
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    hashes = np.fromiter(
        (h for own in split for h in map(_word_hashes.__getitem__, own)), np.uint64, lengths.sum()
    )
    by = _multipliers(words)
    n = max(len(hashes) - words + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for j in range(words):
        rolled += hashes[j : j + n] * by[j]
    rolled = mix64(rolled)
    sets, at = [], 0
    for length in lengths.tolist():
        if length >= words:
            sets.append(np.unique(rolled[at : at + length - words + 1]))
        elif length:  # the whole sequence; its length keeps it apart from other shingles
            parts = np.concatenate([hashes[at : at + length] * by[:length], by[words:] * np.uint64(length)])
            sets.append(mix64(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += length
    return sets


class Bands:
    """Size bands for a threshold num/den, and the parts each deals its shingles into."""

    RATIO_NUM, RATIO_DEN = 3, 2
    FEW = 4  # up to so many differences, subsets of two parts are enumerated

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        top = 1
        while self.differences(2 * (top + 1)) == 0:
            top += 1
        self.tops = [top]

    def differences(self, sizes: int) -> int:
        return sizes * (self.den - self.num) // (self.den + self.num)

    def of(self, size: int) -> Iterator[tuple[int, int, int]]:
        """(band, most differences of any pair in the band, most for this set), for the
        set's own band and those above in which it may have larger partners."""
        largest = size * self.den // self.num
        while self.tops[-1] < largest:
            self.tops.append(max(self.tops[-1] + 1, self.tops[-1] * self.RATIO_NUM // self.RATIO_DEN))
        band = int(np.searchsorted(self.tops, size))
        while True:
            partner = min(self.tops[band], largest)
            yield band, self.differences(2 * self.tops[band]), self.differences(size + partner)
            if self.tops[band] >= largest:
                break
            band += 1


def signatures(shingles: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """The set's signatures in all its bands; for each its band and how many of the band's
    signatures are spared, as band * 2 ** 32 + spared."""
    found, tags = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for band, most, own in bands.of(len(shingles)):
        if most == 0:
            continue  # only equal sets can be partners, and they are one class already
        few = most <= bands.FEW
        parts = most + 2 if few else most + most // 8 + 2
        seed = mix64(np.array([band + 1], np.uint64))[0]
        value = mix64(shingles ^ seed)
        part = ((value >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        value = mix64(value)
        filled = np.bincount(part, minlength=parts)
        # Order-free content of each part; sums of 32-bit halves are exact in doubles.
        low = np.bincount(part, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), parts)
        high = np.bincount(part, (value >> np.uint64(32)).astype(np.float64), parts)
        place = np.arange(1, parts + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        content = mix64(
            low.astype(np.uint64) + (high.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
            + place + seed
        )
        spared = np.count_nonzero(filled) - own - 1
        strong = spared >= 0
        if few:
            spared = 0
            one, two = np.triu_indices(parts, 1)
            if strong:
                held = (filled[one] + filled[two]) > 0
                one, two = one[held], two[held]
            content = mix64(content[one] + content[two] * np.uint64(0xE7037ED1A0B428DB))
        elif strong:
            content = content[np.flatnonzero(filled)]
        found.append(content)
        tags.append(np.full(len(content), (band << 32) + max(spared, 0)))
    return np.concatenate(found), np.concatenate(tags)


def _halves(digests: list[bytes]) -> np.ndarray:
    """Digests of 128 bits as two numbers each: the first is the key of a class, the second tells
    whether two classes share one."""
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def _described(words: int, num: int, den: int):
    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        seen: set[bytes] = set()  # a class emits its signatures once per task
        for chunk in in_chunks(batches, "text", CHUNK_BYTES):
            sizes, digests, signed, tagged = [], [], [], []
            for own in shingle_sets(binaries(chunk.column("text")), words):
                digest = xxhash.xxh128_digest(own.tobytes())
                sizes.append(len(own))
                digests.append(digest)
                if len(own) and digest not in seen:
                    seen.add(digest)
                    found, tags = signatures(own, bands)
                    signed.append(found.view(np.int64))
                    tagged.append(tags)
                else:
                    signed.append(None)
                    tagged.append(None)
            halves = _halves(digests)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id"), chunk.column("at"), pa.array(sizes, pa.int64()),
                    pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                    pa.array(signed, pa.list_(pa.int64())), pa.array(tagged, pa.list_(pa.int64())),
                ],
                ["doc_id", "at", "n_shingles", "key", "twin", "signatures", "tags"],
            )

    return lambda batches: lean(described(batches))


def _sets_of(words: int):
    """The sets of texts that belong to the class they were read for."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "text", CHUNK_BYTES):
            sets = [s.tobytes() for s in shingle_sets(binaries(chunk.column("text")), words)]
            keys = _halves([xxhash.xxh128_digest(s) for s in sets])[:, 0]
            own = keys == chunk.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [chunk.column("key"), pa.array(sets, pa.binary())], ["key", "shingles"]
            ).filter(pa.array(own, pa.bool_()))

    return lambda batches: lean(read(batches))


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (member u, hub v) whose sets are similar enough."""
    payloads = sets.select("key", F.col("shingles").alias("payload"))
    dealt = stage(hubs.dealt(stage(pairs, "pairs")), "pairs")  # read more than once
    return hubs.accepted(dealt, payloads, hubs.similar(num, den)).select("u", "v")


def _shared(described: DataFrame) -> DataFrame:
    """(signature, key, size, weight) of signatures that two classes share and neither spares;
    weight is how many of them a class has."""
    alike = Window.partitionBy("signature")
    rows = described.where(F.col("signatures").isNotNull()).select(
        "key", F.col("n_shingles").alias("size"), F.inline(F.arrays_zip("signatures", "tags"))
    ).select(F.col("signatures").alias("signature"), "key", "size", F.col("tags").alias("tag"))
    shared = rows.select(
        "*", F.count(F.lit(1)).over(alike).alias("holders"),
        F.min("key").over(alike).alias("least"), F.max("key").over(alike).alias("most"),
    ).where("least <> most").select("signature", "key", "size", "tag", "holders").distinct()
    commonest = Window.partitionBy("key", "tag").orderBy(
        F.col("holders").desc(), F.col("signature").desc()
    )
    spared = F.col("tag").bitwiseAND((1 << 32) - 1)
    # Both windows are taken over one shuffle.
    return shared.repartition("key").withColumn("nth", F.row_number().over(commonest)).where(
        F.col("nth") > spared
    ).select(
        "signature", "key", "size", F.count(F.lit(1)).over(Window.partitionBy("key")).alias("weight")
    )


def _at(doc_id: str, text: str) -> Column:
    """A hash of the row's id and text, by which the row is found again; the id can be NULL."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
    words: int = 5, num: int = 80, den: int = 100,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every input row.

    Two rows are linked when the Jaccard similarity of their sets of ``words``-word shingles
    is at least ``num / den``; component_id is the smallest id reachable by links. A text of
    fewer words is one shingle; NULL, empty and blank texts have none, are linked with nothing
    and keep their own id. Equal sets are linked whatever their ids; repeated rows give
    repeated results, a NULL id can be a member but never names a component unless the
    component holds nothing else. Other columns are not read.
    """
    return _grouped(documents, doc_id, text, words, num, den).select(
        "doc_id", "n_shingles", "component_id"
    )


def _grouped(
    documents: DataFrame, doc_id: str, text: str, words: int, num: int, den: int
) -> DataFrame:
    """The rows of ``near_duplicates`` with the hash of each row (at) and the class that stands
    for its component (root), which tells components of one id, or of none, apart."""
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).withColumn("at", _at("doc_id", "text"))
    signed = stage(rows.mapInArrow(
        _described(words, num, den),
        "doc_id long, at long, n_shingles long, key long, twin long, signatures array<bigint>, tags array<bigint>",
    ), "shingles")
    described = stage(signed.select("doc_id", "at", "n_shingles", "key", "twin"), "digests")
    members = stage(_shared(signed), "shared")
    unstage(signed)  # by far the largest table, and read for the last time
    filled = described.where("n_shingles > 0")
    classes = filled.groupBy("key").agg(F.min("at").alias("at"))

    edges = None
    roots = None
    if members.take(1):
        candidates = members.select("key").distinct()
        source = stage(classes.join(candidates, "key"), "candidates")
        sets = stage(_candidate_sets(rows, described, source, words), "sets")
        edges, roots = _links(members, sets, num, den)

    labelled = _named(filled)
    if roots is not None:
        labels = labelled.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
        labels = labels.withColumn("root", F.coalesce("root", "key"))
        smallest = labels.groupBy("root").agg(F.min("least").alias("component_id"))
        labelled = labels.join(smallest, "root").select("key", "root", "component_id")
    else:
        labelled = labelled.select(
            "key", F.col("key").alias("root"), F.col("least").alias("component_id")
        )
    return described.join(labelled, "key", "left").select(
        "doc_id", "at", "n_shingles", "root",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"),
    )


def _named(filled: DataFrame) -> DataFrame:
    """(key, least): the smallest id of each class. Two classes of one key, which 64 bits leave
    possible, raise rather than being taken for one."""
    one = F.min("twin") == F.max("twin")
    error = F.raise_error(F.lit("two sets of shingles share a key"))
    return filled.groupBy("key").agg(F.when(one, F.min("doc_id")).otherwise(error).alias("least"))


def _candidate_sets(
    rows: DataFrame, described: DataFrame, source: DataFrame, words: int
) -> DataFrame:
    """The shingles of the classes in ``source``, read again from one text of each.

    A text is found by the hash of its row, so a class needs no id. Only texts whose hash falls
    into a bucket of some candidate are shuffled. The bucket table has at most FILTER_BUCKETS
    rows whatever the input, so it can be broadcast.
    """
    bucket = F.pmod("at", F.lit(FILTER_BUCKETS)).alias("bucket")
    buckets = source.select(bucket).distinct()
    near = rows.select("*", bucket).join(F.broadcast(buckets), "bucket", "left_semi")
    repeated = bool(described.groupBy("at").count().where("count > 1").take(1))
    if repeated:  # one of equal rows, before they meet by their hash
        near = near.select("doc_id", "text", "at").distinct()
    texts = near.join(source, "at").select("key", "text")
    # Rows of one hash can bring a text of another class: dropped there.
    found = texts.mapInArrow(_sets_of(words), "key long, shingles binary")
    if repeated:  # else each class is read once
        return found.groupBy("key").agg(F.first("shingles").alias("shingles"))
    return found


GROUP = ["signature", "band"]


def _open(groups: DataFrame, roots: DataFrame) -> DataFrame:
    """Groups in which two components meet, one of them at home in the group's size band; a
    member's own key is its root if it has no link."""
    placed = groups.drop("root").join(
        roots.select(F.col("node").alias("key"), "root"), "key", "left"
    ).withColumn("root", F.coalesce("root", "key"))
    group = Window.partitionBy(*GROUP)
    return placed.select(
        "*", F.min("root").over(group).alias("low"), F.max("root").over(group).alias("high"),
        F.max("home").over(group).alias("settled"),
    ).where("low <> high and settled").select(*placed.columns)


def _fit(one: str, other: str, num: int, den: int) -> Column:
    """Can two sets with this shared shingle be similar, by sizes and by its ranks?"""
    a, b = F.col(f"{one}.size"), F.col(f"{other}.size")
    shared = F.ceil((a + b) * num / (num + den))
    return (
        (F.least(a, b) * den >= F.greatest(a, b) * num) & (F.col(f"{one}.home") | F.col(f"{other}.home"))
        & (F.col(f"{one}.rank") <= a - shared + 1) & (F.col(f"{other}.rank") <= b - shared + 1)
    )


def _stars(groups: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of each group's hub with the members it may be similar to, and what remains of the
    groups when the hubs have left: no group of two, whose pair has been taken.

    ``groups`` can bring the ``weight`` of each class, the number of its groups.
    """
    weighed = groups
    if "weight" not in groups.columns:
        weighed = groups.withColumn("weight", F.count(F.lit(1)).over(Window.partitionBy("key")))
    group = Window.partitionBy(*GROUP)
    rays = stage(weighed.select(
        "*", F.max(F.struct("home", "weight", "key", "size", "rank", "root")).over(group).alias("hub"),
        F.count(F.lit(1)).over(group).alias("held"),
    ).where("key <> hub.key").drop("weight"), "stars")  # read for the pairs and for the rest
    pairs = rays.alias("x").where("root <> hub.root").where(_fit("x", "hub", num, den)).select(
        F.col("key").alias("u"), F.col("hub.key").alias("v")
    ).distinct()
    return pairs, rays.where("held > 2").drop("hub", "held")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(s.as_buffer(), np.int64) for s in batch.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        for first in range(0, len(sets), 64):
            some = slice(first, first + 64)
            which = np.repeat(np.arange(len(sets))[some], sizes[some])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(sets[some])), batch.column("key").take(pa.array(which)),
                    pa.array(np.repeat(sizes[some], sizes[some])),
                ],
                ["signature", "key", "size"],
            )


# Ratio of the size bands of the finest partition.
FINE = 1.03


def _rarest(open_: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Groups by single shingles and size band.

    Two sets with an overlap of i have a shared shingle among the size - i + 1 rarest of each. A
    set is a member of its own band and visits each lower one in which it may have a partner,
    with as many shingles as the smallest partner of that band asks for.
    """
    rows = sets.join(open_, "key").mapInArrow(
        _exploded, "signature long, key long, size long"
    ).withColumn("holders", F.count(F.lit(1)).over(Window.partitionBy("signature")))
    # Shingles that one set holds are the rarest: their number is known without them.
    shared = rows.where("holders > 1")
    size, own = F.col("size"), Window.partitionBy("key")
    alone = size - F.count(F.lit(1)).over(own)
    rank = alone + F.row_number().over(own.orderBy("holders", "signature"))
    smallest = F.ceil(size * num / den)

    def band(n: Column) -> Column:
        return F.floor(F.log(n.cast("double")) / F.log(F.lit(FINE)) + 1e-9)

    partner = F.greatest(F.floor(F.pow(F.lit(FINE), F.col("band")) - 1e-6), smallest)
    overlap = F.ceil((size + partner) * num / (num + den))
    return shared.withColumn("rank", rank.cast("long")).where(
        F.col("rank") <= size - smallest + 1
    ).select(
        "signature", "key", "size", "rank", F.explode(F.sequence(band(smallest), band(size))).alias("band")
    ).where(F.col("rank") <= size - overlap + 1).withColumn("home", F.col("band") == band(size))


def _links(members: DataFrame, sets: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Edges that connect all that similar pairs connect, and the components they make."""
    pairs, rest = _stars(members.withColumns({
        "root": F.col("key"), "band": F.lit(0).cast("long"), "rank": F.lit(0).cast("long"),
        "home": F.lit(True),
    }), num, den)
    unstage(members)  # the stars hold what is left of them
    edges = stage(_linked(pairs, sets, num, den), "links")
    roots = components(edges)
    open_ = stage(_open(rest, roots).select("key").distinct(), "open")
    unstage(rest)
    if not open_.take(1):
        return edges, roots
    groups = stage(_open(_rarest(open_, sets, num, den), roots), "rarest")
    for step in range(STAR_ROUNDS + 1):
        if not groups.take(1):
            break
        large = groups.groupBy(*GROUP).count().where(F.col("count") > PAIRED)
        rest = None
        if step < STAR_ROUNDS and large.take(1):
            pairs, rest = _stars(groups, num, den)
        else:  # exact: every open pair of different components
            a, b = groups.alias("a"), groups.alias("b")
            pairs = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in GROUP] + [
                F.col("a.key") > F.col("b.key"), F.col("a.root") != F.col("b.root"),
                _fit("a", "b", num, den),
            ]).select(F.col("a.key").alias("u"), F.col("b.key").alias("v")).distinct()
        new = stage(_linked(pairs, sets, num, den), "links")
        if new.take(1):
            edges = edges.union(new)
            roots = components(edges)
        if rest is None:
            break
        groups = stage(_open(rest, roots), "rarest")
    return edges, roots


def first_of_groups(documents: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``documents`` with one row of each group of near duplicates, one with the smallest id.

    Rows without words are no duplicates of anything and stay. Rows that repeat an id, or have
    none, are told apart by their text: a group keeps one of those with its smallest id; equal
    rows are one row.
    """
    groups = _grouped(documents, "doc_id", "text", words, num, den)
    alone = F.when(F.col("n_shingles") == 0, F.col("at"))  # no words: a group of its own
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(
        "root", "doc_id", alone.alias("alone")
    ).agg(F.min("at").alias("_at"), F.count(F.lit(1)).alias("_rows"))
    kept = kept.select(F.col("doc_id").alias("_kept"), "_at", "_rows")
    chosen = documents.withColumn("_row", _at("doc_id", "text")).join(
        kept, (F.col("_row") == F.col("_at")) & F.col("doc_id").eqNullSafe(F.col("_kept"))
    )
    once = chosen.where("_rows = 1").select(*documents.columns)
    repeated = chosen.where("_rows > 1").select(*documents.columns).dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)
