"""Places of regular-expression matches, in DataFrame functions only.

Spark gives the matches of a pattern and the pieces between them; running sums of their
lengths are the places. Sums are built in blocks, so a text with very many matches costs little
more per match than one with few.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 256
CONTEXT = 24
MATCH = "array<struct<start:bigint,end:bigint,found:string,left:string,right:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x["gap"] + x["size"])


def _running(block: Column, start: Column) -> Column:
    """The block's matches with their places, given where the block begins."""
    empty = F.array().cast(MATCH)
    state = F.struct(start.alias("at"), empty.alias("out"))

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + x["gap"]
        placed = F.struct(
            begin.alias("start"), (begin + x["size"]).alias("end"), x["found"].alias("found"),
            x["left"].alias("left"), x["right"].alias("right"),
        )
        return F.struct(
            (begin + x["size"]).alias("at"), F.concat(s["out"], F.array(placed)).alias("out")
        )

    return F.aggregate(block, state, step, lambda s: s["out"])


def _placed(found: Column, between: Column) -> Column:
    count = F.size(found)
    sizes = F.transform(found, lambda m, i: F.struct(
        F.length(F.get(between, i)).cast("long").alias("gap"),
        F.length(m).cast("long").alias("size"),
        m.alias("found"),
        F.substring(F.get(between, i), -CONTEXT, CONTEXT).alias("left"),
        F.substring(F.get(between, i + 1), 1, 1).alias("right"),
    ))

    def of_blocks(blocks: Column) -> Column:
        starts = F.aggregate(
            blocks, F.array(F.lit(0).cast("long")),
            lambda sums, b: F.concat(sums, F.array(F.element_at(sums, -1) + _sum(b))),
        )
        return F.flatten(F.zip_with(
            blocks, F.slice(starts, 1, F.size(blocks)), lambda b, at: _running(b, at)
        ))

    cut = F.sequence(F.lit(0), F.floor((count - 1) / BLOCK).cast("int"))
    return let(sizes, lambda s: let(
        F.transform(cut, lambda b: F.slice(s, b * BLOCK + 1, F.lit(BLOCK))), of_blocks
    ))


def matches(text: Column, pattern: str, only_if: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of a pattern that never matches the empty text.

    struct<start, end, found, left, right>: code points, end exclusive; the text found; up to
    CONTEXT characters before it that no earlier match holds; the character after it. ``only_if``
    is a cheap test that holds for every text with a match.
    """
    none = F.array().cast(MATCH)
    test = text.rlike(pattern) if only_if is None else only_if & text.rlike(pattern)
    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
        F.split(text, pattern, -1).alias("between"),
    )
    return F.when(test, let(both, lambda x: _placed(x["found"], x["between"]))).otherwise(none)


def named(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
    ))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Does a text of digits pass the check-digit rule?"""
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0
