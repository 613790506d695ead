"""Personal data: generators, boosted trees and a calibrated threshold (operator 1).

Plain DataFrame functions throughout. Base rules find emails, addresses, card and phone numbers,
and their findings always stay. High-recall generators propose further, overlapping
spans that the base rules miss: a card number run together with other digits, a phone
number behind which a number follows, written-out emails, identity numbers. Boosted trees
score every proposal by its format and its context, a logistic curve fitted on held-out
texts turns the score into a probability, and proposals above the threshold are added.

Labels are weak: a proposal whose normalised text passes the strict rule of its kind counts as
personal data. Features take few values each, so all proposals of any corpus add up to a
bounded table of (features, label) counts; only that table reaches the driver, where the trees
are fitted, and the trees come back as one CASE expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import text_or_empty
from salesloom.llm.spans import digits, let, luhn, matches, named, written

# Possessive repeats and look-behinds keep each pattern linear on long runs; they accept the
# same leftmost matches as the plain forms.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTETS = r"\A0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])?(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])?){3}\z"

KINDS = ("email", "ip", "card", "phone", "id")


def _card_ok(found: Column) -> Column:
    return let(digits(found), lambda d: F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))


def _phone_ok(found: Column) -> Column:
    return F.length(digits(found)).between(8, 15)


def base_spans(text: Column) -> dict[str, Column]:
    """The accepted base matches of each kind."""
    digit = text.rlike("[0-9]")
    return {
        "email": matches(text, EMAIL, text.contains("@")),
        "ip": F.filter(matches(text, IP, digit), lambda m: m["found"].rlike(OCTETS)),
        "card": F.filter(matches(text, CARD, digit), lambda m: _card_ok(m["found"])),
        "phone": F.filter(matches(text, PHONE, text.contains("+")), lambda m: _phone_ok(m["found"])),
    }


@dataclass(frozen=True)
class Generator:
    """A loose pattern, and the strict rule that labels what it finds."""

    kind: str
    pattern: str
    strict: Callable[[Column], Column]
    only_if: Callable[[Column], Column] = field(default=lambda text: text.rlike("[0-9]"))


def _email_ok(found: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(
        found, r"\x20?[(\[]at[)\]]\x20?", "@"), r"\x20?[(\[]dot[)\]]\x20?", ".")
    return plain.rlike(r"\A[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]++)*\.[A-Za-z]{2,}\z")


GENERATORS = (
    Generator("card", r"(?<![0-9])[0-9]{12,19}+(?![0-9])", _card_ok),
    Generator("card", r"(?<![0-9])[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}(?![0-9])", _card_ok),
    Generator(
        "phone",
        r"(?:\+[0-9]{1,3}[\x20.-]?)?+(?:\([0-9]{3}\)[\x20.-]?|(?<![0-9])[0-9]{3}[\x20.-])"
        r"[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
        lambda found: found.startswith("+") & _phone_ok(found),
    ),
    Generator(
        "phone", r"\+[0-9]{1,3}(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9])", _phone_ok,
        lambda text: text.contains("+"),
    ),
    Generator(
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++"
        r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
        _email_ok,
        lambda text: text.contains("at)") | text.contains("at]"),
    ),
    Generator(
        "id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda found: ~found.rlike("^(?:000|666|9)|-00-|0000$"),
    ),
)

# Words that announce personal data, as a fixed list.
ANNOUNCING = r"(?i)(?:card|visa|tel|phone|call|fax|mail|contact|ssn|social|account|konto|carte|tarjeta)"

FEATURES = ("generator", "digits", "check", "marks", "left", "right", "announced")


def _around(character: Column) -> Column:
    return (
        F.when(character.rlike(r"\A[\x09-\x0D\x20]?\z"), 0)
        .when(character.rlike(r"\A[A-Za-z0-9]\z"), 1).otherwise(2)
    )


def _features(number: int, m: Column) -> dict[str, Column]:
    found, left = m["found"], m["left"]
    count = F.length(digits(found))
    return {
        "generator": F.lit(number),
        "digits": F.when(count > 19, 20).otherwise(count),
        "check": F.when(count.between(12, 19), luhn(digits(found)).cast("int")).otherwise(0),
        "marks": (
            found.contains(" ").cast("int") + 2 * found.rlike("[-.]").cast("int")
            + 4 * found.rlike(r"[(+\[]").cast("int")
        ),
        "left": _around(F.substring(left, -1, 1)),
        "right": _around(m["right"]),
        "announced": left.rlike(ANNOUNCING).cast("int"),
    }


def proposals(text: Column) -> Column:
    """All generators' spans with features and weak label."""
    def described(number: int, generator: Generator) -> Column:
        found = matches(text, generator.pattern, generator.only_if(text))
        return F.transform(found, lambda m: F.struct(
            F.lit(generator.kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            generator.strict(m["found"]).alias("strict"),
            *[value.cast("int").alias(name) for name, value in _features(number, m).items()],
        ))

    return F.concat(*[described(i, g) for i, g in enumerate(GENERATORS)])


@dataclass
class Model:
    """Boosted trees, the logistic curve over their sum, and the least accepted probability."""

    trees: list
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    def probability(self, p: Column) -> Column:
        total = F.lit(0.0)
        for tree in self.trees:
            total = total + _as_case(tree, p)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(total * F.lit(self.slope) + F.lit(self.shift))))


def _as_case(tree, p: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    name, most, low, high = tree
    return F.when(p[name] <= most, _as_case(low, p)).otherwise(_as_case(high, p))


def _grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, rate: float):
    """One regression tree on rows weighted by their second derivatives."""
    def gain(mask: np.ndarray) -> float:
        return float(gradient[mask].sum()) ** 2 / (float(hessian[mask].sum()) + 1.0)

    everything = np.ones(len(x), bool)
    best = (1e-6, None, None)
    if depth:
        for j in range(x.shape[1]):
            for most in np.unique(x[:, j])[:-1].tolist():
                low = x[:, j] <= most
                won = gain(low) + gain(~low) - gain(everything)
                if won > best[0]:
                    best = (won, j, most)
    if best[1] is None:
        return rate * float(gradient.sum()) / (float(hessian.sum()) + 1.0)
    low = x[:, best[1]] <= best[2]
    return (
        FEATURES[best[1]], int(best[2]),
        _grow(x[low], gradient[low], hessian[low], depth - 1, rate),
        _grow(x[~low], gradient[~low], hessian[~low], depth - 1, rate),
    )


def _value(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    name, most, low, high = tree
    return np.where(x[:, FEATURES.index(name)] <= most, _value(low, x), _value(high, x))


def _boost(x, positive, total, rounds: int, depth: int, rate: float) -> list:
    score = np.zeros(len(x))
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, positive - total * p, total * p * (1 - p), depth, rate)
        trees.append(tree)
        score += _value(tree, x)
    return trees


def _calibrate(score, positive, total) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a light prior."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * score + b)))
        g, h = positive - total * p, total * p * (1 - p)
        first = np.array([(g * score).sum() - 0.1 * (a - 1), g.sum() - 0.1 * b])
        second = np.array([
            [(h * score * score).sum() + 0.1, (h * score).sum()], [(h * score).sum(), h.sum() + 0.1]
        ])
        step = np.linalg.solve(second, first)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -1, 1))
        if abs(step).max() < 1e-6:
            break
    return max(a, 0.01), b


def fit(
    documents: DataFrame, text: str = "text", rounds: int = 16, depth: int = 3,
    rate: float = 0.5, precision: float = 0.95,
) -> Model:
    """Trees from four fifths of the texts (by hash), curve and threshold from the others.

    The threshold lies halfway below the least calibrated probability that keeps the expected
    share of right additions at ``precision``, and never under a half. Without proposals, or without right ones, nothing is
    ever added.
    """
    value = text_or_empty(text)
    one = F.explode(proposals(value)).alias("p")
    rows = documents.select((F.pmod(F.xxhash64(value), F.lit(5)) == 0).alias("held_out"), one)
    # At most the product of the features' values: a bounded table for any corpus.
    counted = rows.groupBy("held_out", *[F.col(f"p.{f}").alias(f) for f in FEATURES]).agg(
        F.sum(F.col("p.strict").cast("int")).alias("positive"), F.count(F.lit(1)).alias("total")
    ).collect()
    if not counted:
        return Model([])
    counted.sort(key=lambda r: tuple(r[f] for f in ("held_out", *FEATURES)))
    x = np.array([[r[f] for f in FEATURES] for r in counted], np.int64)
    positive = np.array([r["positive"] for r in counted], float)
    total = np.array([r["total"] for r in counted], float)
    held = np.array([r["held_out"] for r in counted])
    if held.all() or not held.any():
        learn = check = np.ones(len(x), bool)  # too few texts to hold any out
    else:
        learn, check = ~held, held
    if not positive[learn].sum():
        return Model([])
    model = Model(_boost(x[learn], positive[learn], total[learn], rounds, depth, rate))
    score = sum(_value(t, x) for t in model.trees)
    model.slope, model.shift = _calibrate(score[check], positive[check], total[check])
    p = 1 / (1 + np.exp(-(model.slope * score[check] + model.shift)))
    order = np.argsort(-p, kind="stable")
    weight = total[check][order]
    right = np.cumsum(p[order] * weight) / np.cumsum(weight)
    good = np.flatnonzero(right >= precision)
    if len(good):
        least = good[-1]
        below = float(p[order][least + 1]) if least + 1 < len(p) else 0.0
        model.threshold = max(0.5, (float(p[order][least]) + below) / 2)
    return model


def _code(s: Column) -> Column:
    """A span as one number, so that sets of spans are compared by hashing."""
    return s["start"] * F.lit(1 << 31) + s["end"]


def detect(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``base`` and ``added``: arrays of struct<kind, start, end>.

    Base spans come by kind (email, ip, card, phone), then start. Added ones touch no base
    span; they may overlap each other, and are ordered likewise. A NULL text is empty. Input
    columns named base and added are replaced.
    """
    value = text_or_empty(text)
    base = F.concat(*[named(kind, spans) for kind, spans in base_spans(value).items()])
    rows = documents.drop("base", "added").withColumn("base", base)
    if not model.trees:
        return rows.withColumn("added", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))
    chosen = F.filter(proposals(value), lambda p: model.probability(p) >= F.lit(model.threshold))
    plain = F.transform(chosen, lambda p: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), p["kind"]).alias("order"),
        p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind"),
    ))

    def fresh(spans: Column, known: Column) -> Column:
        """Most proposals are base spans themselves: these go by hashing, the few left
        are compared with each base span."""
        new = F.array_except(F.transform(spans, _code), F.transform(known, _code))
        return F.when(F.size(new) == 0, F.slice(spans, 1, 0)).otherwise(F.filter(
            spans, lambda s: F.array_contains(new, _code(s))
            & ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        ))

    added = F.when(F.size(plain) > 0, let(plain, lambda s: fresh(s, F.col("base"))))
    ordered = F.transform(F.array_sort(F.array_distinct(added)), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")
    ))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return rows.withColumn("added", F.coalesce(ordered, none))


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and written spans of ``detect``: one row per input row."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    order = F.array(*map(F.lit, KINDS))
    every = F.transform(
        F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
            F.array_position(order, s["kind"]).alias("order"),
            s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"),
        ))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return found.select(
        F.col(doc_id).alias("doc_id"), *[count(k) for k in KINDS[:4]],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


PIECES = "array<struct<begin:bigint,end:bigint,mark:string>>"
FEW, MANY = 64, 4096


def _blocks(items: Column, size: int) -> Column:
    last = F.floor((F.size(items) - 1) / size).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda b: F.slice(items, b * size + 1, F.lit(size))
    )


def _between(spans: Column, length: Column) -> Column:
    """The pieces of a text that spans (sorted by start, at least one) leave, each with the mark
    of the span that follows it, '' after the last. A span that begins inside earlier ones makes
    no piece.

    Where earlier spans end is carried from block to block, then within each block, so that no
    array grows by one element at a time over all spans.
    """
    def run(block: Column, before: Column) -> Column:
        state = F.struct(before.alias("at"), F.array().cast(PIECES).alias("out"))

        def step(s: Column, x: Column) -> Column:
            piece = F.struct(
                s["at"].alias("begin"), x["start"].alias("end"),
                F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("mark"),
            )
            return F.struct(
                F.greatest(s["at"], x["end"]).alias("at"),
                F.when(x["start"] < s["at"], s["out"]).otherwise(F.concat(s["out"], F.array(piece)))
                .alias("out"),
            )

        return F.aggregate(block, state, step, lambda s: s["out"])

    def of_blocks(blocks: Column) -> Column:
        ends = F.aggregate(
            blocks, F.array(F.lit(0).cast("long")),
            lambda found, b: F.concat(found, F.array(F.greatest(
                F.element_at(found, -1), F.array_max(F.transform(b, lambda x: x["end"]))
            ))),
        )
        return let(ends, lambda e: F.concat(
            F.flatten(F.zip_with(blocks, F.slice(e, 1, F.size(blocks)), run)),
            F.array(F.struct(
                F.element_at(e, -1).alias("begin"), length.cast("long").alias("end"), F.lit("").alias("mark")
            )),
        ))

    return let(_blocks(spans, FEW * 4), of_blocks)


def _part(text: Column, begin: Column, some: Column) -> Column:
    """What ``some`` consecutive pieces span of a text that begins at ``begin``."""
    first, last = F.element_at(some, 1)["begin"], F.element_at(some, -1)["end"]
    return F.substr(text, (first - begin + 1).cast("int"), (last - first).cast("int"))


def _rewritten(text: Column, pieces: Column) -> Column:
    """The pieces with their marks. A text is walked from its start for every cut, so it is cut
    into the parts of MANY pieces, these into parts of FEW, and only those piece by piece."""
    def of_few(part: Column, begin: Column, some: Column) -> Column:
        return F.array_join(F.transform(some, lambda p: F.concat(
            F.substr(part, (p["begin"] - begin + 1).cast("int"), (p["end"] - p["begin"]).cast("int")),
            p["mark"],
        )), "")

    def first(some: Column) -> Column:
        return F.element_at(some, 1)["begin"]

    def of_many(part: Column, begin: Column, many: Column) -> Column:
        return F.array_join(F.transform(_blocks(many, FEW), lambda few: let(
            _part(part, begin, few), lambda own: of_few(own, first(few), few)
        )), "")

    return F.array_join(F.transform(_blocks(pieces, MANY), lambda many: let(
        _part(text, F.lit(0), many), lambda own: of_many(own, first(many), many)
    )), "")


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The result of ``detect`` with every span replaced by its kind in brackets.

    Spans that overlap are replaced together, by the kind of the first. The cost is the length of
    the text and the number of its spans, but for one walk over the text per MANY spans.
    """
    value = F.col(text).cast("string")
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
    )))
    rebuilt = let(_between(spans, F.length(value)), lambda pieces: _rewritten(value, pieces))
    return found.withColumn(
        text, F.when(F.size("base") + F.size("added") > 0, rebuilt).otherwise(value)
    )
