"""Language identification by cross-parsing (operator 10).

A suffix automaton per language holds every substring of a bounded sample of its labelled
texts. A text is parsed greedily into the longest phrases that occur in the sample; the
language that needs the fewest phrases per character wins, as its sample predicts the text
best (the phrase count estimates the cross entropy).

Case is folded and everything that is not a letter counts as one blank. Texts are parsed in
cuts of ``CUT`` characters, all cuts of a chunk side by side, so a text of any length is read
whole in bounded memory; a cut ends the phrase it falls in, for every language alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from salesloom.llm.common import release, remainder

UNKNOWN = "und"
CUT = 512
CHUNK_CHARS = 1_500_000


def sample(
    labelled: DataFrame, lang: str = "lang", text: str = "text",
    sample_docs: int = 64, sample_chars: int = 16_384,
) -> dict[str, list[str]]:
    """At most ``sample_docs`` texts per language, cut to ``sample_chars`` in all.

    Texts are dealt over ``sample_docs`` buckets by their hash, and the smallest hash of each
    bucket is taken: copies count once, a hot language costs no more than a rare one, and only
    the bounded sample reaches the driver. Rows without text or language are no evidence.
    """
    key = F.xxhash64(F.col(text))
    rows = labelled.where(
        F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")
    ).select(F.col(lang).alias("lang"), F.col(text).alias("text"), key.alias("key"))
    chosen = rows.groupBy("lang", F.pmod("key", F.lit(sample_docs)).alias("bucket")).agg(
        F.min("key").alias("key")
    ).collect()
    if not chosen:
        return {}
    found = rows.where(F.col("key").isin(sorted({r["key"] for r in chosen}))).select(
        "lang", "key", F.substring("text", 1, sample_chars).alias("text")
    ).dropDuplicates(["lang", "key"]).collect()
    wanted = {(r["lang"], r["key"]) for r in chosen}
    texts: dict[str, list[str]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["key"])):
        if (row["lang"], row["key"]) in wanted:
            texts.setdefault(row["lang"], []).append(row["text"])
    return {name: _fill(own, sample_chars) for name, own in sorted(texts.items())}


def _fill(texts: list[str], chars: int) -> list[str]:
    """An even share of each text; what short texts leave goes to the longer ones."""
    kept, left = [], chars
    by_length = sorted(texts, key=len)
    for i, text in enumerate(by_length):
        kept.append(text[: left // (len(by_length) - i)])
        left -= len(kept[-1])
    return kept


@lru_cache(maxsize=1)
def _folded() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter, and its lower case where that is one character."""
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in np.flatnonzero(letter).tolist():
        low = chr(i).lower()
        if len(low) == 1:
            lower[i] = ord(low)
    return letter, lower


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)


class Parser:
    """The automata of all languages as dense transition tables.

    A table entry is the next state times the alphabet size; a missing transition holds the
    complement of the state that the character leads to from the root, so a negative entry
    says "a new phrase begins here". A character that the sample lacks leads to a state without
    transitions: it is a phrase of its own.
    """

    def __init__(self, samples: dict[str, list[str]]):
        letter, lower = _folded()
        seen: Counter = Counter()
        for texts in samples.values():
            codes = _codes(texts)
            codes = lower[codes[letter[codes]]]
            seen.update(dict(zip(*map(np.ndarray.tolist, np.unique(codes, return_counts=True)))))
        alphabet = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))][:250]
        self.size = len(alphabet) + 2  # blank, the letters, any other letter
        self.classes = np.zeros(0x110000, np.uint8)
        own = np.full(0x110000, self.size - 1, np.uint8)
        own[alphabet] = np.arange(1, len(alphabet) + 1)
        self.classes[letter] = own[lower[letter]]
        self.languages = list(samples)
        self.tables = [self._table(texts) for texts in samples.values()]

    def _table(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Transitions of all states, and those of the root."""
        end = self.size  # between texts; no text holds it
        sequence: list[int] = []
        for text in texts:
            sequence += self.symbols([text])[0].tolist() + [end]
        next_, link, length = [{}], [-1], [0]
        last = 0
        for c in sequence:  # online construction of the suffix automaton
            current = len(next_)
            next_.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p != -1 and c not in next_[p]:
                next_[p][c] = current
                p = link[p]
            if p != -1:
                q = next_[p][c]
                if length[q] == length[p] + 1:
                    link[current] = q
                else:
                    clone = len(next_)
                    next_.append(dict(next_[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p != -1 and next_[p].get(c) == q:
                        next_[p][c] = clone
                        p = link[p]
                    link[q] = link[current] = clone
            last = current
        size = self.size
        root = np.full(size, len(next_) * size, np.int32)
        for c, target in next_[0].items():
            if c != end:
                root[c] = target * size
        table = np.tile(~root, (len(next_) + 1, 1))
        for state, moves in enumerate(next_):
            for c, target in moves.items():
                if c != end:
                    table[state, c] = target * size
        return table.ravel(), root

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all texts in a row, runs of blanks as one, none in front; lengths."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        classes = self.classes[_codes(texts)]
        before = np.empty_like(classes)
        before[1:] = classes[:-1]
        starts = np.cumsum(lengths) - lengths
        before[starts[lengths > 0]] = 0
        keep = (classes != 0) | (before != 0)
        upto = np.concatenate([[0], np.cumsum(keep)])
        return classes[keep], upto[starts + lengths] - upto[starts]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases needed, texts x languages, and the length of each text in symbols."""
        classes, lengths = self.symbols(texts)
        cuts = -(-lengths // CUT)
        owner = np.repeat(np.arange(len(texts)), cuts)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        size = np.minimum(CUT, lengths[owner] - rank * CUT)
        start = (np.cumsum(lengths) - lengths)[owner] + rank * CUT
        order = np.argsort(-size, kind="stable")
        owner, size, start = owner[order], size[order], start[order]
        grid = np.zeros((len(size), CUT), np.uint8)
        at = np.repeat(np.arange(len(size)) * CUT - (np.cumsum(size) - size), size)
        flat = np.repeat(start - (np.cumsum(size) - size), size)
        steps = np.arange(len(at))
        grid.ravel()[at + steps] = classes[flat + steps]
        del at, flat, steps
        grid = np.ascontiguousarray(grid.T)
        active = np.searchsorted(-size, -np.arange(CUT), side="left").tolist()
        needed = np.zeros((len(texts), len(self.tables)), np.int64)
        for k, (table, root) in enumerate(self.tables):
            state = root.take(grid[0])
            count = np.zeros(len(size), np.int32)
            for step in range(1, CUT):
                n = active[step]
                if not n:
                    break
                moved = table.take(state[:n] + grid[step, :n])
                missing = moved >> 31
                count[:n] -= missing
                state[:n] = moved ^ missing
            count += size > 0  # the phrase that the end cuts off
            needed[:, k] = np.bincount(owner, count, len(texts)).astype(np.int64)
        return needed, lengths

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Languages and scores. The score is how much longer the runner-up's parse is,
        as a share of it: 0 for a tie (the first name wins), near 1 for a clear case."""
        langs, scores = [], []
        first = 0
        while first < len(texts):
            last, chars = first, 0
            while last < len(texts) and (last == first or chars + len(texts[last]) <= CHUNK_CHARS):
                chars += len(texts[last])
                last += 1
            needed, lengths = self.phrases(texts[first:last])
            for row, n in zip(needed, lengths.tolist()):
                if not n or not len(row):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(np.argmin(row))
                rest = np.delete(row, best)
                rival = rest.min() if len(rest) else n + 1
                langs.append(self.languages[best])
                scores.append(max(0.0, 1.0 - float(row[best]) / float(rival)))
            first = last
        return langs, scores


@lru_cache(maxsize=2)
def _parser(samples: tuple) -> Parser:
    return Parser({name: list(texts) for name, texts in samples})


def language(text: Column, samples: dict[str, list[str]]) -> Column:
    """struct<lang, score> of a text column; the model sees nothing but the text.

    A NULL or empty text, or one without a letter, is ``und`` with score 0; so is every text
    if nothing was learned. Only the sample is sent to the executors (``sample_chars`` per
    language); each Python worker builds the automata once.
    """
    frozen = tuple((name, tuple(texts)) for name, texts in samples.items())

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(frozen)
        for texts in batches:
            langs, scores = parser.predict(texts.fillna("").tolist())
            yield pd.DataFrame({"lang": langs, "score": scores})
        release()

    return predict(text.cast("string"))


def identify(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    folds: int = 5, sample_docs: int = 64, sample_chars: int = 16_384,
) -> DataFrame:
    """Predicted language of every row: doc_id, held_out, lang_pred, score.

    Learns only from rows whose fold (crc32 of the id, modulo ``folds``) is not 0. One result
    row per input row, repeated rows included; other columns are not read. An empty table
    gives an empty result.
    """
    held_out = remainder(F.col(doc_id), folds) == 0
    samples = sample(documents.where(~held_out), lang, text, sample_docs, sample_chars)
    found = language(F.col(text), samples)
    return documents.select(
        F.col(doc_id).alias("doc_id"), held_out.alias("held_out"), found.alias("_found")
    ).select("doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), "_found.score")
