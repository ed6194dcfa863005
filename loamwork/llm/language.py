"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text. A text is cut greedily into the longest phrases that occur in it; the
fewer phrases a language needs, the closer it is. Phrase counts are normalised by the logarithm of the length of the
language's text, which is what naming a phrase costs in bits. Many segments of text step through an automaton together,
as one table lookup per code point.

The automata are built from a bounded sample of labelled rows: ``chars_per_language`` code points of each language, in
pieces of up to ``piece`` code points, the first in the order of a hash of the text. Null and empty texts, and texts without a
letter, are ``und`` with score 0, as is every text when nothing is labelled. Ties go to the first language by name. Repeated rows
are predicted alike; columns other than doc_id, text and lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from loamwork.llm.common import held_out, query, table

_SEGMENT = 256
_FAIL = np.int32(1 << 30)


def letters(text: str) -> str:
    """Lower case, with everything but letters as single blanks."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def training_text(docs: DataFrame, chars_per_language: int = 24_000, piece: int = 1_000) -> dict[str, str]:
    """Sample text of each language; ``docs`` has text and lang. At most chars_per_language / 10 rows a language leave the cluster."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64("text").alias("order"), F.substring("text", 1, piece).alias("text")
    )
    limit = chars_per_language // 10
    # Hashes alone are ranked, within salts first, so a language of a third of all rows is cut down by many tasks.
    keys = rows.select("lang", "order").distinct().withColumn("salt", F.pmod("order", F.lit(64)))
    cut = keys.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy("order"))).where(F.col("at") <= limit)
    chosen = cut.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("order"))).where(F.col("place") <= limit)
    picked = rows.join(F.broadcast(chosen.select("lang", "order", "place")), ["lang", "order"]).groupBy("lang", "place").agg(F.min("text").alias("text"))
    texts: dict[str, str] = {}
    for row in picked.orderBy("lang", "place").toLocalIterator():
        have = texts.get(row["lang"], "")
        if len(have) < chars_per_language:
            texts[row["lang"]] = have + " " + letters(row["text"])
    return {lang: text[:chars_per_language].strip() for lang, text in texts.items() if text.strip()}


def automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``: state 0 is the start, every substring is a path from it."""
    step: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(step)
                step.append(dict(step[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return step


class Parser:
    """Phrase counts of texts in each language's automaton."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        alphabet = sorted(set("".join(texts.values())) | {" "})
        self.width = len(alphabet) + 2
        # Symbols: 0 pads a segment and changes nothing, 1 is any letter without an entry.
        self.codes = {c: i + 2 for i, c in enumerate(alphabet)}
        self.lookup = np.ones(0x10000, np.int32)
        for c, i in self.codes.items():
            if ord(c) < 0x10000:
                self.lookup[ord(c)] = i
        self.tables = [self._table(automaton(texts[name])) for name in self.languages]
        self.bits = np.array([log2(len(texts[name]) + 2) for name in self.languages])

    def _table(self, steps: list[dict[str, int]]) -> np.ndarray:
        """next[state, symbol], premultiplied by the width. Where the phrase ends: the state after a restart, flagged."""
        out = np.zeros((len(steps), self.width), np.int32)
        start = np.full(self.width, _FAIL, np.int32)
        for c, to in steps[0].items():
            start[self.codes[c]] = to * self.width | int(_FAIL)
        out[:] = start
        for state, transitions in enumerate(steps):
            out[state, 0] = state * self.width
            for c, to in transitions.items():
                out[state, self.codes[c]] = to * self.width
        return out.ravel()

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per (text, language). A text is parsed in segments of a few hundred code points, each ending a phrase."""
        rows, owner = [], []
        for i, text in enumerate(texts):
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            symbols = self.lookup[np.minimum(points, 0xFFFF)]
            pad = -len(symbols) % _SEGMENT
            rows.append(np.concatenate([symbols, np.zeros(pad, np.int32)]))
            owner.append(np.full((len(symbols) + pad) // _SEGMENT, i))
        owner = np.concatenate(owner)
        steps = np.ascontiguousarray(np.concatenate(rows).reshape(-1, _SEGMENT).T)
        out = np.zeros((len(texts), len(self.languages)))
        for k, table in enumerate(self.tables):
            state, count = np.zeros(steps.shape[1], np.int32), np.ones(steps.shape[1], np.int32)
            for symbols in steps:
                state += symbols
                np.take(table, state, out=state)
                count += state >> 30
                state &= _FAIL - 1
            out[:, k] = np.bincount(owner, count, len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score: the certainty with which the best beats the second, 0 to 1."""
        cleaned = [letters(t) if t else "" for t in texts]
        filled = [i for i, t in enumerate(cleaned) if t]
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not filled or not self.languages:
            return names, scores
        bits = self.phrases([cleaned[i] for i in filled]) * self.bits
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        margin = 1 - ordered[:, 0] / ordered[:, 1] if bits.shape[1] > 1 else np.ones(len(filled))
        for i, b, m in zip(filled, best, margin):
            names[i], scores[i] = self.languages[b], float(m)
        return names, scores


def identify(docs: DataFrame, texts: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred, score for every row. Each Python worker builds the automata from the sample once."""
    bound = docs.sparkSession.sparkContext.broadcast(texts)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(bound.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                names, scores = parser.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(predict, "doc_id bigint, lang_pred string, score double")


@query("op9_language")
def language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    predicted = identify(docs, training_text(docs.where(~held_out())))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
