"""Quality by a vote of the nearest labelled texts in a latent semantic space.

A text is counted as hashed features: its words, the shapes of its tokens (letters, capitals, digits and marks in turn, runs as one,
so ``Word,###`` is ``Aa,#``), and how often words come back. TF-IDF weights with statistics of all documents follow, then a randomised,
distributed factorisation: every task multiplies its texts with a random matrix and adds up the product with its transpose,
the sums give the leading directions (Nystrom). Labelled texts, projected, are sent to every task; each document takes exact cosines with all
of them, in blocks, and the labels of the ``neighbours`` nearest are weighed by a power of their cosine.

Learned from labels: at most ``max_labelled`` different texts, the first by a hash of the text; copies of a text are one, with the mean of
their labels. Counts and directions cover all documents. Neighbours as near as the last are all heard, so ties don't depend on order.

Null and empty texts, and texts without any neighbour, score the mean label; 0.5 while nothing is labelled. Repeated rows score
alike. Extra columns are ignored; labels, languages, sources and ids are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm.common import held_out, query, stored, table

#: Hashed words, hashed shapes, and directions: the model's size, whatever the input.
WORDS, SHAPES, RANK = 2048, 1024, 48
FEATURES = WORDS + SHAPES
_BLOCK = 256
_LOWERED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_SHAPED = bytes(97 if c >= 128 or 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
#: Words this long seldom come back by chance.
_LONG = 5


class _Counter:
    """Feature numbers and counts of whole texts; hashes are kept from text to text, up to a bound."""

    def __init__(self, memory: int = 300_000):
        self.memory, self.words, self.shapes = memory, {}, {}

    def _number(self, known: dict, token: bytes, start: int, size: int) -> int:
        if len(known) > self.memory:
            known.clear()
        found = known[token] = start + xxhash.xxh32_intdigest(token) % size
        return found

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        raw = (text or "").encode()
        out: Counter = Counter()
        words = raw.translate(_LOWERED).split()
        known = self.words
        counted = Counter(words)
        for word, n in counted.items():
            at = known.get(word)
            out[self._number(known, word, 0, WORDS) if at is None else at] += n
        known = self.shapes
        for token, n in Counter(raw.translate(_SHAPED).split()).items():
            at = known.get(token)
            if at is None:
                at = known[token] = self._number({}, _RUN.sub(rb"\1", token), WORDS, SHAPES)
                if len(known) > self.memory:
                    known.clear()
            out[at] += n
        # Words said twice in a row, and long words that come back three times and more.
        stutter = sum(map(bytes.__eq__, words, words[1:]))
        again = sum(n - 2 for word, n in counted.items() if n > 2 and len(word) >= _LONG)
        for name, n in ((b"\0stutter", stutter), (b"\0again", again)):
            if n:
                out[self._number({}, name, WORDS, SHAPES)] += n
        ids = np.fromiter(out.keys(), np.uint16, len(out))
        return ids, np.fromiter(out.values(), np.float32, len(out))


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = _Counter()
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            found = [count(t.as_py()) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("order"),
                pa.array([i.tobytes() for i, _ in found], pa.binary()), pa.array([n.tobytes() for _, n in found], pa.binary()),
            ], names=["doc_id", "order", "ids", "times"])


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, order, ids, times) of every row: feature numbers and counts; ``order`` is the hash of the text."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("order", F.xxhash64(F.coalesce("text", F.lit(""))))
    return source.mapInArrow(_featured, "doc_id bigint, order bigint, ids binary, times binary")


def _blocks(batch: pa.RecordBatch, idf: np.ndarray | None) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, dense rows): unit TF-IDF rows, or 0 and 1 for the features a row has without ``idf``."""
    ids, times = batch.column("ids"), batch.column("times")
    for start in range(0, batch.num_rows, _BLOCK):
        stop = min(start + _BLOCK, batch.num_rows)
        dense = np.zeros((stop - start, FEATURES), np.float32)
        for i in range(start, stop):
            at = np.frombuffer(ids[i].as_py(), np.uint16)
            if idf is None:
                dense[i - start, at] = 1
            else:
                dense[i - start, at] = np.log1p(np.frombuffer(times[i].as_py(), np.float32)) * idf[at]
        if idf is not None:
            # Words and shapes weigh the same, however many there are of each.
            for part in (slice(0, WORDS), slice(WORDS, FEATURES)):
                dense[:, part] /= np.maximum(np.linalg.norm(dense[:, part], axis=1, keepdims=True), 1e-9)
        yield start, dense


def _present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n): texts that have a feature; feature -1 has the number of texts."""
    counts, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for _, dense in _blocks(batch, None):
            counts += dense.sum(axis=0).astype(np.int64)
            rows += int(dense.any(axis=1).sum())
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(found, -1), pa.int32()), pa.array(np.append(counts[found], rows), pa.int64())], names=["feature", "n"])


def _random(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((FEATURES, RANK)).astype(np.float32)


def _products(idf: np.ndarray, seed: int):
    """Arrow step: rows (feature, z) of A'(A R) for this task's texts A and the random matrix R."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, total = _random(seed), np.zeros((FEATURES, RANK))
        for batch in batches:
            for _, dense in _blocks(batch, idf):
                total += dense.T @ (dense @ random)
        rows = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), *[pa.array(total[rows, k], pa.float64()) for k in range(RANK)]], names=["feature", *[f"z{k}" for k in range(RANK)]]
        )

    return step


def factorise(features: DataFrame, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(idf, directions): whitened leading directions of all texts, FEATURES x RANK. What reaches the driver is the model."""
    counts = features.mapInArrow(_present, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in counts if r["feature"] == -1)
    df = np.zeros(FEATURES)
    for r in counts:
        if r["feature"] >= 0:
            df[r["feature"]] = r["n"]
    idf = np.log((total + 1) / (df + 1)).astype(np.float32)
    schema = "feature int, " + ", ".join(f"z{k} double" for k in range(RANK))
    found = features.mapInArrow(_products(idf, seed), schema).groupBy("feature").agg(*[F.sum(f"z{k}").alias(f"z{k}") for k in range(RANK)]).toArrow()
    z = np.zeros((FEATURES, RANK))
    if found.num_rows:
        z[found.column("feature").to_numpy()] = np.column_stack([found.column(f"z{k}").to_numpy() for k in range(RANK)])
    # Nystrom: A'A is about Z (R'Z)^-1 Z'; its root has A's right singular vectors.
    core = _random(seed).astype(np.float64).T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 1e-12) * 1e-9
    directions, singular, _ = np.linalg.svd(z @ (vectors[:, good] / np.sqrt(np.maximum(values[good], 1e-30))), full_matrices=False)
    return idf, directions[:, singular > max(singular.max(initial=0), 1e-12) * 1e-6].astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(length > 1e-6, x / np.maximum(length, 1e-6), 0)


def fit(features: DataFrame, labels: DataFrame, learnable, max_labelled: int = 8192) -> dict:
    """A model from rows of ``features`` where ``learnable``, labelled by ``labels`` (doc_id, quality)."""
    spark = features.sparkSession
    idf, directions = factorise(features)
    marks = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality")
    marked = features.where(learnable).where(F.octet_length("ids") > 0).select("doc_id", "order").join(marks, "doc_id")
    # One row a text: the copies of a text are folded before the first are taken.
    wanted = marked.groupBy("order").agg(F.avg("quality").alias("label"), F.min("doc_id").alias("doc_id")).orderBy("order").limit(max_labelled)
    chosen = features.join(F.broadcast(wanted), ["order", "doc_id"]).dropDuplicates(["order"])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, dense in _blocks(batch, idf):
                part = batch.slice(start, len(dense))
                yield pa.RecordBatch.from_arrays([part.column("order"), part.column("label"), pa.array([v.tobytes() for v in dense @ directions], pa.binary())], names=["order", "label", "vector"])

    # At most ``max_labelled`` rows of RANK numbers.
    rows = sorted(chosen.mapInArrow(project, "order bigint, label double, vector binary").collect(), key=lambda r: r["order"])
    vectors = np.array([np.frombuffer(r["vector"], np.float32) for r in rows], np.float32).reshape(len(rows), directions.shape[1])
    return {"idf": idf, "directions": directions, "vectors": _unit(vectors).astype(np.float32), "labels": np.array([r["label"] for r in rows], np.float32)}


def vote(texts: np.ndarray, vectors: np.ndarray, labels: np.ndarray, neighbours: int, power: int) -> np.ndarray:
    """Mean label of the nearest vectors to each unit row of ``texts``, weighed by a power of the cosine."""
    usual = float(labels.mean()) if len(labels) else 0.5
    if not len(labels):
        return np.full(len(texts), usual)
    cosines = np.maximum(texts @ vectors.T, 0)
    k = min(neighbours, len(labels))
    last = np.partition(cosines, -k, axis=1)[:, -k:].min(axis=1, keepdims=True)
    weights = np.where(cosines >= last, cosines, 0).astype(np.float64) ** power
    total = weights.sum(axis=1)
    return np.where(total > 1e-12, weights @ labels / np.maximum(total, 1e-12), usual)


def score(features: DataFrame, model: dict, neighbours: int = 25, power: int = 8) -> DataFrame:
    """(doc_id, score) of every row of ``features``."""
    sent = features.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            for start, dense in _blocks(batch, m["idf"]):
                found = vote(_unit(dense @ m["directions"]), m["vectors"], m["labels"], neighbours, power)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(dense)), pa.array(np.clip(found, 0, 1), pa.float64())], names=["doc_id", "score"])

    return features.mapInArrow(step, "doc_id bigint, score double")


@query("op11_quality")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    features = stored(featured(table(spark, folder, "documents").select("doc_id", "text")), "quality-features")
    scored = score(features, fit(features, table(spark, folder, "labels"), ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
