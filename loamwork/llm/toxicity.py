"""Toxicity by a weighted finite-state pattern grammar.

Words map to classes (insult, threat, target, negation, report) and transducers over the classes are composed by a clause
machine: an insult, with or without a target, or a threat with a target, matched inside one clause; a negation or a
reported-speech frame before an insult or a threat changes the kind of the match. A document's matches by kind, not its words
alone, are weighed by a logistic model.

The lexicon of insults and threats is learned from labelled rows: word stems that occur in toxic texts and nearly nowhere else. A
stem's support is the number of distinct neighbourhoods it occurs in, so copies of a text count once; stems are kept when chance
would produce none of their support among all stems tried. A stem is a threat when a target follows it in most of its toxic
places, else an insult. The word lists below start all classes in four languages; targets, negations and reports are function words
and are listed only.

Labels, languages, sources and ids are never inputs of a score. Null and empty texts score as texts without a match; so does
every text while nothing is labelled. Repeated rows score alike. Columns other than those named are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm.common import held_out, query, stored, table

# General word lists of the grammar's classes, in English, German, French and Spanish.
_SEEDS = {
    "insult": (
        "idiot moron stupid scum trash loser pathetic worthless disgusting clown imbecile dumb "
        "trottel dummkopf abschaum versager erbärmlich wertlos widerlich "
        "imbécile crétin abruti minable ordure dégoûtant "
        "idiota imbécil estúpido basura patético asqueroso"
    ).split(),
    "threat": (
        "kill hurt destroy beat shoot stab burn crush strangle punch "
        "töten umbringen verletzen vernichten schlagen erschießen "
        "tuer blesser détruire frapper écraser étrangler "
        "matar herir destruir golpear aplastar quemar"
    ).split(),
    "target": (
        "you your yourself he she him her they them these those people "
        "du dich dir dein ihr euch ihn ihm ihnen leute "
        "tu toi vous ils elles lui eux gens "
        "tú ti usted ustedes ellos ellas gente"
    ).split(),
    "negation": (
        "not never no isn't wasn't aren't don't didn't doesn't nobody neither without "
        "nicht nie niemals kein keine niemand ohne "
        "pas jamais aucun personne sans "
        "nunca jamás nadie ningún sin"
    ).split(),
    "report": (
        "said says say wrote writes called calls claimed claims quoted reported according told "
        "sagte sagt schrieb behauptete nannte laut "
        "dit disait écrit affirme selon déclare "
        "dijo dice escribió afirmó según llamó"
    ).split(),
}
_CLASSES = {"insult": 1, "threat": 2, "target": 3, "negation": 4, "report": 5}
_INSULT, _THREAT, _TARGET, _NEGATION, _REPORT = 1, 2, 3, 4, 5
#: What a clause machine gives out: matches of each kind.
KINDS = ["insult", "insult_at_target", "negated", "reported", "threat_at_target", "threat_negated", "threat_reported"]
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[.!?;:\n]")
_CLAUSE_END = frozenset(".!?;:\n")
#: Shortest and longest learned stem; longer words may also be learned whole.
_STEM = (4, 10)


def _machine() -> dict[tuple[int, int], tuple[int, list[int]]]:
    """The composed machine: (state, class) to (state, kinds given out).

    A state is a set of bits: a target was seen, a negation is near, a report frame is open, an insult waits for a
    target, a threat waits for a target. Negation, report and target reach over a clause; negation and report only to what comes
    after them. An insult is given out at the next one or at the end of the clause (class 0), a threat once with its target.
    """
    target, negation, report, insult, threat = 1, 2, 4, 8, 16
    moves = {}
    for state in range(32):
        def kind(s):
            return 3 if s & report else 2 if s & negation else 1 if s & target else 0

        threatened = [6 if state & report else 5 if state & negation else 4]
        waiting = state & (insult | threat)

        moves[state, 0] = (0, [kind(state)] if state & insult else [])
        moves[state, _INSULT] = (state | insult, [kind(state)] if state & insult else [])
        moves[state, _THREAT] = (state, threatened) if state & target else (state | threat, [])
        moves[state, _TARGET] = ((state | target) & ~threat, threatened if state & threat else [])
        moves[state, _NEGATION] = (state if waiting else state | negation, [])
        moves[state, _REPORT] = (state if waiting else state | report, [])
    return moves


class Grammar:
    """Counts of matched clauses by kind. The lexicon is words and stems with their class."""

    def __init__(self, words: dict[str, int], stems: dict[str, int]):
        self.words, self.stems, self.moves = words, stems, _machine()
        self.lengths = sorted({len(s) for s in stems})
        self.seen: dict[str, int] = {}

    def _class(self, token: str) -> int:
        found = self.words.get(token, 0)
        if not found:
            for n in self.lengths:
                if n > len(token):
                    break
                found = self.stems.get(token[:n], 0)
                if found:
                    break
        return found

    def counts(self, text: str | None) -> list[int]:
        """Matches of each kind in the whole text, and the number of words."""
        out, state, n, seen, moves = [0] * len(KINDS), 0, 0, self.seen, self.moves
        if len(seen) > 300_000:
            seen.clear()
        tokens = _TOKEN.findall((text or "").lower())
        for token in tokens:
            kind = seen.get(token)
            if kind is None:
                kind = seen[token] = -1 if token in _CLAUSE_END else self._class(token)
            if kind == 0:
                continue
            state, given = moves[state, max(kind, 0)]
            for k in given:
                out[k] += 1
        for k in moves[state, 0][1]:
            out[k] += 1
        n = len(tokens)
        return [*out, n]


def _features(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the counts by kind, of their sum, and the density of matches."""
    kinds, words = counts[:, :-1], counts[:, -1:]
    total = kinds.sum(axis=1, keepdims=True)
    return np.hstack([np.log1p(kinds), np.log1p(total), np.minimum(total, 2) / 2, np.log1p(100 * total / np.maximum(words, 1))])


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray, penalty: float = 0.1, steps: int = 40) -> np.ndarray:
    """Weights, intercept last, by Newton's method; rows count ``times`` times. A few features, so the matrix is tiny."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.diag([penalty] * (x.shape[1] - 1) + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (times * (y - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _tail(k: int, n: int, p: float) -> float:
    """Logarithm of the chance of k or more among n at rate p, from its first term."""
    head = lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log1p(-p)
    return head - log(max(1e-9, 1 - min(0.999, (n - k) * p / ((k + 1) * (1 - p)))))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, around, toxic = [], [], []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            tokens = re.findall(r"[^\W\d_]+", (text or "").lower())
            seen = set()
            for i, token in enumerate(tokens):
                near = (token, tokens[i - 1] if i else "", tokens[i + 1] if i + 1 < len(tokens) else "")
                if len(token) >= _STEM[0] and near not in seen:
                    seen.add(near)
                    words.append(token)
                    around.append(" ".join(near[1:]))
                    toxic.append(label)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(around, pa.string()), pa.array(toxic, pa.int32())], names=["word", "around", "toxic"])


def learn_stems(labelled: DataFrame) -> dict[str, int]:
    """Stems of toxic texts with their class, from rows (text, toxic). Counting is by aggregation; only stems that may be significant,
    which the bounded sample of rows bounds, are collected."""
    rows = stored(labelled.mapInArrow(_contexts, "word string, around string, toxic int"), "contexts")
    places = rows.groupBy("word", "around").agg(F.min("toxic").alias("toxic"))
    at_target = F.split_part("around", F.lit(" "), F.lit(2)).isin(_SEEDS["target"]) & (F.col("toxic") == 1)
    words = places.groupBy("word").agg(F.sum("toxic").cast("bigint").alias("bad"), F.count(F.lit(1)).alias("n"), F.count_if(at_target).alias("aimed"))
    lengths = F.sequence(F.lit(_STEM[0]), F.least(F.length("word"), F.lit(_STEM[1])))
    stems = stored(
        words.select("bad", "n", "aimed", F.explode(F.array_union(F.transform(lengths, lambda k: F.substring("word", F.lit(1), k)), F.array("word"))).alias("stem"))
        .groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("bad", "n", "aimed")]), "stems",
    )
    base = words.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    if not base["bad"] or base["bad"] == base["n"]:
        return {}
    rate, tried = base["bad"] / base["n"], stems.count()
    likely = stems.where((F.col("bad") >= 3) & (F.col("bad") >= 0.97 * F.col("n"))).collect()
    # A stem whose words all go on in the same way is no shorter than what they share.
    support = {r["stem"]: (r["bad"], r["n"]) for r in likely}
    longer = {stem[:-1] for stem, found in support.items() if support.get(stem[:-1]) == found}
    chosen: dict[str, int] = {}
    for row in sorted((r for r in likely if r["stem"] not in longer), key=lambda r: (len(r["stem"]), r["stem"])):
        stem, bad, n = row["stem"], row["bad"], row["n"]
        # A longer stem says nothing new when a part of it is in.
        if any(stem[:k] in chosen for k in range(_STEM[0], len(stem))):
            continue
        if _tail(bad, n, rate) < log(0.05 / tried):
            chosen[stem] = _THREAT if 2 * row["aimed"] > bad else _INSULT
    return chosen


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 24_000) -> dict:
    """A model from at most ``max_rows`` labelled rows, the first by a hash of the text: lexicon and weights.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. A row labelled twice counts as toxic if one label says so.
    """
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("order", F.xxhash64("text"))
    wanted = keyed.select("doc_id", "order").join(marks, "doc_id").orderBy("order", "doc_id").limit(max_rows)
    # At most max_rows keys.
    sample = stored(
        keyed.join(F.broadcast(wanted), ["doc_id", "order"]).select("text", "toxic").repartition(docs.sparkSession.sparkContext.defaultParallelism), "toxic-sample"
    )
    words = {w: _CLASSES[c] for c, seeds in _SEEDS.items() for w in seeds}
    stems = learn_stems(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, stems)
        for batch in batches:
            found = [grammar.counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column("toxic")], names=["counts", "toxic"])

    # Equal rows are folded: a handful of numbers per row at most leaves the cluster.
    counted = sample.mapInArrow(count, "counts array<bigint>, toxic int").groupBy("counts", "toxic").count().collect()
    weights = None
    if len({r["toxic"] for r in counted}) == 2:
        counted = sorted(counted, key=lambda r: (r["counts"], r["toxic"]))
        x = _features(np.array([r["counts"] for r in counted], float))
        weights = _logistic(x, np.array([r["toxic"] for r in counted], float), np.array([r["count"] for r in counted], float)).tolist()
    return {"words": words, "stems": stems, "weights": weights}


def score(docs: DataFrame, model: dict, into: str = "score") -> DataFrame:
    """``docs`` (any columns with ``text``) with ``into``, 0 to 1, from the whole text; a column of that name is replaced."""
    bound = docs.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, weights = Grammar(bound.value["words"], bound.value["stems"]), bound.value["weights"]
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = _features(np.array([grammar.counts(t.as_py()) for t in part.column("text")], float))
                z = np.hstack([x, np.ones((len(x), 1))]) @ np.array(weights) if weights else np.full(len(x), -3.0)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=[*part.schema.names, into])

    kept = docs.drop(into)
    return kept.mapInArrow(add, kept.withColumn(into, F.lit(0.0)).schema)


@query("op6_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs.where(~held_out()), table(spark, folder, "labels"))
    # The held-out flag and the verdict are derived beside the score, which sees the text alone.
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
