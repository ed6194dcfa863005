"""Benchmark decontamination by latent semantic retrieval.

Documents are read as passages of ``PASSAGE`` words with TF-IDF weights over hashed words, counted over all documents. A
randomised, distributed factorisation finds the leading directions of the passage-word matrix: every task multiplies its
passages with a random matrix and adds up the product with its transpose; the sums meet in one small matrix, from which the
directions follow (Nystrom). The directions are fitted on the passages of all documents, and every document is searched.

Each benchmark item is a query of its own length, in steps of eight words, longer ones several of 64. Windows of that length
of every document, from every eighth word, every fourth for short items, are projected as the items are, and whitened. Windows whose
cosine with an item reaches ``min_cosine`` are candidates. A candidate window must hold as many words of the item as the check
asks for, counted in bulk; what is left, a small part of all pairs, is checked word by word.

The check looks at windows a quarter longer than the item around the candidates. The longest
common subsequence with the whole item must cover ``min_share`` of the item; below ``sure_share``, where it may be a
paraphrase, the text around must also hold the item's answer, or without an answer column most of the item's rarest words.
With ``exact`` the candidates come from an index of the items' rarer words that no passing pair escapes, and all places are checked:
the yardstick that recall is measured against.

Null and empty texts and items match nothing. Repeated documents match alike, repeated items each. Extra columns are ignored.
The items are the stated query set, which is sent to every task, ``max_items`` at a time; more are searched in parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from loamwork.llm.common import opened, query, sealed, stored, table

#: ASCII bytes that are no word bytes become blanks, as does general punctuation, which UTF-8 starts with E2 80.
_BLANKED = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_PUNCTUATION = re.compile(rb"\xe2\x80.", re.S)
#: Hashed words, and columns of the random matrix: the model's size, whatever the input.
FEATURES, RANK = 1 << 14, 96
PASSAGE = 32
#: Words between the starts of windows, for items of up to ``_SHORT`` words and for others.
_FINE, _STEP, _SHORT = 4, 8, 24
#: Bits of a word's hash that tell most words of no item apart.
_MARK_BITS = 20
_PAD = FEATURES
#: Bytes that are hashed at a time, to whole words, and places of a word with a power of their own.
_HASHED_BYTES, _WORD_BYTES = 1 << 16, 1 << 10
#: Rows that are added up at a time: what they take stays in a core's cache.
_CACHED = 1024


class _Hasher:
    """32-bit hashes of the words of texts: bytes by random numbers, times powers by their place in the word, summed and mixed."""

    def __init__(self):
        self.values = np.random.default_rng(3).integers(0, 1 << 64, 256, np.uint64)
        self.values[32] = 0
        self.powers = np.multiply.accumulate(np.full(_WORD_BYTES, 0x9E3779B97F4A7C15, np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        return self.all([text])[0]

    def all(self, texts: list[str | None]) -> list[np.ndarray]:
        raw = [_blanked(t) for t in texts]
        ends = np.cumsum([len(r) + 1 for r in raw])
        # A blank before each text, and one for each byte that is in no word.
        joined, hashes, starts, begin = b" " + b" ".join(raw), [], [], 0
        while begin < len(joined):
            end = joined.find(b" ", begin + _HASHED_BYTES)
            end = len(joined) if end < 0 else end
            part = np.frombuffer(joined, np.uint8, end - begin, begin)
            held = part != 32
            first = np.flatnonzero(held[1:] > held[:-1]) + 1
            if len(first):
                place = np.arange(first[0], len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
                terms = self.values[part[first[0]:]] * self.powers[place & (_WORD_BYTES - 1)]
                hashes.append(np.add.reduceat(terms, first - first[0]))
                starts.append(first + begin)
            begin = end
        found = np.concatenate([np.empty(0, np.uint64), *hashes])
        found = (found ^ found >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
        found = (found >> np.uint64(32)).astype(np.uint32)
        return np.split(found, np.searchsorted(np.concatenate([np.empty(0, np.int64), *starts]), ends[:-1])) if raw else []


def _blanked(text: str | None) -> bytes:
    raw = (text or "").lower().encode()
    if b"\xe2\x80" in raw:
        raw = _PUNCTUATION.sub(b" ", raw)
    return raw.translate(_BLANKED)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = _Hasher()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            data = [words.tobytes() for words in hasher.all(part.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), pa.array(data, pa.binary())], names=["doc_id", "tie", "words"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of batches with the words of each row, about half a million words at a time."""
    for batch in batches:
        words = [np.frombuffer(w.as_py(), np.uint32) for w in batch.column("words")]
        start, total = 0, 0
        for i, w in enumerate(words):
            total += len(w)
            if total > 500_000 or i == len(words) - 1:
                yield batch.slice(start, i + 1 - start), words[start:i + 1]
                start, total = i + 1, 0


def _blocks(words: list[np.ndarray], size: int, gap: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features in rows of ``size``, padded at the end of each text, and the number of rows of each text.

    With a ``gap`` at least so many rows of padding follow each text, and rows are even in number.
    """
    rows = np.array([-(-len(w) // size) for w in words])
    rows += (gap + 1 + rows) // 2 * 2 - rows if gap else 0
    out = np.full(int(rows.sum()) * size, _PAD, np.int32)
    at = 0
    for w, n in zip(words, rows):
        out[at:at + len(w)] = w & (FEATURES - 1)
        at += n * size
    return out.reshape(-1, size), rows


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n): passages that have a feature, in this task; feature -1 has the number of passages."""
    counts, passages = np.zeros(FEATURES + 1, np.int64), 0
    for _, words in _texts(batches):
        blocks = np.sort(_blocks(words, PASSAGE)[0], axis=1)
        fresh = np.ones(blocks.shape, bool)
        fresh[:, 1:] = blocks[:, 1:] != blocks[:, :-1]
        counts += np.bincount(blocks[fresh], minlength=FEATURES + 1)
        passages += len(blocks)
    found = np.flatnonzero(counts[:FEATURES])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(found, -1), pa.int32()), pa.array(np.append(counts[found], passages), pa.int64())], names=["feature", "n"]
    )


def _random(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((FEATURES, RANK)).astype(np.float32)


def _padded(matrix: np.ndarray) -> np.ndarray:
    # Rows in one piece each, as they are taken by row.
    return np.ascontiguousarray(np.vstack([matrix, np.zeros((1, matrix.shape[1]), matrix.dtype)]))


def _row_sums(matrix: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For every row of ``places``, the sum of the matrix's rows there."""
    n, size = places.shape
    out, ones = np.empty((n, 1, matrix.shape[1]), matrix.dtype), np.ones((1, size), matrix.dtype)
    step = max(1, 2 * _CACHED // size)
    for start in range(0, n, step):
        part = places[start:start + step]
        np.matmul(ones, matrix[part.ravel()].reshape(len(part), size, -1), out=out[start:start + step])
    return out[:, 0]


def _sums_by(ids: np.ndarray, rows: np.ndarray, places: np.ndarray, size: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(distinct ids, sums of ``rows[places]`` by them) of sorted ids: eight at a time, then eight of those sums."""
    while True:
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        n = np.diff(np.append(first, len(ids)))
        if len(first) == len(ids):
            return ids, rows[places]
        groups = -(-n // size)
        slots = np.full(int(groups.sum()) * size, len(rows))
        slots[np.repeat((np.cumsum(groups) - groups) * size - first, n) + np.arange(len(ids))] = places
        rows = _row_sums(_padded(rows), slots.reshape(-1, size))
        ids, places = np.repeat(ids[first], groups), np.arange(len(rows))


def _products(idf: np.ndarray, seed: int):
    """Arrow step: rows (feature, z) of A'(A R) for this task's passages A and the random matrix R."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = _padded(_random(seed) * idf[:, None])
        total = np.zeros((FEATURES + 1, RANK), np.float32)
        for _, words in _texts(batches):
            blocks = _blocks(words, PASSAGE)[0]
            for start in range(0, len(blocks), 8192):
                part = blocks[start:start + 8192]
                flat = part.ravel().astype(np.uint16)
                order = np.argsort(flat, kind="stable")
                ids, sums = _sums_by(flat[order], _row_sums(weighted, part), order // PASSAGE)
                total[ids] += sums
        total[:FEATURES] *= idf[:, None]
        rows = np.flatnonzero(np.abs(total[:FEATURES]).sum(axis=1))
        for start in range(0, len(rows), 2048):
            part = rows[start:start + 2048]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), *[pa.array(total[part, k], pa.float32()) for k in range(RANK)]], names=["feature", *[f"z{k}" for k in range(RANK)]]
            )

    return step


def factorise(words: DataFrame, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(idf, directions): whitened leading directions, FEATURES x RANK. Two passes over all words.

    What reaches the driver is the model: FEATURES rows, summed on the cluster.
    """
    counts = words.mapInArrow(_document_counts, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    total = sum(r["n"] for r in counts if r["feature"] == -1)
    df = np.zeros(FEATURES)
    for r in counts:
        if r["feature"] >= 0:
            df[r["feature"]] = r["n"]
    # Words of all passages weigh next to nothing, not nothing, so that no text is without a place.
    idf = (np.log((total + 1) / (df + 1)) + 1e-3).astype(np.float32)
    schema = "feature int, " + ", ".join(f"z{k} float" for k in range(RANK))
    sums = words.mapInArrow(_products(idf, seed), schema).groupBy("feature").agg(*[F.sum(f"z{k}").cast("float").alias(f"z{k}") for k in range(RANK)])
    found = sums.toArrow()
    z = np.zeros((FEATURES, RANK))
    if found.num_rows:
        z[found.column("feature").to_numpy()] = np.column_stack([found.column(f"z{k}").to_numpy() for k in range(RANK)])
    # Nystrom: A'A is about Z (R'Z)^-1 Z'. Its root has the singular vectors and values.
    core = _random(seed).astype(np.float64).T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 1e-12) * 1e-9
    root = z @ (vectors[:, good] / np.sqrt(np.maximum(values[good], 1e-30)))
    directions, singular, _ = np.linalg.svd(root, full_matrices=False)
    keep = singular > max(singular.max(initial=0), 1e-12) * 1e-6
    # singular is the square root of A'A's eigenvalue, so of A's singular value: whitening divides by its square's root.
    return idf, (directions[:, keep] / singular[keep]).astype(np.float32)


def _common(masks: dict[int, int], length: int, window: np.ndarray) -> int:
    """Length of the longest common subsequence of an item, given as positions per word, and a window; bits run in parallel."""
    full = (1 << length) - 1
    row = full
    for w in window.tolist():
        mask = masks.get(w)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


class _Items:
    """The benchmark, projected, the rarer words of the items, and what the check needs of each."""

    def __init__(self, rows: list[dict], idf: np.ndarray, directions: np.ndarray, min_share: float, sure_share: float):
        self.rows, self.min_share, self.sure_share = rows, min_share, sure_share
        self.weighted = _padded(directions * idf[:, None])
        vectors: dict[int, list] = {}
        self.owner: dict[int, list] = {}
        self.masks, self.keys, self.times = [], [], []
        #: Words of an item that must be found at the least, and those of them that must be rarer ones.
        self.least, self.rarer, entries = [], [], []
        for number, row in enumerate(rows):
            words = row["words"]
            masks: dict[int, int] = {}
            for i, w in enumerate(words.tolist()):
                masks[w] = masks.get(w, 0) | 1 << i
            self.masks.append(masks)
            self.times.append({w: m.bit_count() for w, m in masks.items()})
            if len(row["answer"]):
                keys = set(row["answer"].tolist())
            else:
                by_rarity = sorted(set(words.tolist()), key=lambda w: (-idf[w & (FEATURES - 1)], w))
                keys = set(by_rarity[:max(1, len(by_rarity) // 4)])
            self.keys.append(keys)
            least = next(n for n in range(len(words) + 1) if n / len(words) >= min(min_share, sure_share))
            rarer = min(least, max(1, least // 3))
            self.least.append(least)
            self.rarer.append(rarer)
            # Only len - least words may lack, so of these at least ``rarer`` are there.
            by_rarity = sorted(words.tolist(), key=lambda w: (-idf[w & (FEATURES - 1)], w))
            entries.extend((w, number, n) for w, n in Counter(by_rarity[:len(words) - least + rarer]).items())
            size = min(2 * PASSAGE, max(PASSAGE // 2, _STEP * round(len(words) / _STEP)))
            for start in range(0, max(1, len(words) - size + 1), PASSAGE):
                part = words[start:start + size] & (FEATURES - 1)
                vectors.setdefault(size, []).append(self.weighted[part].sum(axis=0))
                self.owner.setdefault(size, []).append(number)
        self.vectors = {size: self._unit(np.array(v, np.float32)) for size, v in sorted(vectors.items())}
        self.vocabulary = np.unique(np.concatenate([r["words"] for r in rows])) if rows else np.empty(0, np.uint32)
        self.codes = [np.searchsorted(self.vocabulary, np.unique(r["words"])) for r in rows]
        found = np.array(sorted(entries), np.int64).reshape(-1, 3)
        self.indexed, self.starts, self.lengths = np.unique(found[:, 0], return_index=True, return_counts=True)
        self.postings, self.counts = found[:, 1], found[:, 2]
        self.marked = np.zeros(1 << _MARK_BITS, bool)
        self.marked[self.vocabulary & ((1 << _MARK_BITS) - 1)] = True

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)

    def search(self, words: list[np.ndarray], min_cosine: float, exact: bool) -> Iterator[tuple[int, int, np.ndarray | None]]:
        """(text, item, starts) to check, in order: the places to look at, or None for all of them."""
        if not self.rows or not sum(map(len, words)):
            return
        if exact:
            for pair in self._sharing(words).tolist():
                yield pair // len(self.rows), pair % len(self.rows), None
            return
        held = self._holding(words, *self._near(words, min_cosine))
        order = np.lexsort((held[2], held[1], held[0]))
        text, item, start = (h[order] for h in held)
        edges = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]))) if len(text) else []
        for first, end in zip(edges, np.append(edges[1:], len(text)) if len(text) else []):
            yield int(text[first]), int(item[first]), start[first:end]

    def _near(self, words: list[np.ndarray], min_cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, start) of the windows near a passage of an item; ``start`` is a place in the text."""
        # Windows end with their text, whose last blocks are empty.
        most = max(self.vectors) // _FINE
        blocks, rows = _blocks(words, _FINE, most - 1)
        out: list[tuple] = []
        if self.weighted.shape[1]:
            owner = np.repeat(np.arange(len(words)), rows)
            firsts = np.arange(len(blocks)) - (np.cumsum(rows) - rows)[owner]
            for start in range(0, len(blocks) - most + 1, _CACHED):
                # Sums of 1, 2, 4, ... blocks, of which windows are put together.
                runs = {1: _row_sums(self.weighted, blocks[start:start + _CACHED + most - 1])}
                for n in (2, 4, 8, 16):
                    if n <= most:
                        runs[n] = runs[n // 2][:-(n // 2)] + runs[n // 2][n // 2:]
                count = len(runs[1]) - most + 1
                for size, queries in self.vectors.items():
                    # Long windows start at every second block.
                    step = 1 if size <= _SHORT else _STEP // _FINE
                    window, at = None, 0
                    for n in runs:
                        if size // _FINE & n:
                            part = runs[n][at:at + count:step]
                            window, at = part if window is None else window + part, at + n
                    bound = min_cosine * np.sqrt(np.einsum("ij,ij->i", window, window))
                    which, query = np.divmod(np.flatnonzero(window @ queries.T >= np.maximum(bound, 1e-9)[:, None]), len(queries))
                    begin = start + which * step
                    out.append((owner[begin], np.array(self.owner[size])[query], firsts[begin] * _FINE))
        none = np.empty(0, np.int64)
        return tuple(np.concatenate([none, *part]) for part in zip(*out)) if out else (none, none, none)

    def _holding(self, words: list[np.ndarray], text: np.ndarray, item: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the candidates with as many words of the item as the check asks for, in and about their window."""
        flat, lengths = np.concatenate(words), np.array([len(w) for w in words])
        # Words as numbers in the items' vocabulary; the last number is for all others, and for the gaps that are left between texts.
        gap = 2 * _STEP + max(len(row["words"]) * 5 // 4 for row in self.rows) + 1
        firsts = np.cumsum(lengths + gap) - lengths
        codes = np.full(int(firsts[-1] + lengths[-1]) + gap, len(self.vocabulary))
        at = np.flatnonzero(self.marked[flat & ((1 << _MARK_BITS) - 1)])
        slot = np.minimum(np.searchsorted(self.vocabulary, flat[at]), len(self.vocabulary) - 1)
        shift = np.repeat(firsts - (np.cumsum(lengths) - lengths), lengths)
        codes[at + shift[at]] = np.where(self.vocabulary[slot] == flat[at], slot, len(self.vocabulary))
        order = np.argsort(item, kind="stable")
        edges = np.searchsorted(item[order], np.arange(len(self.rows) + 1))
        known, kept = np.zeros(len(self.vocabulary) + 1, np.float32), []
        for number in np.flatnonzero(np.diff(edges)).tolist():
            rows = order[edges[number]:edges[number + 1]]
            known[self.codes[number]] = 1
            # A leak begins within half a step of a window, and is at most a quarter longer than the item.
            width = len(self.rows[number]["words"]) * 5 // 4 + 2 * _STEP
            around, ones = np.lib.stride_tricks.sliding_window_view(codes, width), np.ones(width, np.float32)
            place = firsts[text[rows]] + start[rows] - _STEP
            for begin in range(0, len(rows), _CACHED):
                held = known[around[place[begin:begin + _CACHED]]] @ ones
                kept.append(rows[begin:begin + _CACHED][held >= self.least[number]])
            known[self.codes[number]] = 0
        kept = np.concatenate([np.empty(0, np.int64), *kept])
        return text[kept], item[kept], start[kept]

    def _sharing(self, words: list[np.ndarray]) -> np.ndarray:
        """Text times number of items plus item, where the text holds enough of the item's rarer words for the check to pass."""
        flat, owner = np.concatenate(words), np.repeat(np.arange(len(words)), [len(w) for w in words])
        at = np.flatnonzero(self.marked[flat & ((1 << _MARK_BITS) - 1)])
        slot = np.minimum(np.searchsorted(self.indexed, flat[at]), len(self.indexed) - 1)
        same = self.indexed[slot] == flat[at]
        # Each word once a text.
        text, slot = np.divmod(np.unique(owner[at[same]] * len(self.indexed) + slot[same]), len(self.indexed))
        lengths, items, rarer, out = self.lengths[slot], len(self.rows), np.array(self.rarer), [np.empty(0, np.int64)]
        # Whole texts, about four million postings at a time; one text has no more than all items.
        ends, start = np.flatnonzero(np.append(text[1:] != text[:-1], True)) + 1 if len(text) else [], 0
        total = np.cumsum(lengths)
        for i, end in enumerate(ends):
            if i < len(ends) - 1 and total[ends[i + 1] - 1] - (total[start - 1] if start else 0) <= 4_000_000:
                continue
            n = lengths[start:end]
            place = np.repeat(self.starts[slot[start:end]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            pair, inverse = np.unique(np.repeat(text[start:end], n) * items + self.postings[place], return_inverse=True)
            out.append(pair[np.bincount(inverse, self.counts[place]) >= rarer[pair % items]])
            start = end
        return np.concatenate(out)

    def check(self, text: np.ndarray, item: int, near: np.ndarray | None = None) -> float:
        """The largest share of the item that a place of the text has, 0 when none counts as a leak.

        Only places within a quarter of an item's length of ``near`` are looked at, or all of them without it.
        """
        length, least, masks, keys = len(self.rows[item]["words"]), self.least[item], self.masks[item], self.keys[item]
        # Windows little longer than the item, so that stray words of a long stretch do not add up.
        width = length + max(1, length // 4)
        last = max(1, len(text) - width + 1)
        if near is None:
            starts = np.arange(last)
        else:
            reach = length // 4 + _STEP
            starts = np.unique(np.clip((near[:, None] + np.arange(-reach, reach + 1)).ravel(), 0, last - 1))
        # Words of the item, counted over the part of the text that the windows cover.
        first, part = int(starts[0]), text[starts[0]:starts[-1] + width]
        own = self.vocabulary[self.codes[item]]
        slot = np.minimum(np.searchsorted(own, part), len(own) - 1)
        known = np.append(0, np.cumsum(own[slot] == part))
        starts = starts[known[np.minimum(starts - first + width, len(part))] - known[starts - first] >= least]
        best, after = 0, 0
        for start in starts.tolist():
            if start < after:
                continue
            found = _common(masks, length, text[start:start + width])
            needed = max(least, best + 1)
            if found < needed:
                # A window that starts n words later has at most n words more.
                after = start + needed - found
                continue
            around = text[max(0, start - length - PASSAGE):start + width + length + PASSAGE]
            if found / length >= self.sure_share or found / length >= self.min_share and len(keys & set(around.tolist())) >= 0.6 * len(keys):
                best = found
            if best == length:
                break
        return best / length


def search(
    docs: DataFrame, items: DataFrame, min_cosine: float = 0.45, min_share: float = 0.6, sure_share: float = 0.8, max_items: int = 20_000,
    exact: bool = False,
) -> DataFrame:
    """(doc_id, tie, item_id, share) of all leaks: documents and items, with the largest share of the item found.

    ``tie`` is the hash of the document's text. ``items`` has item_id, text and, if there is one, answer.
    """
    answer = F.coalesce(F.col("answer").cast("string"), F.lit("")) if "answer" in items.columns else F.lit("")
    listed = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), answer.alias("answer"))
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    words = stored(source.mapInArrow(_hashed, "doc_id bigint, tie bigint, words binary"), "word-hashes")
    idf, directions = factorise(words)
    parts = max(1, -(-listed.count() // max_items))
    found = None
    for part in range(parts):
        # Parts by hash are of about the same size.
        own = listed if parts == 1 else listed.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        leaks = _search(words, own, items.schema["item_id"].dataType.simpleString(), (idf, directions), min_cosine, min_share, sure_share, exact)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def _search(words: DataFrame, listed: DataFrame, kind: str, space: tuple, min_cosine: float, min_share: float, sure_share: float, exact: bool) -> DataFrame:
    hasher = _Hasher()
    rows = sorted(({"item_id": r["item_id"], "words": hasher(r["text"]), "answer": hasher(r["answer"])} for r in listed.collect()), key=lambda r: str(r["item_id"]))
    model = words.sparkSession.sparkContext.broadcast(([r for r in rows if len(r["words"])], *space))
    whole = kind in ("int", "bigint")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = _Items(*model.value, min_share, sure_share)
        for part, texts in _texts(batches):
            best, around, held = {}, None, frozenset()
            for i, item, near in benchmark.search(texts, min_cosine, exact):
                if around != i:
                    around, held = i, frozenset(texts[i].tolist())
                # A common subsequence is no longer than the part of the item whose words stand in the text at all.
                if sum(map(benchmark.times[item].__getitem__, benchmark.times[item].keys() & held)) >= benchmark.least[item]:
                    best[i, item] = benchmark.check(texts[i], item, near)
            hits = [(i, item, share) for (i, item), share in sorted(best.items()) if share > 0]
            at = pa.array([i for i, _, _ in hits], pa.int32())
            ids = pa.array([benchmark.rows[item]["item_id"] for _, item, _ in hits])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(at), part.column("tie").take(at), ids.cast(pa.int64()) if whole else ids.cast(pa.string()), pa.array([s for *_, s in hits], pa.float64())],
                names=["doc_id", "tie", "item_id", "share"],
            )

    return words.mapInArrow(find, f"doc_id bigint, tie bigint, item_id {'bigint' if whole else 'string'}, share double")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    leaks = stored(search(docs, items).select("doc_id", "tie").distinct(), "leaks")
    keyed = docs.select(sealed(docs), F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_tie"))
    same = (F.col("_tie") == F.col("tie")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    return opened(keyed.join(leaks, same, "left_anti"), docs.columns)


@query("op3_decontaminate")
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select("doc_id", "item_id", "share")
