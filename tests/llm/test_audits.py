"""Quality votes, source divergence and the Merkle manifest against brute force and held-out rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamwork.llm import divergence, manifest, quality
from loamwork.llm.common import held_out, lowered

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# Quality

def test_vote_equals_a_loop():
    rng = np.random.default_rng(5)
    vectors = quality._unit(rng.standard_normal((60, 6)))
    vectors[10:14] = vectors[9]
    texts, labels = quality._unit(rng.standard_normal((40, 6))), rng.integers(0, 2, 60).astype(float)
    texts[7] = vectors[9]
    texts[8] = 0
    found = quality.vote(texts, vectors, labels, 5, 3)
    for i, text in enumerate(texts):
        cosines = [max(0.0, float(text @ v)) for v in vectors]
        last = sorted(cosines)[-5]
        heard = [(c**3, y) for c, y in zip(cosines, labels) if c >= last]
        weight = sum(w for w, _ in heard)
        assert found[i] == pytest.approx(sum(w * y for w, y in heard) / weight if weight > 1e-12 else labels.mean())
    assert (quality.vote(texts, vectors[:0], labels[:0], 5, 3) == 0.5).all()


def test_features_of_a_text():
    count = quality._Counter()

    def named(text):
        ids, times = count(text)
        return dict(zip(ids.tolist(), times.tolist()))

    assert named(None) == named("") == named(" \n") == {}
    assert named("Word word") != named("word word")
    # Letters and shapes are counted by themselves: marks change shapes alone.
    plain, marked = named("alpha beta"), named("alpha,### beta")
    words = {k: v for k, v in plain.items() if k < quality.WORDS}
    assert words == {k: v for k, v in marked.items() if k < quality.WORDS} and plain != marked
    assert sum(named("x" * 50_000 + " y" * 50_000).values()) > 100_000


def test_quality_on_held_out_rows(spark):
    found = quality.quality(spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_of_odd_rows(spark):
    rows = [(i, f"plain words number {i} are said here", 1) for i in range(20)] + [(100 + i, f"JUNK!! WORDS!! {i}!!", 0) for i in range(20)]
    rows += [(None, None, 1), (None, "", 0), (7, rows[7][1], 1), (7, rows[7][1], 1), (500, "%% " * 30_000, None)]
    docs = spark.createDataFrame([(*r[:2], 0.5, "order") for r in rows], "doc_id bigint, text string, score double, `order` string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, quality int")
    features = quality.featured(docs)
    model = quality.fit(features, labels, ~held_out())
    scored = quality.score(features, model, neighbours=3).collect()
    assert len(scored) == len(rows)
    by_id = defaultdict(set)
    for r in scored:
        by_id[r.doc_id].add(round(r.score, 9))
    assert all(len(by_id[i]) == 1 for i in (*range(20), 500))
    assert all(min(by_id[i]) > 0.7 for i in range(20)) and all(max(by_id[100 + i]) < 0.7 for i in range(20))
    usual = float(model["labels"].mean())
    assert by_id[None] == {round(usual, 9)}
    # Copies of a text are one vector.
    assert len(model["labels"]) == len({r[1] for r in rows if r[2] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 4 != 2})
    unlabelled = quality.fit(features, labels.limit(0), ~held_out())
    assert {r.score for r in quality.score(features, unlabelled).collect()} == {0.5}
    nothing = quality.featured(docs.limit(0))
    assert quality.score(nothing, quality.fit(nothing, labels, ~held_out())).count() == 0


# Divergence

def divergence_by_hand(rows, min_docs, top):
    """(lang, source, part, item, value, rank) from rows of (text, lang, source)."""
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), lang or "", source or "") for text, lang, source in rows]
    out = []
    for lang in {d[1] for d in docs}:
        here = [d for d in docs if d[1] == lang]
        having = Counter(t for words, *_ in here for t in set(words))
        kept = [t for t, n in having.items() if n >= min_docs]
        groups = {s: Counter() for _, _, s in here}
        for words, _, s in here:
            groups[s].update(w for w in words if having[w] >= min_docs)
        whole = sum(groups.values(), Counter())

        def share(counts, t):
            return 1 + 1000000000 * (counts[t] + 2) // (sum(counts.values()) + 2 * len(kept))

        shares = {s: {t: share(c, t) for t in kept} for s, c in groups.items()}
        lang_shares = {t: share(whole, t) for t in kept}
        for s in groups:
            pairs = [(-sum((shares[s][t] - shares[o][t]) ** 2 // (shares[s][t] + shares[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-((shares[s][t] - lang_shares[t]) ** 2 // (shares[s][t] + lang_shares[t])), t.encode(), t) for t in kept if groups[s][t] and shares[s][t] > lang_shares[t]]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


def test_divergence_equals_a_loop(spark):
    rng = np.random.default_rng(2)
    letters = [f"{a}{b}" for a in "abcdefghijkl" for b in ("é", "x", "zz", "Ω", "𝒳")]
    rows = []
    # More groups than a tile has rows, and more terms than it has columns.
    for i in range(500):
        source = f"s{int(rng.integers(0, 70))}"
        words = rng.choice(letters, int(rng.integers(0, 12)), p=None if i % 3 else np.arange(1, 61) / 1830)
        rows.append((" ".join(str(w).upper() if w.isascii() else str(w) for w in words), "xx" if i % 4 else "yy", source))
    rows += [(None, "xx", "only-null"), ("", None, None), ("a1b_c-d a", None, None), ("alone", "zz", "one"), (rows[0][0], "xx", ""), rows[1], rows[1]]
    frame = spark.createDataFrame([(*r, 1, "g", 2) for r in rows], "text string, lang string, source string, n int, term string, at int")
    found = sorted(tuple(r) for r in divergence.audit(frame, min_docs=4, top=3).collect())
    assert found == divergence_by_hand(rows, 4, 3)


def test_divergence_of_long_texts_and_of_nothing(spark):
    rows = [("word " * 50_000 + "other", "l", "a"), ("word other " * 3, "l", "b"), ("other", "l", "c")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence.audit(frame, min_docs=1).collect()) == divergence_by_hand(rows, 1, 10)
    assert divergence.audit(frame.limit(0)).count() == 0
    # No term is kept: all pairs are there, with the value 0.
    assert {(r.part, r.value) for r in divergence.audit(frame, min_docs=9).collect()} == {("pair", 0)}


def test_descent_equals_the_whole_quadrant():
    rng = np.random.default_rng(4)
    a, b = (rng.integers(1, 10**9, (64, 64)) * (rng.random((64, 64)) < share) for share in (0.2, 0.02))
    a[:, 32:] = 0
    p0, q0 = rng.integers(1, 1000, 64), rng.integers(1, 1000, 64)
    out = np.zeros((64, 64), np.int64)
    divergence.descend(a, b, p0, q0, out)

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for g in range(64):
        for h in range(64):
            p, q = np.where(a[g] > 0, a[g], p0[g]), np.where(b[h] > 0, b[h], q0[h])
            only = [f(x, q0[h]) if x != p0[g] else 0 for x in p], [f(p0[g], y) for y in q]
            zeros = f(p0[g], q0[h])
            priced = sum(f(x, q0[h]) - zeros for x in a[g][a[g] > 0]) + sum(f(p0[g], y) - zeros for y in b[h][b[h] > 0]) + 64 * zeros
            assert only and priced + out[g, h] == sum(f(x, y) for x, y in zip(p.tolist(), q.tolist()))


# Manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def folded(digests, passed):
    """The root of a run tree, and for each leaf the siblings passed as (before, after)."""
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, owned = [], []
        for start in range(0, len(digests), 16):
            run = digests[start:start + 16]
            for k, owner in enumerate(owners[start:start + 16]):
                for i in owner:
                    passed[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(sha("".join(run)))
            owned.append([i for owner in owners[start:start + 16] for i in owner])
        digests, owners = above, owned
    return digests[0]


def manifest_by_hand(rows, found):
    sources = defaultdict(list)
    for (doc_id, text, lang, source, n), other in zip(rows, found):
        sources[source].append((doc_id, leaf_of(doc_id, source, lang, n, text), leaf_of(doc_id, source, lang, n, other)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    kept, subroots = {}, []
    for s in order:
        leaves = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        passed = defaultdict(list)
        subroots.append(folded([r[1] for r in leaves], passed))
        kept[s] = leaves, passed
    tops = defaultdict(list)
    root = folded(subroots, tops)
    out = []
    for i, s in enumerate(order):
        leaves, passed = kept[s]
        for k, (doc_id, leaf, shown) in enumerate(leaves):
            way, value = passed[k] + tops[i], shown
            for before, after in way:
                value = sha(before + value + after)
            out.append((doc_id, leaf, subroots[i], root, sha("".join(b + a for b, a in way)), value, value == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_manifest_equals_a_loop(spark, sources):
    rng = np.random.default_rng(sources)
    rows = []
    for i in range(700):
        # One source has most rows.
        s = 0 if i % 3 else int(rng.integers(0, sources))
        rows.append((int(rng.integers(0, 500)), f"Text {rng.integers(0, 9)} ÄÖ" * int(rng.integers(0, 3)), "en" if i % 5 else None, f"s{s}", i if i % 7 else None))
    if sources > 1:
        rows += [(None, None, None, None, None), (None, "A", "x", None, 1), (5, "", "", "", 0), (5, "", "", "", 0), (9, "Z" * 100_000, "x", "é", 2)]
    rows += [rows[3], rows[3]]
    frame = spark.createDataFrame([(*r, "leaf", 7, "up") for r in rows], f"{DOCS}, leaf string, tree int, up string")
    text = F.when(F.col("doc_id") % 2 == 0, lowered(F.col("text"))).otherwise(F.col("text"))
    shown = [re.sub("[A-Z]", lambda m: m[0].lower(), r[1]) if r[1] is not None and r[0] is not None and r[0] % 2 == 0 else r[1] for r in rows]
    found = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in manifest.audit(frame, text).collect()]
    assert sorted(found, key=repr) == manifest_by_hand(rows, shown)


def test_manifest_of_one_row_and_of_none(spark):
    row = [(4, "Abc", "en", "s", 3)]
    found = manifest.audit(spark.createDataFrame(row, DOCS), lowered(F.col("text"))).collect()
    leaf = leaf_of(4, "s", "en", 3, "Abc")
    assert [(r.leaf, r.subroot, r.root, r.proof_sha256, r.verified) for r in found] == [(leaf, leaf, leaf, sha(""), False)]
    assert manifest.audit(spark.createDataFrame([], DOCS), F.col("text")).count() == 0


def test_recursion_keeps_the_callers_limit(spark):
    key = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(key, "17")
    try:
        rows = [(i, "t", "en", "s", 1) for i in range(600)]
        assert manifest.audit(spark.createDataFrame(rows, DOCS), F.col("text")).where("verified").count() == 600
        assert spark.conf.get(key) == "17"
    finally:
        spark.conf.unset(key)
