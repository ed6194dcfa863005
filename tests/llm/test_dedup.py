"""Shared lines, fingerprints and the Jaccard join against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from loamwork.llm import components, fingerprints, jaccard, lines
from loamwork.llm.common import ORACLES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_components(texts: dict):
    """Smallest id reachable over links, compared pair by pair."""
    sets = {k: shingle_set(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (len(sets[k]), find(k)) for k in sets}


def edited_texts(seed, n):
    """Base texts, copies with a few words changed at random, texts around a common passage, and odd ones."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [chance.choice(vocabulary) for _ in range(60)]
    texts = []
    for group in range(6):
        base = [chance.choice(vocabulary) for _ in range(chance.randint(8, 120))]
        if group % 2:
            base = passage + base[:chance.randint(5, 20)]
        for _ in range(n):
            words = list(base)
            for _ in range(chance.randint(0, max(1, len(words) // 30))):
                words[chance.randrange(len(words))] = chance.choice(vocabulary)
            if chance.random() < 0.3:
                words = words[: -chance.randint(1, 4)]
            texts.append(" ".join(words))
    return texts + [texts[0], texts[0].upper(), "", "   ", None, "one", "One", "a b c d e", "a b c d e"]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    texts = dict(enumerate(edited_texts(seed, 12)))
    docs = spark.createDataFrame([(k, t, 0, 1) for k, t in texts.items()], "doc_id bigint, text string, n int, v int")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_copies(docs).collect()}
    assert found == brute_components(texts)


def test_jaccard_on_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_copies(docs).collect()}
    assert found == brute_components(texts)


def test_partial_overlaps_sum_to_the_overlap(spark):
    """Parts cut at pivots hold each set once, and their overlaps add up to those of the sets."""
    chance = random.Random(8)
    sets = {v: sorted(chance.sample(range(-500, 500), chance.randint(1, 300))) for v in range(20)}
    df = {s: sum(s in x for x in sets.values()) for s in range(-500, 500)}
    rows = [(v, len(x), [(df[s], s * 2**53) for s in sorted(x, key=lambda s: (df[s], s))]) for v, x in sets.items()]
    frame = spark.createDataFrame(rows, "v bigint, n bigint, order array<struct<df:bigint,s:bigint>>")
    shared = spark.createDataFrame([(s * 2**53, n) for s, n in df.items() if n > 1], "s bigint, df bigint")
    cuts = jaccard.pivots(shared, 4)
    assert len(cuts) == 3 and cuts == sorted(cuts)
    parts = frame.mapInArrow(jaccard._cut(cuts), jaccard._PARTS).cache()
    for v, x in sets.items():
        own = sorted((r for r in parts.collect() if r.v == v), key=lambda r: r.fragment)
        assert sorted(s for r in own for s in r.s) == [s * 2**53 for s in x]
        assert all(r.s == sorted(r.s) and r.before + len(r.s) + r.after == len(x) for r in own)
        assert [r.before for r in own] == [sum(len(q.s) for q in own[:k]) for k in range(len(own))]
    pairs = [(a, b) for a in sets for b in sets if a < b]
    found = {tuple(r) for r in jaccard._links(spark.createDataFrame(pairs, "centre bigint, v bigint"), parts).collect()}
    assert found == {(a, b) for a, b in pairs if 9 * len(set(sets[a]) & set(sets[b])) >= 4 * (len(sets[a]) + len(sets[b]))}


def template_documents(n, seed=4):
    """Documents of ten of forty template blocks each; hardly any two of them link."""
    chance = random.Random(seed)
    blocks = [" ".join(f"b{k}w{chance.randrange(10**6)}" for _ in range(30)) for k in range(40)]
    return [" ".join(chance.sample(blocks, 10)) for _ in range(n)]


def test_documents_of_template_blocks(spark):
    texts = dict(enumerate(template_documents(150)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_copies(docs).collect()} == brute_components(texts)


def test_jaccard_of_long_texts_and_repeated_rows(spark):
    long = " ".join(f"w{i * 7919 % 50021}" for i in range(50_000))
    rows = [(1, long), (2, long + " and a tail"), (3, long[: len(long) // 2]), (2, long + " and a tail"), (4, "z" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r.doc_id, r.component_id) for r in jaccard.near_copies(docs).collect())
    assert found == [(1, 1), (2, 1), (2, 1), (3, 3), (4, 4)]


def test_jaccard_links_through_two_centres(spark):
    """A chain of texts where only neighbours link is one component, whichever text is a centre."""
    words = [f"x{i}" for i in range(100)]
    chain = [" ".join(words[8 * i:8 * i + 60] if i else words[:60]) for i in range(5)]
    # A shift by 8 words of 60 is too far, one by 5 is near enough.
    near = [" ".join(words[5 * i:5 * i + 60]) for i in range(8)]
    texts = dict(enumerate(chain + near))
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_copies(docs).collect()}
    assert found == brute_components(texts)


def test_keep_one_of_each_component(spark):
    rows = [(5, "a b c d e f"), (3, "A b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (7, ""), (8, None), (9, "other")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("root", F.lit("kept"))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8, 9]
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_components_of_long_chains_and_stars(spark):
    chance = random.Random(5)
    names = list(range(200))
    chance.shuffle(names)
    edges = list(zip(names[:80], names[1:81])) + [(names[100], n) for n in names[101:150]] + [(names[100], names[100])]
    found = dict(components.components(spark.createDataFrame(edges, "a bigint, b bigint")).select("v", "root").collect())
    assert {found[n] for n in names[:81]} == {min(names[:81])}
    assert {found[n] for n in names[100:150]} == {min(names[100:150])}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_lines_agree_with_sql(spark):
    assert compare(spark, connect(FOLDER), lines.line_dedup, ORACLES["op1_line_dedup"], FOLDER) == ""


def test_lines_near_the_threshold_are_counted_exactly(spark):
    """With 9, 10 and 11 sources around a threshold of 10, and one far above it."""
    rows, doc = [], 0
    for sites, name in ((9, "nine"), (10, "ten"), (11, "eleven"), (60, "sixty")):
        for s in range(sites):
            for _ in range(2):
                rows.append((doc, f"own {doc}\n {name} \n", f"s{s}"))
                doc += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("_gone", F.lit(1))
    result = {r.doc_id: r for r in lines.remove_shared_lines(docs, 10).collect()}
    firsts = {name: min(d for d, t, _ in rows if f" {name} " in t) for name in ("ten", "eleven", "sixty")}
    for d, text, _ in rows:
        name = text.split()[2]
        if name == "nine" or firsts[name] == d:
            assert (result[d].text, result[d].n_removed) == (text, 0)
        else:
            assert (result[d].text, result[d].n_removed) == (f"own {d}\n", 1)


def test_lines_with_odd_rows(spark):
    rows = [(1, None, None, 7), (2, "", "a", 1), (3, "x\nx\n y", "a", 1), (3, "x\nx\n y", "a", 1), (None, "x", "b", 1), (5, " x \nz", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_removed int")
    found = sorted(((r.doc_id or -1, r.text, r.n_removed) for r in lines.remove_shared_lines(docs, 3).collect()), key=str)
    assert found == sorted([(1, None, 0), (2, "", 0), (3, "x\nx\n y", 0), (3, " y", 2), (-1, "", 1), (5, "z", 1)], key=str)
    assert lines.remove_shared_lines(docs.limit(0), 3).count() == 0


def test_edited_texts_and_estimates(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in fingerprints.fingerprints(spark, FOLDER).collect()}
    for at, d in enumerate(order):
        text, after = texts[d], texts[order[(at + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert found[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingle_set(text), shingle_set(edited)
        assert abs(found[d].near_edited - len(a & b) / len(a | b)) < 0.2
        assert found[d].n_chars == len(text)


def test_sketches_merge_and_estimate(spark):
    # More words than one part of a sketch holds, so parts are merged.
    words = [f"t{i * 7919 % 30011}" for i in range(40_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:20_000])), (3, "a b"), (4, "a b"), (5, None), (6, "")]
    frame = spark.createDataFrame(rows, "id bigint, text string").withColumn("s", fingerprints.sketch(F.col("text"), 64))
    got = {r.id: r.s for r in frame.collect()}
    assert got[3] == got[4] and got[5] == got[6] == []
    pair = frame.where("id = 1").select(F.col("s").alias("a")).join(frame.where("id = 2").select(F.col("s").alias("b")))
    union, whole, part, same, inside = pair.select(
        fingerprints.merged(F.col("a"), F.col("b"), 64), fingerprints.distinct_count(F.col("a"), 64), fingerprints.containment(F.col("a"), F.col("b"), 64),
        fingerprints.resemblance(F.col("a"), F.col("b"), 64), fingerprints.containment(F.col("b"), F.col("a"), 64),
    ).first()
    assert union == got[1]
    assert abs(whole / len(shingle_set(rows[0][1])) - 1) < 0.4
    true = len(shingle_set(rows[1][1])) / len(shingle_set(rows[0][1]))
    assert abs(part - true) < 0.2 and abs(same - true) < 0.2 and inside > 0.7
    assert fingerprints.corpus_sketch(frame.where("id < 3").withColumn("g", F.lit(1)), ["g"], 64).first().sketch == got[1]


def test_neighbours_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, "abc"), (None, "xyz"), (2, "abc"), (4, "")], "doc_id bigint, text string")
    found = sorted((str(r.doc_id), r.text, r.next_text, r.edited) for r in fingerprints.edited_neighbours(docs).collect())
    assert found == [("1", "", "xyz", ""), ("2", "abc", "", "ab"), ("2", "abc", "abc", "aba"), ("4", "", "abc", ""), ("None", "xyz", "", "xy")]
    assert fingerprints.edited_neighbours(docs.limit(0)).count() == 0
    alone = fingerprints.edited_neighbours(docs.where("doc_id = 2").limit(1)).first()
    assert alone.edited == "aba"
