"""Toxicity, language, leaks and urls on held-out rows, literal cases and brute force."""

import re

import numpy as np
from pyspark.sql import functions as F

from loamwork.llm import decontaminate, language, toxicity, urls
from loamwork.llm.common import held_out

FOLDER = "/root/testdata/sf0.01"


def test_machine_kinds():
    grammar = toxicity.Grammar({w: toxicity._CLASSES[c] for c, ws in toxicity._SEEDS.items() for w in ws}, {"grobl": 1})

    def kinds(text):
        return {k: n for k, n in zip(toxicity.KINDS, grammar.counts(text)) if n}

    assert kinds("you idiot") == {"insult_at_target": 1}
    assert kinds("what an idiot. you came") == {"insult": 1}
    assert kinds("you are not an idiot") == {"negated": 1}
    assert kinds("she said he is a moron and a grobling") == {"reported": 2}
    assert kinds("I will hurt them") == {"threat_at_target": 1}
    assert kinds("you, I will hurt") == {"threat_at_target": 1}
    assert kinds("hurt. you") == {} and kinds(None) == {} and kinds("") == {}
    assert kinds("I will never hurt you") == {"threat_negated": 1}
    assert kinds("he said they would kill them") == {"threat_reported": 1}
    assert kinds("kill them. never hurt you, people") == {"threat_at_target": 1, "threat_negated": 1}
    assert kinds("Er sagte, du bist ein Trottel") == {"reported": 1} and kinds("je vais te frapper, toi") == {"threat_at_target": 1}
    assert kinds("nunca eres un idiota") == {"negated": 1}


def clause_kinds(classes):
    """Matches of one clause, by looking at the places of its classes."""
    insults = [i for i, c in enumerate(classes) if c == 1]
    found, waiting = [], None
    before = {4: False, 5: False}
    for i, c in enumerate(classes):
        targets = any(x == 3 for x in classes[:i])
        if c in before and not any(x == 1 for x in classes[:i]) and waiting is None:
            before[c] = True
        kind = "threat_reported" if before[5] else "threat_negated" if before[4] else "threat_at_target"
        if c == 2 and targets:
            found.append(kind)
        elif c == 2:
            waiting = i
        elif c == 3 and waiting is not None:
            found.append(kind)
            waiting = None
    for k, i in enumerate(insults):
        # An insult hears of targets up to the next one.
        end = insults[k + 1] if k + 1 < len(insults) else len(classes)
        aimed = any(x == 3 for x in classes[:end])
        marks = classes_before(classes, insults[0])
        found.append("reported" if 5 in marks else "negated" if 4 in marks else "insult_at_target" if aimed else "insult")
    return found


def classes_before(classes, first):
    """Negations and reports before the first insult, without those that came while a threat waited for its target."""
    marks, waiting = set(), False
    for i, c in enumerate(classes[:first]):
        if c == 2 and not any(x == 3 for x in classes[:i]):
            waiting = True
        elif c == 3:
            waiting = False
        elif c in (4, 5) and not waiting:
            marks.add(c)
    return marks


def test_kinds_equal_a_parse_of_clauses():
    grammar = toxicity.Grammar({"i": 1, "t": 2, "g": 3, "n": 4, "r": 5}, {})
    rng = np.random.default_rng(9)
    for _ in range(3000):
        clauses = [["witgnr"[k] for k in rng.integers(0, 6, int(rng.integers(0, 9)))] for _ in range(int(rng.integers(1, 4)))]
        want = [kind for clause in clauses for kind in clause_kinds([" itgnr".index(c) if c != "w" else 0 for c in clause])]
        got = grammar.counts(". ".join(" ".join(c) for c in clauses))
        assert {k: n for k, n in zip(toxicity.KINDS, got) if n} == {k: want.count(k) for k in want}, clauses


def test_toxicity_learns_a_made_up_lexicon(spark):
    """Stems that no list holds are found from labels, copies of one text are not mistaken for them."""
    rng = np.random.default_rng(3)
    clean = [f"{a}{b}" for a in ("ba", "ko", "ti", "mu", "re") for b in ("la", "no", "pi", "sa", "de", "fu")]
    rows = []
    for i in range(600):
        words = list(rng.choice(clean, 40))
        bad = i % 8 == 0
        if bad:
            for at in rng.choice(40, 3, replace=False):
                words[at] = "zorgu" + str(rng.choice(clean))
        rows.append((i, " ".join(words), int(bad)))
    rows += [(1000 + i, "copied rarewordx rarewordy " + rows[1][1], 1 if i < 6 else None) for i in range(6)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    twice = toxicity.score(docs.unionByName(docs), toxicity.fit(docs.where(~held_out()), labels)).groupBy("doc_id").agg(F.countDistinct("score").alias("n"))
    assert twice.where("n > 1").count() == 0
    model = toxicity.fit(docs.where(~held_out()), labels)
    assert any("zorgu".startswith(s) for s in model["stems"]) and not any(s.startswith("rareword") for s in model["stems"])
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scored[i] >= 0.3) == bool(y) for i, _, y in rows if i < 1000)
    odd = spark.createDataFrame([(1, None, 0.5), (None, "", 0.1)], "doc_id bigint, text string, score double")
    assert all(0 <= r.score < 0.3 for r in toxicity.score(odd, model).collect())
    untrained = toxicity.fit(docs.limit(0), labels)
    assert toxicity.score(docs, untrained).where("score >= 0.3").count() == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_of_long_texts_and_of_threats_learned(spark):
    """A made-up verb before a target is learned as a threat, a made-up name as an insult."""
    rng, rows = np.random.default_rng(2), []
    clean = [f"{a}{b}{c}" for a in ("ba", "ko", "ti", "mu", "re") for b in ("la", "no", "pi", "sa", "de") for c in ("mo", "ku", "ri")]
    for i in range(400):
        bad = i % 5 == 0
        filler = " ".join(rng.choice(clean, 20))
        threat = f"{filler} mirzlo{'abc'[i % 3]} {('them', 'you', 'her')[i % 3]}"
        rows.append((i, f"{threat} {filler}, grunvek{'xyz'[i % 3]} {filler}" if bad else filler, int(bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    stems = toxicity.learn_stems(spark.createDataFrame([r[1:] for r in rows], "text string, toxic int"))
    assert {c for s, c in stems.items() if "mirzlo".startswith(s)} == {2} and {c for s, c in stems.items() if "grunvek".startswith(s)} == {1}
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int"))
    long = spark.createDataFrame([(1, "koreno tisala " * 40_000), (2, "koreno tisala " * 40_000 + "I will mirzloa them"), (3, "z" * 400_000)], "doc_id bigint, text string")
    scored = {r.doc_id: r.score for r in toxicity.score(long, model).collect()}
    assert scored[1] == scored[3] < scored[2]


def longest_match_parse(text, corpus):
    """Phrases of a greedy parse, by substring search."""
    count, at = 1, 0
    for end in range(1, len(text) + 1):
        if text[at:end] not in corpus:
            count += 1
            at = end - 1
            if text[at:end] not in corpus:
                at = end
    return count


def test_automaton_parse_equals_substring_search():
    corpus = {"x": "abracadabra alakazam abrakadabra", "y": "hocus pocus fidibus tontus talontus"}
    parser = language.Parser(corpus)
    for text in ("abracadabra", "zzz abra hocus", "pocus fidibus alakazam", "a", "kadabra cadabra"):
        counts = parser.phrases([text])[0]
        for k, name in enumerate(parser.languages):
            # Letters that the corpus lacks are phrases of their own.
            want, at = 1, ""
            for c in text:
                if at + c in corpus[name]:
                    at += c
                else:
                    want += 1
                    at = c if c in corpus[name] else ""
            assert counts[k] == want, (text, name)


def test_language_on_held_out_rows(spark):
    found = language.language(spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "n_chars")
    rows = found.join(truth, "doc_id").where("held_out AND n_chars > 100").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    texts = {"a": "aaa bbb ccc ddd", "b": "xxx yyy zzz"}
    rows = [(1, None), (2, ""), (None, "123 %"), (3, "yyy zzz"), (3, "yyy zzz"), (4, "bbb" * 5000)]
    found = sorted((str(r.doc_id), r.lang_pred) for r in language.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), texts).collect())
    assert found == [("1", "und"), ("2", "und"), ("3", "b"), ("3", "b"), ("4", "a"), ("None", "und")]
    assert language.training_text(spark.createDataFrame([], "doc_id bigint, text string, lang string")) == {}
    assert language.identify(spark.createDataFrame(rows, "doc_id bigint, text string"), {}).where("lang_pred <> 'und'").count() == 0


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            before, row[j + 1] = row[j + 1], before + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_bit_parallel_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 40)).tolist(), rng.integers(0, 6, rng.integers(1, 60))
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        assert decontaminate._common(masks, len(a), b) == longest_common(a, b.tolist())


def test_leaks_and_paraphrases_are_found(spark):
    docs, items = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/benchmark.parquet")

    def words(t):
        return re.findall(r"\w+", (t or "").lower())

    texts = {r.doc_id: words(r.text) for r in docs.collect()}
    queries = {r.item_id: words(r.text) for r in items.collect()}
    # Brute force: the item's words in a row stand in the text.
    exact = {(d, i) for d, t in texts.items() for i, q in queries.items() if f" {' '.join(q)} " in f" {' '.join(t)} "}
    found = {(r.doc_id, r.item_id) for r in decontaminate.search(docs, items).collect()}
    assert exact and found == exact
    # Every seventh word of an item replaced, inside other text.
    base = [t for d, t in texts.items() if len(t) > 200 and not any(d == x for x, _ in exact)][:20]
    changed = []
    for n, (i, q) in enumerate(list(queries.items())[:20]):
        para = [w if k % 7 else f"changed{k}in{n}" for k, w in enumerate(q)]
        changed.append((10_000 + i, " ".join(base[n][:90] + para + base[n][90:180])))
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(changed, "doc_id bigint, text string"))
    again = {(r.doc_id, r.item_id) for r in decontaminate.search(both, items).collect()}
    assert exact <= again
    assert len(again & {(10_000 + i, i) for i in queries}) >= 18 and len(again) <= len(exact) + 22


def planted(docs, queries, rates, seed):
    """(doc_id, text) of documents with an item at a random place, some of its words replaced by words of other documents."""
    rng, rows = np.random.default_rng(seed), []
    texts = [t for t in docs if len(t) > 120]
    for r, rate in enumerate(rates):
        for i, q in queries.items():
            host, other = texts[rng.integers(len(texts))], texts[rng.integers(len(texts))]
            words = [other[rng.integers(len(other))] if rng.random() < rate else w for w in q]
            at = int(rng.integers(0, len(host)))
            rows.append((100_000 * (r + 1) + i, " ".join(host[:at] + words + host[at:])))
    return rows


def test_recall_of_the_search(spark):
    """Items planted verbatim and reworded: of those that pass the check at any place, the cosines find nine in ten at each rate."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    queries = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in items.collect()}
    rates = (0.0, 0.2, 0.25, 0.35)
    rows = planted([(r.text or "").split() for r in docs.collect()], queries, rates, 11)
    both = docs.unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"))
    whole = {(r.doc_id, r.item_id): r.share for r in decontaminate.search(both, items, exact=True).collect()}
    found = {(r.doc_id, r.item_id): r.share for r in decontaminate.search(both, items).collect()}
    # What is found is what the yardstick finds, with its share or that of another place.
    assert set(found) <= set(whole) and all(found[k] <= whole[k] for k in found)
    for r, rate in enumerate(rates):
        own = {k for k in whole if k[0] == 100_000 * (r + 1) + k[1]}
        assert len(own) >= (0.3 if rate > 0.3 else 0.6) * len(queries)
        assert len(own & set(found)) >= (0.97 if rate == 0 else 0.9) * len(own), rate


def test_words_are_hashed_alike_wherever_they_stand():
    hasher = decontaminate._Hasher()
    texts = ["One two, ONE\u2019two", None, "", "  one ", "three " * 30_000 + "one", "é_1 \u2026 two"]
    one, two, three = (hasher(w)[0] for w in ("one", "two", "three"))
    found = hasher.all(texts)
    assert [w.tolist() for w in found] == [hasher(t).tolist() for t in texts]
    assert found[0].tolist() == [one, two, one, two] and found[3].tolist() == [one]
    assert found[4].tolist() == [three] * 30_000 + [one] and len({one, two, three, *hasher("eno owt é_1")}) == 6
    assert len(found[1]) == len(found[2]) == 0 and len(found[5]) == 2
    # Hashes tell a million words apart about as well as random numbers of 32 bits do.
    assert 1_000_000 - len(np.unique(hasher(" ".join(map(str, range(1_000_000)))))) < 200


def test_sums_of_rows():
    """Rows are taken one by one, so each must lie in one piece, also where the directions come by column."""
    rng = np.random.default_rng(2)
    matrix = decontaminate._padded(np.asfortranarray(rng.integers(0, 9, (50, 7)).astype(np.float32)))
    assert matrix.flags.c_contiguous and not matrix[50].any()
    places = rng.integers(0, 51, (5000, 3))
    assert (decontaminate._row_sums(matrix, places) == matrix[places].sum(axis=1)).all()
    ids = np.sort(rng.integers(0, 40, 3000) ** 2)
    at, want = rng.integers(0, 51, 3000), np.zeros((1600, 7), np.float32)
    np.add.at(want, ids, matrix[at])
    found, sums = decontaminate._sums_by(ids, matrix, at)
    assert found.tolist() == np.unique(ids).tolist() and (sums == want[found]).all()


def test_few_pairs_are_checked(spark):
    """Fewer than one pair of document and item in a hundred reaches the word by word check."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    hasher = decontaminate._Hasher()
    items = [{"item_id": r.item_id, "words": hasher(r.text), "answer": hasher("")} for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    source = docs.withColumn("tie", F.xxhash64("text"))
    words = source.mapInArrow(decontaminate._hashed, "doc_id bigint, tie bigint, words binary").cache()
    idf, directions = decontaminate.factorise(words)
    benchmark = decontaminate._Items(items, idf, directions, 0.6, 0.8)
    texts = [np.frombuffer(bytes(r.words), np.uint32) for r in words.collect()]
    checked = {(i, item) for i, item, _ in benchmark.search(texts, 0.45, False)}
    assert len(checked) < 0.01 * len(texts) * len(items)


def test_items_are_searched_in_parts(spark):
    docs, items = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    twice = items.unionByName(items)
    one = sorted(map(tuple, decontaminate.search(docs, items).collect()), key=str)
    assert sorted(map(tuple, decontaminate.search(docs, items, max_items=7).collect()), key=str) == one
    # Repeated items match each, repeated documents alike.
    assert sorted(map(tuple, decontaminate.search(docs, twice).collect()), key=str) == sorted(2 * one, key=str)
    again = docs.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    assert {tuple(r)[:3] for r in decontaminate.search(again, items).collect()} == {r[:3] for r in one}


def test_leaks_in_very_long_texts(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    filler = " ".join(f"w{i * 7919 % 4001}" for i in range(60_000))
    docs = spark.createDataFrame([(1, filler[:200_003] + " " + item + " " + filler), (2, filler), (3, item[:60])], "doc_id bigint, text string")
    items = spark.createDataFrame([("a", item)], "item_id string, text string")
    assert [(r.doc_id, r.item_id, r.share) for r in decontaminate.search(docs, items).collect()] == [(1, "a", 1.0)]


def test_leaks_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog every single day"), (2, None), (3, "")], "item_id bigint, text string")
    rows = [(1, None, 0.5), (2, "", 0.5), (None, "The quick, brown fox jumps over the lazy dog every single day", 0.1), (4, "nothing of it", 0.2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, share double")
    assert [(r.doc_id, r.item_id, r.share) for r in decontaminate.search(docs, items).collect()] == [(None, 1, 1.0)]
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]
    assert decontaminate.clean(docs, items.limit(0)).count() == 4 and decontaminate.search(docs.limit(0), items).count() == 0


def test_url_parts_and_rules(spark):
    rows = [
        (1, None, "", "", None), (2, "nourl", "", "", None), (3, "http://A.Example.COM", "a.example.com", "", None),
        (4, "https://www.EXAMPLE.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/"), (5, "http://b.example.com/en/", "b.example.com", "/en/", "example.com/en/"),
        (6, "http://x.net/es/1", "x.net", "/es/1", "net/es/"), (7, "http://x.net/de/1", "x.net", "/de/1", None), (8, "ftp://notexample.com/en/", "notexample.com", "/en/", "com/"),
        (9, "http://h?a/b", "h", "", None), (10, "http://com/a#b", "com", "/a", "com/"), (10, "http://com/a#b", "com", "/a", "com/"), (None, "http://x.com/?/", "x.com", "/", "com/"),
    ]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id bigint, url string").withColumn("rule", held_out("page_id"))
    found = sorted(((r.page_id, r.host, r.path, r["rule"]) for r in urls.judge(pages).collect()), key=str)
    assert found == sorted(((r[0], *r[2:]) for r in rows), key=str)
    verdicts = {r["rule"]: r.verdict for r in urls.judge(pages).collect() if r["rule"]}
    assert verdicts == {"com/": "allow", "www.example.com/en/": "allow", "example.com/en/": "block", "net/es/": "block"}
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_models_separate_held_back_examples(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    judged = urls.judge(pages).where("rule IS NOT NULL")
    wrong = judged.where("(ratio >= 0) <> (verdict = 'allow')").count()
    assert wrong <= 0.1 * judged.count()


def test_url_probabilities_sum_to_one_over_seen_contexts(spark):
    """Smoothed probabilities of the longest order agree with a direct computation."""
    bodies = [("abab", True), ("abba", True), ("bcbc", False), ("abcb", False)] * 2
    model = urls.fit(spark.createDataFrame(bodies, "body string, accepted boolean"), order=2, prior=1.0, min_count=1)
    one = {r.gram: r.ratio for r in model[0].collect()}
    yes, no = "".join(b for b, y in bodies if y), "".join(b for b, y in bodies if not y)
    for c in "abc":
        want = np.log((yes.count(c) + 1 / 256) / (len(yes) + 1)) - np.log((no.count(c) + 1 / 256) / (len(no) + 1))
        assert abs(one[c] - want) < 1e-9


def test_every_leak_that_passes_the_check_is_a_candidate(spark):
    """Short and reworded items at odd places, against the longest common subsequence over all places of all texts."""
    rng = np.random.default_rng(11)
    docs, items = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    texts = [re.findall(r"\w+", r.text.lower()) for r in docs.orderBy("doc_id").limit(300).collect() if r.text]
    texts = [t for t in texts if len(t) > 60]
    queries = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in items.collect()}
    planted = []
    for i, q in queries.items():
        for n, changed in enumerate((0, 0.2, 0.25, 0.35)):
            words = [f"new{k}x{i}x{n}" if rng.random() < changed else w for k, w in enumerate(q)]
            base = texts[(4 * i + n) % len(texts)]
            at = int(rng.integers(len(base)))
            planted.append((4 * i + n, base[:at] + words + base[at:]))
    rows = spark.createDataFrame([(d, " ".join(t)) for d, t in planted], "doc_id bigint, text string")

    hasher = decontaminate._Hasher()
    hashed = {i: hasher(" ".join(q)) for i, q in queries.items()}
    want = {}
    for d, t in planted:
        t = hasher(" ".join(t))
        for i, q in hashed.items():
            width, masks = len(q) + max(1, len(q) // 4), {}
            if len(set(t.tolist()) & set(q.tolist())) < 0.3 * len(q):
                continue
            for k, w in enumerate(q.tolist()):
                masks[w] = masks.get(w, 0) | 1 << k
            want[d, i] = max(decontaminate._common(masks, len(q), t[s:s + width]) for s in range(max(1, len(t) - width + 1))) / len(q)
    # Without a demand on rare words, the share alone decides.
    found = {(r.doc_id, r.item_id): r.share for r in decontaminate.search(rows, items, min_share=0.6, sure_share=0.6).collect()}
    assert found == {pair: share for pair, share in want.items() if share >= 0.6}
    assert len(found) > 3 * len(queries)


def test_url_models_keep_all_ngrams_and_join_by_shuffle(spark):
    """More than 200,000 n-grams of a length are all kept; scores are the same whether tables are broadcast or shuffled."""
    rng = np.random.default_rng(5)
    bodies = ["".join(map(chr, row)) for row in rng.integers(97, 123, (2500, 100))]
    labelled = spark.createDataFrame([(b, i % 2 == 0) for i, b in enumerate(bodies)], "body string, accepted boolean")
    model = urls.fit(labelled, min_count=1)
    padded = ["\x02" * 4 + b for b in bodies]
    want = {p[i:i + 5] for p in padded for i in range(100)}
    assert len(want) > 200_000 and model[4].count() == len(want)
    few = labelled.limit(50).withColumn("key", labelled["body"])
    small, large = ({r.key: r.ratio for r in urls.score(few, model, "key", limit).collect()} for limit in (1 << 30, 0))
    assert len(small) == 50 and small == large
