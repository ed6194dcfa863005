"""Main text, WARC round trips, the mixture and the pipeline."""

import base64
import hashlib
import re
from collections import defaultdict
from html import unescape

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from loamwork.llm import decontaminate, html, jaccard, lines, mixing, warc
from loamwork.llm.common import ORACLES, QUERIES
from loamwork.workspace import cut_lineage, fresh_path

from tests.llm.test_dedup import brute_components

FOLDER = "/root/testdata/sf0.001"
PARAGRAPH = "This is the first paragraph of the article, long enough to count, with commas, and a full stop."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"),
    (f"<nav>menu</nav><article><h1>Head</h1><p>{PARAGRAPH}</article><footer>foot</footer>", f"Head\n{PARAGRAPH}"),
    (f"<div class='sidebar'><p>{PARAGRAPH}</p></div><div class='content'><p>Main text, that stays.</p><p>{PARAGRAPH}</p></div>", f"Main text, that stays.\n{PARAGRAPH}"),
    (f"<article><p>{PARAGRAPH}</p></article><div id='comments'><p>{PARAGRAPH} me too, really, yes, yes, yes</p></div>", PARAGRAPH),
    (f"<article><p>a &amp; b&nbsp;&#8211; c<br>d</p><div class='ad'>buy</div><form>x<input></form><script>if (a<b) x</script><p>{PARAGRAPH}</p></article>", f"a & b – c d\n{PARAGRAPH}"),
    (f"<article><p>{PARAGRAPH}</p><ul><li>one<li>two</ul><pre> x\n y </pre></article>", f"{PARAGRAPH}\none\ntwo\nx y"),
    (f"<body><div class='cookie-notice'>We use cookies</div><p>{PARAGRAPH}</p></body>", PARAGRAPH),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("cut", [
    '<p class="ad">Buy', '<ul><li class="share">Share</ul>', '<div><div class="menu"><span>Menu</div></div>', '<div><p class="promo">Buy</div>',
    '<table><tr><td class="ad">Buy<tr><td></table>', "<head><title>Head</title><meta name='x'>", "<div><button>Press</div>", "<select><option>a<option>b</select>",
])
def test_cut_elements_end_as_others_do(cut):
    assert html.main_text(f"{cut}<p>{PARAGRAPH}<p>more of it.</p>") == f"{PARAGRAPH}\nmore of it."


@pytest.mark.parametrize("label", ["content with-sidebar", "page has-sidebar", "layout menu-open", "main-content share-open"])
def test_wrappers_named_after_a_part_keep_their_article(label):
    body = f"<p>{PARAGRAPH}</p>" * 3
    side = f"<div class='sidebar'><p>{PARAGRAPH} beside it</p></div><ul class='menu'><li><a href='x'>Menu of the page</a></ul>"
    assert html.main_text(f"<div class='{label}'>{body}{side}</div>") == "\n".join([PARAGRAPH] * 3)
    assert html.main_text(f"<div class='{label}'><article>{body}</article>{side}</div>") == "\n".join([PARAGRAPH] * 3)

    nested = f"<article><p>{PARAGRAPH}</p><div class='comments'>{body}</div></article>"
    assert html.main_text(nested) == html.main_text(f"<div class='{label}'>{nested}</div>") == PARAGRAPH


def test_main_text_survives_broken_and_deep_markup():
    assert html.main_text("<div>" * 5000 + "deep, text") == "deep, text"
    assert html.main_text("</p></div><b>bold<i>both</b> tail") == "boldboth tail"
    for page in ("<", "<!--", "<![CDATA[", "<p", "&#xZZ;", "<a href='", "\x00<p>x"):
        html.main_text(page)


@pytest.mark.parametrize("comments", [
    f"<article class='comment'><p>{PARAGRAPH} says one</p></article><article class='comment'><p>{PARAGRAPH} says two</p></article>",
    f"<section class='user-responses'><p>{PARAGRAPH} says one</p><p>{PARAGRAPH} says two</p></section>",
    f"<div><article><header>Ann, 3 May</header><p>{PARAGRAPH} says one</p></article><article><p>{PARAGRAPH} says two</p></article></div>",
])
def test_comments_in_other_forms_go(comments):
    body = f"<h1>Head</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH} again</p>"
    want = f"Head\n{PARAGRAPH}\n{PARAGRAPH} again"
    inside = f"<main><article>{body}{comments}</article></main>"
    assert html.main_text(inside) == want
    if "class" in comments:
        assert html.main_text(f"<main><article>{body}</article>{comments}</main>") == want
    # With nothing else on the page, what is called a comment is its text.
    assert PARAGRAPH in html.main_text(f"<main><article class='comment'><p>{PARAGRAPH}</p></article></main>")


@pytest.mark.parametrize("page, text", [
    (f"<p>{PARAGRAPH}</p><!-- open <p>lost</p>", PARAGRAPH), (f"<p>{PARAGRAPH}</p><!-- a --><p>b</p><!-- open", f"{PARAGRAPH}\nb"),
    (f"<p>{PARAGRAPH}</p><p class='x", PARAGRAPH), ("<p>ab<img src='x'>cd<br>ef</p>", "abcd ef"), ("<p>1 < 2 and 3 <4</p>", "1 < 2 and 3 <4"),
    ("<p>a & b &amp c</p>", "a & b & c"), (f"<article><header><h1>Head</h1></header><p>{PARAGRAPH}</p></article>", PARAGRAPH),
])
def test_unclosed_markup_and_inline_images(page, text):
    assert html.main_text(page) == text


def article_by_hand(page):
    """Blocks between the article's tags in the given pages, which hold paragraphs, headings, inline tags and line breaks."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    inner = re.sub(r"<!--.*?-->|<(script|style)>.*?</\1>|<div class=\"(?:ad|share)[^>]*>.*?</div>|<(aside|form|nav)\b.*?</\2>", "", inner, flags=re.S)
    parts = re.split(r"</?(?:p|h[1-6]|li|ul|ol|div|blockquote|pre|table|tr|td|section)\b[^>]*>", inner)
    lines = [" ".join(unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", part))).split()) for part in parts]
    return "\n".join(line for line in lines if line)


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_given_pages_equal_their_article_block(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    wanted = {r.page_id: article_by_hand(r.html) for r in pages.collect() if r.html and "<article>" in r.html}
    found = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert wanted and {k: found[k] for k in wanted} == wanted


def test_extract_rows(spark):
    rows = [(1, "u", "<p>a</p>", 1), (1, "u", "<p>a</p>", 1), (None, None, None, 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    found = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html.extract(pages).collect()), key=str)
    assert found == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0)], key=str)
    assert html.extract(pages.limit(0)).count() == 0


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark):
    rows = [
        (1, "u%\r\nx", "a\r\n\r\nWARC/1.1\r\nContent-Length: 4\r\n\r\nq", 7), (2, None, None, 1), (3, "x", "é€𝄞" * 50, 1), (4, "x", "é€𝄞" * 50, 1),
        (None, "n", None, 2), (5, "y", "é€𝄞" * 50, 1), (5, "y", "z", 1), (6, "e", "\r\n\r\n\r\n", 1),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int")
    # Chunks of 7 code points, the payloads' lengths are known without them.
    chunks = warc.chunk_table(pages, 7)
    assert chunks.groupBy("record_no").agg(F.count("*").alias("n"), F.max("n_chunks").alias("m")).where("n <> m").count() == 0
    path = fresh_path(spark, "warc")
    warc.write_archive(chunks, warc.roles(chunks), path, 2)
    found = sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(spark, path).collect()), key=str)
    expected = []
    for page_id, url, text, _ in rows:
        same = [r[0] for r in rows if (r[2] or "") == (text or "")]
        keeper = max((p for p in same if p is not None), default=None)
        response = keeper == page_id
        expected.append((page_id, url, len((text or "").encode()), digest(text), "response" if response else "revisit", None if response else keeper))
    assert found == sorted(expected, key=str)


def test_warc_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id bigint, url string, html string")
    kinds = {r.refers_to for r in warc.roles(warc.chunk_table(pages), min_bytes=3).collect()}
    assert kinds == {None, 4}
    empty = warc.chunk_table(pages.limit(0))
    path = fresh_path(spark, "warc")
    warc.write_archive(empty, warc.roles(empty), path)
    assert warc.read_archive(spark, path).count() == 0


def test_schedule_deviates_by_less_than_one_block(spark):
    for weights in ({"a": 5, "b": 3, "c": 2}, {"a": 1, "b": 1, "c": 1, "d": 97}, {f"s{i}": 1 + i * i % 7 for i in range(12)}, {"only": 4}):
        period = sum(weights.values())
        frame = spark.createDataFrame(list(weights.items()), "source string, weight bigint")
        plan = sorted(mixing.schedule(frame, period).collect(), key=lambda r: r.slot)
        assert [r.slot for r in plan] == list(range(period))
        issued = defaultdict(int)
        for r in plan:
            assert r.block == issued[r.source]
            issued[r.source] += 1
            for source, w in weights.items():
                assert abs(issued[source] - (r.slot + 1) * w / period) < 1
        assert dict(issued) == weights


def test_mixture_of_rows(spark):
    rows = [(i, f"s{i % 3 if i % 5 else 0}", f"t{i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    mixed = mixing.mix(docs, block_rows=4, period=50).collect()
    assert sorted((r.doc_id, r.source, r.text) for r in mixed) == sorted(rows)
    blocks = defaultdict(list)
    for r in mixed:
        blocks[r.mix_slot].append(r)
    assert all(len({r.source for r in b}) == 1 and sorted(r.mix_place for r in b) == list(range(len(b))) for b in blocks.values())
    counts = {s: sum(r[1] == s for r in rows) for s in ("s0", "s1", "s2")}
    weights = {r.source: r.weight for r in mixing.tempered_weights(docs.groupBy("source").agg(F.count("*").alias("n")), 50).collect()}
    assert sum(weights.values()) == 50
    full = sorted(s for s, b in blocks.items() if b[0].mix_full)
    # Up to the end of the full part every slot has its block, and the targets hold after each.
    assert full == list(range(len(full)))
    issued = defaultdict(int)
    for slot in full:
        issued[blocks[slot][0].source] += 1
        assert all(abs(issued[s] - (slot + 1) * w / 50) < 1 for s, w in weights.items())
    assert all(-(-counts[s] // 4) == len({r.mix_block for r in mixed if r.source == s}) for s in counts)


def test_mixture_of_more_sources_than_slots(spark):
    rows = [(i, f"s{i % 2400 if i % 3 else i % 7}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    mixed = mixing.mix(docs, block_rows=2).collect()
    assert sorted((r.doc_id, r.source) for r in mixed) == sorted(rows) and all(r.mix_slot is not None for r in mixed)
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    weights = cut_lineage(mixing.tempered_weights(counts, 3000))
    plan = sorted(mixing.schedule(weights, 3000).collect(), key=lambda r: r.slot)
    assert [r.slot for r in plan] == list(range(3000)) and len({r.source for r in plan}) == counts.count() > 1000
    issued = defaultdict(int)
    for r in plan:
        # Just before and just after its blocks a source deviates most.
        assert r.block == issued[r.source] and abs(r.block - r.slot * r.weight / 3000) < 1
        issued[r.source] += 1
        assert abs(issued[r.source] - (r.slot + 1) * r.weight / 3000) < 1


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, None, 7), (2, "", "a", 1), (3, "x", "a", 1), (3, "x", "a", 1), (None, "x", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, weight int")
    mixed = mixing.mix(docs)
    assert mixed.columns[:4] == docs.columns and mixed.count() == 5
    assert mixing.mix(docs.limit(0)).count() == 0
    some = {(r.source, r.mix_slot is None) for r in mixing.mix(docs, {"a": 1}).collect()}
    assert some == {("a", False), ("b", True), (None, True)}
    with pytest.raises(ValueError):
        mixing.mix(docs, period=2)


def test_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert contract.queries()["pipeline"] is corpus_pipeline.run


CLASHING = [
    "_row", "row", "_row_no", "row_no", "at", "line", "value", "keeper", "gone", "_gone", "n_removed", "_slot", "_weight", "_start", "_key", "_tie", "_rank", "_bucket",
    "_order", "_place", "_in", "_id", "tie", "_doc", "item_id", "share", "score", "root", "v", "n", "s", "_wordless", "least", "mix_rank", "weight", "block", "slot",
]


def clashing_documents(spark):
    """Documents with an extra column of every name that operators use inside."""
    shared = "a line that many sites share"
    rows = [(i, f"own words {i} of the document {i * 7} said once\n{shared}", f"s{i % 12}", "en", 9) for i in range(36)]
    rows += [(100, rows[0][1], "s1", "en", 9), (None, "no id at all", None, None, None), (101, None, "s2", None, None), (102, "", "s2", "en", 0), (103, "x " * 30_000, "s3", "en", 60_000)]
    rows += [rows[3], rows[3]]
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *[f"{c}{k}" for c in CLASHING]) for k, r in enumerate(rows)], f"doc_id bigint, text string, source string, lang string, n_chars bigint, {extra}")


@pytest.mark.parametrize("operator", ["lines", "mix", "keep_one", "clean", *[name for name, _ in corpus_pipeline.STAGES]])
def test_extra_columns_of_any_name_stay(spark, operator):
    docs = clashing_documents(spark)
    items = spark.createDataFrame([(1, "own words 5 of the document 35 said once")], "item_id bigint, text string")
    stages = dict(corpus_pipeline.STAGES)
    run = {
        "lines": lambda: lines.remove_shared_lines(docs, 10), "mix": lambda: mixing.mix(docs), "keep_one": lambda: jaccard.keep_one(docs),
        "clean": lambda: decontaminate.clean(docs, items),
    }.get(operator) or (lambda: stages[operator](spark, docs, FOLDER))
    found = run()
    results = {"lines": ["n_removed"], "mix": [], "mixing": []}.get(operator, [])
    assert set(docs.columns) <= set(found.columns)
    if operator not in ("mix", "mixing", "lines"):
        assert found.columns == docs.columns
    rows = found.collect()
    given = {tuple(r[c] for c in CLASHING if c not in results) for r in docs.collect()}
    kept = [tuple(r[c] for c in CLASHING if c not in results) for r in rows]
    assert set(kept) <= given and len(kept) >= 30 - (operator in ("clean", "decontamination"))
    if operator in ("lines", "mix", "mixing", "toxicity", "line_dedup"):
        assert len(kept) == docs.count() and {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    if operator in ("lines", "line_dedup"):
        assert sum("many sites" in (r.text or "") for r in rows) == 1


def test_pipeline_equals_its_stages_by_hand(spark):
    """Shared lines, copies and leaks worked out by hand on what each stage gets; the mixture drops nothing."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("line_dedup", "near_copies", "decontamination", "mixing"):
        after = stages[name](spark, docs, FOLDER).cache()
        before = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id: r for r in after.collect()}
        assert set(kept) <= set(before)
        if name == "line_dedup":
            sites = defaultdict(set)
            keeper = {}
            for d in sorted(before):
                for line in (before[d].text or "").split("\n"):
                    if line.strip(" \t\n\x0b\x0c\r"):
                        sites[line.strip(" \t\n\x0b\x0c\r")].add(before[d].source)
                        keeper.setdefault(line.strip(" \t\n\x0b\x0c\r"), d)
            for d, r in before.items():
                left = [x for x in (r.text or "").split("\n") if len(sites[x.strip(" \t\n\x0b\x0c\r")]) < 10 or keeper[x.strip(" \t\n\x0b\x0c\r")] == d]
                text = "\n".join(left)
                assert (d in kept) == (text == (r.text or "") or bool(text.strip(" \t\n\x0b\x0c\r")))
                if d in kept:
                    assert (kept[d].text or "") == text and (kept[d].n_chars == len(text) or text == r.text)
        elif name == "near_copies":
            component = brute_components({d: r.text for d, r in before.items()})
            assert set(kept) == {d for d in before if component[d][1] == d}
        elif name == "decontamination":
            items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
            leaks = {r.doc_id for r in decontaminate.search(docs, items, exact=True).collect()}
            assert set(kept) == set(before) - leaks
        else:
            assert set(kept) == set(before)
        docs = after.select(*docs.columns)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_copies", "decontamination", "mixing"]
    final = corpus_pipeline.run(spark, FOLDER)
    assert set(docs.columns) < set(final.columns)
    ids = [r.doc_id for r in final.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0.5 * docs.count() < len(ids) < docs.count()
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.count() == 0 and set(docs.columns) <= set(empty.columns)
