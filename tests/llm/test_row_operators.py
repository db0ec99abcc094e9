"""Operators that judge each row by itself, or by statistics of all rows."""

import hashlib
import itertools
import random
import re
import textwrap
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pricewright.llm import decontamination as D
from pricewright.llm import fingerprints as G
from pricewright.llm import html_extraction as H
from pricewright.llm import licenses as L
from pricewright.llm import packing as P
from pricewright.llm import token_counts as T
from pricewright.llm import toxicity as X
from pricewright.llm import url_filters as U
from tests.conftest import SF
from tests.llm.conftest import prose


def oracle(sql: str, **tables) -> list[tuple]:
    c = duckdb.connect()
    for name, df in tables.items():
        c.register(name, df.toArrow())
    return c.execute(sql).fetchall()


def same(rows, want) -> bool:
    return Counter(map(repr, map(tuple, rows))) == Counter(map(repr, want))


# packing


@pytest.mark.parametrize("seed", range(40))
def test_boundaries_waste_least(seed):
    r = random.Random(seed)
    h = {r.randint(0, 25): r.randint(1, 9) for _ in range(r.randint(1, 9))}
    k = r.randint(1, 5)
    cost = lambda bounds: sum(n * (min(b for b in bounds if b >= x) - x) for x, n in h.items())
    best = min(cost(c) for q in range(1, k + 1) for c in itertools.combinations(sorted(h), min(q, len(h))) if c[-1] == max(h))
    got = P.optimal_boundaries(h, k)
    assert cost(got) == best and len(got) <= k


def test_pack_keeps_every_token(docs):
    out = P.pack(docs, context=512, budget=2048, buckets=4, shards=3)
    rows = out.collect()
    words = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect())
    assert sum(r.n_tokens for r in rows) == sum(words)
    assert out.columns == ["doc_id", *P.ADDED]
    assert all(r.n_tokens <= r.padded_length <= 512 and r.n_pieces >= 1 for r in rows)
    slots = Counter((r.bucket, r.batch, r.slot) for r in rows)
    assert max(slots.values()) == 1
    for bucket in {r.bucket for r in rows}:
        mine = [r for r in rows if r.bucket == bucket]
        room = max(1, 2048 // max(1, mine[0].padded_length))
        fill = Counter(r.batch for r in mine)
        assert sorted(fill) == list(range(len(fill))) and all(fill[b] == room for b in range(len(fill) - 1)) and fill[len(fill) - 1] <= room


def test_pack_empty_and_too_small_a_budget(no_docs):
    assert P.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        P.pack(no_docs, context=10, budget=5)


# toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(i, 40).split()
        if toxic:
            words.insert(r.randrange(40), r.choice(["vilewretch", "vilewretched", "scumbagx"]))
            if i % 8 == 0:
                words.insert(5, "muslim")  # a biased mention
        elif i % 9 == 1:
            words.insert(5, "christian")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(labelled):
    return X.train(*labelled)


def test_held_out_accuracy(labelled, model):
    docs, labels = labelled
    held = X.score(docs, model).join(labels, "doc_id").filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0).collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)


def test_mentions_count_alike(labelled, model):
    plain = X.train(*labelled, fairness=0.0)
    gap = lambda m: abs(m.score("plain words about muslim people") - m.score("plain words about christian people"))
    assert gap(model) < 0.02 and gap(model) <= gap(plain)
    assert model.score("plain words about muslim people") < 0.5 < model.score("you vilewretch of words")


def test_scores_of_awkward_rows(spark, docs, no_docs, model):
    rows = X.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert {r.score for r in rows if not (r.text or "").strip()} == {model.score("")}
    assert X.score(no_docs, model).count() == 0
    clash = spark.createDataFrame([("t", 4.0, 1)], "text string, SCORE double, other int")
    assert X.score(clash, model).columns == ["text", "other", "score", "predicted"]


def test_training_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.train(docs, none).score("anything") < 0.5
    one = spark.createDataFrame([(i, 1, 1) for i in range(3, 9)], "doc_id long, quality int, toxic int")
    assert X.train(docs, one).score("anything") > 0.5


def test_labels_of_held_out_rows_are_never_used(labelled):
    docs, labels = labelled
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    lying = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.train(docs, lying) == X.train(docs, labels)


# url filters


def test_urls(spark):
    rows = [(0, "http://A.Example.NET/en/x?q#f"), (1, "https://b.net/"), (2, "https://b.net"), (3, "x://www.example.com/de/1"), (4, "http://q.org/fr/"), (5, None), (6, "no scheme"), (7, ""), (8, "http://h?x://y/"), (9, "a://b.co.uk/p\n/z"), (9, "a://b.co.uk/p\n/z"), (None, "http://NÉ.example.com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit("x"))
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    none = labels.limit(0).select(F.col("doc_id").alias("page_id"), F.lit(1).alias("bad"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.url_verdicts(pages, none).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("b.net", "/", "net/", "block") and got[2] == ("b.net", "", None, "allow")
    assert got[3][2:] == ("example.com/de/", "block") and got[4][2:] == ("org/fr/", "allow")
    assert got[5] == got[6] == got[7] == ("", "", None, "allow")
    assert got[8] == ("h", "", None, "allow") and got[9][1] == "/p\n/z"
    assert got[None][0] == "nÉ.example.com"
    from unittest.mock import patch

    with patch.object(U, "read", lambda s, d, t: {"pages": pages, "labels": labels}[t]):
        rows = U.op4_url_filters(spark, "").collect()
    assert same(rows, oracle(U.OP4_SQL, pages=pages, labels=labels))


def test_bad_host_is_blocked_and_little_evidence_is_not(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i < 60 else 'fine'}.shop.com/{i}") for i in range(200)] + [(999, "http://new.shop.com/")], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, int(i < 60)) for i in range(200)] + [(999, 1)], "page_id long, bad int")
    got = {r.host: r.verdict for r in U.url_verdicts(pages, outcomes).collect()}
    assert got == {"bad.shop.com": "block", "fine.shop.com": "allow", "new.shop.com": "allow"}
    assert U.url_verdicts(pages.limit(0), outcomes).count() == 0
    clash = pages.withColumns({"Host": F.lit(1), "bad": F.lit(2), "blocked": F.lit("b")})
    out = U.url_verdicts(clash, outcomes)
    assert out.columns == ["page_id", "url", "bad", "blocked", "host", "path", "rule", "verdict"] and out.count() == 201


# token counts


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.ranks_of(T.VOCABULARY))


@pytest.mark.parametrize("leaves", [2, 5, 256])
def test_edits_count_as_a_full_encoding(counter, monkeypatch, leaves):
    monkeypatch.setattr(T, "LEAVES", leaves)
    signs = "ab1 '\n\tslé.   !"
    for seed in range(150):
        r = random.Random(seed)
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 120)))
        tree = T.TokenTree(text, counter)
        for _ in range(4):
            a = r.randint(0, len(text) + 2)
            b = a + r.randint(0, 12)
            new = "".join(r.choice(signs) for _ in range(r.randint(0, 9)))
            tree.edit(a, b, new)
            text = text[: min(a, len(text))] + new + text[min(b, len(text)) :]
            assert tree.text == text and tree.total == len(counter.encode(text))


def test_token_counts_of_awkward_rows(spark, docs, no_docs, counter):
    ranks = T.ranks_of(T.VOCABULARY)
    for r in T.counted(docs, ranks).collect():
        text = r.text or ""
        edited = text
        for a, b, new in T.sample_edits(text):
            edited = edited[:a] + new + edited[b:]
        assert (r.n_tokens, r.n_tokens_edited) == (len(counter.encode(text)), len(counter.encode(edited)))
        assert r.n_reencoded < 120
    assert T.counted(no_docs, ranks).count() == 0
    assert T.counted(spark.createDataFrame([("a", 1)], "text string, N_Tokens int"), ranks).columns == ["text", "n_tokens", "n_tokens_edited", "n_pretokens", "n_reencoded"]


# fingerprints


def fingerprint(text):
    return G.sketch(*G.syncmers(G.code_points(text)), text)


def check_fingerprints(rows, out):
    docs = sorted(((r[0], r[1] or "") for r in rows), key=lambda x: -x[0])
    got = {r.doc_id: r for r in out}
    for i, (k, text) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        a, b, r = fingerprint(text), fingerprint(edited), got[k]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), G.as_text(a), G.as_text(b))
        assert r.near_edited == pytest.approx(G.likeness(a, b)) and r.near_next == pytest.approx(G.likeness(a, fingerprint(after)))


@pytest.mark.parametrize("part", [1, 200, 1 << 24])
def test_fingerprints_match_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(G, "PART_BYTES", part)
    rows = [(i * 3 - 20, t) for i, t in enumerate([None, "", "é" * 40, prose(1, 50), prose(1, 50), prose(2, 3), "𝒳𝒴" * 30, prose(3, 900), "abc"] + [prose(i, 20) for i in range(20, 40)])]
    check_fingerprints(rows, G.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_fingerprints_of_awkward_rows(spark, docs, no_docs):
    rows = G.fingerprints(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert G.fingerprints(no_docs).count() == 0
    alone = G.fingerprints(spark.createDataFrame([(1, "abcdef", 2)], "doc_id long, text string, part int")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_equal_texts_equal_fingerprints_and_pasted_text_is_found():
    text, other = prose(1, 400), prose(2, 400)
    assert (fingerprint(text) == fingerprint(str(text))).all()
    assert G.likeness(fingerprint(text), fingerprint(text + " " + prose(3, 40))) > 0.7
    assert G.likeness(fingerprint(text), fingerprint(other)) < 0.1
    at, value = G.syncmers(G.code_points(text))
    k = text[at[7] : at[7] + G.K]
    assert value[7] == G.syncmers(G.code_points(k))[1][0]


# decontamination


def test_leaks_match_sql(spark, docs, no_docs):
    passage = prose(1, 120)
    items = spark.createDataFrame([(0, " ".join(passage.split()[10:50])), (1, "one two three"), (2, None), (3, ""), (4, prose(77, 30)), (5, passage.upper() + "!"), (5, passage), (None, "Extra, words here")], "item_id long, text string").withColumn("h", F.lit(1))
    named = docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    found = D.contaminated(named.withColumn("sketch", F.lit(1)), items)
    k1, k2 = D.text_keys(F.col("text"))
    got = named.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(found, ["k1", "k2"]).select("doc_id", "item_id", "n_shared", "n_item", "containment").filter("item_id <> 5 and item_id is not null").collect()
    assert same(got, [r for r in oracle(D.OP7_SQL, documents=named.select("doc_id", "text"), benchmark=items.filter("item_id <> 5")) if r[1] is not None])
    kept = [r.doc_id for r in D.decontaminated(docs, items).collect()]
    assert {8, 9, 10, 4, 77} & set(kept) == set() and {0, 1, 2, 5, 12} <= set(kept) and kept.count(5) == 2
    assert D.decontaminated(no_docs, items).count() == 0 and D.decontaminated(docs, items.limit(0)).count() == docs.count()


def test_sketch_loses_no_item(spark):
    r = random.Random(2)
    items = [(i, prose(100 + i, r.randint(5, 60))) for i in range(30)]
    docs = []
    for i, text in items:
        words = text.split()
        words[r.randrange(len(words))] = "changed"
        docs.append((i, prose(i, 30) + " " + " ".join(words) + " " + prose(i + 50, 10)))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    k1, k2 = D.text_keys(F.col("text"))
    got = docs.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(D.contaminated(docs, items), ["k1", "k2"]).select("doc_id", "item_id", "n_shared", "n_item", "containment").collect()
    assert got and same(got, oracle(D.OP7_SQL, documents=docs, benchmark=items))


def test_only_sketch_hits_are_verified(spark, monkeypatch):
    """Documents that share a fifth of an item's shingles meet few sketch hashes; every item that is there is a candidate."""
    r, told = random.Random(4), []
    items = [(i, prose(300 + i, 60)) for i in range(40)]
    docs = [(i, f"{prose(i, 30)} {' '.join(text.split()[: 60 if i % 8 == 0 else 14])} {prose(i + 50, r.randint(5, 40))}") for i, text in items]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")

    class Kept(D.Scratch):
        def written(self, df, name, large=False):
            out = super().written(df, name, large)
            told.append(out.count())
            return out

    monkeypatch.setattr(D, "Scratch", Kept)
    found = D.contaminated(docs, items).collect()
    shingle_rows = lambda df, key: df.select(key, F.explode(D.shingles(F.col("text"), 5)).alias("h"))
    shared = shingle_rows(docs, "doc_id").join(shingle_rows(items, "item_id"), "h")
    pairs = shared.select("doc_id", "item_id").distinct().count()
    assert len(found) == 5 and pairs == 40 and shared.count() > 600
    (candidates,) = told
    assert 5 <= candidates < pairs
    sketch = D.sketches(items.select(F.col("item_id").alias("i1"), F.col("item_id").alias("i2"), D.shingles(F.col("text"), 5).alias("s")))
    assert sketch.count() == 40 * (64 - 52 + 1)  # sets of 56 are in the class of up to 64


def test_no_column_is_lost_or_changed(spark):
    items = spark.createDataFrame([(1, prose(9, 20))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c", 5, "x", 2.0), (2, prose(9, 20), 6, "y", 3.0)], "doc_id long, text string, K1 int, k2 string, i1 double")
    kept = D.decontaminated(docs, items)
    assert kept.columns == docs.columns and kept.collect() == docs.filter("doc_id = 1").collect()


def test_short_items_are_found_in_long_documents(spark):
    items = [(1, "What is 2 + 2?"), (2, "alpha beta"), (3, "Omega!"), (4, prose(9, 20)), (5, "x y z"), (6, "one two three four")]
    long = prose(3, 60)
    docs = [(1, f"{long} what IS 2 2 {long}"), (2, f"alpha {long} beta"), (3, f"alpha, BETA {long} omega"), (4, f"{long} {prose(9, 20)}"), (5, "x y z"), (6, "x y"), (7, "w x y z"), (8, "one two three"), (9, "two three four one two three four five six"), (10, None), (11, "omega")]
    of = lambda t: [w.lower() for w in re.findall(r"[^\W_]+", t or "")]
    has = lambda d, w: any(d[i : i + len(w)] == w for i in range(len(d) - len(w) + 1))
    want = sorted((d, i) for d, t in docs for i, x in items if has(of(t), of(x)))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    k1, k2 = D.text_keys(F.col("text"))
    got = docs.select("doc_id", k1.alias("k1"), k2.alias("k2")).join(D.contaminated(docs, items), ["k1", "k2"]).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want and len(want) == 8
    assert same([(r.doc_id, r.item_id, r.n_shared, r.n_item, r.containment) for r in got], oracle(D.OP7_SQL, documents=docs, benchmark=items))
    assert all(r.n_shared == r.n_item == r.containment == 1 for r in got if r.item_id != 4)
    assert sorted(r.doc_id for r in D.decontaminated(docs, items).collect()) == [2, 6, 8, 10]


# html extraction


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav>home</nav>
    <div class="cookie-notice">We use cookies</div><div class="wrap"><div class="content"><h1>Title &amp; more</h1><div class="ad">buy</div><p>Some <b>long</b> text
    here with many words to count, really many words.<br>Next line<p>Second para of text, with <a href=x>a link</a> in it &#38; some more words.<ul><li>one<li>two</ul></div>
    <div id="sidebar"><p>Side</p></div></div><section id="comments"><p>nice post</p></section><form><input><p>x</p></form><!-- <p>c</p> --><footer>foo</footer>"""
    assert H.extract(page) == "Title & more\nSome long text here with many words to count, really many words. Next line\nSecond para of text, with a link in it & some more words.\none\ntwo"


def test_densities_of_a_page_worked_out_by_hand():
    """Characters a tag, times how few of them are in links, as the formula says it for a small page."""
    import math

    root = H.parse("<body><div><p>aaaaaaaaaa</p><p>bbbbb<a>cc</a></p></div></body>")
    order = {n.tag: n for n in H.measure(root) if n.tag != "p"}
    first, second = (n for n in order["div"].children)

    def density(c, t, lc, lt, whole=17, links=2):
        c, t, lc1, lt = max(1, c), max(1, t), max(1, lc), max(1, lt)
        base = math.log(c / max(1, c - lc) * lc + links / whole * c + math.e)
        return c / t * math.log(1 + max(1.0, c / lc1 * t / lt)) / math.log(1 + base)

    assert first.density == pytest.approx(density(10, 0, 0, 0)) and second.density == pytest.approx(density(7, 1, 2, 1))
    assert order["div"].density == pytest.approx(density(17, 3, 2, 1)) and order["div"].total == pytest.approx(first.density + second.density)
    assert H.settle(root)[1][0] is order["div"]  # the heart: the greatest sum of its blocks' densities


def test_density_alone_finds_the_article():
    """Without article and main elements, nearly all pages give the same text as with them."""
    import pyarrow.parquet as pq

    pages = [h for h in pq.read_table(f"{SF.replace('0.001', '0.01')}/pages.parquet").column("html").to_pylist() if h]
    plain = [re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", h, flags=re.IGNORECASE) for h in pages]
    assert sum(H.extract(a) == H.extract(b) for a, b in zip(pages, plain)) >= 0.95 * len(pages)


def test_article_element_is_whole_however_short():
    assert H.extract("<body><div>lots of words here that are not in the article at all, many of them</div><article><header><h1>T</h1></header><p>s</article><aside>long aside text with words</aside>") == "T\ns"


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("plain &lt;b&gt; text", "plain <b> text"), ("<p>a<p>b", "a\nb"), ("<script>x", ""), ("<!-- never ends", ""), ("</p></div>x", "x"), ("<p>a&nbsp;&nbsp;b\n c", "a b c"), ("<p/>a<div/>b", "a\nb")])
def test_odd_pages(page, text):
    assert H.extract(page) == text


def test_extraction_over_tables(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>" + "word " * 50_000 + "</article>", "x"), (1, "u", None, None), (None, None, "", "y")], "page_id long, url string, html string, Text string")
    rows = sorted((r.n_chars, r.text[:9]) for r in H.extracted(pages).collect())
    assert rows == [(0, ""), (0, ""), (249_999, "word word")]
    assert H.extracted(pages).columns == ["page_id", "url", "html", "text", "n_chars"] and H.extracted(pages.limit(0)).count() == 0
    out = H.op8_html_extraction(spark, SF)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.filter("n_chars = 0").count() == 0


BODY = "<p>" + "Many plain words of the main text, one after the other, in a long paragraph of its own. " * 4 + "</p>"
TEASER = '<article class="card"><h3><a href="/x">A card</a></h3><p>Short teaser.</p></article>'


@pytest.mark.parametrize("n", [1, 2, 5])
@pytest.mark.parametrize("frame", ["<body><div class='content'>{}</div>{}", "<body><div id='page'><div class='content'>{}</div><div class='cards'>{}</div></div>", "<body><div class='content'>{}{}</div>", "<body><main><div class='content'>{}</div>{}</main>"])
@pytest.mark.parametrize("cards", [1, 3])
def test_text_beside_teaser_articles_is_kept(n, frame, cards):
    got = H.extract(frame.format(BODY * n, TEASER * cards))
    assert got.count("Many plain words") == 4 * n and "teaser" not in got


def test_main_leaves_out_link_lists_and_keeps_short_text():
    links = "<ul>" + "<li><a href='/a'>other page</a></li>" * 20 + "</ul>"
    got = H.extract(f"<body><main><h1>Title</h1><div>{BODY * 4}</div><p>The end.</p><div>{links}</div></main>")
    assert got.startswith("Title\n") and got.endswith("The end.") and "other page" not in got


def test_articles_in_a_frame_are_all_kept():
    got = H.extract("<body><div>A word before.<article>{0}</article><article>{0}</article></div>".format(BODY))
    assert got.count("Many plain words") == 8 and "before" not in got


@pytest.mark.parametrize("wrap", ['<div style="overflow:hidden">{}</div>', '<div title="The hidden city">{}</div>', "<div data-x='a hidden=1' data-hidden>{}</div>", '<section id="search-for-meaning">{}</section>', '<section id="related-work"><h2 id="job-search">A heading here</h2>{}</section>', '<div id="commentary">{}</div>', '<div class="content-with-sidebar">{}</div>', '<section class="related-work">{}</section>', '<section class="commentary">{}</section>'])
@pytest.mark.parametrize("page", ["<body><nav>home</nav><article><h1>Title</h1>{0}{1}</article>", "<body><nav>home</nav><article><h1>Title</h1>{1}</article>", "<body><nav>home</nav><div><h1>Title</h1>{1}</div>", "<body><div>Site of ours</div>{1}"])
def test_names_alone_leave_nothing_out(wrap, page):
    got = H.extract(page.format(BODY, wrap.format(BODY * 2)))
    assert got.count("Many plain words") == 4 * page.count("{0}") + 8 and ("A heading here" in got) == ("A heading here" in wrap)


@pytest.mark.parametrize("noise", ["<div hidden>{}</div>", "<div HIDDEN=''>{}</div>", "<div aria-hidden='true'>{}</div>", "<div role=search>{}</div>", "<div class='related-posts'><a href='/x'>{}</a></div>", "<div class=ad>buy</div>", "<p class='share-buttons'>Share</p>"])
@pytest.mark.parametrize("page", ["<body><article><h1>Title</h1>{0}{1}</article>", "<body><div><h1>Title</h1>{0}{1}</div>"])
def test_noise_that_text_or_attribute_confirms_is_left_out(noise, page):
    assert H.extract(page.format(BODY, noise.format("Nothing of the article"))) == H.extract(page.format(BODY, ""))


def test_many_comments_are_no_article():
    comment = "<div class='comment'><article><b>me</b><p>A short remark of a reader.</p></article></div>"
    got = H.extract(f"<body><div><h1>Title</h1>{BODY * 2}</div><section class='comments'>{comment * 40}</section>")
    assert got.count("Many plain words") == 8 and "remark" not in got


# licences


def test_licences_match_sql(spark, docs):
    mit = " ".join(t for n, t in L.SENTENCES if n in ("MitGrant", "MitNotice", "AsIsCaps", "MitLiability"))
    texts = [mit, f"Intro.\nReleased under the MIT License. Licensed under CC BY-NC 4.0.\nmore", "This work is licensed under the GNU General Public License, version 3.", "All rights reserved. Released under the MIT License.", "You need a licence for that.", "licensed under the apache license version 2 0", "Licensed under the Apache License, Version 2.0.\n" * 3]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(texts, 1000)), "doc_id long, text string"))
    got = L.licences(table.withColumns({"ids_": F.lit(1), "Status": F.lit(2)})).select("doc_id", "sentence_ids", "licences", "n_unknown", "status").collect()
    assert same(got, oracle(L.OP10_SQL, documents=table))
    by = {r.doc_id: r for r in got}
    assert by[1000].licences == "MIT" and by[1001].licences == "MIT AND CC-BY-NC-4.0" and by[1002].licences == "GPL-3.0-only"
    assert by[1004].status == "unknown" and by[1005].licences == by[1006].licences == "Apache-2.0" and by[0].status == "none"
    assert L.licences(table.limit(0)).count() == 0


def versions_of(text):
    mark = next((m for m in L._VERSIONS if m in text), None)
    return [text.replace(mark, v) for v in L._VERSIONS[mark]] if mark else [text]


def test_every_known_sentence_and_rule_is_found_in_its_own_text(spark):
    ids = {v: L.known_sentences()[L.normal(v)] for _, t in L.SENTENCES for v in versions_of(t)}
    text_of = {i: t for t, i in ids.items()}
    rows = [(t, i, None) for t, i in ids.items()] + [("\n".join(text_of[i] for i in p.split()), p, n) for p, n in L.expanded_rules()]
    got = L.licences(spark.createDataFrame(rows, "text string, want string, name string")).collect()
    assert [(r.text, r.sentence_ids) for r in got if r.sentence_ids != r.want or r.n_unknown] == []
    assert [(r.text, r.licences) for r in got if r.name and (r.licences, r.status) != (r.name, "known")] == []


@pytest.mark.parametrize("begin", ["", "# ", " * ", "// ", ";; "])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_licences_are_found(spark, begin, end):
    of = lambda *names: [versions_of(next(t for n, t in L.SENTENCES if n == name))[-1] for name in names]
    texts = {
        "MIT": [of("MitGrant"), of("MitNotice"), of("AsIsCaps", "MitLiability")],
        "Apache-2.0": [of("ApacheGrant2", "ApacheObtain"), ["http://www.apache.org/licenses/LICENSE-2.0"], of("ApacheAsIs", "ApacheSee")],
        "GPL-3.0-or-later": [of("GplFree"), of("GplHope", "GplSee"), of("GplCopy")],
        "BSD-3-Clause": [of("BsdGrant"), ["1. " + of("BsdSource")[0]], ["2. " + of("BsdBinary")[0]], ["3. " + of("BsdEndorse")[0]]],
        "MPL-2.0": [of("MplRef2")],
    }
    wrapped = lambda paragraphs: f"{end}{begin.rstrip()}{end}".join(end.join(begin + x for x in textwrap.wrap(" ".join(p), 72)) for p in paragraphs)
    rows = [(n, f"#!/bin/sh{end}{begin.rstrip()}{end}{wrapped(p)}{end}{end}import x{end}") for n, p in texts.items()]
    rows += [("", f"{begin}Permission is hereby granted, free of charge, to any{end}{end}{begin}person"), ("MIT", f"{begin}SPDX-License-Identifier: MIT{end}import x"), ("MIT AND Proprietary", f"{begin}All rights reserved{end}{begin}Released under the MIT License{end}{begin}more")]
    got = L.licences(spark.createDataFrame(rows, "want string, text string")).collect()
    assert [(r.want, r.licences, r.sentence_ids) for r in got if r.want != r.licences] == []
    assert {r.n_unknown for r in got if r.want in ("MIT", "GPL-3.0-or-later", "BSD-3-Clause", "MPL-2.0")} == {0}
