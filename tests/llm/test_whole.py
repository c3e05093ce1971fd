"""Cases in which an operator once did less than its whole job."""

import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import base, html, langid, minhash, neardup


def families(n=150, dims=16, seed=1):
    """Two tight families whose every cosine across is over 0.98, and far vectors of the same label."""
    r = np.random.default_rng(seed)
    a, b = np.linalg.qr(r.standard_normal((dims, 2)))[0].T
    centres = [a, 0.987 * a + np.sqrt(1 - 0.987**2) * b]
    rows = [(1000 * k + i, (c + r.standard_normal(dims) * 0.002).tolist(), 1) for k, c in enumerate(centres) for i in range(n)]
    return rows + [(5000 + i, r.standard_normal(dims).tolist(), 1) for i in range(300)]


def brute(rows, threshold=0.98):
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.array([r[0] for r in rows])
    for _ in rows:
        new = np.minimum(comp, np.where(near, comp, 1 << 40).min(1))
        if (new == comp).all():
            break
        comp = new
    return {r[0]: (int(n), int(c)) for r, n, c in zip(rows, near.sum(1), comp)}


def linked(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup.link(df).collect()}


def test_neardup_links_beyond_full_lists(spark):
    rows = families()
    want = brute(rows)
    assert want[0] == (299, 0) and want[1000] == (299, 0)
    assert linked(spark, rows) == want


def test_neardup_meets_in_blocks_where_the_last_try_misses(spark, monkeypatch):
    rows = families(12)
    monkeypatch.setattr(neardup, "TRIES", 1)
    monkeypatch.setattr(neardup, "cells", lambda unit: unit.filter("false").select(F.col("node").alias("g"), "node"))
    assert linked(spark, rows) == brute(rows)


def test_html_keeps_what_stands_beside_the_largest_part():
    post = html.Page(f"<body><nav>Home</nav><div class=post><h1>Headline</h1><div class=lead>{'lead ' * 20}</div><div class=body>{'text ' * 75}</div></div><ul><li><a href=/>More of us</a></ul></body>")
    assert post.main(None).split("\n") == ["Headline", ("lead " * 20).strip(), ("text " * 75).strip()]
    quoted = html.Page(f"<main><p>Before it<blockquote>{'said ' * 75}</blockquote><p>After it</main>")
    assert quoted.main(None).split("\n") == ["Before it", ("said " * 75).strip(), "After it"]


def test_html_leaves_the_path_of_the_host_where_it_holds_a_part():
    usual, other = f"<div class=post><div class=text>{'here ' * 35}</div>", f"<section>{'there ' * 65}</section></div>"
    path = html.Page(usual).best()[0]
    assert html.Page(usual + other).main(path).split("\n") == [("here " * 35).strip(), ("there " * 65).strip()]
    assert html.Page(usual + "<ul><li><a href=/>More of us</a></ul></div>").main(path) == ("here " * 35).strip()


def test_one_row_of_each_group_stays(spark):
    long = [" ".join(f"w{k}x{i}" for i in range(200)) for k in range(4)]
    rows = [(1, long[0], "a"), (1, long[0], "b"), (1, long[0], "b"), (2, long[0] + " tail", "a")]  # repeats, a near copy
    rows += [(2, long[1], "a"), (3, long[1].upper(), "a")]  # 2 stays with its other text
    rows += [(None, long[0], "a"), (None, long[2], "a"), (None, long[2], "a"), (None, long[2] + " tail", "b")]
    rows += [(5, "", "a"), (6, "", "a"), (6, "", "a"), (7, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    got = minhash.first_of_groups(df)
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert got.columns == df.columns
    third = [k for k in kept if k[0] is None]
    assert len(third) == 1 and third[0][1] in (long[2], long[2] + " tail")
    assert sorted((k for k in kept if k[0] is not None), key=str) == sorted([(1, long[0]), (2, long[1]), (5, ""), (6, ""), (7, None)], key=str)
    assert sorted(kept, key=str) == sorted(((r["doc_id"], r["text"]) for r in minhash.first_of_groups(df.repartition(2)).collect()), key=str)


def test_every_language_is_learned(spark):
    r = np.random.default_rng(3)
    word = lambda k: "".join(chr(0x4E00 + 8 * k + i) for i in r.integers(0, 8, 3))
    text = lambda k, n: " ".join(word(k) for _ in range(n))
    rows = [(100 * k + i, text(k, 20), f"l{k:02}" if i < 6 else None) for k in range(70) for i in range(8)]
    rows += [(9000 + i, "1 " * 60000 + text(80, 13000), "long") for i in range(3)] + [(9100, text(80, 20), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(df, F.lit(False)).collect()}
    assert [got[100 * k + i] for k in range(70) for i in (6, 7)] == [f"l{k:02}" for k in range(70) for _ in (6, 7)]
    assert got[9100] == "long"


def test_language_stage_keeps_letters_where_nothing_is_learned(spark):
    df = spark.createDataFrame([(1, "plain words", None), (2, "\u00e9", None), (3, "12 !", None), (4, None, None)], "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in langid.confident(df).collect()) == [1, 2]


ARTICLE = "<article><h1>Title here</h1><p>" + "word " * 60 + "</p></article>"
PLAIN = "<h1>Title here</h1><p>" + "word " * 60 + "</p>"


def test_html_spares_what_only_a_class_marks():
    want = "Title here\n" + ("word " * 60).strip()
    for body in (ARTICLE, PLAIN):
        for around in ('<div class="content has-sidebar">{}</div>', '<div class="layout with-sidebar">{}<div class="sidebar">Popular now</div></div>', '<div class="search-results">{}</div>', '<div id="banner-page">{}</div>', '<div class="post comments-open">{}</div><div class="comments"><p>I say a lot.</div>'):
            assert html.Page(f"<body><nav>Home</nav>{around.format(body)}<footer>end</footer>").main(None) == want, around
    # furniture that holds most of a short page's text is furniture all the same
    short = f"<body><article><h1>Title</h1><p>Only this much.</p></article><div class=sidebar>{'other ' * 20}</div><div id=comments>{'said ' * 200}</div>"
    assert html.Page(short).main(None) == "Title\nOnly this much."
    assert html.Page(f"<body><div class=comments>{'said ' * 200}</div>").main(None) == ""


def test_html_keeps_titles_of_article_headers():
    page = "<body><header><h1>Site</h1></header><article><header class=top><h1>The <b>title</b></h1><p>By me</p><nav>x</nav></header><p>Text of it.</p><section><header><h2>Part</h2></header>More.</section><footer>f</footer></article>"
    assert html.Page(page).main(None) == "The title\nText of it.\nPart\nMore."


def test_html_is_linear_in_depth():
    for h in ("<font>" * 100_000 + "text", "<div>" * 100_000 + "deep text", "<p><b>" * 50_000 + "<div>x</div>" * 1000, "<table><tr><td>" * 30_000):
        tracemalloc.start()
        began = time.perf_counter()
        html.Page(h).main(None)
        assert time.perf_counter() - began < 10 and tracemalloc.get_traced_memory()[1] < 200 << 20
        tracemalloc.stop()


def test_html_votes(spark, monkeypatch):
    """The winning path of each host against a count by hand, and the same texts where the winners can't be broadcast."""
    r = np.random.default_rng(2)
    shapes = ["<div class=a{}><p>{}</div><div class=nav>x</div>", "<main><div class=b><p>{1}</div></main>", "<section class='c d{}'>{}</section>"]
    pages = [(i, f"http://h{i % 7}.org/{i}", "<body>" + shapes[int(r.integers(3)) if i % 3 else i % 7 % 3].format(i, "word " * (5 + i % 4))) for i in range(140)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    votes = {}
    for _, url, h in pages:
        path, score = html.Page(h).best()
        votes.setdefault(url.split("/")[2], {}).setdefault(path, []).append(score)
    won = {host: max(((len(s), sum(s), p) for p, s in v.items()))[2] for host, v in votes.items()}
    want = {i: html.Page(h).main(won[url.split("/")[2]]) for i, url, h in pages}
    assert {x["page_id"]: x["text"] for x in html.extract(df).collect()} == want and all(want.values())
    monkeypatch.setattr("tidemark.llm.base.MOST_BROADCAST", 1)
    assert {x["page_id"]: x["text"] for x in html.extract(df).collect()} == want


def test_groups_larger_than_a_block(spark, monkeypatch):
    """Near copies in many blocks, some of them linked with the hub by way of others only; nothing depends on block sizes."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "SIGNATURES", 8)
    r = np.random.default_rng(4)
    word = lambda i: f"w{i}"
    base, rows = [word(i) for i in range(300)], []
    for i in range(60):  # a chain: each step changes a little more of the text
        text = list(base)
        text[: 3 * i] = [f"x{j}" for j in range(3 * i)]
        rows.append((i, " ".join(text)))
    for i in range(60, 100):  # a star around the first
        text = list(base)
        at = int(r.integers(300))
        text[at] = f"y{i}"
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(f"z{i}_{j}" for j in range(50))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    comp = {i: i for i in sets}
    for _ in sets:
        new = {i: min(comp[j] for j in sets if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for i in sets}
        if new == comp:
            break
        comp = new
    assert len(set(comp.values())) == 21
    assert {x["doc_id"]: x["component_id"] for x in minhash.link(df).collect()} == comp


def test_shared_folder_is_asked_for():
    from types import SimpleNamespace as Given

    far = lambda folder, master: Given(conf=Given(get=lambda key, default: folder), sparkContext=Given(master=master))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        base.shared_folder(far(None, "spark://far:7077"))
    assert base.shared_folder(far("hdfs://x/y/", "spark://far:7077")) == "hdfs://x/y"
    assert base.shared_folder(far(None, "local[2]")).startswith("file:///")
