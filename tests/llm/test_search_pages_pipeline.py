import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import html_blocks, lsh


def test_perturbations_are_ordered_and_valid():
    sets = lsh.perturbations(4, 60)
    assert sets[0] == () and len(set(sets)) == len(sets)
    assert all(not any(9 - j in s for j in s) for s in sets)


def test_scores_depend_on_the_pair_alone():
    """Whatever cells two vectors meet in, their score is the same double, and ties at the border go to smaller ids."""
    rng = np.random.default_rng(5)
    members, queries = rng.normal(size=(200, 33)), rng.normal(size=(9, 33))
    members[150:] = np.roll(members[:50], 0, axis=1)
    want = None
    for cells in (1, 3, 40):
        left = lsh.pd.DataFrame({"cell": np.arange(200) % cells, "cid": np.arange(200)[::-1], "vec": list(members)})
        right = lsh.pd.DataFrame({"qid": np.arange(9), "cells": [np.arange(cells)] * 9, "vec": list(queries)})
        got = lsh._scored(left, right, 20).sort_values(["qid", "score", "cid"], ascending=[True, False, True]).reset_index(drop=True)
        assert want is None or got.equals(want)
        want = got
    at = 199 - want["cid"].to_numpy()
    assert (want["score"].to_numpy() == lsh.products(queries, members, want["qid"].to_numpy(), at)).all()
    plain = lsh.products(queries, members, np.repeat(np.arange(9), 200), np.tile(np.arange(200), 9)).reshape(9, 200)
    for q in range(9):
        order = np.lexsort((199 - np.arange(200), -plain[q]))[:20]
        assert (199 - order).tolist() == want["cid"][want["qid"] == q].tolist()


def test_exact_beyond_the_cap(frame):
    """Where the most probes do not reach the aim, every row is scored, over several slices of queries and split cells."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12))
    table = frame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>", 3)
    crowds = np.repeat(x[:4] / np.sqrt((x[:4] * x[:4]).sum(axis=1, keepdims=True)), 30, axis=0)
    assert lsh.fitted(x, 10.0, most=1).exact and not lsh.fitted(crowds, 1.0, top=3, most=50).exact
    rows = lsh.nearest(table, asks=F.col("vec_id") % 5 == 0, top=7, cell=32, most_probes=1, slice_queries=20).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert len(got) == len(rows) == 80 * 7
    for q in range(0, 400, 5):
        scores = lsh.products(x, x, np.full(400, q), np.arange(400))
        scores[q] = -np.inf
        order = np.lexsort((np.arange(400), -scores))[:7]
        assert [got[q, k + 1] for k in range(7)] == [(int(v), scores[v]) for v in order]


def test_nearest_against_brute_force(frame):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[40:80] = x[40]                       # a crowd of equal vectors
    rows = [(i, [float(v) for v in r], "a") for i, r in enumerate(x)]
    rows += [(400, None, "a"), (420, [0.0] * 8, "a"), (440, [float("nan")] * 8, "a"), (460, [None] + [1.0] * 7, "a"),
             (480, [float("inf")] * 8, "a"), (500, [1.0, 2.0, 3.0], "a"), (501, [3.0, 2.0, 1.0], "a"), (5, rows[5][1], "a")]
    table = frame(rows, "vec_id long, embedding array<float>, score string", 3)
    got = {}
    for r in lsh.nearest(table, asks=F.col("vec_id") % 20 == 0, top=10, cell=16, slice_queries=6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [i for i in range(300) if i % 20 == 0] + [500]
    assert got[500] == [(1, 501, 10.0)]
    hits = 0
    y = x.astype(float)
    for q in range(0, 300, 20):
        scores = y @ y[q]
        scores[q] = -np.inf
        order = np.lexsort((np.arange(300), -scores))[:10]
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 11)) and len({f[1] for f in found}) == 10
        assert all(abs(scores[v] - s) < 1e-12 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        hits += len({f[1] for f in found} & set(order.tolist()))
    assert hits >= 0.9 * 150
    assert lsh.nearest(table.limit(0)).count() == 0


ARTICLE = ("The first paragraph of a long story goes on &amp; on, with many words in it, as stories do.",
           "A second paragraph follows the first, and it is not much shorter than that one was.")


def page(k, body=None):
    text = "".join(f"<p>{p} Number {k}.</p>" for p in ARTICLE)
    return (f"<!DOCTYPE html><html><head><title>T {k}</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li>"
            f"<a href=/>Home</a></li><li><a href=/b>News</a></li></ul></nav><!-- x --><div class='ad'>Buy now {k}</div>"
            f"{body or f'<article><h1>Title {k}</h1>{text}</article>'}<footer>&copy; {k} site</footer></body></html>")


def test_blocks():
    got = html_blocks.blocks_of("a<p><b>x &lt;y&gt;<br>z\n\n w<p>v<script>if (a<b) '<p>'</script> u<ul><li>1<li>2 <a href='>'>l</a></ul>t<!-- -")
    assert [b[1] for b in got] == ["a", "x <y> z w", "v u", "1", "2 l", "t"]
    assert got[3][0].names() == ("ul", "li") and 0 < got[4][2] < 1
    assert html_blocks.blocks_of(None) == html_blocks.blocks_of("<p> &nbsp;</p><style>x") == []
    assert [b[1] for b in html_blocks.blocks_of("</div>x</p>" + "<div>" * 3000 + "y")] == ["x", "y"]


@pytest.mark.parametrize("page, blocks", [
    ("<a " * 350_000, 1), ('<a ">"' * 170_000, 1), ("<a '" * 250_000, 1), ("<a" * 500_000 + ">", 0), ("<div>x" * 170_000, 170_000),
    ("<div>" * 100_000 + "</p>" * 100_000, 0), ("<u><div>" + "<b>" * 150_000 + "</u>" * 100_000, 0),
    ("<table>" + "<b>" * 100_000 + "<li>" * 100_000, 0), ("\u0130" + "<script></script>" * 60_000, 1)])
def test_unclosed_and_nested_markup_takes_linear_time(page, blocks):
    begin = time.process_time()
    got = html_blocks.blocks_of(page)
    html_blocks.vectors([got])
    assert len(got) == blocks and time.process_time() - begin < 15       # a quadratic search takes hours


def test_a_path_is_the_sum_of_its_elements():
    for names in [(), ("div",), ("body", "nav a b"), ("html", "body", "article x", "div ad", "p", "main", "p")]:
        want = np.zeros(html_blocks.PATH_SLOTS)
        for depth, element in enumerate(reversed(names)):
            tag, *words = element.split(" ")
            for token, weight in [(f"t:{tag}", 1), (f"d{min(depth, 2)}:{tag}", 0.5), *((f"n:{w}", 1) for w in words)]:
                h = zlib.crc32(token.encode())
                want[h % html_blocks.PATH_SLOTS] += weight if h >> 16 & 1 else -weight
        path = html_blocks.Path.of(*names)
        assert path.names() == names and (path.vector() == want).all()
    label = {n: html_blocks.path_label(html_blocks.Path.of(*n)) for n in [("p",), ("nav",), ("nav", "main"), ("main", "p ad"), ("article", "p")]}
    assert list(label.values()) == [None, False, True, False, True]


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = html_blocks.BlockLabeller(3)
    x, y, sizes = rng.normal(size=(9, html_blocks.INPUT)), (rng.random(9) > 0.5).astype(float), [4, 1, 4]
    _, grads = net.gradients(x, sizes, y)
    for name, value in net.theta.items():
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in value.shape)
            old = value[at]
            value[at] = old + 1e-5
            up, _ = net.gradients(x, sizes, y)
            value[at] = old - 1e-5
            down, _ = net.gradients(x, sizes, y)
            value[at] = old
            assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-6, name


def test_main_text(frame, monkeypatch):
    rows = [(k, f"u{k}", page(k), 1) for k in range(60)] + [(70, None, None, 1), (71, "u", "", 1), (0, "u0", page(0), 1)]
    other = page(80, "<div class=content><h1>Title 80</h1><p>" + ARTICLE[0] + "</p><p>" + ARTICLE[1] +
                 "</p></div><div class=comments><p>I like it a lot.</p></div>")
    pages = frame(rows + [(80, "v", other, 1)], "page_id long, url string, html string, text int")
    got = html_blocks.main_text(pages).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.page_id < 60:
            want = [f"Title {r.page_id}"] + [f"{p.replace('&amp;', '&')} Number {r.page_id}." for p in ARTICLE]
            assert r.text == "\n".join(want) and r.n_chars == len(r.text)
        elif r.page_id in (70, 71):
            assert (r.text, r.n_chars) == ("", 0)
        else:
            assert r.text.split("\n") == ["Title 80", ARTICLE[0].replace("&amp;", "&"), ARTICLE[1]]
    assert html_blocks.main_text(pages.limit(0)).count() == 0


def test_pipeline(spark, frame, tmp_path):
    """Every stage on planted documents: each bad one goes, clean ones stay, and the mix is whole."""
    import random
    rng = random.Random(3)
    words = [a + b for a in "ka lo mi nu pe ri so tu".split() for b in "na te lim dor es".split()]

    def text(n=60):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, item = text(40), text(25)
    docs = [(i, text(), "en", f"s{i % 3}", 0) for i in range(60)]
    docs += [(100 + i, text() + " vilenok vilensur vilenok " + text(20), "en", "s0", 0) for i in range(30)]
    docs += [(200, docs[4][1], "en", "s1", 0), (201, text(30) + " " + passage, "de", "s1", 0), (202, passage + " " + text(30), "de", None, 0),
             (203, text(20) + " " + item + " " + text(20), "en", "s2", 0), (204, None, None, "s2", None), (205, "", "en", "s2", 0),
             (206, docs[4][1].upper(), "en", "s1", 0), (3, docs[3][1], "en", "s0", 0), (None, docs[5][1], "en", "s0", 0), (None, text(), "en", "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(100 <= i < 130)) for i in [*range(0, 60), *range(100, 125)]]
    frame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table, seen, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), {}, {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, table, str(tmp_path)).write.parquet(out)
        following = spark.read.parquet(out)
        if name != "mixing":
            assert following.columns == table.columns
        table, seen[name] = following, {r.doc_id: r for r in following.collect()}
        counts[name] = following.count()
    assert not set(seen["toxicity"]) & set(range(100, 130)) and set(range(60)) <= set(seen["toxicity"])
    assert not {200, 206} & set(seen["near_duplicates"]) and {4, 201, 202, 203} <= set(seen["near_duplicates"])
    assert len({204, 205} & set(seen["near_duplicates"])) == 1
    # Repeated rows leave one; of two rows without id the copy goes and the other stays.
    assert counts["near_duplicates"] == len(seen["near_duplicates"]) == counts["toxicity"] - 5 and None in seen["near_duplicates"]
    assert passage not in seen["repeated_strings"][202].text and passage in seen["repeated_strings"][201].text
    assert set(seen["decontamination"]) == set(seen["repeated_strings"]) - {203}
    assert set(seen["mixing"]) <= set(seen["decontamination"]) and "copy" in table.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == table.count()
