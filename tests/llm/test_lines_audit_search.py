import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import common, filter_audit, lines, term_tree

DOCS = "doc_id long, text string, lang string, d1 int, _dropped int, `n_lines` int, rows int"
BLANK = " \t\n\x0b\f\r"


def as_rows(texts, langs=("en", "de", None)):
    return [(i, t, langs[(i or 0) % len(langs)], 7, 8, 9, 10) for i, t in texts]


# --- line dedup ---------------------------------------------------------------------

def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def plain_lines(rows, least):
    """(id, text) -> (lines, dropped, kept text)"""
    key = lambda line: ascii_lower(line.strip(BLANK))
    seen = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            seen.setdefault(key(line), set()).add((i, t or ""))
    common_keys = {k for k, d in seen.items() if k and len(d) >= least}
    out = Counter()
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if key(x) not in common_keys]
        out[i, len(own), len(own) - len(kept), "\n".join(kept)] += 1
    return out


def test_line_dedup_against_brute_force(frame, monkeypatch):
    rng = random.Random(3)
    pool = ["Shared Line", "  shared line\t", "ÄRGER", "ärger", "", " ", "\x0b", "rare", "x\x1fy", "\x1fshared line", "a  b", "a b"]
    texts = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8)))) for i in range(60)]
    texts += [(100, None), (101, ""), (102, "\n"), (103, "shared line"), (103, "shared line"), (None, "shared line\nown"),
              (None, "rare"), (104, "only\nshared line\n" * 500), (105, "unique " * 2000)]
    rows = as_rows(texts)
    docs = frame(rows, DOCS)
    for heavy in (4096, 2):       # with few heavy keys, and with most keys joined by shuffle
        monkeypatch.setattr(common, "HEAVY_SHARE", heavy)
        for least in (3, 10, 1000):
            got = lines.drop_common_lines(docs, least_documents=least)
            assert got.columns == docs.columns + ["n_lines_", "n_dropped"]
            found = got.collect()
            assert Counter((r.doc_id, r.n_lines_, r.n_dropped, r.text) for r in found) == plain_lines(rows, least)
            assert all((r.d1, r["_dropped"], r.n_lines, r.rows) == (7, 8, 9, 10) for r in found)
    assert lines.drop_common_lines(docs.limit(0)).count() == 0


def test_line_threshold_counts_documents_not_lines(frame):
    rows = as_rows([(1, "x\nx\nx"), (2, "x"), (3, "y")])
    got = {r.doc_id: r.text for r in lines.drop_common_lines(frame(rows, DOCS), least_documents=3).collect()}
    assert got == {1: "x\nx\nx", 2: "x", 3: "y"}
    got = {r.doc_id: r.text for r in lines.drop_common_lines(frame(rows, DOCS), least_documents=2).collect()}
    assert got == {1: "", 2: "", 3: "y"}


# --- filter interaction audit -------------------------------------------------------

def plain_fails(rows):
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    out = []
    for i, t, *_ in rows:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        out.append((len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                    bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    bad = {i for i, _, t in labels if i is not None and t == 1}
    fails, out = plain_fails(rows), {}
    for part in {r[2] or "" for r in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        shapley = Counter()
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order):
                removed = [x for x in left if x[1][f]]
                left = [x for x in left if not x[1][f]]
                shapley[f] += len(removed)
                out[part, "".join("ABCDE"[x] for x in order), step + 1] = [
                    len(left), len(removed), sum(x[1][f] for x in own) - len(removed),
                    sum(x[1][f] and sum(x[1]) == 1 for x in own),
                    sum(x[0] in good for x in removed), sum(x[0] in bad for x in removed)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley["ABCDE".index(order[step - 1])])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_against_brute_force(frame, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}é" for i in range(300)] + ["UPPER"] * 40 + ["$"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 99, 100, 130, 400])))) for i in range(70)]
    texts += [(i, "same text " * 60) for i in range(200, 240)] + [(300, None), (301, ""), (302, "\t\n"), (303, "A#" * 40000)]
    texts += [(None, "same text " * 60), (None, None), (5, texts[5][1]), (5, "same text " * 60)]
    rows = as_rows(texts)
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 230, 3)] + [(6, 1, None), (6, None, 1), (None, 1, 1), (9999, 1, 1)]
    docs, marks = frame(rows, DOCS, 5), frame(labels, "doc_id long, quality int, toxic int")
    want = plain_audit(rows, labels)
    for heavy, fan in ((4096, 64), (1, 2)):          # a second round of sums, and joins by shuffle
        monkeypatch.setattr(common, "HEAVY_SHARE", heavy)
        monkeypatch.setattr(filter_audit, "FAN_IN", fan)
        got = {(r[0], r[1], r[2]): tuple(r[3:]) for r in filter_audit.audit(docs, marks).collect()}
        assert got == want and len(got) == 3 * 600
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert all(v[4:6] == (0, 0) for v in (tuple(r[3:]) for r in filter_audit.audit(docs, marks.limit(0)).collect()))


def test_packed_fields_do_not_overflow():
    many = 2 ** 63 - 1
    counts = filter_audit.unpack(filter_audit._bytes(many * filter_audit.packed_mask(0b10011)))
    one = filter_audit.unpack(filter_audit._bytes(filter_audit.packed_mask(0b10011)))
    assert (counts == one * np.uint64(many)).all() and set(np.unique(one)) == {0, 1}
    assert one[:, :, 1].sum() == 120      # a document is removed once in every order


# --- ranked search ------------------------------------------------------------------

def terms_of(text):
    return [ascii_lower(t) for t in re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain_ranks(docs, items, k=10):
    vectors = [(i, Counter(terms_of(t))) for i, t, *_ in docs]
    vectors = [(i, c) for i, c in vectors if c]
    n, total = len(vectors), sum(sum(c.values()) for _, c in vectors)
    df = Counter(t for _, c in vectors for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(terms_of(t))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in vectors:
            m = 100 - 75 + 75 * sum(c.values()) * n // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, times in own.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_TERMS": 20, "TREE_TERMS": 6, "TREE_CELLS": 60}])
def test_search_against_brute_force(frame, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(term_tree, name, value)
    rng = random.Random(7)
    vocabulary = [f"t{i}" for i in range(40)] + ["Äpfel", "ÉTÉ", "x-y", "A_b", "日本"]
    word = lambda: vocabulary[min(int(rng.expovariate(0.12)), len(vocabulary) - 1)]
    docs = [(i, " ".join(word() for _ in range(rng.choice([1, 5, 20, 60])))) for i in range(300)]
    docs += [(i, docs[7][1]) for i in range(400, 430)] + [(None, docs[7][1]), (7, docs[7][1]), (8, None), (9, ""), (10, "-- !!"),
                                                         (500, "T1 " * 20000 + "t39")]
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 4, 30])))) for i in range(15)]
    items += [(20, docs[7][1]), (21, None), (22, "nowhere"), (23, "T1 t1 t1!"), (24, "two"), (24, "t3 parts"), (None, "t2 t5")]
    rows = frame(as_rows(docs), DOCS, 3)
    asked = frame(items, "item_id long, text string")
    got = term_tree.ranked(rows, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_ranks(docs, items)
    if not limits:
        assert term_tree.ranked(rows.limit(0), asked).count() == 0 and term_tree.ranked(rows, asked.limit(0)).count() == 0
        assert term_tree.ranked(rows.select("doc_id", F.lit(" ").alias("text")), asked).count() == 0


def test_nodes_bound_every_document_below():
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(200):
        own = np.flatnonzero(rng.random(30) < np.linspace(0.9, 0.05, 30))
        vectors.append((own, rng.integers(1, 5, len(own))))
    tree = term_tree.TermTree(list(range(200)), rng.integers(25, 400, 200), vectors, 30)
    terms, weights = np.arange(0, 30, 3), np.arange(1, 11) * 100

    def check(node):
        documents = []
        for child in tree.below[node].tolist():
            documents += check(child) if child >= tree.documents else [child]
        bound = tree.bounds(np.array([node]), terms, weights)[0]
        assert bound >= tree.bounds(np.array(documents), terms, weights).max()
        assert tree.low_id[node] == min(tree.low_id[d] for d in documents)
        return documents

    assert sorted(check(tree.root)) == list(range(200))
    best = []
    assert tree.search(terms, weights, best, 3) <= 400 and len(best) == 3


@pytest.mark.parametrize("bucket, at_once", [(1, 1), (2, 3), (8, 32)])
def test_tree_search_is_exact(monkeypatch, bucket, at_once):
    monkeypatch.setattr(term_tree, "BUCKET", bucket)
    monkeypatch.setattr(term_tree, "AT_ONCE", at_once)
    rng = np.random.default_rng(bucket)
    rows = []
    for i in range(400):
        own = np.flatnonzero(rng.random(20) < np.linspace(0.9, 0.1, 20))
        rows.append((None if i % 97 == 5 else i % 350, int(rng.integers(1, 60)), own, rng.integers(1, 4, len(own))))
    rows += [rows[3]] * 30
    items = [(at, np.sort(rng.choice(20, 6, replace=False)), rng.integers(0, 900, 6)) for at in range(12)]
    got = term_tree.best_in_trees(iter(rows), term_tree.tree_groups(items, 9), 400, 9000, 10, cells=900)
    for at, terms, weights in items:
        scores = []
        for i, n, own, counts in rows:
            tf, m = dict(zip(own.tolist(), counts.tolist())), 25 + 75 * n * 400 // 9000
            s = sum(w * (10 ** 9 * tf.get(t, 0) // (1000 * tf.get(t, 0) + 8 * m)) for t, w in zip(terms.tolist(), weights.tolist()))
            scores.append((-s, i is None, i or 0))
        assert got[at] == sorted(x for x in scores if x[0] < 0)[:10]


def test_digest_of_kept_text(frame):
    got = lines.drop_common_lines(frame(as_rows([(1, None)]), DOCS)).select(F.sha2("text", 256)).first()[0]
    assert got == hashlib.sha256(b"").hexdigest()
