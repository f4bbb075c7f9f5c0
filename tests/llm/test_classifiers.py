import itertools
import random
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from orderloom.llm import quality_crf as crf
from orderloom.llm import toxicity as tox

WORDS = [a + b for a in "ba de fi go lu ma no re".split() for b in "n s t r".split()]


def corpus(n, seed=1):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        bad = i % 3 == 0
        words = [rng.choice(WORDS) for _ in range(rng.randint(30, 60))]
        if bad:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vilenok", "vilensur"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_ngrams_of_blocks_are_those_of_the_text(monkeypatch):
    text = "Straße und Weg, " * 50
    whole = tox.ngram_slots(text)
    monkeypatch.setattr(tox, "BLOCK_CHARS", 37)
    assert (tox.ngram_slots(text) == whole).all()
    assert len(tox.ngram_slots(None)) == len(tox.ngram_slots("")) == 0


def test_toxicity_learns_and_scores_all_rows(spark, frame):
    docs, labels = corpus(120)
    rows = docs + [(900, None), (901, ""), (902, "x " * 5000), (3, docs[3][1])]
    table = frame([(i, t, 0.3) for i, t in rows], "doc_id long, text string, score double")
    marks = frame(labels + [(5, None), (6, 7), (None, 1), (5000, 1)], "doc_id long, toxic int")
    fold = tox.held_out(F.col("doc_id"), 5, 0)
    model = tox.train(table, marks, ~fold)
    got = tox.score(table, model, name="p").select("doc_id", "p", "score").collect()
    assert len(got) == len(rows) and all(0 <= r.p <= 1 and r.score == 0.3 for r in got)
    truth = dict(labels)
    assert all((r.p >= 0.5) == bool(truth[r.doc_id]) for r in got if r.doc_id in truth)
    # one class, or no labels at all
    assert tox.score(table, tox.train(table, marks.where("toxic = 0"), F.lit(True)), name="p").agg(F.max("p")).first()[0] < 0.01
    assert tox.score(table, tox.train(table, marks.limit(0), F.lit(True)), name="p").first().p == 0.5
    assert tox.score(table.limit(0), model, name="p").count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths = [1, 4, 2, 6]
    first = np.cumsum([0, *lengths])[:-1]
    margin, pair = rng.normal(size=sum(lengths)) * 2, rng.normal(size=(2, 2))
    starts = np.zeros(len(margin), bool)
    starts[first] = True
    good, pairs = crf.forward_backward(margin, starts, pair)
    want_pairs = np.zeros((2, 2))
    for a, n in zip(first, lengths):
        total, mass, seen = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum((2 * v - 1) * m / 2 for v, m in zip(y, margin[a:a + n])) + sum(pair[u, v] for u, v in zip(y, y[1:])))
            total += w
            mass += w * np.array(y)
            for u, v in zip(y, y[1:]):
                seen[u, v] += w
        assert np.allclose(mass / total, good[a:a + n])
        want_pairs += seen / total
    assert np.allclose(pairs, want_pairs)


def test_quality_learns_from_document_labels(spark, frame):
    rng = random.Random(2)

    def line(bad):
        words = [rng.choice(WORDS) for _ in range(12)]
        return " | ".join(words) if bad else " ".join(words).capitalize() + "."

    docs, labels = [], []
    for i in range(90):
        bad = i % 2 == 0
        docs.append((i, "\n".join(line(bad and k != 1) for k in range(4))))
        labels.append((i, int(not bad)))
    rows = docs + [(800, None), (801, ""), (802, "\n\n"), (803, "ü" * 100_000), (0, docs[0][1])]
    table = frame([(i, t, "own") for i, t in rows], "doc_id long, text string, bins string")
    model = crf.train(table, frame(labels, "doc_id long, quality int"), F.col("doc_id") < 60)
    got = crf.score(table, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.bins == "own" for r in got)
    truth = dict(labels)
    assert all((r.score >= 0.5) == bool(truth[r.doc_id]) for r in got if r.doc_id in truth)
    marked = crf.line_labels(docs[0][1], model)
    assert [text for text, _ in marked] == docs[0][1].split("\n") and marked[0][1] < 0.5
    assert crf.train(table, frame([(1, 1)], "doc_id long, quality int"), F.lit(True)) == 1.0
    assert crf.score(table.limit(0), model).count() == 0


def test_line_features_do_not_depend_on_pieces(monkeypatch):
    """A long text is read in runs of whole lines; lines that repeat across runs still count as repeated."""
    draw = np.random.default_rng(4)
    words = ["a", "the", "The", "x1", "!!!", "||", "12", "\t", "", "a b", "zz,"]
    for size in (1, 7, 60):
        for _ in range(40):
            texts = ["\n".join(" ".join(draw.choice(words, draw.integers(6))) for _ in range(draw.integers(1, 9))).encode()
                     for _ in range(draw.integers(1, 5))]
            monkeypatch.setattr(crf, "BATCH_BYTES", 1 << 22)
            whole = crf.line_features(texts)
            monkeypatch.setattr(crf, "BATCH_BYTES", size)
            assert all((a == b).all() for a, b in zip(whole, crf.line_features(texts)))
            assert all((a == b).all() for a, b in zip(whole, crf.batched_features(texts)))
    monkeypatch.setattr(crf, "BATCH_BYTES", 1 << 18)
    tracemalloc.start()
    lines, _, _ = crf.line_features([b"Some words of an ordinary line, number 12.\n" * 100_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lines) == 100_001 and peak < 70 << 20       # in one piece it takes 300 MB
