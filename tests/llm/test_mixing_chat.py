import hashlib
import json

import pytest
from pyspark.sql import functions as F

from orderloom.llm import chat, mixing


def plain_targets(sizes):
    """Targets by cutting and sharing anew until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        target = {s: 2 * sizes[s] if s in capped else left * weight[s] / sum(weight[f] for f in free) for s in names}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(frame):
    rows = [(i, "w " * (1 + i % 7), src, 1, 2) for i, src in enumerate(["a"] * 40 + ["b"] * 90 + [None] * 20 + ["ü"] * 3)]
    rows += [(500, None, "a", 1, 2), (501, "", "z", 1, 2), (502, "\t\x1f x", "a", 1, 2), (0, rows[0][1], "a", 1, 2)]
    docs = frame(rows, "doc_id long, text string, source string, size int, target int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, src, *_ in rows:
        n = len([w for w in (text or "").replace("\t", " ").split(" ") if w])
        sizes[src] = sizes.get(src, 0) + n
    want = plain_targets(sizes)
    assert {round(r.target, 6) for r in got} == {round(float(t), 6) for t in want.values()}
    assert all(0 <= r.taken <= 2 * r.size for r in got) and sum(r.source_size for r in got if r.doc_id == 500) == sizes["a"]
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))
    out = mixing.emit(docs, copy_column="copy")
    assert out.columns == docs.columns + ["copy"]
    taken = {r.doc_id: r.copies for r in got}
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: n * (2 if i == 0 else 1) for i, n in taken.items() if n}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_rows_without_an_id_draw_apart(frame):
    """A source whose rows have no id, or one id, still comes near its target."""
    rows = [(None, f"text number {i} of many", "a") for i in range(600)] + [(7, f"other words {i}", "b") for i in range(600)]
    got = mixing.mix(frame(rows, "doc_id long, text string, source string"))
    sums = got.groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.sum("size").alias("size")).collect()
    assert len(sums) == 2 and all(abs(r.taken - r.target) < 0.1 * r.size for r in sums)


EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def test_fold(frame):
    log = [
        (1, 1, 1, "message", "user", "hi"), (1, 1, 5, "edit", None, "hello"),
        (1, 2, 1, "delta", "assistant", "wro"), (1, 2, 2, "delta", None, "ng"), (1, 2, 3, "regenerate", None, None),
        (1, 2, 4, "delta", None, "rig"), (1, 2, 5, "delta", None, "ht"), (1, 2, 6, "delta", None, None),
        (2, 1, 1, "delta", None, "a"), (2, 1, 1, "delta", None, "b"), (None, None, None, "message", "user", None)]
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.fold(frame(log, EVENTS)).collect()}
    assert got == {(1, 1): ("user", "hello"), (1, 2): ("assistant", "right"), (2, 1): ("", "ab"), (None, None): ("user", "")}


def test_round_trip_of_hostile_texts(spark, frame):
    hostile = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "<s", "[", "a|b\\|c", "[/INST", "<</s>>", "[[INST]]", "", "x\n\ny", "\\\\<s>", "é" * 3000]
    rows = [(7, k, role, text, "n") for k, (text, role) in enumerate((t, r) for t in hostile for r in ("user", "assistant", "t|o\\ol", None))]
    rows += [(8, None, "user", None, "n"), (8, 1, "assistant", "yes", "n"), (8, 1, "assistant", "yes", "n")]
    table = frame(rows, "conv_id long, turn long, role string, text string, formatted string").select("conv_id", "turn", "role", "text")
    read = chat.read_back(chat.render(chat.fold(chat.message_events(table.unionByName(chat.probe(spark))))))
    got = {r.conv_id: r for r in read.collect()}
    assert [(t.role, t.text) for t in got[7].turns] == [(r or "", x) for _, _, r, x, _ in rows if _ == "n"][:len(hostile) * 4]
    assert [(t.text, t.loss) for t in got[8].turns] == [("", False), ("yes", True), ("yes", True)]
    assert [t.text for t in got[-7].turns] == ["</s>[INST] ok [/INST]"] * 2
    d = {r.conv_id: r for r in chat.digests(read).collect()}
    loss = "".join(x for x in hostile)
    assert d[7].loss_chars == len(loss) and d[7].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert d[7].formatted_chars == len(got[7].formatted) and d[8].n_turns == 3
    assert chat.render(chat.fold(frame([], EVENTS))).count() == 0
