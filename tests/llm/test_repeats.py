import hashlib
import random

import numpy as np
import pytest

from pyspark.sql import types as T

import corpus_pipeline
from orderloom.llm import repeats


def plain(rows, length=100):
    """Expected report by a set of all strings seen so far."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: r[0]):
        data = (text or "").encode()
        cover = bytearray(len(data))
        for p in range(len(data) - length + 1):
            g = data[p:p + length]
            if g in seen:
                cover[p:p + length] = b"\1" * length
            seen.add(g)
        kept = bytes(b for b, c in zip(data, cover) if not c)
        spans = sum(1 for p in range(len(cover)) if cover[p] and (p == 0 or not cover[p - 1]))
        out[i] = (len(data), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(24):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 50))) for _ in range(3)]
        if i % 2:
            p = rng.choice(passages)
            parts.insert(1, p[rng.randint(0, 40):] if i % 4 == 1 else p)
        rows.append((i * 3, "\n".join(parts)))
    copy = rows[5][1]
    return rows + [(200, copy), (201, copy[:150] + "Z" + copy[150:]), (202, None), (203, ""), (204, "For " * 300), (1, "x" * 99),
                   (205, "ab" * 50), (206, "q" * 500)]


def test_index_finds_all_repeated_starts():
    rng = np.random.default_rng(0)
    for trial in range(12):
        length = (100, 8, 20)[trial % 3]
        base = rng.integers(97, 97 + (2, 4, 26)[trial % 3], 400).astype(np.uint8)
        parts = []
        for _ in range(25):
            a, n = int(rng.integers(0, 300)), int(rng.integers(length, 170))
            part = base[a:a + n].copy()
            part[rng.integers(0, len(part))] = 120
            parts += [part] * (len(part) >= length)
        seen, want = set(), set()
        for s, part in enumerate(parts):
            for i in range(len(part) - length + 1):
                g = part[i:i + length].tobytes()
                want |= {(s, i)} if g in seen else set()
                seen.add(g)
        segment, offset = repeats.repeated_starts(parts, length)
        assert set(zip(segment.tolist(), offset.tolist())) == want


def test_matching_statistics_come_from_the_runs():
    """Lengths and partners are right at every place, and rest on the sampled run ends."""
    rng = np.random.default_rng(4)
    base = rng.integers(97, 100, 200).astype(np.uint8)
    parts = [base[a:a + n].copy() for a, n in zip(rng.integers(0, 100, 15), rng.integers(5, 90, 15))]
    index = repeats.RunIndex(parts)
    assert len(index.run_size) < len(index.text) / 2 and index.run_size.sum() == len(index.text)
    matched, partner = index.matching_statistics()
    text, stop = index.text.tolist(), index.own_stop.tolist()
    suffixes = sorted((text[i:stop[i]] + [0, i], i) for i in range(len(text)))
    for (a, p), (b, q) in zip(suffixes, suffixes[1:]):
        same = 0
        while a[same] == b[same] and a[same] > 0:
            same += 1
        assert matched[q] == same and (same == 0 or partner[q] == p)
    index.run_end_place = np.zeros_like(index.run_end_place)
    assert (index.matching_statistics()[0] != matched).any()


@pytest.mark.parametrize("part_bytes, block, rows_held", [(2 << 20, 1 << 18, 1 << 17), (400, 300, 5)])
def test_report_equals_brute_force(frame, monkeypatch, part_bytes, block, rows_held):
    """Also with parts so small that groups are spread by hash, texts cut into blocks, and rows met in small chunks."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    monkeypatch.setattr(repeats, "CHUNK_ROWS", rows_held)
    rows = texts(7)
    docs = frame([(i, t, 5) for i, t in rows], "doc_id long, text string, doc int", 3)
    got = repeats.repeat_report(docs, part_bytes=part_bytes).collect()
    assert {r.doc_id: tuple(r[1:]) for r in got} == plain(rows) and len(got) == len(rows)


def test_repeated_and_shared_ids(frame):
    rows = [(1, "a b c " * 40), (1, "a b c " * 40), (None, "k l m n o p q " * 12), (2, "k l m n o p q " * 12)]
    got = repeats.repeat_report(frame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by[1]) == 2 and by[1][0] == by[1][1] and 0 < by[1][0].n_removed < by[1][0].n_bytes
    assert by[2][0].n_removed == by[2][0].n_bytes and by[None][0].n_removed < by[None][0].n_bytes   # null ids come first


def test_texts_without_repeats(frame):
    rows = texts(9)
    docs = frame([(i, t, "s") for i, t in rows], "doc_id long, text string, bytes string")
    out = repeats.without_repeats(docs)
    assert out.columns == docs.columns
    got, want = {r.doc_id: r.text for r in out.collect()}, plain(rows)
    for i, t in rows:
        if want[i][1] == 0:
            assert got[i] == t
    assert got[200] == "" and got[202] is None and len(got) == len(rows)
    assert repeats.repeat_report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("first", [0, None])
def test_columns_of_the_caller_keep_their_values(frame, first):
    """Names that the operator uses itself, with ids that serve as they are and with numbered rows."""
    names = ["doc", "bytes", "ats", "key", "row", "_mark", "_n", "a.b"]
    rows = texts(9)
    docs = frame([(first if i == 0 else i, t, *[f"{n} {i}" for n in names]) for i, t in rows],
                 T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(n, T.StringType()) for n in ["text", *names]]]))
    out = repeats.without_repeats(docs)
    assert out.columns == docs.columns
    got, before = {r[0]: r for r in out.collect()}, {r[0]: r for r in docs.collect()}
    assert got.keys() == before.keys() and all(got[i][2:] == before[i][2:] for i in got)
    assert sum(got[i].text != before[i].text for i in got) > 2


def test_mix_keeps_a_column_copy(spark, frame):
    docs = frame([(i, f"text {i}", "s0", f"c{i}") for i in range(40)], "doc_id long, text string, source string, copy string")
    out = corpus_pipeline.mixing_stage(spark, docs, "")
    assert out.columns == [*docs.columns, "copy_"] and all(r.copy == f"c{r.doc_id}" and r["copy_"] >= 1 for r in out.collect())
