import re

import numpy as np
import pytest
import xxhash

from orderloom.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component_id int, rows int"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("segment", [5, 1 << 22])
def test_fingerprint(monkeypatch, segment):
    monkeypatch.setattr(simhash, "SEGMENT_BYTES", segment)
    for text in (None, "", " \n\t", "One", "one two", "A b C d", "É ß x\x1fy z w q", "a b c " * 40, "wort " * 9 + "Ende"):
        assert simhash.fingerprint(text) == plain_fingerprint(text), text


def test_sliced_comparison_equals_brute_force():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64) for _ in range(4)]
    fp = np.unique(np.concatenate([base, base ^ flips[0], base ^ flips[0] ^ flips[1], base ^ flips[1] ^ flips[2] ^ flips[3]]))
    starts = np.array([0, 1, 4, 70])
    group = np.searchsorted(starts, np.arange(len(fp)), "right")
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
            if group[i] == group[j] and bin(int(fp[i]) ^ int(fp[j])).count("1") <= 2}
    left, right = simhash.compare_sliced(fp, starts)
    assert want and set(zip(left.tolist(), right.tolist())) == want


@pytest.mark.parametrize("crowded", [2, 2048])
def test_near_edges_connect_all_links(frame, crowded):
    """Crowded buckets are refined; a chain of steps of two bits stays one component."""
    rng = np.random.default_rng(5)
    values, fp = set(), 0
    for _ in range(12):
        values.add(fp)
        a, b = rng.choice(64, 2, replace=False)
        fp ^= (1 << int(a)) ^ (1 << int(b))
    values |= {int(x) for x in rng.integers(1 << 40, 1 << 62, 10)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.near_edges(frame([(v,) for v in signed], "fp long"), crowded=crowded).collect()
    parent = {v: v for v in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in edges:
        parent[find(e.a)] = find(e.b)
    for x in signed:
        for y in signed:
            if bin((x ^ y) & (1 << 64) - 1).count("1") <= 2:
                assert find(x) == find(y)
    assert all(find(r.a) == find(r.b) for r in edges) and len({find(v) for v in signed}) >= 2


def test_groups(frame):
    rows = [(9, None), (4, ""), (4, ""), (7, "a b c d e f g"), (2, "A B C D E F G"), (5, "other words stand here now"), (8, " \n ")]
    docs = frame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(9, 4), (4, 4), (7, 2), (2, 2), (5, 5), (8, 4)}
    assert {r.fingerprint for r in got if r.component_id == 4} == {"0" * 16}
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_group_leads(frame):
    rows = [(9, None), (4, ""), (4, ""), (7, "a b c d e f g"), (2, "A B C D E F G"), (2, "a b c d e f g"), (None, "other words stand here now"),
            (None, "Other words stand here now"), (8, " \n ")]
    docs = frame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    import hashlib
    digest = {t: hashlib.md5((t or "").encode()).hexdigest() for _, t in rows}
    got = {(r.id, r.h, r.n) for r in simhash.group_leads(docs).collect()}
    both = min(digest["A B C D E F G"], digest["a b c d e f g"])
    other = min(digest[t] for i, t in rows if i is None)
    assert got == {(4, digest[""], 2), (2, both, 1), (None, other, 1)}
    assert simhash.group_leads(docs.limit(0)).count() == 0
