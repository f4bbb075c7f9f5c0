import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import tiling, warc

WORDS = [a + b for a in "ka lo mi nu pe ri so tu".split() for b in "na te lim dor es".split()]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_tiles_are_greedy_and_disjoint():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(30):
        p, t = rng.integers(1, 4, 25), rng.integers(1, 4, 40)
        tiles = tiling.tile(p, [t], 3)
        used_p, used_t = set(), set()
        for a, b, n in tiles:
            assert (p[a:a + n] == np.append(t, -1)[b:b + n]).all()
            assert not used_p & set(range(a, a + n)) and not used_t & set(range(b, b + n))
            used_p |= set(range(a, a + n))
            used_t |= set(range(b, b + n))
        lengths = [n for _, _, n in tiles]
        best = max((n for n in range(1, 26) for i in range(26 - n) for j in range(41 - n) if (p[i:i + n] == t[j:j + n]).all()), default=0)
        assert lengths == sorted(lengths, reverse=True) and (lengths[0] == best if best >= 3 else not lengths)


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_decontamination(frame, bits):
    rng = random.Random(4)
    items = [(k, ". ".join(sentence(rng, 10) for _ in range(3))) for k in range(6)]
    clean = [sentence(rng, 80) for _ in range(20)]
    shuffled = items[1][1].split(". ")[::-1]
    docs = [(100 + i, c) for i, c in enumerate(clean)] + [
        (1, f"{clean[0]} {items[0][1].upper()} {clean[1]}"), (2, f"{shuffled[0]}! {clean[2]} {shuffled[1]}, {shuffled[2]} x"),
        (3, " ".join(items[2][1].split()[:9])), (4, items[3][1].split(". ")[0] + " " + items[3][1].split(". ")[2]),
        (5, "Ärger ÖL drei"), (6, None), (7, ""), (8, items[5][1]), (8, items[5][1])]
    benchmark = items + [(50, "ärger öl DREI"), (51, None), (52, "?!"), (0, items[0][1])]
    table = frame([(i, t, 0.5) for i, t in docs], "doc_id long, text string, coverage double")
    tests = frame(benchmark, "item_id long, text string")
    got = tiling.contaminated(table, tests, filter_bits=bits).distinct().collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 0), (2, 1), (4, 3), (5, 50), (8, 5)}
    assert {r.doc_id: round(r.coverage, 3) for r in got} == {1: 1.0, 2: 1.0, 4: 0.667, 5: 1.0, 8: 1.0}
    kept = tiling.clean(table, tests, filter_bits=bits)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in (1, 2, 4, 5, 8))
    assert tiling.clean(table, tests.limit(0)).count() == len(docs) and tiling.contaminated(table.limit(0), tests).count() == 0


def plain_coverage(text, item, seed=5):
    """Share of the item's words under greedy tiles over the whole text, without any candidate search."""
    pattern, words = tiling._whole(item), tiling._whole(text)
    if not len(pattern) or not len(words):
        return 0.0
    return tiling.covered(pattern, [words], seed)[0]


def test_candidates_lose_no_match(frame):
    """All pairs above the coverage are found, by items of all lengths that share words, sentences and whole texts."""
    rng = random.Random(8)
    pool = [sentence(rng, rng.choice([1, 2, 4, 6, 9])) for _ in range(30)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([1, 2, 5])))) for i in range(60)]
    docs = [(i, " ".join(rng.choice(pool) if rng.random() < 0.6 else sentence(rng, 3) for _ in range(rng.choice([1, 5, 30])))) for i in range(80)]
    docs += [(80, docs[3][1]), (None, docs[4][1])]
    want = {(d, i) for d, text in docs for i, item in items if plain_coverage(text, item) >= 0.5}
    assert len(want) > 100
    for bits in (1 << 20, 64):
        got = tiling.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"), filter_bits=bits)
        assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_runs_over_blocks(monkeypatch):
    """Runs are those of the text as a whole, wherever its blocks end."""
    rng = random.Random(9)
    words = [rng.choice(WORDS[:6]) for _ in range(400)]
    bits = np.zeros(2, np.uint32)
    bits[:] = 0x0F0F3311
    for width in (1, 3, 5):
        part = tiling.Filter(bits, [width])
        whole = tiling._whole(" ".join(words))
        passed = part.may_hold(tiling.window_hashes(whole, width))
        inside = [any(passed[max(0, i - width + 1):i + 1]) for i in range(len(whole))]
        edges = np.flatnonzero(np.diff([0, *map(int, inside), 0]))
        want = [whole[a:b].tolist() for a, b in zip(edges[::2], edges[1::2])]
        assert len(want) > 3
        for block in (7, 20, 64, 1 << 18):
            monkeypatch.setattr(tiling, "BLOCK_CHARS", block)
            tiling._powers.cache_clear()
            assert [r.tolist() for _, r in part.runs(" ".join(words))] == want
    tiling._powers.cache_clear()


def test_repeated_words_cost_no_pairs():
    """Hundreds of equal windows on both sides; tiles are those of the plain greedy choice."""
    import time
    start = time.perf_counter()
    tiles = tiling.tile(np.ones(3000, np.int64), [np.ones(40_000, np.int64), np.array([1, 2, 1])], 5)
    assert tiles == [(0, 0, 3000)] and time.perf_counter() - start < 5
    start = time.perf_counter()
    pattern = np.tile(np.array([1, 1, 1, 2], np.int64), 500)
    tiles = tiling.tile(pattern, [np.tile(np.array([1, 1, 1, 3], np.int64), 3000)], 3)
    assert tiles == [(4 * i, 4 * i, 3) for i in range(500)] and time.perf_counter() - start < 5


def test_tiles_equal_the_plain_choice():
    rng = np.random.default_rng(6)
    for _ in range(60):
        pattern = rng.integers(0, 3, 30)
        runs = [rng.integers(0, 3, n) for n in rng.integers(3, 25, 3)]
        text = [(r, i) for r, run in enumerate(runs) for i in range(len(run))]
        free_p, free_t, want = set(range(30)), set(text), []
        while True:
            best = []
            for p in range(30):
                for r, i in text:
                    n = 0
                    while (p + n in free_p and (r, i + n) in free_t and p + n < 30 and i + n < len(runs[r]) and pattern[p + n] == runs[r][i + n]):
                        n += 1
                    best.append((n, p, r, i))
            longest = max(b[0] for b in best)
            if longest < 3:
                break
            for n, p, r, i in best:
                cells = [(p + k, (r, i + k)) for k in range(longest)]
                if n == longest and all(a in free_p and b in free_t for a, b in cells):
                    free_p -= {a for a, _ in cells}
                    free_t -= {b for _, b in cells}
                    want.append((p, r, i, n))
        starts = np.cumsum([0] + [len(r) + 1 for r in runs[:-1]])
        assert tiling.tile(pattern, runs, 3) == [(p, int(starts[r]) + i, n) for p, r, i, n in want]


def test_record_round_trip():
    data = "<p>é</p>\r\n\r\n".encode() * 9
    digest = hashlib.sha1(data).hexdigest()
    r = warc.parsed(warc.record(-5, "http://a.b/ü\r\nX: 1", data, digest, None, False))
    assert (r.page, r.kind, r.payload, r.payload_bytes, r.digest, r.refers_to) == (-5, "response", data, len(data), digest, None)
    r = warc.parsed(warc.record(None, None, data, digest, 9, True))
    assert (r.page, r.kind, r.payload, r.payload_bytes, r.digest, r.refers_to) == (None, "revisit", None, len(data), digest, 9)
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(warc.record(1, "http://a", data, hashlib.sha1(b"x").hexdigest(), None, False))


def test_keys():
    assert warc.url_key("http://www.Example.com:8080/a?b=1#c") == "com,example,www:8080)/a?b=1#c"
    assert warc.url_key(None) == "" and "\n" not in warc.url_key("http://a.b/x\ny\tz")
    assert warc.url_key("http://[bad/") and warc.entry_key("u", -1, "f") < warc.entry_key("u", 3, "a") < warc.entry_key("u", 10, "a")


def test_archives(spark, frame):
    big, rng = "b" * 1200, random.Random(0)
    rows = [(k, f"http://h{k % 3}.example.org/{k}", "p" * k) for k in range(40)]
    rows += [(50, "http://x.org/", big), (51, "http://x.org/", big), (49, None, big), (60, "http://x.org/", None), (61, "y", "b" * 999),
             (62, "y", "b" * 999), (None, "z", big), (70, "http://x.org/", sentence(rng, 500)), (50, "http://x.org/", big)]
    pages = frame([(p, u, h, "q") for p, u, h in rows], "page_id long, url string, html string, payload string", 3)
    index = warc.build_index(warc.write(pages), block_lines=4)
    asked = pages.withColumn("digest", warc.payload_digest(F.col("html")))
    got = warc.read(warc.lookup(asked, index), texts=True).collect()
    assert len(got) == len(rows)
    kinds = {}
    for r in got:
        kinds.setdefault(r.page_id, set()).add((r.record_type, r.refers_to))
    assert kinds[51] == {("response", None)} and kinds[50] == kinds[49] == kinds[None] == {("revisit", 51)}
    assert kinds[61] == kinds[62] == kinds[60] == {("response", None)}
    assert {r.page_id: (r.payload or b"").decode() for r in got if r.record_type == "response"} == {
        p: h or "" for p, _, h in rows if p not in (49, 50, None)}
    missing = warc.lookup(frame([(999, "http://x.org/"), (0, "http://none/")], "page_id long, url string").withColumn(
        "digest", F.lit("0" * 40)), index)
    assert missing.count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_rows_that_share_id_and_url(frame):
    """Each reads back its own record, with and without an id, long payloads and short ones."""
    rows = [(5, "http://a.org/", "one"), (5, "http://a.org/", "two"), (5, "http://a.org/", "x" * 2000), (5, "http://a.org/", "y" * 2000),
            (None, "u", "three"), (None, "u", "four"), (6, "http://b.org/", "x" * 2000), (5, "http://a.org/", "one")]
    got = warc.round_trip(frame(rows, "page_id long, url string, html string")).collect()
    sha = {h: hashlib.sha1(h.encode()).hexdigest() for _, _, h in rows}
    want = sorted((str(p), len(h), sha[h], "revisit" if p == 5 and h[0] == "x" else "response", 6 if p == 5 and h[0] == "x" else None)
                  for p, _, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
