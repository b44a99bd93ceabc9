"""Periodic runs against brute force on periods, random and planted; odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from conftest import SMALL
from delaylens.llm import periodic_runs as pr
from delaylens.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(words):
    """All runs, by looking for words that equal those a period on, for every period."""
    w = np.array(words, object)
    found, seen = [], set()
    for q in range(1, len(w) // 4 + 1):
        edge = np.diff(np.concatenate([[0], (w[:-q] == w[q:]).astype(int), [0]]))
        for start, end in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) + q).tolist()):
            if end - start >= max(6, 4 * q) and (start, end) not in seen:
                seen.add((start, end))
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(key, words):
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests(words):
    runs = by_hand(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    row = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return len(runs), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    with_runs = 0
    for d in docs:
        want = digests(planted(d.doc_id, WORD.findall(d.text or "")))
        assert rows[d.doc_id] == want, d.doc_id
        with_runs += want[0] > 0
    assert with_runs > 10


@pytest.mark.parametrize("kinds", [1, 2, 3, 8, 60])
def test_random_and_planted_sequences(kinds):
    rng = np.random.default_rng(kinds)
    rows = []
    for _ in range(300):
        n = int(rng.integers(0, 250))
        w = rng.integers(0, kinds, n)
        for _ in range(int(rng.integers(0, 4)) if n > 8 else 0):
            a = int(rng.integers(0, n))
            p = 1 + int(rng.integers(0, max(1, (n - a) // 3)))
            for i in range(a, a + int(rng.integers(0, n - a + 1))):
                w[i] = w[a + (i - a) % p]
        rows.append(w)
    for w, together in zip(rows, pr.runs_of_all(rows)):
        want = [(s, s + n, q) for s, n, q in by_hand(w.tolist())]
        assert list(map(tuple, pr.runs(w).tolist())) == want == list(map(tuple, together.tolist()))


def test_nested_and_long_runs():
    inner = ([1] * 12 + [2]) * 9  # runs of one word inside a run of thirteen
    fibonacci = [[1], [1, 2]]
    while len(fibonacci[-1]) < 2000:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for w in (inner, fibonacci[-1], list(range(700)) * 6, [0] * 5000, list(range(5000)), inner * 5, [1, 2] * 2000 + [1] * 999):
        want = [(s, s + n, q) for s, n, q in by_hand(w)]
        assert list(map(tuple, pr.runs(np.array(w)).tolist())) == want


def test_sets_synchronise():
    """Equal contexts are members alike, and each stretch of a scale has a member unless it is highly periodic."""
    rng = np.random.default_rng(1)
    part = rng.integers(0, 50, 400)
    words = np.concatenate([part, rng.integers(0, 50, 300), part, np.zeros(200, int), part])
    names = [pr.mix64(words.astype(np.uint64) + np.uint64(1))]
    for k in range(5):
        names.append(pr.doubled(names[-1], 1 << k))
    scale = 16
    zero = pr.covered(np.array([1100]), np.array([1300 - scale + 1]), len(names[4]))
    members = set(pr.synchronising(names[4], zero, scale).tolist())
    for shift in (700, 1300):
        assert all((i in members) == (i + shift in members) for i in range(400 - 2 * scale))
    assert all(members & set(range(i, i + scale)) for i in range(1100 - 3 * scale))
    assert not members & set(range(1110, 1250))
    assert len(members) < 6 * len(words) / scale


def test_odd_rows(spark):
    texts = [None, "", " \t\n", "one", "a " * 60_000 + "b", "x y z " * 5, "x y z " * 5, "é\x0bé\x0cé é é é", "no runs in here at all"]
    rows = [(i if i else None, t, 7, "kept", 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long, runs string, pr_words int")
    found = pr.with_runs(docs)
    assert found.columns == ["doc_id", "text", "start", "runs", "pr_words", "pr_runs", "pr_text"]
    got = sorted(found.collect(), key=lambda r: r.doc_id or 0)
    assert [r.pr_words for r in got] == [0, 0, 0, 1, 60_001, 15, 15, 6, 6] and all(r.runs == "kept" and r.start == 7 for r in got)
    assert [[tuple(x) for x in r.pr_runs] for r in got] == [[], [], [], [], [(0, 60_000, 1)], [(0, 15, 3)], [(0, 15, 3)], [(0, 6, 1)], []]
    assert [r.pr_text for r in got] == ["", "", "", "one", "a b", "x y z", "x y z", "é", "no runs in here at all"]
    for r, t in zip(sorted(pr.digest(docs).collect(), key=lambda r: r.doc_id or 0), texts):
        if len(t or "") < 1000:
            words = WORD.findall(t or "")
            assert tuple(r)[1:] == digests(words if r.doc_id is None else planted(r.doc_id, words))
    assert pr.digest(docs.limit(0)).isEmpty()
