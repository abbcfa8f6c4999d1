import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from quizlake.llm import periods as P
from tests.llm.helpers import AWKWARD, SF001, awkward


def brute_runs(words):
    """Every period's maximal stretches, smallest period kept."""
    n, found = len(words), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p):
                found.setdefault((i, j + p - i), p)
            i = j
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    words = planted(doc_id, words_of(text))
    runs = brute_runs(words)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def some_sequence(rng):
    out = []
    while len(out) < rng.randint(0, 220):
        kind = rng.random()
        if kind < 0.4:
            out += [rng.randint(0, 2) for _ in range(rng.randint(1, 12))]
        else:
            part = [rng.randint(0, 3) for _ in range(rng.randint(1, 14))]
            out += part * rng.randint(1, 7) + part[:rng.randint(0, len(part))]
    return np.array(out, np.int64)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(monkeypatch, seed):
    monkeypatch.setattr(P, "GRID_SLICE", [50, 1 << 20][seed % 2])
    rng = random.Random(seed)
    seqs = [some_sequence(rng) for _ in range(40)]
    doc, start, length, period = P.runs_of(seqs)
    got = sorted(zip(doc.tolist(), start.tolist(), length.tolist(), period.tolist()))
    want = sorted((d, *r) for d, s in enumerate(seqs) for r in brute_runs(s.tolist()))
    assert got == want and len(want) > 20


@pytest.mark.parametrize("letters", [1, 2, 4, 50])
def test_extension_equals_direct_comparison(letters):
    rng = np.random.default_rng(letters)
    seq = rng.integers(0, letters, 400)
    seq[200:300] = seq[40:140]
    lce = P.Extension(seq)
    i, j = rng.integers(0, 400, 3000), rng.integers(0, 401, 3000)
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i, j, lce(i, j)):
        n = 0
        while max(a, b) + n < 400 and seq[a + n] == seq[b + n]:
            n += 1
        assert got == n


def test_cover_meets_every_pair():
    for a in range(P.STEP):
        for b in range(P.STEP):
            d = P.MEET[a, b]
            assert (a + d) % P.STEP in P.COVER and (b + d) % P.STEP in P.COVER


def test_awkward_documents(spark):
    rows = [r for r in AWKWARD if r[0] not in (6, 7)]
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(4000))
    rows += [(6, long, "en", "a"), (20, "a " * 3000, "en", "a"), (21, ("b c d\n" * 30) + "b c d x", "en", "a"),
             (24, "Ab ab " * 40, "en", "a")]
    docs = awkward(spark, rows).repartition(3)
    got = P.find_runs(P.with_planted_runs(docs)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[3].n_words == 0 and by[3].collapsed == "" and by[3].best is None
    for doc_id, text, *_ in rows:
        words = planted(doc_id, words_of(text))
        assert [tuple(x) for x in by[doc_id].runs] == brute_runs(words), doc_id
    assert tuple(by[20].best) == (0, 3000, 1) and by[20].collapsed == "a"


def test_long_periodic_text(spark):
    words = [f"v{i * i % 4099}" for i in range(9000)]
    text = " ".join(words * 3 + words[:7])
    r = P.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r.runs if x.period == 4099 or x.period > 4099] and r.n_words == 27007
    assert [tuple(x) for x in r.runs] == brute_runs_fast(words * 3 + words[:7])


def brute_runs_fast(words):
    """As ``brute_runs``, the comparison of shifted sequences done by arrays."""
    _, w = np.unique(words, return_inverse=True)
    n, found = len(w), {}
    for p in range(1, n // 3 + 1):
        same = np.concatenate([[False], w[:-p] == w[p:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a + p >= max(24, 3 * p):
                found.setdefault((int(a), int(b - a + p)), p)
    return sorted(((s, k, p) for (s, k), p in found.items()), key=lambda r: (r[0], r[2]))


def test_empty_table(spark):
    assert P.find_runs(awkward(spark).limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    docs = [r for r in docs if len(r.text or "") < 30_000]
    got = {r.doc_id: tuple(r) for r in P.op12_periodic_runs(spark, SF001).collect()}
    want = [brute(r.doc_id, r.text) for r in docs]
    assert all(got[w[0]] == w for w in want)
    assert sum(w[1] > 0 for w in want) > 5
