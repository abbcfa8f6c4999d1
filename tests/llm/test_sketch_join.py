import random

import numpy as np
import pytest

from quizlake.llm import sketch_join as S
from tests.llm.helpers import AWKWARD, awkward, shingles


def brute(docs):
    """(doc_id, set size, smallest linked doc_id) of rows with distinct ids."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if a and sets[j] and 100 * same >= 75 * (len(a) + len(sets[j]) - same):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(docs)), key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        words[at:at + rng.choice([0, 1])] = [f"x{rng.randrange(10 ** 6)}"]
    return words


def corpus(seed, groups=25):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for g in range(groups):
        sizes = [1, 3, 5, 6, 8, 12, 20, 40, 90, 200] if g % 3 else [90, 120, 200]
        words = [f"v{rng.randrange(400)}" for _ in range(rng.choice(sizes))] + passage * (g % 3 == 0)
        for _ in range(rng.choice([1, 1, 2, 5])):
            docs.append(" ".join(edited(rng, words, rng.randint(0, max(1, len(words) // 30)))))
    docs += ["junk line here again " * n for n in (3, 4, 50)]
    rng.shuffle(docs)
    return [(i * 3 + 1, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("block", [3, S.GROUP_BLOCK])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "EMIT", 500)  # several hand-overs
    monkeypatch.setattr(S, "FLUSH", 500)  # and compactions
    monkeypatch.setattr(S, "GROUP_BLOCK", block)  # keys in one block, or in many pairs of blocks
    docs = corpus(7) + [r[:2] for r in AWKWARD if r[0] != 8]
    docs += [(1000 + i, t) for i, (_, t) in enumerate(docs[:10])]
    got = S.near_copies(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs)


def test_leaving_out_common_shingles_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "COMMON_SHARE", 1)
    monkeypatch.setattr(S, "COMMON_COUNT", 8)
    docs = corpus(11, 30)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(S._common_shingles(df)) > 0
    assert sorted(map(tuple, S.near_copies(df).collect()), key=repr) == brute(docs)


def test_linked_sets_share_a_band_and_near_sketches():
    rng = np.random.default_rng(3)
    none = np.zeros(0, np.uint64)
    for trial in range(1500):
        n = int(rng.integers(1, 260))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        drop = int(rng.integers(0, n // 4 + 1))
        b = a[drop:] if drop < len(a) else a
        extra = rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 1))).astype(np.uint64)
        b = np.unique(np.concatenate([b, extra]))
        same = len(np.intersect1d(a, b))
        if not len(b) or 100 * same < 75 * (len(a) + len(b) - same):
            continue
        common = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False)) if trial % 3 == 0 else none
        doc, key, cls = S.band_keys(np.array([len(a), len(b)]), np.concatenate([a, b]), common)
        both = [set(zip(cls[doc == i].tolist(), key[doc == i].tolist())) for i in (0, 1)]
        assert len(both[0]) == (doc == 0).sum()
        sizes = [c for c, _ in both[0] & both[1]]
        assert any(sizes.count(c) >= S.shared_keys(c) for c in set(sizes))


def test_one_of_each_keeps_one_row_a_component(spark):
    docs = awkward(spark)
    out = S.one_of_each(docs)
    assert out.columns == docs.columns
    got = sorted((r["doc_id"] for r in out.collect()), key=repr)
    assert got == sorted([1, 3, 4, 5, 6, 8, 9, None, 10, 11, 12, -5, 9_000_000_000], key=repr)
    kept = out.collect()
    assert all(c["score"] == "clash" for c in kept)
    again = S.near_copies(out).groupBy("component_id").count().where("count > 1 and component_id is not null")
    assert again.count() == 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_copies(none).count() == 0 and S.one_of_each(none).count() == 0


def test_long_chains_meet(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in S.components(edges).collect()}
    assert {got[i] for i in range(2, 41)} == {1} and got[101] == 100


def test_a_document_is_one_row_a_hub_however_many_keys_they_share(spark):
    keys = [(k << 8, s) for k in range(50) for s in (1, 2, 3, 4)] + [(k << 8, s) for k in range(50, 90) for s in (1, 5)]
    shared = spark.createDataFrame(keys + [(k << 8, s) for k in range(90, 99) for s in (6, 7, 8)], "key long, sid long")
    label = spark.createDataFrame([(7, 6), (8, 6)], "node long, label long")
    got = [(r["hub"], r["sid"], sorted(r["keys"])) for r in S._open_members(shared, label, 4).collect()]
    # under 1 and 5 only the hub's own pair is left, which the star has compared; 6, 7 and 8 are one component
    assert sorted(got) == [(1, s, [k << 8 for k in range(50)]) for s in (2, 3, 4)]


def test_near_pairs_equal_comparing_all_sketches():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 63, 600).astype(np.uint64)
    sets = sorted((np.unique(np.append(base[:int(k)], rng.integers(0, 1 << 63, int(k) // 8 + 1).astype(np.uint64)))
                   for k in rng.integers(1, 600, 60)), key=len)
    n, label, block = np.array([len(x) for x in sets]), np.arange(60) % 7, np.arange(60) % 2
    sketches = [S.parity_sketch(x) for x in sets]
    for cross in (False, True):
        want = set()
        for i in range(60):
            for j in range(i + 1, 60):
                a, b = (np.frombuffer(sketches[k], np.uint64) for k in (i, j))
                far = int(np.bitwise_count(a ^ S._folded(b, len(a))).sum())
                if (100 * n[i] >= 75 * n[j] and label[i] != label[j] and far <= (n[i] + n[j]) // 7
                        and not (cross and block[i] == block[j])):
                    want.add((i, j))
        assert want and set(S._near_pairs(n, sketches, label, block, cross)) == want


def test_describing_a_batch_of_texts_holds_little_memory():
    import tracemalloc

    import pyarrow as pa
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 1 << 20, 500))) for _ in range(700)]  # 2.4 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(700)), pa.array(texts)], names=["doc_id", "text"])
    list(S._describe([batch.slice(0, 5)]))
    tracemalloc.start()
    try:
        list(S._describe([batch]))
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()
