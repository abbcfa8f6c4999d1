import heapq
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quizlake.llm import huffman as H
from tests.llm.helpers import AWKWARD, SF001, awkward

BPE = public_tokenizers.path("byte_bpe_50k.json")


def huffman_cost(counts):
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("n,limit", [(2, 20), (3, 20), (40, 20), (700, 20), (700, 10), (9, 3)])
def test_code_is_complete_limited_and_optimal(n, limit):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(1.0, n) * 5).astype(np.int64)
    counts[:2] = 1, 7
    lengths = H.code_lengths(counts, limit)
    used = counts > 0
    assert (lengths[used] > 0).all() and not lengths[~used].any()
    assert sum(2.0 ** -lengths[used].astype(float)) == 1.0
    assert lengths.max() <= max(limit, int(used.sum() - 1).bit_length())
    cost = int((counts * lengths).sum())
    if H.code_lengths(counts, 60).max() <= limit:
        assert cost == huffman_cost(counts)
    else:
        assert cost >= huffman_cost(counts)


def test_small_alphabets():
    assert not H.code_lengths(np.zeros(4, np.int64)).any()
    one = H.code_lengths(np.array([0, 9, 0]))
    assert one.tolist() == [0, 1, 0]
    code = H.Code(one)
    ids = np.full(700, 1)
    assert (H.unframe([H.frame(ids, code)], code)[0] == ids).all()


def test_limited_code_is_the_best_within_the_limit():
    """Against all length assignments of five ids that fill the code and stay within three bits."""
    from itertools import product
    rng = random.Random(4)
    for _ in range(30):
        counts = np.array([rng.randint(1, 60) for _ in range(5)])
        best = min(sum(c * n for c, n in zip(counts, ls)) for ls in product((1, 2, 3), repeat=5)
                   if sum(2.0 ** -n for n in ls) <= 1)
        assert int((counts * H.code_lengths(counts, 3)).sum()) == best


def test_frames_round_trip_and_notice_damage():
    rng = np.random.default_rng(5)
    counts = (rng.pareto(0.8, 5000) * 9).astype(np.int64) + 1
    code = H.Code(H.code_lengths(counts))
    parts = [rng.integers(0, 5000, n) for n in (0, 1, H.INTERVAL - 1, H.INTERVAL, H.INTERVAL + 1, 40_000)]
    frames = [H.frame(p, code) for p in parts] + [H.frame(parts[-1], code, 31)]
    for got, want in zip(H.unframe(frames, code), [*parts, parts[-1]]):
        assert (got == want).all()
    bad = bytearray(frames[4])
    bad[-6] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        H.unframe([bytes(bad)], code)


def test_crc_of_pieces():
    rng = random.Random(6)
    for _ in range(30):
        a, b = rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.randint(0, 9000))
        assert zlib.crc32(a + b) == H.crc_shifted(zlib.crc32(a), len(b)) ^ zlib.crc32(b)


def test_words_give_the_same_ids_as_whole_texts():
    from tokenizers import Tokenizer
    public = Tokenizer.from_file(BPE)
    rng = random.Random(7)
    some = [" ", "  ", "\n", "\t", "a", "don't", "'s", "1", "é", " ", " ", "\x1c", "́", "!", "...", "_",
            "<|endoftext|>", "\U0001F600", "​", "中", "\x00", "\x85", "½"]
    texts = ["".join(rng.choices(some, k=rng.randint(0, 14))) for _ in range(8000)]
    tok = H.Tokenizer(H._definition(BPE))
    for lo in (0, 4000):
        ids, n = tok.encode(texts[lo:lo + 4000], (2,))
        for text, got in zip(texts[lo:lo + 4000], np.split(ids, np.cumsum(n)[:-1])):
            assert list(got) == [*public.encode(text, add_special_tokens=False).ids, 2], repr(text)


def brute(rows):
    from tokenizers import Tokenizer
    public = Tokenizer.from_file(BPE)
    out, at = [], 0
    docs = [(d, public.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    for d, ids in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def read_back(spark, path):
    bases = dict(H.read_files(spark, path))
    return sorted(((r.doc_id, bases[r.file] + r.start, r.size, r.crc32)
                   for r in H.crc_of_documents(H.read_ids(spark, path)).collect()), key=lambda r: r[1])


@pytest.mark.parametrize("block,per_file", [(H.BLOCK_TOKENS, H.TOKENS_PER_FILE), (700, 9_000)])
def test_files_equal_brute_force(spark, monkeypatch, block, per_file):
    monkeypatch.setattr(H, "BLOCK_TOKENS", block)
    monkeypatch.setattr(H, "TOKENS_PER_FILE", per_file)
    path = tempfile.mkdtemp(prefix="ids-") + "/t"
    H.write_ids(awkward(spark).repartition(5), path, BPE)
    got = read_back(spark, path)
    assert got == brute([r[:2] for r in AWKWARD])  # both rows of id 8 are equal
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.agg(F.max("n")).first()[0] <= block
    if per_file < 10_000:
        assert len(H.read_files(spark, path)) > 3 and blocks.count() > 50


def test_lost_block_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_TOKENS", 500)
    path = tempfile.mkdtemp(prefix="ids-") + "/t"
    H.write_ids(awkward(spark), path, BPE)
    rows = H.read_ids(spark, path).where("not (at > 0 and at <= 500)")
    with pytest.raises(Exception, match="missing"):
        H.crc_of_documents(rows).collect()


def test_empty_table(spark):
    path = tempfile.mkdtemp(prefix="ids-") + "/t"
    H.write_ids(awkward(spark).limit(0), path, BPE)
    assert read_back(spark, path) == []


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, H.op13_huffman_ids(spark, SF001).collect()), key=lambda r: r[1])
    assert got == brute([tuple(r) for r in docs])


def test_another_tokenizer(spark):
    """A tokenizer with a normaliser is applied to whole texts."""
    from tokenizers import Tokenizer
    name = public_tokenizers.path("word_bpe_49k.json")
    texts = ["The Quick  brown fox", "", "é È ß don't 123"]
    public = Tokenizer.from_file(name)
    ids, n = H.Tokenizer(H._definition(name)).encode(texts)
    assert [list(g) for g in np.split(ids, np.cumsum(n)[:-1])] == [public.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_call_looks_up_its_distinct_words_only():
    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

        def __getitem__(self, k):
            Counted.asked += 1
            return super().__getitem__(k)

    tok = H.Tokenizer(H._definition(public_tokenizers.path("byte_bpe_50k.json")))
    tok.of = Counted()
    texts = ["one two three " * 400 + "end", "two  spaces", "", "one", " lead"]
    ids, n = tok.encode(texts, (2,))
    want = [tok.model.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert 0 < Counted.asked < 30


def test_ranked_bytes_give_the_ids_back():
    rng = np.random.default_rng(4)
    ranks = H.Ranks(np.concatenate([rng.integers(0, 9, 40_000), np.zeros(10_000, np.int64)]))
    ids, sizes = rng.integers(0, 50_000, 5_000), np.array([0, 1, 4_000, 0, 999, 0])
    parts = ranks.pack(ids, sizes)
    assert [len(ranks.unpack([p])) for p in parts] == sizes.tolist()
    assert ranks.unpack(parts).tolist() == ids.tolist() and ranks.unpack([]).tolist() == []


def test_a_word_is_encoded_once_whatever_follows_it():
    tok = H.Tokenizer(H._definition(BPE))
    given, plain = [], tok._ids
    tok._ids = lambda texts: given.extend(texts) or plain(texts)
    words = ["".join(random.Random(i).choices("abcdefghiéß", k=9)) for i in range(50)]
    texts = ["start " + end.join(words) for end in (" ", ". ", ", ", "! ", "? ", "; ", ": ", ".\n ", "!!! ", ") ")]
    ids, n = tok.encode(texts, (2,))
    want = [tok.model.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert sum(map(len, given)) < 3 * sum(map(len, words))


@pytest.mark.parametrize("kept,bits", [(40, 12), (300, 10), (10_000, 8)])
def test_forgotten_and_crowded_out_units(monkeypatch, kept, bits):
    monkeypatch.setattr(H, "UNITS_KEPT", kept)
    monkeypatch.setattr(H, "TABLE_BITS", bits)
    rng, tok = random.Random(8), H.Tokenizer(H._definition(BPE))
    texts = [" ".join("".join(rng.choices("abé.x\x00", k=rng.choice([1, 2, 3, 8, 14, 15, 16, 17, 200]))) for _ in range(40))
             for _ in range(60)]
    for lo in range(0, 60, 6):
        ids, n = tok.encode(texts[lo:lo + 6], (2,))
        want = [tok.model.encode(t, add_special_tokens=False).ids + [2] for t in texts[lo:lo + 6]]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert tok.learnt <= min(1 << (bits - 1), kept + 6 * 40 * 9 + 1)
