"""N-gram Jaccard join by parity sketches: every linked pair is found, copies are not expanded.

A text's set is its distinct five-word shingles (a shorter text: all its words as one). Each
shingle flips one bit of a long bit sketch, so the Hamming distance of two sketches is at most
the symmetric difference of their sets, which for a Jaccard similarity of 0.75 is at most
(|A| + |B|) / 7. Sketches are cut into bands; a band's content is keyed by the XOR of the
64-bit codes of its set bits. Size bands are powers of two; a document belongs to its own and,
where a partner can be there, to the next smaller one, which fixes the number of bands.

Pigeonhole: with at most d differing bands, of d + s non-empty bands of a document at least s are
equal in both. So each document emits its first d + s non-empty bands in band order (of two
linked documents the one whose emission ends earlier supplies the argument), or, having fewer,
all bands, empty ones too. As linked documents share s keys, each may drop its s - 1 most
frequent ones (one order for all): the rarest shared key is never among them. This is what keeps
passages that many documents share from joining them. Shingles that are very common among
otherwise unlike documents (found on a hashed share of the documents) flip no bit: leaving them
out for all documents alike only shortens the symmetric difference, so it costs no pair.

Equal sets are one entry throughout. Documents under one key are compared with one of them (a
star, linear in the group): pairs whose whole sketches differ in more bits than the bound are
out, the others are verified exactly on their full sets, and links are merged. Where the other
documents of a key still belong to several components, they are compared inside the tasks on whole
sketches: all keys of one centre together, so that a document is one row a centre and not one a key
(a large centre in pairs of blocks, each pair of blocks a group of its own). Only pairs of different
components within the bound are handed on and verified, so the components are those of all links.
Whole sketches hold two to four bits a shingle; the longer one of a pair is folded onto the shorter.

Cases: null or empty texts and texts of separators have an empty set and are linked with
nothing (their own component); copies share a component; several rows with one doc_id are rows
of their own; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizlake.llm.store import saved, table
from quizlake.llm.tokens import SMALL_CHUNK, U64, chunks, mix, shingle_hashes, spaced_words

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Share of documents (one in) searched for common shingles, their count there, and how many are
#: kept: these change the cost only, never the result.
COMMON_SHARE, COMMON_COUNT, COMMON_MAX = 16, 8, 1 << 18
#: Linked documents share at least one key in so many of a size band's largest set.
SHARED = 10
#: Emitted bands that a task gathers before it hands them on; entries of a bucket that a reducer holds
#: (four times FLUSH) before it compacts them; bands per reducer bucket.
EMIT, FLUSH, BUCKET_BANDS = 1 << 18, 1 << 20, 1 << 18
#: Documents of a centre that are compared as one block.
GROUP_BLOCK = 2048
#: Rows of documents in groups that a task gets, about.
TASK_MEMBERS = 1 << 15
#: Frequency that stands for that of a key with more entries than a task gathers.
VERY_OFTEN = 1 << 40
#: Bits of the map that keeps non-candidates out of the second reading of the texts.
FILTER_BITS = 23
_EMPTY = 0xD6E8FEB86659FD93


def _sets(col, k: int = SHINGLE):
    """(row, sorted distinct shingle hashes) of each text, chunk by chunk: (lo, counts, hashes)."""
    for lo, hi, data, off in chunks(col, SMALL_CHUNK):
        w = spaced_words(data, off)
        doc, h = shingle_hashes(w.hashes(), w, k)
        at = np.searchsorted(doc, np.arange(hi - lo + 1))
        sets = [np.unique(h[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        counts = np.array([len(s) for s in sets], dtype=np.int64)
        yield lo, hi, counts, np.concatenate(sets) if sets else h


def _set_ids(counts: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One number per set (equal sets, equal numbers); 0 for the empty set."""
    at = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ U64(0x5851F42D4C957F2D)))])
    sid = mix((total[at[1:]] - total[at[:-1]]) ^ (counts.astype(np.uint64) * U64(0x9E3779B97F4A7C15)))
    sid = (sid >> U64(1)).astype(np.int64)
    sid[counts == 0] = 0
    return sid


def sketch_bits(n: int) -> int:
    """Bits of the whole sketch of a set of n shingles: a power of two, 64 at least."""
    return max(64, 2 << int(n).bit_length())


def parity_sketch(h: np.ndarray) -> bytes:
    """The packed sketch: every shingle flips the bit of its hash."""
    bits = sketch_bits(len(h))
    flips = np.bincount((h & U64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def _describe(batches):
    for batch in batches:
        n = np.zeros(batch.num_rows, np.int64)
        sid = np.zeros(batch.num_rows, np.int64)
        sketch = []
        for lo, hi, counts, h in _sets(batch.column("text")):
            n[lo:hi], sid[lo:hi] = counts, _set_ids(counts, h)
            at = np.concatenate([[0], np.cumsum(counts)]).tolist()
            sketch += [parity_sketch(h[a:b]) for a, b in zip(at, at[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(sid), pa.array(sketch, pa.binary())],
                                         names=["doc_id", "n", "sid", "sketch"])


def _packed(sid: np.ndarray, counts: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    """(sid, packed shingles) of a chunk's sets."""
    at = np.concatenate([[0], np.cumsum(counts)]).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(sid), pa.array([h[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary())], names=["sid", "shingles"])


def _common_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles frequent in a hashed share of the documents, most of whose documents are mainly
    made of other shingles (so not those of a large group of near copies)."""
    spark = docs.sparkSession
    share = docs.where(F.expr(f"pmod(xxhash64(doc_id), {COMMON_SHARE}) = 0")).select("text")

    def pack(batches):
        for batch in batches:
            for _, _, counts, h in _sets(batch.column("text")):
                yield _packed(_set_ids(counts, h), counts, h)

    def explode(batches):
        for batch in batches:
            for x in batch.column("shingles"):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_buffer(), np.int64))], names=["h"])

    rows = share.mapInArrow(pack, "sid bigint, shingles binary").where("sid <> 0")
    rows = saved(rows.dropDuplicates(["sid"]), "shared-shingles")  # equal sets count once
    often = (rows.select("shingles").mapInArrow(explode, "h bigint").groupBy("h").agg(F.count("*").alias("df"))
             .where(F.col("df") >= COMMON_COUNT).orderBy(F.desc("df"), "h").limit(COMMON_MAX).select("h"))
    often = np.sort(often.toPandas()["h"].to_numpy(dtype=np.int64).view(np.uint64))
    if not len(often):
        return often
    shared = spark.sparkContext.broadcast(often)

    def flagged(batches):
        often = shared.value
        for batch in batches:
            for x in batch.column("shingles"):
                h = np.frombuffer(x.as_buffer(), np.uint64)
                common = h[often[np.minimum(np.searchsorted(often, h), len(often) - 1)] == h]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(common.view(np.int64)), pa.array(np.full(len(common), 2 * len(common) < len(h)))], names=["h", "unlike"])

    picked = (rows.select("shingles").mapInArrow(flagged, "h bigint, unlike boolean")
              .groupBy("h").agg(F.avg(F.col("unlike").cast("int")).alias("unlike")).where("unlike >= 0.5").select("h"))
    return np.sort(picked.toPandas()["h"].to_numpy(dtype=np.int64).view(np.uint64))


def shared_keys(cls):
    """Keys that two linked documents of a size band share at least."""
    return np.maximum(1, ((np.int64(2) << np.asarray(cls, dtype=np.int64)) - 1) // SHARED)


def band_plan(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the own and the next smaller size band: (size band or -1, bands, most differing bands)."""
    n = np.asarray(n, dtype=np.int64)
    own = np.frexp(np.maximum(n, 1).astype(float))[1].astype(np.int64) - 1
    out = []
    for cls in (own, own - 1):
        high = (np.int64(1) << np.maximum(cls + 1, 0)) - 1
        bands = (11 * high + 19) // 20 + 2
        if cls is own:
            differ, fits = n // 3, n > 0  # a partner has at most n / 0.75 shingles
        else:
            differ, fits = (n + high) // 7, (cls >= 0) & (100 * high >= PERCENT * n)
        out.append((np.where(fits, cls, -1), bands, differ))
    return out


def band_keys(counts: np.ndarray, h: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, key, size band) of the emitted bands of a chunk's sets."""
    doc = np.repeat(np.arange(len(counts)), counts)
    if len(common) and len(h):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        light = common[at] != h
        doc, h = doc[light], h[light]
    code = mix(h + U64(0x2545F4914F6CDD1D))
    docs, keys, owners = [], [], []
    for cls, bands, differ in band_plan(counts):
        use = cls[doc] >= 0
        d, x, c = doc[use], h[use], code[use]
        salt = mix((cls + 1).astype(np.uint64) * U64(0xBF58476D1CE4E5B9))
        wanted = np.flatnonzero(cls >= 0)
        most = differ + shared_keys(np.maximum(cls, 0))
        emitted = np.zeros(len(counts), dtype=np.int64)
        if len(d):
            band = ((x >> U64(32)) * bands[d].astype(np.uint64)) >> U64(32)
            head = np.ones(len(d), dtype=bool)
            head[1:] = (d[1:] != d[:-1]) | (band[1:] != band[:-1])
            start = np.flatnonzero(head)
            value = np.bitwise_xor.reduceat(c, start)
            d, band = d[start], band[start]
            emitted = np.bincount(d, minlength=len(counts))
            rank = np.arange(len(d)) - (np.cumsum(emitted) - emitted)[d]
            keep = rank < most[d]
            docs.append(d[keep])
            keys.append(mix(value[keep] ^ mix(band[keep] + salt[d[keep]])))
            owners.append(cls[d[keep]])
        for i in wanted[emitted[wanted] < most[wanted]].tolist():  # too few non-empty bands: all
            have = band[d == i] if len(d) else np.zeros(0, np.uint64)
            empty = np.setdiff1d(np.arange(bands[i], dtype=np.uint64), have)
            docs.append(np.full(len(empty), i))
            keys.append(mix(U64(_EMPTY) ^ mix(empty + salt[i])))
            owners.append(np.full(len(empty), cls[i]))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(owners)


def _emit(buckets: int, common):
    """mapInArrow: (bucket, keys, size bands, sids) with packed arrays; one entry a set and task."""
    def rows(parts):
        sid, key, cls = (np.concatenate(x) for x in zip(*parts))
        bucket = ((key >> U64(32)) * U64(buckets)) >> U64(32)
        order = np.argsort(bucket, kind="stable")
        packed = key[order].astype(np.uint32), cls[order].astype(np.uint8), sid[order]
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int64)),
             *(pa.array([x[cut[b]:cut[b + 1]].tobytes() for b in full], pa.binary()) for x in packed)],
            names=["bucket", "keys", "bands", "sids"])

    def run(batches):
        heavy, seen, parts, size = common.value, set(), [], 0
        for batch in batches:
            for _, _, counts, h in _sets(batch.column("text")):
                sid = _set_ids(counts, h)
                new = np.zeros(len(sid), dtype=bool)
                for i, s in enumerate(sid.tolist()):
                    if s and s not in seen:
                        seen.add(s)
                        new[i] = True
                d, k, c = band_keys(counts[new], h[np.repeat(new, counts)], heavy)
                parts.append((sid[new][d], k, c))
                size += len(k)
                if size >= EMIT:
                    yield rows(parts)
                    parts, size = [], 0
        if size:
            yield rows(parts)
    return run


def _same_key(batches):
    """mapInArrow over rows sorted by bucket: (key, sid, often) of keys that two or more sets
    emitted, with the number of those sets.

    Entries beyond ``4 * FLUSH`` are compacted: of a key seen more than once all entries but one
    are handed on at once, so a key with very many entries keeps one in memory; its frequency is
    VERY_OFTEN for all of them."""
    def groups(bucket, low, sid, shared, last):
        order = np.lexsort((shared, sid, low))
        low, sid, shared = low[order], sid[order], shared[order]
        if len(low):
            repeat = np.zeros(len(low), dtype=bool)  # one set under one key once; keep its shared mark
            repeat[:-1] = (low[1:] == low[:-1]) & (sid[1:] == sid[:-1])
            low, sid, shared = low[~repeat], sid[~repeat], shared[~repeat]
        head = np.ones(len(low), dtype=bool)
        head[1:] = low[1:] != low[:-1]
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(low)))
        several = np.repeat(size, size) > 1
        early = np.repeat(np.logical_or.reduceat(shared, start), size) if len(low) else shared
        out = several & ~shared
        often = np.where(early | (not last), VERY_OFTEN, np.repeat(size, size))[out]
        key = low[out] | (np.int64(bucket) << 40)
        batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array(sid[out]), pa.array(often)], names=["key", "sid", "often"])
        if last:
            return batch, None
        return batch, (low[start], sid[start], shared[start] | (size > 1))

    def flush(bucket, lows, sids, kept, last):
        low, sid = np.concatenate(lows), np.concatenate(sids)
        shared = np.zeros(len(low), dtype=bool)
        if kept is not None:
            low, sid = np.concatenate([kept[0], low]), np.concatenate([kept[1], sid])
            shared = np.concatenate([kept[2], shared])
        return groups(bucket, low, sid, shared, last)

    bucket, lows, sids, size, kept = None, [], [], 0, None
    for batch in batches:
        for b, k, c, s in zip(batch.column("bucket").to_pylist(), *(batch.column(x) for x in ("keys", "bands", "sids"))):
            if b != bucket:
                if bucket is not None:
                    yield flush(bucket, lows, sids, kept, True)[0]
                bucket, lows, sids, size, kept = b, [], [], 0, None
            low = np.frombuffer(k.as_buffer(), np.uint32).astype(np.int64) << 8
            lows.append(low | np.frombuffer(c.as_buffer(), np.uint8))
            sids.append(np.frombuffer(s.as_buffer(), np.int64))
            size += len(lows[-1])
            if size >= 4 * FLUSH:
                out, kept = flush(bucket, lows, sids, kept, False)
                lows, sids, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
                yield out
    if bucket is not None:
        yield flush(bucket, lows, sids, kept, True)[0]


def _without_hottest(shared: DataFrame) -> DataFrame:
    """Drops each document's most frequent keys in a size band, one fewer than linked ones share."""
    spare = F.expr(f"greatest(1, ((2L << cast(key & 255 as int)) - 1) div {SHARED}) - 1")
    order = Window.partitionBy("sid", F.expr("key & 255")).orderBy(F.desc("often"), "key")
    return shared.withColumn("rank", F.row_number().over(order)).where(F.col("rank") > spare).select("key", "sid")


def _star(batches):
    """mapInArrow over rows sorted by (key, sid): each entry with the first of its key."""
    key = hub = None
    for batch in batches:
        k, sid = batch.column("key").to_numpy(), batch.column("sid").to_numpy()
        if not len(k):
            continue
        head = np.ones(len(k), dtype=bool)
        head[1:] = k[1:] != k[:-1]
        head[0] = k[0] != key
        first = np.where(head, np.arange(len(k)), -1)
        at = np.maximum.accumulate(first)
        hubs = np.where(at < 0, hub if hub is not None else 0, sid[np.maximum(at, 0)])
        key, hub = k[-1], hubs[-1]
        pair = hubs != sid
        found = np.unique(np.stack([sid[pair], hubs[pair]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of the hashed doc_ids (fixed size; with more ids it only lets more rows pass)."""
    slot = F.expr(f"xxhash64(doc_id) & {(1 << FILTER_BITS) - 1}")
    words = (ids.select(slot.alias("s")).select(F.expr("s >> 5").alias("w"), F.expr("1L << cast(s & 31 as int)").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas())
    bits = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    bits[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).astype(np.uint32)
    return bits


def _set_rows(bits):
    """mapInArrow: (sid, packed shingles) of the texts whose doc_id passes the filter."""
    def run(batches):
        b = bits.value
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            keep = (b[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1
            batch = batch.filter(pa.array(keep.astype(bool)))
            for _, _, counts, h in _sets(batch.column("text")):
                yield _packed(_set_ids(counts, h), counts, h)
    return run


def _linked(batches):
    """mapInArrow over candidate pairs with both sets: the pairs that are links."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            small, large = sorted((len(a), len(b)))
            if 100 * small < PERCENT * large:
                keep.append(False)
                continue
            both = np.concatenate([a, b])
            both.sort()
            same = int(np.count_nonzero(both[1:] == both[:-1]))
            keep.append(100 * same >= PERCENT * (len(a) + len(b) - same))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (last axis: 64-bit words) on fewer words: bit numbers modulo the shorter length."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


def _near_sketches(batches):
    """mapInArrow over candidate pairs with sizes and sketches: those within the Hamming bound."""
    for batch in batches:
        n = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        keep = []
        for bound, x, y in zip((n // 7).tolist(), batch.column("sketch_a"), batch.column("sketch_b")):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            words = min(len(a), len(b))
            keep.append(int(np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum()) <= bound)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _likely(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """The pairs whose sizes and whole sketches allow a link."""
    def side(x):
        return info.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    return sized.where(fits).mapInArrow(_near_sketches, "a bigint, b bigint")


def _near_pairs(n, sketches, label, block, cross):
    """Pairs (positions) of different labels, of different blocks where ``cross``, whose sizes and
    whole sketches allow a link; the documents come in ascending ``n``."""
    words = np.array([len(x) // 8 for x in sketches])  # ascends with n
    top = np.searchsorted(n, 100 * n // PERCENT, side="right")
    for w in np.unique(words).tolist():
        first, past = np.searchsorted(words, [w, w + 1]).tolist()
        last = int(top[past - 1])  # partners of these documents have at most twice as many words
        folded = np.stack([_folded(np.frombuffer(x, np.uint64), w) for x in sketches[first:last]])
        for i in range(first, past):
            other = label[i + 1:top[i]] != label[i]
            if cross:
                other &= block[i + 1:top[i]] != block[i]
            j = np.arange(i + 1, top[i])[other]
            if len(j):
                far = np.bitwise_count(folded[j - first] ^ folded[i - first]).sum(axis=1, dtype=np.int64)
                for x in j[far <= (n[j] + n[i]) // 7].tolist():
                    yield i, x


def _near_in_groups(batches):
    """mapInArrow over rows sorted by (hub, lo, hi): pairs of documents that share an open key of the
    hub, are in different components and whose sizes and whole sketches allow a link.

    A group holds one block of the hub's documents (lo = hi) or two, which are compared with each
    other: key by key, or all at once where that is less work (pairs without a common key are no
    links or found elsewhere, so they do no harm)."""
    def group(rows, cross):
        rows = sorted(rows, key=lambda r: r[2])
        sid, label, n, block = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        owner = np.repeat(np.arange(len(rows)), [len(r[5]) for r in rows])
        keys = np.concatenate([r[5] for r in rows])
        order = np.argsort(keys, kind="stable")  # inside a key in ascending n
        parts = np.split(owner[order], np.flatnonzero(np.diff(keys[order])) + 1)
        if sum(len(p) ** 2 for p in parts) >= len(rows) ** 2:
            parts = [np.arange(len(rows))]
        found = set()
        for p in parts:
            if (label[p] != label[p[0]]).any():
                for i, j in _near_pairs(n[p], [rows[k][4] for k in p.tolist()], label[p], block[p], cross):
                    a, b = int(sid[p[i]]), int(sid[p[j]])
                    found.add((max(a, b), min(a, b)))
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    now, rows = None, []
    for batch in batches:
        heads = zip(*(batch.column(c).to_pylist() for c in ("hub", "lo", "hi")))
        columns = [batch.column(c).to_pylist() for c in ("sid", "label", "n", "block", "sketch")]
        keys = batch.column("keys")
        at, values = keys.offsets.to_numpy(), keys.values.to_numpy()
        for k, (head, row) in enumerate(zip(heads, zip(*columns))):
            if head != now:
                if len(rows) > 1:
                    yield group(rows, now[1] != now[2])
                now, rows = head, []
            rows.append((*row, values[at[k]:at[k + 1]].copy()))
    if len(rows) > 1:
        yield group(rows, now[1] != now[2])


class _Sets:
    """Shingle sets of candidate documents, read from the texts once for each set."""

    def __init__(self, docs: DataFrame, info: DataFrame):
        self.docs, self.info, self.tables = docs, info, []

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are linked."""
        sids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        for known in self.tables:
            sids = sids.join(known.select("sid"), "sid", "left_anti")
        sids = saved(sids, "sets-wanted")
        if not sids.isEmpty():
            ids = sids.join(self.info.select("sid", "rep"), "sid").select(F.col("rep").alias("doc_id"))
            bits = self.docs.sparkSession.sparkContext.broadcast(_id_filter(ids))
            slot = F.expr(f"xxhash64(doc_id) & {(1 << FILTER_BITS) - 1}").alias("slot")
            sets = self.docs.select(slot, "text").mapInArrow(_set_rows(bits), "sid bigint, shingles binary")
            self.tables.append(saved(sets.join(sids, "sid", "left_semi").dropDuplicates(["sid"]), "candidate-sets"))
        if not self.tables:
            return pairs
        every = self.tables[0]
        for more in self.tables[1:]:
            every = every.union(more)
        left = every.select(F.col("sid").alias("a"), F.col("shingles").alias("set_a"))
        right = every.select(F.col("sid").alias("b"), F.col("shingles").alias("set_b"))
        return pairs.join(left, "a").join(right, "b").mapInArrow(_linked, "a bigint, b bigint")


def _open_members(shared: DataFrame, label: DataFrame, parts: int) -> DataFrame:
    """(hub, sid, label, keys): the documents under each hub with the open keys they have there.

    A key's hub is its first document, with which the star has compared all others; a key is open
    where these others belong to several components."""
    marked = (shared.join(label, shared.sid == label.node, "left")
              .select("key", "sid", F.coalesce("label", "sid").alias("label")).repartition(parts, "key"))
    of_label = marked.groupBy("key", "label").agg(F.min("sid").alias("low"), F.count("*").alias("c"))
    keys = of_label.groupBy("key").agg(F.min(F.struct("low", "c")).alias("first"), F.count("*").alias("labels"))
    keys = keys.where("labels - if(first.c = 1, 1, 0) > 1").select("key", F.col("first.low").alias("hub"))
    return (marked.join(keys, "key").where("sid <> hub")
            .groupBy("hub", "sid").agg(F.first("label").alias("label"), F.collect_list("key").alias("keys")))


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of a hub dealt to its blocks, and each block to all pairs of blocks it is part of."""
    block = F.expr("cast(pmod(xxhash64(sid), blocks) as int)")
    rows = rows.withColumn("block", block).withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    return rows.withColumns({"lo": F.least("block", "with"), "hi": F.greatest("block", "with")}).drop("with", "blocks")


def _local_stars(batches):
    """mapInArrow: a task's edges (a, b) as edges (u, v) from each node to the smallest one it reaches."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    found = [(x, find(x)) for x in list(root)]
    found = [f for f in found if f[0] != f[1]]
    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["u", "v"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label): label is the smallest node reachable over the edges (a, b).

    Alternating star contraction: every node points its larger neighbours, then its smaller
    ones, at the smallest neighbour; rounds grow with the logarithm of the longest path."""
    e = saved(edges.where("a <> b").select("a", "b").mapInArrow(_local_stars, "u bigint, v bigint"), name)
    last = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = saved(small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                 F.struct("u", F.col("m").alias("v")))).alias("x"))
                  .select("x.u", "x.v").where("u <> v").distinct(), name)
        now = tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == last:
            break
        last = now
    return e.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sid, component_id) of every row."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select("doc_id", "text")
    described = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("sid", T.LongType()),
                              T.StructField("sketch", T.BinaryType())])
    rows = saved(docs.mapInArrow(_describe, described), "sets-described")
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * BUCKET_BANDS)))
    common = sc.broadcast(_common_shingles(docs))
    emitted = docs.select("text").mapInArrow(_emit(buckets, common), "bucket bigint, keys binary, bands binary, sids binary")
    shared = saved(emitted.repartition(buckets, "bucket").sortWithinPartitions("bucket")
                   .mapInArrow(_same_key, "key bigint, sid bigint, often bigint"), "shared-bands")
    shared = saved(_without_hottest(shared), "kept-bands")
    reps = rows.where("sid <> 0").groupBy("sid").agg(F.min("doc_id").alias("rep"))
    met = shared.select("sid").distinct()
    info = saved(rows.join(met, "sid", "left_semi").groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "candidates")

    sets = _Sets(docs, info)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    star = (shared.repartition(parts, "key").sortWithinPartitions("key", "sid")
            .mapInArrow(_star, "a bigint, b bigint").distinct())
    links = saved(sets.links(saved(_likely(star, info), "star-likely")), "star-links")
    label = saved(components(links), "star-components")
    members = saved(_open_members(shared, label, parts), "open-members")
    blocks = members.groupBy("hub").agg(F.ceil(F.count("*") / GROUP_BLOCK).cast("int").alias("blocks"))
    parts = max(parts, -(-members.count() // TASK_MEMBERS))
    rest = _in_blocks(members.join(blocks, "hub").join(info.select("sid", "n", "sketch"), "sid"))
    rest = (rest.repartition(parts, "hub", "lo", "hi").sortWithinPartitions("hub", "lo", "hi")
            .mapInArrow(_near_in_groups, "a bigint, b bigint").distinct())
    rest = saved(rest, "rest-likely")
    if not rest.isEmpty():
        links = links.union(saved(sets.links(rest), "rest-links"))
        label = components(links, "all-components")

    group = (reps.join(label, reps.sid == label.node, "left")
             .select("sid", "rep", F.coalesce("label", "sid").alias("label")))
    first = group.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = group.join(first, "label").select("sid", "component_id")
    out = rows.where("sid <> 0").join(named, "sid").select("doc_id", "n", "sid", "component_id")
    alone = rows.where("sid = 0").select("doc_id", "n", "sid", F.col("doc_id").alias("component_id"))
    return out.union(alone)


def near_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked doc_id)."""
    return _grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _with_set_id(names: list[str]):
    def run(batches):
        for batch in batches:
            sid = np.zeros(batch.num_rows, np.int64)
            for lo, hi, counts, h in _sets(batch.column("text")):
                sid[lo:hi] = _set_ids(counts, h)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sid)], names=[*names, "__sid"])
    return run


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: its smallest doc_id (repeated rows: one of them;
    several sets under that id: the one with the smallest set number, then the smallest text).
    Documents with an empty set all stay, one row each doc_id."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    found = _grouped(docs)
    first = found.where("sid <> 0").groupBy("component_id").agg(F.min(F.struct("doc_id", "sid")).alias("x"))
    keep = first.select("x.*").union(found.where("sid = 0").select("doc_id", "sid"))
    keep = keep.select(key.alias("__key"), F.col("sid").alias("__sid"))
    schema = T.StructType([*docs.schema.fields, T.StructField("__sid", T.LongType())])
    marked = docs.mapInArrow(_with_set_id(docs.columns), schema).withColumn("__key", key)
    kept = marked.join(keep, ["__key", "__sid"], "left_semi")
    one = Window.partitionBy("__key", "__sid").orderBy("text")  # the join's partitioning serves the window too
    return kept.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(*docs.columns)


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
