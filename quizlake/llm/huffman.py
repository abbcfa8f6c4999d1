"""Token ids of documents as canonical length-limited Huffman files.

Writing (``write_ids``): documents are tokenised once into compact bytes, the ids are counted over
all documents, and one canonical code of at most ``LIMIT`` bits is built by package-merge. The
documents are then range-partitioned by (doc_id, content), sorted, and each range becomes one file:
a run of blocks of ``BLOCK_TOKENS`` ids. A block is one frame (header, bit offsets of every
``INTERVAL``-th id, bits, CRC32), decodable by itself from the code lengths alone; next to it stand
the documents that overlap it. Reading (``read_ids``) decodes any block in any task.

Layout below one path, each a Parquet table committed by Spark: ``code`` (id, length), ``blocks``
(file, first id, count, frame, overlapping documents). Position 0 of a file is its first id; files
in order hold all documents in ascending doc_id (null first; equal ids by content).

Defined cases: a null text is empty; every document has the end id, so none is without ids; repeated
rows and repeated ids are kept as documents of their own; an empty table gives no blocks and no
code. Bounds: the code has one entry per vocabulary id, on the driver and in each task; the manifest
one row per file, at most ``MAX_FILES``. The temporary table holds ranks of ids in one to three bytes;
the ranks that keep it small are found on the beginnings of ``SAMPLE_DOCS`` documents and change no result.
"""

from __future__ import annotations

import itertools
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizlake.llm.store import ROW_GROUP, saved, ship, table
from quizlake.llm.tokens import U64, chunks, text_buffer
from quizlake.session import fresh_dir

END_ID = 2
LIMIT = 20  # longest code, bits (more only where the alphabet needs it)
BLOCK_TOKENS = 1 << 15
INTERVAL = 128  # ids between two bit-offset checkpoints
DECODED = 1 << 20  # ids decoded at once from the temporary table
TOKENS_PER_FILE = 1 << 22
MAX_FILES = 20_000  # beyond this many, files grow instead
SAMPLE_DOCS, SAMPLE_CHARS = 2_000, 4_000
UNITS_KEPT = 5 << 18  # distinct units a task remembers before it forgets the later half
TABLE_BITS = 22  # of their table's slots; twice the units that it can hold
JOINED = 256  # new units encoded as one text
LONGEST = 128  # bytes of a unit that is remembered

MAGIC = b"QHB1"
_HEAD = np.dtype([("magic", "S4"), ("n", "<u4"), ("interval", "<u4"), ("marks", "<u4")])


# --------------------------------------------------------------------------- code

def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code length per id (0: id unused), none above ``limit``, by package-merge."""
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    level, flags = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        m = len(level) // 2
        both = np.concatenate([leaves, level[0:2 * m:2] + level[1:2 * m:2]])
        at = np.argsort(both, kind="stable")[:2 * n - 2]  # a leaf goes before an equal package
        level = both[at]
        flags.append(at < n)
    found, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(flags):
        own = int(leaf[:take].sum())
        found[:own] += 1
        take = 2 * (min(take, len(leaf)) - own)
    lengths[order] = found
    return lengths


class Code:
    """Canonical code of ``lengths``: codes ascend by (length, id)."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        ids = used[np.argsort(self.lengths[used], kind="stable")]
        size = self.lengths[ids]
        self.longest = int(size[-1]) if len(size) else 1
        span = np.left_shift(np.int64(1), self.longest - size)
        self.codes = np.zeros(len(lengths), np.uint64)
        first = np.cumsum(span) - span
        self.codes[ids] = (first >> (self.longest - size)).astype(np.uint64)
        self._table = None
        self._ids, self._span = ids, span

    def table(self) -> np.ndarray:
        """32 * id + length for every ``longest``-bit window; windows outside the code have 0."""
        if self._table is None:
            self._table = np.zeros(1 << self.longest, np.uint32)
            self._table[:int(self._span.sum())] = np.repeat((self._ids << 5) | self.lengths[self._ids], self._span)
        return self._table


def pack(ids: np.ndarray, code: Code, sizes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bits of ``ids`` (most significant first), each id's first bit, and the byte after each part;
    parts of ``sizes`` ids start at whole bytes."""
    size = code.lengths[ids]
    if len(size) and not size.all():
        raise ValueError("id without a code")
    upto = np.concatenate([[0], np.cumsum(size)])
    edge = np.cumsum(sizes)
    used = upto[edge] - upto[edge - sizes]
    ends = np.cumsum(-(-used // 8))
    start = upto[:-1] + np.repeat(8 * np.concatenate([[0], ends[:-1]]) - upto[edge - sizes], sizes)
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 8 + 2, np.uint64)
    if len(ids):
        value = code.codes[ids]
        word, room = start >> 6, 64 - (start & 63) - size
        high = np.where(room >= 0, value << np.maximum(room, 0).astype(np.uint64),
                        value >> np.maximum(-room, 0).astype(np.uint64))
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[heads]] = np.bitwise_or.reduceat(high, heads)
        over = np.flatnonzero(room < 0)
        words[word[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[:total], start, ends


def frame(ids: np.ndarray, code: Code, interval: int = INTERVAL) -> bytes:
    """One self-contained block: header, checkpoints, bits, CRC32."""
    return frames(ids, np.array([len(ids)]), code, interval)[0]


def frames(ids: np.ndarray, sizes: np.ndarray, code: Code, interval: int = INTERVAL) -> list[bytes]:
    """Blocks of the given sizes from one run of ids, packed together (each starts at a whole byte)."""
    bits, start, ends = pack(ids, code, sizes)
    first = np.cumsum(sizes) - sizes
    n_marks = -(-sizes // interval)
    which = np.repeat(np.arange(len(sizes)), n_marks)
    step = np.arange(len(which)) - np.repeat(np.cumsum(n_marks) - n_marks, n_marks)
    byte = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    marks = (start[first[which] + step * interval] - 8 * byte[which]).astype("<u4").tobytes()
    head = np.zeros(len(sizes), _HEAD)
    head["magic"], head["n"], head["interval"], head["marks"] = MAGIC, sizes, interval, n_marks
    heads, h = head.tobytes(), _HEAD.itemsize
    out, m = [], 0
    for k, (a, b, n) in enumerate(zip(byte.tolist(), ends.tolist(), n_marks.tolist())):
        body = heads[k * h:(k + 1) * h] + marks[4 * m:4 * (m + n)] + bits[a:b]
        m += n
        out.append(body + zlib.crc32(body).to_bytes(4, "little"))
    return out


def unframe(frames: list[bytes], code: Code) -> list[np.ndarray]:
    """Ids of each frame. All checkpoints of all frames are decoded side by side."""
    heads, marks, bodies, at = [], [], [], 0
    for f in frames:
        if zlib.crc32(f[:-4]) != int.from_bytes(f[-4:], "little"):
            raise ValueError("damaged block: its checksum does not match")
        head = np.frombuffer(f, _HEAD, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a block of token ids")
        top = _HEAD.itemsize + 4 * int(head["marks"])
        marks.append(np.frombuffer(f, "<u4", int(head["marks"]), _HEAD.itemsize).astype(np.int64) + 8 * at)
        bodies.append(f[top:-4])
        at += len(f) - 4 - top
        heads.append((int(head["n"]), int(head["interval"])))
    data = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    table = code.table()
    out = []
    shift, mask = 32 - code.longest, (1 << code.longest) - 1
    if shift < 7:
        raise ValueError("codes longer than 25 bits are not supported")
    for interval in sorted({i for _, i in heads}):
        chosen = [k for k, (_, i) in enumerate(heads) if i == interval]
        pos = np.concatenate([marks[k] for k in chosen] or [np.zeros(0, np.int64)])
        got = np.zeros((interval, len(pos)), np.uint32)
        longest = max((min(heads[k][0], interval) for k in chosen), default=0)
        top = len(window) - 1
        for step in range(longest):
            byte = np.minimum(pos >> 3, top)
            w = (window[byte] >> (shift - (pos & 7)).astype(np.uint32)) & np.uint32(mask)
            found = table[w]
            got[step] = found >> 5
            pos += found & 31
        lane = 0
        for k in chosen:
            n = len(marks[k])
            out.append((k, got[:, lane:lane + n].T.reshape(-1)[:heads[k][0]]))
            lane += n
    return [x for _, x in sorted(out, key=lambda kx: kx[0])]


class Ranks:
    """Ids as bytes, seven bits each, by rank (most frequent first); an id's last byte has the high bit."""

    def __init__(self, counts: np.ndarray):
        if len(counts) > 1 << 21:
            raise ValueError("more ids than three bytes hold")
        self.ids = np.argsort(-counts, kind="stable").astype(np.int32)
        self.ranks = np.empty(len(counts), np.int32)
        self.ranks[self.ids] = np.arange(len(counts), dtype=np.int32)

    def pack(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Bytes of each part of ``sizes`` ids."""
        rank = self.ranks[ids]
        two = np.flatnonzero(rank >= 1 << 7)
        three = two[rank[two] >= 1 << 14]
        size = np.ones(len(rank), np.int64)
        size[two] += 1
        size[three] += 1
        upto = np.concatenate([[0], np.cumsum(size)])
        last = upto[1:] - 1
        out = np.empty(int(upto[-1]), np.uint8)
        out[last] = (rank & 0x7F) | 0x80
        out[last[two] - 1] = (rank[two] >> 7) & 0x7F
        out[last[three] - 2] = rank[three] >> 14
        raw, edge = out.tobytes(), upto[np.concatenate([[0], np.cumsum(sizes)])].tolist()
        return [raw[a:b] for a, b in zip(edge, edge[1:])]

    def unpack(self, parts: list[bytes]) -> np.ndarray:
        """Ids of all parts, one after another."""
        data = np.frombuffer(b"".join(parts), np.uint8)
        last = np.flatnonzero(data >= 0x80)
        size = np.diff(last, prepend=-1)
        rank = (data[last] & 0x7F).astype(np.int32)
        two = np.flatnonzero(size > 1)
        rank[two] |= data[last[two] - 1].astype(np.int32) << 7
        three = two[size[two] > 2]
        rank[three] |= data[last[three] - 2].astype(np.int32) << 14
        return self.ids[rank]


# --------------------------------------------------------------------------- tokens

# Classes of bytes by which texts are cut; other characters are of no known class.
_LETTER, _DIGIT, _MARK, _QUOTE, _BLANK, _SPACE = range(1, 7)
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[0x27] = _QUOTE
_CLASS[0x09:0x0E] = _BLANK
_CLASS[0x20] = _SPACE


def _cuts() -> np.ndarray:
    """For two neighbours' classes (8 * first + second): 1 if pieces part between them, 2 before the first."""
    cuts, words = np.zeros(64, np.uint8), (_LETTER, _DIGIT, _MARK, _QUOTE)
    for x in words:
        for y in (_BLANK, _SPACE):
            cuts[8 * x + y] |= 1  # a piece ends where white space begins
            cuts[8 * y + x] |= 2  # of white space before a word the last one is apart
        cuts[8 * _BLANK + x] |= 1  # and only a space belongs to the word
        for y in words:
            if x != y and x != _QUOTE and not (x == _MARK and y == _QUOTE):  # a quote may begin a suffix
                cuts[8 * x + y] |= 1
    return cuts


_CUTS = _cuts()


def _classes(data: np.ndarray) -> np.ndarray:
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF: letters but for the signs of times and division
    lead = lead[(data[lead + 1] & 0xDF) != 0x97]
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


class _Known:
    """Numbers of short units (up to 15 bytes, which two 64-bit words hold with the length), looked up all at once."""

    def __init__(self, bits: int):
        self.bits = bits
        self.slots = np.full(1 << bits, -1, np.int32)
        self.keys = np.zeros((2, 1 << (bits - 1)), np.uint64)

    @staticmethod
    def words(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Both words of each unit (``size`` bytes from ``at`` on, 15 at most)."""
        room = np.zeros(len(data) + 16, np.uint8)
        room[:len(data)] = data
        every = np.ndarray((len(room) - 7,), "<u8", room, 0, (1,))
        low = _ONES[np.minimum(size, 8)]
        return np.stack([every[at] & low, (every[at + 8] & _ONES[np.maximum(size, 8) - 8]) | (size.astype(np.uint64) << U64(56))])

    def _slot(self, words: np.ndarray) -> np.ndarray:
        mixed = (words[0] * U64(0x9E3779B97F4A7C15)) ^ (words[1] * U64(0xC2B2AE3D27D4EB4F))
        return ((mixed ^ (mixed >> U64(29))) * U64(0xBF58476D1CE4E5B9) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, words: np.ndarray) -> np.ndarray:
        """Number of each unit, -1 for unknown ones."""
        slot, out, todo = self._slot(words), np.full(words.shape[1], -1, np.int64), None
        while True:
            unit = self.slots[slot]
            same = (self.keys[0][unit] == words[0]) & (self.keys[1][unit] == words[1]) & (unit >= 0)
            if todo is None:
                out[same] = unit[same]
                todo = np.flatnonzero(~same & (unit >= 0))
                more = todo
            else:
                out[todo[same]] = unit[same]
                more = np.flatnonzero(~same & (unit >= 0))
                todo = todo[more]
            if not len(more):
                return out
            slot, words = (slot[more] + 1) & (len(self.slots) - 1), words[:, more]

    def add(self, words: np.ndarray, number: np.ndarray) -> None:
        """Units that are not known yet, each once."""
        self.keys[:, number] = words
        slot = self._slot(words)
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]
            left = np.flatnonzero(self.slots[slot] != number)  # taken, or another one of these came first
            slot, number = (slot[left] + 1) & (len(self.slots) - 1), number[left]


_ONES = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
SHORT = 15  # bytes of a unit in the table


class Tokenizer:
    """Ids of texts by the tokenizers library, distinct words once.

    With a byte-level pre-tokenizer and no normaliser, pieces always part at certain neighbours (a letter
    and a full stop, a word and the space after it, ...: ``_cuts``), whatever else stands around. Texts are
    cut there; all units of a call are looked up at once among those that the task remembers. New units go to the library many in one text: those that begin with a space one
    after another (cut where a token starts with a space), others between line breaks. Units with other
    white space or of unknown characters at an end are encoded alone. When too many are remembered, the
    ones learnt first (so the frequent ones) stay. Other tokenizers and texts that hold an added token
    are not cut.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer as Public

        self.model = Public.from_str(definition)
        d = json.loads(definition)
        pre = d.get("pre_tokenizer") or {}
        self.splits = (d.get("normalizer") is None and pre.get("type") == "ByteLevel"
                       and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.added = [t["content"].encode() for t in d.get("added_tokens", [])]
        self.joins = False
        if self.splits:
            vocabulary = d["model"]["vocab"]
            self.spaced, self.broken = np.zeros((2, max(vocabulary.values()) + 1), bool)
            self.spaced[[i for t, i in vocabulary.items() if t[0] == "\u0120"]] = True
            line = self._ids(["\n"])[0]
            self.broken[line] = True
            self.joins = len(line) == 1
        self._reset()

    def _reset(self):
        self.of: dict[str, int] = {}  # units that are too long for the table
        self.known, self.learnt = _Known(TABLE_BITS), 0
        self.flat, self.first = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)  # grown on demand

    def _added(self, text: bytes) -> bool:
        return any(t in text for t in self.added)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _put(self, unit: int, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of the units from number ``unit`` on, behind those of the units before."""
        at = int(self.first[unit])
        for name, used, more in (("flat", at, len(ids)), ("first", unit + 1, len(sizes))):
            old = getattr(self, name)
            if used + more > len(old):
                new = np.zeros(max(len(old) + len(old) // 2, used + more), old.dtype)
                new[:used] = old[:used]
                setattr(self, name, new)
        self.flat[at:at + len(ids)] = ids
        self.first[unit + 1:unit + 1 + len(sizes)] = at + np.cumsum(sizes)

    def _joined(self, units: list[str], lead: str, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of units encoded ``JOINED`` in a text, each behind ``lead``;
        ``heads``: ids with which a unit begins there."""
        texts = [lead + lead.join(units[i:i + JOINED]) for i in range(0, len(units), JOINED)]
        ids = np.fromiter(itertools.chain.from_iterable(self._ids(texts)), np.int64)
        head = heads[ids]
        at = np.flatnonzero(head)
        if len(at) != len(units):
            raise AssertionError("units do not part where they were joined")
        sizes = np.diff(at, append=len(ids))
        return (ids[~head], sizes - 1) if lead else (ids, sizes)

    def _encoded(self, units: list[str], spaced: int, plain: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each): the first ``spaced`` and the next ``plain`` units can be joined."""
        alone = self._ids(units[spaced + plain:])
        parts = [self._joined(units[:spaced], "", self.spaced)] if spaced else []
        parts += [self._joined(units[spaced:spaced + plain], "\n", self.broken)] if plain else []
        parts.append((np.fromiter(itertools.chain.from_iterable(alone), np.int64), np.array([len(x) for x in alone], np.int64)))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _learn(self, units: list[str], new: np.ndarray, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Encode the units numbered ``new`` of a call (bytes ``data``, ends ``off``); those of up to ``LONGEST``
        bytes are remembered, others hold for this call. Returns the order in which they were stored."""
        if self.joins:
            kind = _classes(data)
            blanks = np.concatenate([[0], np.cumsum(kind >= _BLANK)])
            lo, hi = off[new], off[new + 1]
            space = (kind[lo] == _SPACE).astype(np.int64)
            fit = (blanks[hi] - blanks[lo] == space) & (hi - lo > space) & (hi - lo <= LONGEST)
            fit &= (kind[np.minimum(lo + space, hi - 1)] > 0) & (kind[hi - 1] > 0)
            if self._added(data.tobytes()):
                fit &= [not self._added(units[i].encode()) for i in new.tolist()]
            sort = np.where(fit, 1 - space, 2)
        else:
            sort = np.full(len(new), 2)
        sort[off[new + 1] - off[new] > LONGEST] = 3
        order = np.argsort(sort, kind="stable")
        n = np.bincount(sort, minlength=4)
        names = [units[i] for i in new[order].tolist()]
        self._put(self.learnt, *self._encoded(names, int(n[0]), int(n[1])))
        kept = new[order][:min(len(new) - int(n[3]), self.known.keys.shape[1] - self.learnt)]
        size = off[kept + 1] - off[kept]
        short = np.flatnonzero(size <= SHORT)
        self.known.add(_Known.words(data, off[kept[short]], size[short]), self.learnt + short)
        self.of.update((names[i], self.learnt + i) for i in np.flatnonzero(size > SHORT).tolist())
        self.learnt += len(kept)
        return order

    def _forget(self) -> None:
        """Only the units learnt first stay."""
        keep, old = UNITS_KEPT // 2, self.known
        self.of = {name: unit for name, unit in self.of.items() if unit < keep}
        units = np.sort(old.slots[(old.slots >= 0) & (old.slots < keep)]).astype(np.int64)
        self.known, self.learnt = _Known(TABLE_BITS), keep
        self.known.add(old.keys[:, units], units)

    def encode(self, texts: list[str], end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each); ``end`` follows each text."""
        raw, off = text_buffer(pa.array(texts, pa.large_string()))
        return self.encode_bytes(raw[off[0]:off[-1]], off - off[0], end)

    def encode_bytes(self, data: np.ndarray, off: np.ndarray, end: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of texts that stand in one run of bytes, text i from ``off[i]`` to ``off[i + 1]``."""
        if self.learnt > UNITS_KEPT:
            self._forget()
        cut = np.zeros(len(data) + 1, bool)
        if self.splits and len(data):
            kind = _classes(data)
            pair = (kind[:-1] << 3) | kind[1:]
            edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
            pair[edge - 1] = 0
            part = _CUTS[pair]
            cut[1:-1] = part & 1
            cut[:-2] |= part > 1
            whole = data.tobytes()
            if self._added(whole):
                for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                    if self._added(whole[a:b]):
                        cut[a:b] = False
        cut[off] = True
        cut[-1] = False
        at = np.flatnonzero(cut)
        edge = np.append(at, len(data)).astype(np.int64)
        size = np.diff(edge)
        number = self.known.find(_Known.words(data, at, np.minimum(size, SHORT)))
        number[size > SHORT] = -1
        miss, known = np.flatnonzero(number < 0), self.learnt
        ending = known
        if len(miss):
            text = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edge), pa.py_buffer(data))
            numbered = text.take(pa.array(miss)).dictionary_encode()
            units = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
            found = np.fromiter(map(self.of.get, units, itertools.repeat(-1)), np.int64, len(units))
            new = np.flatnonzero(found < 0)
            if len(new):
                order = self._learn(units, new, *text_buffer(numbered.dictionary))
                found[new[order]] = known + np.arange(len(new))
                ending += len(new)
            number[miss] = found[numbered.indices.to_numpy()]
        self._put(ending, np.array(end, np.int64), np.array([len(end)]))
        upto = np.searchsorted(at, off[1:])
        unit = np.insert(number, upto, ending)
        first = self.first
        n = first[unit + 1] - first[unit]
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(first[unit] - (ends - n), n) + np.arange(int(n.sum()))]
        return ids, np.diff(ends[upto + np.arange(len(upto))], prepend=0)


_TOKENIZERS: dict[int, Tokenizer] = {}


def _tokenizer(definition: str) -> Tokenizer:
    key = zlib.crc32(definition.encode())
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = Tokenizer(definition)
    return _TOKENIZERS[key]


# --------------------------------------------------------------------------- writing

TOKENS = "doc_id bigint, n bigint, frame binary, counted boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("frame", pa.binary()), ("counted", pa.bool_())])


def _definition(path: str) -> str:
    """The tokenizer's file (a vocabulary: bounded), read on the driver and shipped with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def tokens(docs: DataFrame, definition: str, end_id: int, sampled: np.ndarray) -> DataFrame:
    """One row per document (its ids as bytes of ``Ranks``), and per task one row that holds the
    task's id counts (``counted``)."""
    vocabulary = len(sampled)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((definition, sampled))

    def run(batches):
        definition, sampled = shared.value
        tok, ranks = _tokenizer(definition), Ranks(sampled)
        seen = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for lo, hi, data, off in chunks(batch.column("text")):
                ids, n = tok.encode_bytes(data, off, (end_id,))
                seen += np.bincount(ids, minlength=vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array(ranks.pack(ids, n), pa.binary()), pa.array([False] * len(n))], schema=_ARROW)
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()),
                                          pa.array([seen.astype("<i8").tobytes()], pa.binary()), pa.array([True])],
                                         schema=_ARROW)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, TOKENS)


def _id_counts(found: DataFrame, vocabulary: int) -> np.ndarray:
    """Counts of all ids (one row per id that occurs reaches the driver)."""
    def run(batches):
        for batch in batches:
            for raw in batch.column("frame").to_pylist():
                n = np.frombuffer(raw, "<i8")
                ids = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n[ids], pa.int64())], ["id", "n"])

    rows = (found.where("counted").select("frame").mapInArrow(run, "id bigint, n bigint")
            .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(vocabulary, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return counts


def _sample_counts(docs: DataFrame, definition: str, end_id: int, vocabulary: int) -> np.ndarray:
    """Id counts of a bounded sample, for the temporary table's ranks.

    The first ``SAMPLE_DOCS`` rows that Spark finds, ``SAMPLE_CHARS`` of each (a read of one or a few
    splits); they decide how small the temporary table is and nothing else."""
    texts = [r[0] or "" for r in docs.select(F.substring(F.col("text").cast("string"), 1, SAMPLE_CHARS)).take(SAMPLE_DOCS)]
    counts = np.zeros(vocabulary, np.int64)
    for _, _, data, off in chunks(pa.array(texts, pa.large_string())):
        counts += np.bincount(_tokenizer(definition).encode_bytes(data, off, (end_id,))[0], minlength=vocabulary)
    return counts


BLOCKS = ("file int, first bigint, n bigint, frame binary, doc_ids array<bigint>, doc_starts array<bigint>, "
          "doc_sizes array<bigint>")


def _blocks(lengths: np.ndarray, sampled: np.ndarray, sc):
    """Rows of documents in order -> rows of blocks."""
    shared = sc.broadcast((lengths, sampled))

    def run(batches):
        from pyspark import TaskContext

        final, ranks = Code(shared.value[0]), Ranks(shared.value[1])
        part = TaskContext.get().partitionId()
        held, docs, first, end = [], [], 0, 0  # ids not written, documents that overlap them, positions

        def block(ids):
            own = [d for d in docs if d[1] < first + len(ids)]
            row = (part, first, len(ids), frame(ids, final), [d[0] for d in own], [d[1] for d in own], [d[2] for d in own])
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BLOCK_TYPES)], _BLOCK_NAMES)

        for batch in batches:
            coded, names = batch.column("frame"), batch.column("doc_id").to_pylist()
            sizes = batch.column("n").to_pylist()
            upto = np.cumsum(sizes)
            hi = 0
            while hi < len(names):
                lo, hi = hi, max(int(np.searchsorted(upto, (upto[hi - 1] if hi else 0) + DECODED, side="right")), hi + 1)
                for name, size in zip(names[lo:hi], sizes[lo:hi]):
                    docs.append((name, end, size))
                    end += size
                held.append(ranks.unpack(coded.slice(lo, hi - lo).to_pylist()))
                if len(held[-1]) != sum(sizes[lo:hi]):
                    raise ValueError("damaged temporary table: ids are missing")
                if end - first < BLOCK_TOKENS:
                    continue
                ids, at = np.concatenate(held), 0
                while len(ids) - at >= BLOCK_TOKENS:
                    yield block(ids[at:at + BLOCK_TOKENS])
                    at += BLOCK_TOKENS
                    first += BLOCK_TOKENS
                    docs = [d for d in docs if d[1] + d[2] > first]
                held = [ids[at:]]
        if end > first:
            yield block(np.concatenate(held))

    return run


_BLOCK_NAMES = ["file", "first", "n", "frame", "doc_ids", "doc_starts", "doc_sizes"]
_BLOCK_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 3]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write code and blocks below ``path``."""
    spark = docs.sparkSession
    ship(spark)
    definition = _definition(tokenizer)
    vocabulary = max(_tokenizer(definition).model.get_vocab_size(), end_id + 1)
    sampled = _sample_counts(docs, definition, end_id, vocabulary)
    found = saved(tokens(docs, definition, end_id, sampled), "huffman-tokens")
    counts = _id_counts(found, vocabulary)
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id bigint, length int").coalesce(1) \
        .write.parquet(f"{path}/code")
    files = int(min(max(int(counts.sum()) // TOKENS_PER_FILE, 1), MAX_FILES))
    order = ["doc_id", "n", F.xxhash64("frame"), "row"]  # equal ids by content; equal documents in any order
    ordered = (found.where("not counted").withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "n", "frame"))
    (ordered.mapInArrow(_blocks(lengths, sampled, spark.sparkContext), BLOCKS)
     .write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/blocks"))


# --------------------------------------------------------------------------- reading

PIECES = "file int, doc_id bigint, start bigint, size bigint, at bigint, ids binary"
_PIECE = pa.schema([("file", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                    ("at", pa.int64()), ("ids", pa.binary())])


def read_code(spark: SparkSession, path: str) -> np.ndarray:
    """Code lengths by id (bounded by the vocabulary)."""
    rows = spark.read.schema("id bigint, length int").parquet(f"{path}/code").collect()
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.uint8)
    for r in rows:
        lengths[r["id"]] = r["length"]
    return lengths


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decoded pieces: a document's ids (little-endian 32-bit) per block that holds some of them.

    ``start`` is the document's position in its file, ``size`` its number of ids, ``at`` the piece's
    first id within the document."""
    ship(spark)
    shared = spark.sparkContext.broadcast(read_code(spark, path))

    def run(batches):
        code = Code(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 32):
                rows = batch.slice(lo, 32)
                ids = unframe(rows.column("frame").to_pylist(), code)
                out = []
                for r, got in zip(rows.drop_columns(["frame"]).to_pylist(), ids):
                    for doc, start, size in zip(r["doc_ids"], r["doc_starts"], r["doc_sizes"]):
                        a, b = max(start, r["first"]), min(start + size, r["first"] + r["n"])
                        piece = got[a - r["first"]:b - r["first"]].astype("<u4").tobytes()
                        out.append((r["file"], doc, start, size, a - start, piece))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECE.types)], schema=_PIECE)

    return spark.read.schema(BLOCKS).parquet(f"{path}/blocks").mapInArrow(run, PIECES)


def read_files(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(file, position of its first id among all ids), in order; one row per file."""
    rows = (spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("file").agg(F.sum("n").alias("n"))
            .orderBy("file").collect())
    at, out = 0, []
    for r in rows:
        out.append((r["file"], at))
        at += r["n"]
    return out


# --------------------------------------------------------------------------- digests

_POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC32 polynomial (reflected bit order)."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = (b >> 1) ^ (_POLY if b & 1 else 0)
    return out


def crc_shifted(crc: int, n_bytes: int) -> int:
    """What ``crc`` contributes to the CRC32 of a text in which ``n_bytes`` more bytes follow."""
    power, base = 1 << 31, 1 << 23  # x^0 and x^8
    while n_bytes:
        if n_bytes & 1:
            power = _times(power, base)
        base = _times(base, base)
        n_bytes >>= 1
    return _times(power, crc)


def crc_of_documents(pieces: DataFrame) -> DataFrame:
    """(file, doc_id, start, size, crc32) per document: shifted CRCs of its pieces, XORed."""
    def run(batches):
        for batch in batches:
            crc = []
            for size, at, ids in zip(*(batch.column(c).to_pylist() for c in ("size", "at", "ids"))):
                after = 4 * (size - at) - len(ids)
                crc.append(crc_shifted(zlib.crc32(ids), after) if after else zlib.crc32(ids))
            read = pc.divide(pc.binary_length(batch.column("ids")).cast(pa.int64()), 4)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("file", "doc_id", "start", "size")], read, pa.array(crc, pa.int64())],
                ["file", "doc_id", "start", "size", "read", "crc"])

    crcs = pieces.mapInArrow(run, "file int, doc_id bigint, start bigint, size bigint, read bigint, crc bigint")
    whole = crcs.groupBy("file", "start").agg(F.first("doc_id").alias("doc_id"), F.first("size").alias("size"),
                                              F.sum("read").alias("read"), F.bit_xor("crc").alias("crc32"))
    complete = F.when(F.col("read") == F.col("size"), F.col("size")).otherwise(
        F.raise_error(F.lit("a block of a document is missing")).cast("bigint"))
    return whole.select("file", "doc_id", "start", complete.alias("size"), "crc32")


def op13_huffman_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Ids of all documents written as Huffman files and read back."""
    import public_tokenizers

    path = fresh_dir(spark, "huffman-ids")
    write_ids(table(spark, sf_dir, "documents"), path, tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    bases = spark.createDataFrame(read_files(spark, path), "file int, base bigint")
    rows = crc_of_documents(read_ids(spark, path)).join(F.broadcast(bases), "file")
    return rows.select("doc_id", (F.col("base") + F.col("start")).alias("start"), F.col("size").alias("n_tokens"),
                       F.col("crc32").alias("ids_crc32"))
