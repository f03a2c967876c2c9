"""Removal of repeated passages with suffix arrays, built by external induced sorting.

Every ``width``-byte window of a document is dealt to a shard by the smallest hash of the
short strings inside it: equal windows meet in one shard wherever they stand. Neighbouring
windows with the same smallest hash travel as one fragment; fragments whose hash occurs in
a single document can't repeat and stay at home, equal fragments of a chunk of documents
travel once, with the smallest document id. A smallest hash with more than ``HEAVY`` windows
is no key of one shard: its windows are dealt singly by a hash of all their bytes, those that
several documents hold by that hash, each once a chunk with its smallest document id, so that
no string fills a shard however many documents have it. A shard sorts the suffixes of its
distinct fragments by induced sorting: sorted S* suffixes seed first-in-first-out queues, one
per first symbol, which deliver L-type and then S-type suffixes in order; queues spill to the
task's temporary folder, but a shard's text, its order and the arrays beside it (about 50
bytes a byte of text) are in memory: shards are external to each other, not within, and the
number of shards and ``HEAVY`` bound their size. Neighbours in the order with a common
prefix of at least ``width`` are one class, and each class's smallest document id goes back
to the chunks, where documents drop the windows that start in a document of smaller id.

The S* suffixes are ranked by naming their substrings and doubling the named length until it
passes ``width`` (the reduced string's recursion, cut off where common prefixes are long
enough): one vectorised step per level instead of one queue per name.

Whole copies of a text with a smaller id lose everything (if ``width`` bytes or more) and
take no part: the first copy stands for them.

Defined results: null and empty texts have 0 bytes and nothing removed; texts shorter than
``width`` keep everything; of rows sharing an id none removes the others' text; rows without
id come after all others and are no source for each other; an empty table gives no rows;
extra columns are ignored (the stage keeps them).
"""

import hashlib
import tempfile

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .shingle_join import IDS, _mix, _powers

U = np.uint64
#: Length of the hashed strings; bytes of a chunk of documents; hashes of a group;
#: corpus bytes per shard (fragments overlap, up to 3.5 times the text they cover).
KMER, CHUNK, GROUP, SHARD = 20, 3 << 20, 1 << 20, 1 << 20
#: Windows hashed at a time (their arrays fit a core's cache).
TILE = 1 << 16
#: Windows or bytes of fragments that are looked up or compared at a time.
PIECE = 1 << 18
#: Queue entries held in memory by one sort before queues spill.
MEMORY = 8 << 20
#: Windows with one smallest hash that stay together; a chunk tells their number from MANY on.
HEAVY, MANY = 1 << 16, 64
LOW = U((1 << 63) - 1)
LAST = (1 << 63) - 1
_R = U(0x9E3779B97F4A7C15)
_RINV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _totals(b: np.ndarray, up: np.ndarray) -> np.ndarray:
    total = np.zeros(len(b) + 1, dtype=np.uint64)
    x = total[1:]
    x[:] = b
    x += U(1)
    x *= up[: len(b)]
    return np.cumsum(total, out=total)


def window_hashes(b: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """63-bit hashes of all bytes of the windows at ``at`` (ascending), tile by tile."""
    out = np.zeros(len(at), dtype=np.uint64)
    up, down = _powers(_R, TILE + width), _powers(_RINV, TILE + width)
    cut = np.searchsorted(at, np.arange(0, len(b) + TILE, TILE))
    for k in np.flatnonzero(np.diff(cut)).tolist():
        own = at[cut[k]:cut[k + 1]] - k * TILE
        total = _totals(b[k * TILE:(k + 1) * TILE + width], up)
        out[cut[k]:cut[k + 1]] = _mix((total[own + width] - total[own]) * down[own]) >> U(1)
    return out


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``known``."""
    if not len(known) or not len(x):
        return np.zeros(len(x), bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def window_keys(b: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one key: (first window, last window, key) over documents laid end to end.

    Works through overlapping tiles that fit a core's cache; runs that a tile's edge cuts are joined.
    """
    w, n = width - KMER + 1, len(b)
    none = np.zeros(0, dtype=np.int64)
    if n < width:
        return none, none, none.astype(np.uint64)
    up, down = _powers(_R, TILE + width), _powers(_RINV, TILE + width)
    start = np.append(0, ends[:-1])
    fits = (ends - start) >= width
    start = start[fits]
    mark = np.zeros(n + 1, dtype=np.int8)  # 1 where a document's windows begin, -1 after its last
    mark[start] += 1
    mark[ends[fits] - width + 1] -= 1
    firsts, lasts, keys, level = [none], [none], [none.astype(np.uint64)], 0
    for s in range(0, n - width + 1, TILE):
        e = min(s + TILE, n - width + 1)
        total = _totals(b[s:e + width - 1], up)
        h = total[KMER:] - total[:-KMER]
        h *= down[: len(h)]
        h, span = _mix(h), 1
        while 2 * span <= w:  # least of 2, 4, 8 ... hashes, then of w
            h = np.minimum(h[:-span], h[span:])
            span *= 2
        if span < w:
            h = np.minimum(h[: span - w], h[w - span:])
        ok = np.cumsum(mark[s:e], dtype=np.int8) + np.int8(level)
        level = int(ok[-1])
        ok = ok > 0
        new = np.ones(e - s, bool)
        new[1:] = (h[1:] != h[:-1]) | ~ok[:-1]
        new[start[np.searchsorted(start, s):np.searchsorted(start, e)] - s] = True
        new &= ok
        end = np.ones(e - s, bool)
        end[:-1] = new[1:] | ~ok[1:]
        end &= ok
        first = np.flatnonzero(new)
        firsts.append(first + s), lasts.append(np.flatnonzero(end) + s), keys.append(h[first])
    first, last, key = np.concatenate(firsts), np.concatenate(lasts), np.concatenate(keys)
    cut = (first[1:] % TILE == 0) & (first[1:] == last[:-1] + 1) & (key[1:] == key[:-1])
    cut &= ~_among(first[1:], start)
    keep = np.append(True, ~cut)[: len(first)]
    return first[keep], last[np.append(~cut, True)[: len(first)]], key[keep]


class Queue:
    """First in, first out arrays of suffixes; what does not fit in memory is in a file."""

    def __init__(self, pool: list[int]):
        self.pool, self.parts, self.file, self.read, self.written = pool, [], None, 0, 0

    def push(self, x: np.ndarray) -> None:
        if not len(x):
            return
        self.parts.append(x)
        self.pool[0] += len(x)
        if self.pool[0] > MEMORY and len(self.parts) > 1:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for p in self.parts:
                self.file.write(p.tobytes())
                self.written += len(p)
                self.pool[0] -= len(p)
            self.parts = []

    def pop(self) -> np.ndarray | None:
        if self.read < self.written:
            self.file.seek(self.read * 8)
            x = np.frombuffer(self.file.read(8 * min(1 << 20, self.written - self.read)), dtype=np.int64)
            self.read += len(x)
            return x
        if not self.parts:
            return None
        x = np.concatenate(self.parts)
        self.parts = []
        self.pool[0] -= len(x)
        return x


def induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes of ``t`` in order, from its S* suffixes in order. ``small``: S-type."""
    pool = [0]
    left = [Queue(pool) for _ in range(symbols)]
    done_l: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    first = t[seeds]
    cut = np.searchsorted(first, np.arange(symbols + 1))

    def send(x: np.ndarray, want_small: bool, queues: list[Queue]) -> None:
        j = x - 1
        j = j[j >= 0]
        j = j[small[j] == want_small]
        if len(j):
            c = t[j]
            order = np.argsort(c, kind="stable")
            j, c = j[order], c[order]
            edge = np.flatnonzero(np.diff(c)) + 1
            for part, s in zip(np.split(j, edge), c[np.concatenate([[0], edge])].tolist()):
                queues[s].push(part)

    for s in range(symbols):
        while (x := left[s].pop()) is not None:
            done_l[s].append(x)
            send(x, False, left)
        send(seeds[cut[s]:cut[s + 1]], False, left)
    right = [Queue(pool) for _ in range(symbols)]
    out: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    for s in range(symbols - 1, -1, -1):
        while (x := right[s].pop()) is not None:
            out[s].append(x)
            send(x, True, right)
        for x in reversed(done_l[s]):
            send(x[::-1], True, right)
    whole = []
    for s in range(symbols):
        whole += done_l[s] + [x[::-1] for x in reversed(out[s])]
    return np.concatenate([seeds[:1], *whole])  # the end mark's suffix is the first


def suffix_order(t: np.ndarray, symbols: int, depth: int) -> np.ndarray:
    """Suffixes of ``t`` (its last symbol 0 occurs only there) in order of their first ``depth`` symbols at least."""
    n = len(t)
    step = np.sign(t[1:].astype(np.int64) - t[:-1])
    known = np.flatnonzero(step)
    ahead = known[np.searchsorted(known, np.arange(n - 1))]
    small = np.append(step[ahead] > 0, True)
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(star) < 2:
        return induce(t, small, star, symbols)
    # S* substrings in order, by inducing from S* suffixes sorted by their first symbol only
    rough = induce(t, small, star[np.argsort(t[star], kind="stable")], symbols)
    is_star = np.zeros(n, bool)
    is_star[star] = True
    rough = rough[is_star[rough]]
    place = np.zeros(n, dtype=np.int64)
    place[star] = np.arange(len(star))
    size = np.append(np.diff(star), 0) + 1
    a, b = rough[:-1], rough[1:]
    same = size[place[a]] == size[place[b]]
    at, off = np.flatnonzero(same), 0
    while len(at):
        ok = (off < size[place[a[at]]]) if off else np.ones(len(at), bool)
        at = at[ok]
        differ = t[a[at] + off] != t[b[at] + off]
        same[at[differ]] = False
        at, off = at[~differ], off + 1
    rank = np.zeros(len(star), dtype=np.int64)
    rank[place[rough]] = np.concatenate([[0], np.cumsum(~same)])
    # order of S* suffixes: double the number of substrings compared until they span the depth
    span, order = 1, place[rough]
    reach = np.append(star, n + depth)
    while rank.max() < len(star) - 1:
        after = np.append(rank[span:] + 1, np.zeros(min(span, len(rank)), dtype=np.int64))[: len(rank)]
        pair = rank * (len(rank) + 2) + after
        order = np.argsort(pair)
        new = np.append(True, np.diff(pair[order]) != 0)
        rank[order] = np.cumsum(new) - 1
        span *= 2
        if (reach[np.minimum(np.arange(len(star)) + span, len(star))] - star).min() >= depth:
            break
    return induce(t, small, star[order], symbols)


def first_documents(frags: list[bytes], docs: np.ndarray, width: int) -> list[np.ndarray]:
    """For each window of each fragment the smallest document among all fragments that contain it."""
    lens = np.array([len(f) for f in frags])
    body = np.frombuffer(b"".join(f + b"\0" for f in frags), dtype=np.uint8)
    ends = np.cumsum(lens + 1)
    t = np.append(body.astype(np.int16) + 2, 0).astype(np.int16)
    t[ends - 1] = 1
    order = suffix_order(t, 258, width + 1)
    start = ends - lens - 1
    owner = np.repeat(np.arange(len(frags)), lens + 1)
    room = np.repeat(ends - 1, lens + 1) - np.arange(len(body))  # bytes up to the fragment's end
    order = order[order < len(body)]
    order = order[room[order] >= width]
    words = np.zeros(len(body), dtype=np.uint64)
    wide = np.append(body, np.zeros(8, np.uint8)).astype(np.uint64)
    for k in range(8):
        words |= wide[k:k + len(body)] << U(8 * k)
    a, b = order[:-1], order[1:]
    same = np.ones(len(a), bool)  # common prefix of neighbours reaches the width
    for k in [*range(0, width - 8, 8), width - 8]:
        same &= words[a + k] == words[b + k]
    group = np.concatenate([[0], np.cumsum(~same)])
    head = np.flatnonzero(np.concatenate([[True], ~same]))
    least = np.minimum.reduceat(docs[owner[order]], head)[group]
    found = np.zeros(len(body), dtype=np.int64)
    found[order] = least
    return [found[s:s + n - width + 1] for s, n in zip(start.tolist(), lens.tolist())]


# ---- the passes ----

def _pack(batches):
    """Chunks of documents: (chunk, ids, lens, rest, data)."""
    squeeze = zstandard.ZstdCompressor(level=3)

    def row(ids, raw, rest):
        lens, data = [len(r) for r in raw], b"".join(raw)
        # chunks with one name hold the same ids and bytes, so whatever is told of one holds for the other
        name = hashlib.blake2b(np.array([ids, lens], dtype=np.int64).tobytes() + data, digest_size=8).digest()
        return int.from_bytes(name, "little", signed=True), ids, lens, rest, squeeze.compress(data)

    cols = ["chunk", "ids", "lens", "rest", "data"]
    ids, raw, rest, size = [], [], [], 0
    for pdf in batches:
        for i, t, r in zip(pdf["id"].tolist(), pdf["text"], pdf["rest"]):
            ids.append(i), raw.append(t.encode("utf-8", "surrogatepass")), rest.append(r)
            size += len(raw[-1])
            if size >= CHUNK:
                yield pd.DataFrame([row(ids, raw, rest)], columns=cols)
                ids, raw, rest, size = [], [], [], 0
    if ids:
        yield pd.DataFrame([row(ids, raw, rest)], columns=cols)


def _unpack(row) -> tuple[np.ndarray, np.ndarray, bytes]:
    data = zstandard.ZstdDecompressor().decompress(row.data, max_output_size=max(1, int(np.sum(row.lens))))
    return np.asarray(row.ids, dtype=np.int64), np.cumsum(np.asarray(row.lens, dtype=np.int64)), data


def _grouped(chunk: int, key: np.ndarray, doc: np.ndarray, size: np.ndarray, groups: int) -> pd.DataFrame:
    """(group, chunk, keys, many): distinct 63-bit keys, the lowest bit tells of several documents; many: (place, windows) of keys with many."""
    order = np.lexsort((doc, key))
    key, doc, size = key[order], doc[order], size[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    tail = np.append(head[1:], len(key)) - 1
    size = np.add.reduceat(size, head)
    key = (key[head] << U(1)) | (doc[head] != doc[tail]).astype(np.uint64)
    g = ((key >> U(1)) % U(groups)).astype(np.int64)
    order = np.argsort(g, kind="stable")
    cut = np.searchsorted(g[order], np.arange(groups + 1))
    out = []
    for k in range(groups):
        if cut[k] < cut[k + 1]:
            own = order[cut[k]:cut[k + 1]]
            many = np.flatnonzero(size[own] >= MANY)
            out.append((k, chunk, key[own].tobytes(), np.stack([many, size[own[many]]]).tobytes()))
    return pd.DataFrame(out, columns=["group", "chunk", "keys", "many"])


def _hashes(width: int, groups: int):
    """A chunk's distinct keys by group."""
    def run(batches):
        for pdf in batches:
            for row in pdf.itertuples():
                ids, ends, data = _unpack(row)
                first, last, key = window_keys(np.frombuffer(data, np.uint8), ends, width)
                if len(key):
                    yield _grouped(row.chunk, key >> U(1), np.searchsorted(ends, first, side="right"), last - first + 1, groups)
    return run


def _shared(heavy: int):
    """(chunk, keys, split): the keys of each chunk that several documents have, the highest bit set
    where they have more than ``heavy`` windows; split: windows of those, once a group."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(k, np.uint64) for k in pdf["keys"]]
        key = np.concatenate(parts)
        whole = np.sort(key >> U(1))
        twice = np.concatenate([whole[1:][whole[1:] == whole[:-1]], key[(key & U(1)) == 1] >> U(1)])
        twice = np.unique(twice)
        # windows of a key: as told, below MANY where a chunk doesn't tell
        size = (np.searchsorted(whole, twice, side="right") - np.searchsorted(whole, twice)) * (MANY - 1)
        for p, m in zip(parts, pdf["many"]):
            place, n = np.frombuffer(m, np.int64).reshape(2, -1)
            k = p[place] >> U(1)
            known = _among(k, twice)
            size[np.searchsorted(twice, k[known])] += n[known] - (MANY - 1)
        large = size > heavy
        split, out = int(size[large].sum()), []
        mark = twice | (large.astype(np.uint64) << U(63))
        for chunk, p in zip(pdf["chunk"], parts):
            k = p >> U(1)
            k = k[_among(k, twice)]
            if len(k):
                out.append((chunk, mark[np.searchsorted(twice, k)].tobytes(), split))
                split = 0
        return pd.DataFrame(out, columns=["chunk", "keys", "split"])
    return run


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All windows of the runs."""
    n = last - first + 1
    return np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())


def _singles(width: int, groups: int):
    """A chunk's windows with heavy keys by group, as hashes of all their bytes."""
    def run(chunks: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        _, heavy, _ = _keys_of(keys)
        out = [pd.DataFrame([], columns=["group", "chunk", "keys", "many"])]
        for row in chunks.itertuples():
            ids, ends, data = _unpack(row)
            b = np.frombuffer(data, np.uint8)
            first, last, key = window_keys(b, ends, width)
            hot = _among(key >> U(1), heavy)
            if hot.any():
                at = _spread(first[hot], last[hot])
                out.append(_grouped(row.chunk, window_hashes(b, at, width), np.searchsorted(ends, at, side="right"), np.ones(len(at), np.int64), groups))
        return pd.concat(out)
    return run


def _alike(b: np.ndarray, p: np.ndarray, q: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Whether the strings of ``lens`` bytes at ``p`` and at ``q`` are equal, some at a time."""
    out = np.ones(len(p), bool)
    for x in _slices(lens):
        n = lens[x]
        j = _spread(np.zeros(len(n), np.int64), n - 1)
        differ = b[np.repeat(p[x], n) + j] != b[np.repeat(q[x], n) + j]
        out[x] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
    return out


def _slices(n: np.ndarray) -> list[slice]:
    """Slices whose ``n`` come to about ``PIECE``."""
    cut = np.unique(np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()), PIECE))).tolist()
    return [slice(p, q) for p, q in zip(cut, [*cut[1:], len(n)])]


class Fragments:
    """Fragments by number, kept as their places in a chunk's bytes and their lengths."""

    def __init__(self, data: bytes, place: np.ndarray, size: np.ndarray):
        self.data, self.place, self.size = data, place, size

    def __len__(self) -> int:
        return len(self.place)

    def __iter__(self):
        return (self.data[p:p + n] for p, n in zip(self.place, self.size))

    def joined(self, x: np.ndarray) -> bytes:
        """Those numbered ``x``, end to end."""
        return np.frombuffer(self.data, np.uint8)[_spread(self.place[x], self.place[x] + self.size[x] - 1)].tobytes()


def _runs(row, known: tuple[np.ndarray, np.ndarray, np.ndarray], width: int, shards: int):
    """A chunk's fragments with shared keys: (ids, ends, data, runs, fragments, shard, least id).

    runs: arrays of document, first window, windows, fragment's number; the others by number.
    Fragments stay arrays: as heavy keys grow with the corpus, they may be as many as the windows.
    """
    ids, ends, data = _unpack(row)
    shared, heavy, windows = known
    b = np.frombuffer(data, np.uint8)
    first, last, key = window_keys(b, ends, width)
    key = key >> U(1)
    keep = _among(key, shared)
    first, last, key = first[keep], last[keep], key[keep]
    hot = _among(key, heavy)
    if hot.any():  # one window a fragment
        at = _spread(first[hot], last[hot])
        h = window_hashes(b, at, width)
        keep = _among(h, windows)
        at, h = at[keep], h[keep]
        first, last, key = np.append(first[~hot], at), np.append(last[~hot], at), np.append(key[~hot], h)
        order = np.argsort(first, kind="stable")
        first, last, key = first[order], last[order], key[order]
        del at, h, order
    doc, n = np.searchsorted(ends, first, side="right"), last - first + 1
    # of fragments with one name, if equal, the one with the smallest id stands for all
    name = _mix(window_hashes(b, first, width) * _R + window_hashes(b, last, width) + n.astype(np.uint64))
    order = np.lexsort((ids[doc], name))
    head = np.append(True, np.diff(name[order]) != 0)[: len(order)]
    like = np.zeros(len(order), dtype=np.int64)
    like[order] = order[head][np.cumsum(head) - 1]
    del name, order, head
    own = n != n[like]
    rest = np.flatnonzero(~own & (like != np.arange(len(like))))
    own[rest] = ~_alike(b, first[rest], first[like[rest]], n[rest] + width - 1)
    like[own] = np.flatnonzero(own)
    reps = np.flatnonzero(like == np.arange(len(like)))
    runs = doc, first, n, np.searchsorted(reps, like)
    return ids, ends, data, runs, Fragments(data, first[reps], n[reps] + width - 1), (key[reps] % U(shards)).astype(np.int64), ids[doc[reps]]


def _by_shard(shard: np.ndarray):
    """(shard, numbers of its fragments) in order."""
    order = np.argsort(shard, kind="stable")
    cut = np.flatnonzero(np.diff(shard[order])) + 1
    return [(int(shard[x[0]]), x) for x in np.split(order, cut) if len(x)]


def _keys_of(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shared keys, those of them that are heavy, shared windows of these; each sorted."""
    none = [np.zeros(0, np.uint64)]
    key, windows = (np.concatenate(none + [np.frombuffer(k, np.uint64) for k in pdf[c].dropna()]) for c in ("keys", "windows"))
    return np.unique(key & LOW), np.unique(key[key > LOW] & LOW), np.unique(windows)


def _fragments(width: int, shards: int):
    def run(chunks: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        known, squeeze, out = _keys_of(keys), zstandard.ZstdCompressor(level=3), []
        for row in chunks.itertuples():
            _, _, _, _, frags, shard, least = _runs(row, known, width, shards)
            for s, x in _by_shard(shard):
                out.append((s, row.chunk, squeeze.compress(frags.joined(x)), frags.size[x].tobytes(), least[x].tobytes()))
        return pd.DataFrame(out, columns=["shard", "chunk", "data", "lens", "docs"])
    return run


def _sorted(width: int):
    """A shard: (chunk, shard, firsts), the smallest document of every window, in the chunk's order."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        at: dict[bytes, int] = {}
        docs: list[int] = []
        lists = []
        for row in pdf.itertuples():
            lens = np.frombuffer(row.lens, np.int64)
            data = zstandard.ZstdDecompressor().decompress(row.data, max_output_size=int(lens.sum()))
            own, p = [], 0
            for n, d in zip(lens.tolist(), np.frombuffer(row.docs, np.int64).tolist()):
                f = data[p:p + n]
                p += n
                k = at.setdefault(f, len(docs))
                if k == len(docs):
                    docs.append(d)
                elif d < docs[k]:
                    docs[k] = d
                own.append(k)
            lists.append((row.chunk, row.shard, own))
        firsts = first_documents(list(at), np.array(docs, dtype=np.int64), width)
        squeeze = zstandard.ZstdCompressor(level=3)
        out = [(c, s, squeeze.compress(np.concatenate([firsts[k] for k in own]).tobytes())) for c, s, own in lists]
        return pd.DataFrame(out, columns=["chunk", "shard", "firsts"])
    return run


def _cleaned(width: int, shards: int, text: bool):
    """Per document of a chunk: what is removed, and the kept text where asked for."""
    def run(chunks: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys = _keys_of(known)
        firsts = known[known["firsts"].notna()]
        out = []
        for row in chunks.itertuples():
            ids, ends, data, (doc, first, n, number), frags, shard, _ = _runs(row, keys, width, shards)
            size = frags.size - width + 1
            place, found, p = np.zeros(len(size), dtype=np.int64), np.zeros(int(size.sum()), dtype=np.int64), 0
            got = dict(zip(firsts["shard"].tolist(), firsts["firsts"]))
            for s, x in _by_shard(shard):
                m = int(size[x].sum())
                place[x] = p + np.cumsum(size[x]) - size[x]
                found[p:p + m] = np.frombuffer(zstandard.ZstdDecompressor().decompress(got[s], max_output_size=8 * m), np.int64)
                p += m
            hit = np.zeros(len(data), bool)
            for x in _slices(n):
                j = _spread(np.zeros(len(n[x]), np.int64), n[x] - 1)
                at = np.repeat(first[x], n[x]) + j
                hit[at[found[np.repeat(place[number[x]], n[x]) + j] < np.repeat(ids[doc[x]], n[x])]] = True
            del doc, first, n, number, place, found
            total = np.cumsum(hit, dtype=np.int32)
            total[width:] -= total[:-width].copy()
            gone = total > 0
            del hit, total
            b = np.frombuffer(data, np.uint8)
            start = np.append(0, ends[:-1])
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            some = start[start < ends]
            edge[some] = gone[some]
            removed, spans = (np.diff(np.append(0, np.append(np.int32(0), np.cumsum(x, dtype=np.int32))[ends])).tolist() for x in (gone, edge))
            for k, (s, e) in enumerate(zip(start.tolist(), ends.tolist())):
                kept = b[s:e][~gone[s:e]].tobytes() if removed[k] else data[s:e]
                out.append((int(ids[k]), e - s, removed[k], spans[k], hashlib.sha256(kept).hexdigest(),
                            kept.decode("utf-8", "ignore") if text else None, row.rest[k]))
        return pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "rest"])
    return run


def dedup(docs: DataFrame, width: int = 50, text: bool = False, rest: list[str] | None = None, heavy: int = HEAVY) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, kept (the text left, if asked for), rest (other columns as JSON)."""
    if width < KMER + 8:
        raise ValueError(f"width must be at least {KMER + 8}")
    other = F.to_json(F.struct(*rest)) if rest else F.lit(None).cast("string")
    d = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("id"), F.coalesce("text", F.lit("")).alias("text"), other.alias("rest"))
    n = F.octet_length("text").cast("long")
    d = d.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), F.reverse("text")))
    names = stored(d.select("id", "h1", "h2", n.alias("n")), "dedup-names")
    total = names.agg(F.sum("n").alias("b")).first()["b"] or 0
    groups, shards = int(total // 20 // GROUP) + 1, int(total // SHARD) + 1
    first = names.groupBy("h1", "h2", "n").agg(F.min("id").alias("first"), F.count("*").alias("c")).where("c > 1")
    copies = names.join(first, ["h1", "h2", "n"]).where("id > first").select(F.col("id").alias("c_id"), F.col("h1").alias("c_h1"), F.col("h2").alias("c_h2")).distinct()
    copies = stored(copies, "dedup-copies")
    copies = F.broadcast(copies) if copies.count() <= IDS else copies
    is_copy = (d["id"] == copies["c_id"]) & (d["h1"] == copies["c_h1"]) & (d["h2"] == copies["c_h2"])
    chunks = stored(d.join(copies, is_copy, "left_anti").select("id", "text", "rest").mapInPandas(_pack, "chunk long, ids array<long>, lens array<long>, rest array<string>, data binary"), "dedup-chunks")
    by_group, none = "group long, chunk long, keys binary, many binary", F.lit(None)
    keys = chunks.mapInPandas(_hashes(width, groups), by_group)
    keys = stored(keys.groupBy("group").applyInPandas(_shared(heavy), "chunk long, keys binary, split long"), "dedup-keys")
    split = keys.agg(F.sum("split").alias("n")).first()["n"] or 0
    keys = keys.select("chunk", "keys", none.cast("binary").alias("windows"))
    lean = chunks.select("chunk", "ids", "lens", "data").groupBy("chunk")
    if split:
        windows = lean.cogroup(keys.groupBy("chunk")).applyInPandas(_singles(width, int(split // GROUP) + 1), by_group)
        windows = windows.groupBy("group").applyInPandas(_shared(LAST), "chunk long, keys binary, split long")
        windows = stored(windows.select("chunk", F.col("keys").alias("windows")), "dedup-windows")
        keys = keys.unionByName(windows.select("chunk", none.cast("binary").alias("keys"), "windows"))
    frags = lean.cogroup(keys.groupBy("chunk")).applyInPandas(_fragments(width, shards), "shard long, chunk long, data binary, lens binary, docs binary")
    firsts = stored(frags.groupBy("shard").applyInPandas(_sorted(width), "chunk long, shard long, firsts binary"), "dedup-firsts")
    known = keys.select("*", none.cast("long").alias("shard"), none.cast("binary").alias("firsts"))
    known = known.unionByName(firsts.select("chunk", none.cast("binary").alias("keys"), none.cast("binary").alias("windows"), "shard", "firsts"))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, rest string"
    out = chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(_cleaned(width, shards, text), schema)
    copy = d.join(copies, is_copy, "left_semi").withColumn("n", n)
    gone = F.col("n") >= width
    left = F.when(gone, F.lit("")).otherwise(F.col("text"))
    copy = copy.select("id", F.col("n").alias("n_bytes"), F.when(gone, F.col("n")).otherwise(0).alias("n_removed"), F.when(gone, 1).otherwise(0).cast("long").alias("n_spans"),
                       F.sha2(left.cast("binary"), 256).alias("kept_sha256"), (left if text else F.lit(None).cast("string")).alias("kept"), "rest")
    return out.unionByName(copy)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup(table(spark, sf_dir, "documents"))
    return out.select(F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages (characters cut by an end go too); documents left without text go."""
    rest = [c for c in docs.columns if c != "text"]
    out = dedup(docs, text=True, rest=rest)
    back = F.from_json("rest", docs.select(*rest).schema).alias("r")
    out = out.where("not (n_removed > 0 and trim(kept) = '')").select("kept", back)
    out = out.select(*[(F.col("kept") if c == "text" else F.col(f"r.{c}")).alias(c) for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


