"""Language-model scoring with an Elias-Fano n-gram trie.

Counts come from all training texts (Spark shuffles, summed per shard). Shard
``s`` of the trie holds the n-grams whose first word lies in range ``s`` of the
vocabulary, and is one file of compact levels in the shared folder that tasks
map into memory. The n-grams of a hot first word (and of the start of texts) lie in the
shard of their second word instead, so that they spread over all files:

* level 1: the words' hashes, sorted (a word's rank is its number), and counts;
* level k: the successors of each context of k-1 words. Their numbers, made
  monotone by adding the last value of the range before, are Elias-Fano coded; so
  are the pointers from a context to its range. A successor is found by a
  search relative to its context's range. Probabilities are 16-bit codes of one
  fixed codebook (even steps of the logarithm), the same for all levels and shards.

Smoothing is absolute discounting with interpolation: P(w|h) = max(c(hw) - D, 0) / c(h)
+ g(h) P(w|h'), down to the additive unigram. Stored is the first term; g(h) is
what the stored terms of a context leave of 1, so that the quantised model still sums to 1.
N-grams of two or more words seen fewer than ``least`` times are not stored (their mass goes to g);
by default all are stored (``least`` 1).
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import mix, scratch, text_slices, width, word_hashes

ORDER, DISCOUNT, LEAST, DELTA = 3, 0.75, 1, 0.1
END = np.uint64(0x9E3779B97F4A7C15)  # the hash that stands for a text's end
SLICE = 4 << 20  # bytes of text whose n-grams are counted together
SCORED = 2 << 20  # bytes of text whose n-grams are looked up together
RUN = 16 << 20  # bytes of counts that a shard's task holds before it sums them
HOT = 4  # a word is hot from the HOT-th part of a shard's mean tokens
HOT_OF = 1024  # most hot words of one shard's range
STEP = 20 / 65535  # of the codes of log10


# ------------------------------------------------------------------ files

def filesystem(path: str):
    """(file system, path in it) of a path or URI that executors share."""
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def save_arrays(path: str, arrays: dict[str, np.ndarray]) -> int:
    """Write arrays as one file (header, then each array on a 64-byte boundary), by a rename so that retries do no harm."""
    fs, at = filesystem(path)
    places, end = {}, 0
    for name, a in arrays.items():
        places[name] = [a.dtype.str, end, len(a)]
        end += -(-a.nbytes // 64) * 64
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 8) % 64)
    part = f"{at}.{np.random.default_rng().integers(1 << 62)}"
    with fs.open_output_stream(part, compression=None) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for a in arrays.values():
            out.write(a.tobytes())
            out.write(b"\0" * (-a.nbytes % 64))
    fs.move(part, at)
    return 8 + len(head) + end


def open_arrays(path: str) -> dict[str, np.ndarray]:
    """Memory-mapped where the shared folder is mounted, else read as a whole file."""
    fs, at = filesystem(path)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.memmap(at, np.uint8, "r").view(np.ndarray)
    else:
        with fs.open_input_file(at) as f:
            raw = np.frombuffer(f.read(), np.uint8)
    size = int.from_bytes(raw[:8].tobytes(), "little")
    places = json.loads(raw[8:8 + size].tobytes())
    return {k: raw[8 + size + off:8 + size + off + n * np.dtype(t).itemsize].view(t) for k, (t, off, n) in places.items()}


# ------------------------------------------------------------------ Elias-Fano

def _select_in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th (from 0) set bit of each word."""
    place, k = np.zeros(len(word), np.int64), k.astype(np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(word & np.uint64((1 << half) - 1)).astype(np.int64)
        up = k >= below
        k -= below * up
        place += half * up
        word = np.where(up, word >> np.uint64(half), word)
    return place


class EliasFano:
    """A monotone sequence: low bits packed, high parts in unary with a count per word."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, self.high, self.ones, self.zeros = (arrays[f"{name}.{x}"] for x in ("low", "high", "ones", "zeros"))
        self.n, self.bits = (int(x) for x in arrays[f"{name}.head"])

    @staticmethod
    def build(values: np.ndarray, name: str) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.zeros((n * bits + 63) // 64 + 2, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = np.flatnonzero(shift + np.uint64(bits) > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = (top >> bits) + n + 1
        high = np.zeros(size // 64 + 1, np.uint64)
        np.bitwise_or.at(high, place >> 6, np.uint64(1) << (place & 63).astype(np.uint64))
        count = np.bitwise_count(high).astype(np.int64)
        ones = np.concatenate(([0], np.cumsum(count)))
        zeros = np.arange(len(ones)) * 64 - ones
        kind = np.uint32 if len(high) * 64 < 1 << 32 else np.uint64
        return {f"{name}.low": low, f"{name}.high": high, f"{name}.ones": ones.astype(kind), f"{name}.zeros": zeros.astype(kind),
                f"{name}.head": np.array([n, bits], np.int64)}

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        got = self.low[word] >> shift
        over = (self.low[word + 1] << np.uint64(1)) << (np.uint64(63) - shift)
        return (got | over) & np.uint64((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        word = np.searchsorted(self.ones, i.astype(self.ones.dtype), "right") - 1
        place = word * 64 + _select_in_word(self.high[word], i - self.ones[word].astype(np.int64))
        return ((place - i).astype(np.uint64) << np.uint64(self.bits)) | self._lows(i)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        k = np.clip(k, 0, int(self.zeros[-1]) - 1)
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), "right") - 1
        return word * 64 + _select_in_word(~self.high[word], k - self.zeros[word].astype(np.int64))

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the successor of x, whether it equals x)."""
        if not self.n:
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        x = x.astype(np.uint64)
        part = (x >> np.uint64(self.bits)).astype(np.int64)
        low = x & np.uint64((1 << self.bits) - 1)
        lo = np.where(part > 0, self._zero(part - 1) + 1 - part, 0)
        end = np.minimum(self._zero(part) - part, self.n)
        out = part >= int(self.zeros[-1])  # beyond the last value
        lo = np.where(out, self.n, lo)
        end = np.where(out, self.n, end)
        hi, limit = end.copy(), end
        while (live := np.flatnonzero(lo < hi)).size:
            mid = (lo[live] + hi[live]) // 2
            less = self._lows(mid) < low[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
        inside = np.flatnonzero(lo < limit)
        same = np.zeros(len(x), bool)
        same[inside] = self._lows(lo[inside]) == low[inside]
        return lo, same


# ------------------------------------------------------------------ tokens

def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, and the offsets."""
    words, at = word_hashes(texts)
    n = np.diff(at)
    offsets = at + np.arange(len(at))
    out = np.full(len(words) + len(n), END, np.uint64)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = words
    return out, offsets


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class Vocabulary:
    """Level 1 over all shards."""

    def __init__(self, paths: list[str], sizes: list[int]):
        self.paths, self.offsets, self.parts = paths, np.concatenate(([0], np.cumsum(sizes))), {}
        self.size = int(self.offsets[-1])

    def part(self, s: int) -> dict[str, np.ndarray]:
        if s not in self.parts:
            self.parts[s] = open_arrays(self.paths[s]) if self.paths[s] else {"hash": np.zeros(0, np.uint64), "count": np.zeros(0, np.int64)}
        return self.parts[s]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of hashes, which are sorted and distinct."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(_shard_of(hashes, len(self.paths)), np.arange(len(self.paths) + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            own = hashes[cuts[s]:cuts[s + 1]]
            part = self.part(int(s))
            at = np.minimum(np.searchsorted(part["hash"], own), max(0, len(part["hash"]) - 1))
            if len(part["hash"]):
                known = part["hash"][at] == own
                ids[cuts[s]:cuts[s + 1]] = np.where(known, at + self.offsets[s], -1)
                counts[cuts[s]:cuts[s + 1]] = np.where(known, part["count"][at], 0)
        return ids, counts

    def distinct(self, texts: pa.Array):
        """(numbers and counts of the distinct tokens, each token's place among them, offsets) of texts."""
        tokens, at = _tokens(texts)
        distinct, back = np.unique(tokens, return_inverse=True)
        return *self.lookup(distinct), back, at

    def numbers(self, texts: pa.Array):
        """(token numbers, counts, offsets) of texts."""
        ids, counts, back, at = self.distinct(texts)
        return ids[back], counts[back], at


def _before(ids: np.ndarray, at: np.ndarray, back: int, start: int) -> np.ndarray:
    """The token ``back`` places before each token; ``start`` before the text's first, -2 farther out."""
    out = np.full(len(ids), -2, np.int64)
    out[back:] = ids[:len(ids) - back] if back else ids
    place = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
    out[place < back] = -2
    out[place == back - 1] = start
    return out


# ------------------------------------------------------------------ counting

_BLOB = "shard int, a binary, b binary, n binary"


def _blobs(shard: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray):
    """One row for each shard; ``shard`` is sorted."""
    cuts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.zeros(0, int)
    ends = np.concatenate((cuts[1:], [len(shard)])).astype(int)
    return pa.RecordBatch.from_arrays(
        [pa.array(shard[cuts], pa.int32()), *[pa.array([_packed(x[i:j], c == 0) for i, j in zip(cuts, ends)], pa.binary()) for c, x in enumerate((a, b, n))]], names=["shard", "a", "b", "n"])


def _packed(x: np.ndarray, steps: bool) -> bytes:
    """The numbers' first bytes, then their second and so on, of sorted numbers of their
    steps: the upper ones are mostly zeros, which the shuffle's compression takes out."""
    if steps and len(x):
        x = np.diff(x, prepend=x[:1] * 0)
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unpacked(raw, kind, steps: bool) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, np.uint8)
    x = np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).reshape(-1).view(kind)
    return np.cumsum(x, dtype=kind) if steps else x


def _count_words(shards: int):
    def run(batches):
        for batch in batches:
            for _, _, texts in text_slices(batch, 0, SLICE):
                words, n = np.unique(_tokens(texts)[0], return_counts=True)
                yield _blobs(_shard_of(words, shards), words, words[:0].view(np.int64), n.astype(np.int32))
    return run


def _place(hot: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Place of each word among the hot ones (sorted), or -1."""
    at = np.minimum(np.searchsorted(hot, heads), len(hot) - 1)
    return np.where(hot[at] == heads, at, -1)


def _shard(offsets: np.ndarray, hot: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Shard of n-grams by their first word, or by their second where the first is hot."""
    by = np.where(_place(hot, first) >= 0, np.maximum(second, 0), first)
    return np.minimum(np.searchsorted(offsets, by, "right") - 1, len(offsets) - 2).astype(np.int64)


def _count_ngrams(paths, sizes, order: int, hot: np.ndarray):
    def run(batches):
        vocabulary = Vocabulary(paths, sizes)
        start, pad, base = vocabulary.size, vocabulary.size + 1, vocabulary.size + 2
        for batch in batches:
            for _, _, texts in text_slices(batch, 0, SLICE):
                ids, _, at = vocabulary.numbers(texts)
                if not len(ids):
                    continue
                first = _before(ids, at, 1, start)
                if order == 2:
                    pairs, n = np.unique(first * base + ids, return_counts=True)
                    a, b = pairs // base, (pairs % base).astype(np.int32)
                    head, second = a, b
                else:  # (first, ids) are the contexts, what follows is the word; after the end comes a pad
                    after = np.full(len(ids), pad, np.int64)
                    after[:-1] = ids[1:]
                    after[at[1:] - 1] = pad
                    contexts, rank = np.unique(first * base + ids, return_inverse=True)
                    keys, n = np.unique(rank * base + after, return_counts=True)
                    a, b = contexts[keys // base], (keys % base).astype(np.int32 if base < 2**31 else np.int64)
                    head, second = a // base, a % base
                shard = _shard(vocabulary.offsets, hot, head, second)
                order_ = np.argsort(shard, kind="stable")
                yield _blobs(shard[order_], a[order_], b[order_].astype(np.int64 if base >= 2**31 else np.int32), n[order_].astype(np.int32))
    return run


def _shards(batches, kinds: list):
    """Rows sorted by shard -> (shard, its summed counts as columns a, b, n).
    Blobs are summed as soon as they outweigh what is summed so far (and RUN),
    so that a task holds a shard's distinct n-grams but not all their repeats,
    and nothing of them while the shard is written."""
    shard, rows, size, summed = None, [], 0, 0  # the first of rows is what is summed so far
    for batch in batches:
        for i, own in enumerate(batch.column("shard").to_pylist()):
            if own != shard:
                if rows:
                    yield shard, _merged(rows)
                shard, size, summed = own, 0, 0
            rows.append([_unpacked(batch.column(c)[i].as_buffer(), t, c == "a") for c, t in zip(("a", "b", "n"), kinds)])
            size += sum(x.nbytes for x in rows[-1])
            if size >= max(RUN, summed):
                rows = [_merged(rows)]
                size, summed = 0, sum(x.nbytes for x in rows[0])
        del batch
    if rows:
        yield shard, _merged(rows)


def _merged(rows: list) -> list[np.ndarray]:
    """Columns (a, b, n), sorted by (a, b), of which each pair comes once; b is empty for words. ``rows`` is emptied."""
    a, b, n = (np.concatenate([r[i] for r in rows]) for i in range(3))
    rows.clear()
    order = np.lexsort((b, a)) if len(b) else np.argsort(a, kind="stable")
    a, b, n = a[order], b[order] if len(b) else b, n[order].astype(np.int64)
    del order
    first = np.concatenate(([True], a[1:] != a[:-1])) if len(a) else np.zeros(0, bool)
    if len(b):
        first[1:] |= b[1:] != b[:-1]
    starts = np.flatnonzero(first)
    return [a[starts], b[starts] if len(b) else b, np.add.reduceat(n, starts) if len(n) else n]


def _dealt(blobs: DataFrame, shards: int) -> DataFrame:
    """Each shard in a task of its own: by hash several would meet in one, lie there in one batch and have to be sorted."""
    return blobs.repartitionById(shards, "shard")


_MADE = "shard int, path string, size long, total long, bytes long, hot binary"


def _made(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                      names=["shard", "path", "size", "total", "bytes", "hot"])


def _write_words(root: str):
    def run(batches):
        for shard, (keys, _, n) in _shards(batches, [np.uint64, np.int64, np.int32]):
            path = f"{root}/words-{shard:05d}"
            most = np.union1d(np.argsort(-n, kind="stable")[:HOT_OF], np.flatnonzero(keys == END))
            often = np.stack((most, n[most], keys[most] == END), axis=1).astype(np.int64)  # (place, count, whether it is the end)
            yield _made([(shard, path, len(keys), int(n.sum()), save_arrays(path, {"hash": keys, "count": n}), often.tobytes())])
    return run


def _level(arrays: dict, k: int, parent: np.ndarray, word: np.ndarray, count: np.ndarray, total: np.ndarray, parents: int, discount: float) -> np.ndarray:
    """Add level ``k``: nodes sorted by (parent, word); ``total`` the parents' counts. Returns what each parent's terms sum to."""
    pointers = np.searchsorted(parent, np.arange(parents + 1))
    ends = np.flatnonzero(np.concatenate((parent[1:] != parent[:-1], [True]))) if len(parent) else np.zeros(0, int)
    lifts = np.concatenate(([0], np.cumsum(word[ends] + 1)[:-1])) if len(ends) else np.zeros(0, np.int64)
    values = word + np.repeat(lifts, np.diff(np.concatenate(([0], ends + 1))))
    code = np.rint(np.log10((count - discount) / total[parent]) / -STEP).astype(np.uint16)
    spent = np.bincount(parent, 10 ** (code * -STEP), parents)
    arrays |= EliasFano.build(pointers, f"{k}.pointers") | EliasFano.build(values, f"{k}.words")
    arrays |= {f"{k}.code": code, f"{k}.left": np.clip(1 - spent, 1e-6, 1).astype(np.float32)}
    return spent


def _write_trie(root: str, sizes: list[int], order: int, least: int, discount: float, hot: np.ndarray, hot_counts: np.ndarray):
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    start, base = int(offsets[-1]), int(offsets[-1]) + 2

    def run(batches):
        for shard, (a, word, n) in _shards(batches, [np.int64, np.int64 if base >= 2**31 else np.int32, np.int32]):
            local = int(sizes[shard]) + len(hot)  # a shard's own words, then the hot ones of all
            first, second = (a, 0) if order == 2 else (a // base, a % base)
            place = _place(hot, first)
            a = np.where(place >= 0, sizes[shard] + place, first - offsets[shard]) * (1 if order == 2 else base) + second
            del first, second, place
            turn = np.argsort(a, kind="stable")  # hot words come last
            a, word, n = a[turn], word[turn].astype(np.int64), n[turn]
            del turn
            contexts, ctx = np.unique(a, return_inverse=True)
            del a
            total = np.bincount(ctx, n, len(contexts)).astype(np.int64)
            arrays: dict[str, np.ndarray] = {}
            keep = (n >= least) & (word <= start)
            if order == 2:
                sums = np.bincount(contexts, total, local)
                sums[int(sizes[shard]):] = hot_counts
                spent = _level(arrays, 2, contexts[ctx[keep]], word[keep], n[keep], sums, local, discount)
            else:
                first, second = contexts // base, contexts % base
                sums = np.bincount(first, total, local)
                sums[int(sizes[shard]):] = hot_counts
                live = total >= least  # contexts seen as often; deeper n-grams have such contexts
                place = np.cumsum(live) - 1
                spent = _level(arrays, 2, first[live], second[live], total[live], sums, local, discount)
                keep &= live[ctx]
                _level(arrays, 3, place[ctx[keep]], word[keep], n[keep], total[live], int(live.sum()), discount)
            path = f"{root}/trie-{shard:05d}"
            yield _made([(shard, path, int(keep.sum()), int(n.sum()), save_arrays(path, arrays), spent[int(sizes[shard]):].tobytes())])
    return run


class Trie:
    """All shards' levels, mapped when first used."""

    def __init__(self, paths: list[str], vocabulary: Vocabulary, order: int, hot: np.ndarray, hot_left: np.ndarray):
        self.paths, self.vocabulary, self.order, self.parts = paths, vocabulary, order, {}
        self.hot, self.hot_left = hot, hot_left

    def part(self, s: int) -> dict | None:
        if s not in self.parts:
            if not self.paths[s]:
                self.parts[s] = None
            else:
                raw = open_arrays(self.paths[s])
                self.parts[s] = raw | {(k, x): EliasFano(raw, f"{k}.{x}") for k in range(2, self.order + 1) for x in ("pointers", "words")}
        return self.parts[s]

    @staticmethod
    def step(part: dict, k: int, node: np.ndarray, word: np.ndarray):
        """Successors of nodes of level k-1: (place at level k, found)."""
        lo = part[k, "pointers"].get(node).astype(np.int64)
        hi = part[k, "pointers"].get(node + 1).astype(np.int64)
        lift = np.zeros(len(node), np.int64)
        some = np.flatnonzero((lo > 0) & (hi > lo))
        if len(some):
            lift[some] = part[k, "words"].get(lo[some] - 1).astype(np.int64) + 1
        at, same = part[k, "words"].find((word + lift).astype(np.uint64))
        return at, same & (at >= lo) & (at < hi)

    def _by_shard(self, shard: np.ndarray):
        """(part, first and end place) for each run of the sorted ``shard``; those below 0, and shards without a file, are left out."""
        cuts = np.searchsorted(shard, np.arange(len(self.paths) + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            if self.part(int(s)) is not None:
                yield int(s), self.part(int(s)), int(cuts[s]), int(cuts[s + 1])

    def pairs(self, a: np.ndarray, b: np.ndarray, shard: np.ndarray):
        """For pairs of word numbers, sorted by shard: the stored term (0 if none), what the
        first word leaves to lower orders, and the pair's node and what that leaves (-1 and 1 if none)."""
        term, left, node, after = np.zeros(len(a)), np.ones(len(a)), np.full(len(a), -1, np.int64), np.ones(len(a))
        offsets, hot = self.vocabulary.offsets, _place(self.hot, a)
        for s, part, lo, hi in self._by_shard(shard):
            at = np.where(hot[lo:hi] >= 0, offsets[s + 1] - offsets[s] + hot[lo:hi], a[lo:hi] - offsets[s])
            left[lo:hi] = part["2.left"][at]
            good = np.flatnonzero(b[lo:hi] >= 0)
            place, found = self.step(part, 2, at[good], b[lo:hi][good])
            rows, place = lo + good[found], place[found]
            term[rows], node[rows] = 10 ** (part["2.code"][place] * -STEP), place
            if self.order > 2:
                after[rows] = part["3.left"][place]
        return term, np.where(hot >= 0, self.hot_left[hot], left), node, after  # a hot word's terms are in all files

    def probabilities(self, numbers: np.ndarray, token: np.ndarray, at: np.ndarray, unigram: np.ndarray) -> np.ndarray:
        """P of every token given up to ``order - 1`` tokens before it in its text. ``token`` are places in
        ``numbers``. Distinct pairs are looked up once; they are the contexts that distinct triples go on from."""
        known = len(numbers)
        base = known + 1
        pairs, pair = np.unique(_before(token, at, 1, known) * base + token, return_inverse=True)
        a, b = np.append(numbers, self.vocabulary.size)[pairs // base], numbers[pairs % base]
        shard = np.where(a >= 0, _shard(self.vocabulary.offsets, self.hot, a, b), -1)
        turn = np.argsort(shard, kind="stable")
        a, b, shard = a[turn], b[turn], shard[turn]
        back = np.empty_like(turn)
        back[turn] = np.arange(len(turn))
        pair = back[pair]
        term, left, node, after = self.pairs(a, b, shard)
        p = term[pair] + left[pair] * unigram
        if self.order == 2:
            return p
        place = np.arange(len(token)) - np.repeat(at[:-1], np.diff(at))
        later = np.flatnonzero(place > 0)
        before = pair[later - 1]
        triples, back = np.unique(before * base + token[later], return_inverse=True)
        context, word = triples // base, numbers[triples % base]  # contexts ascend, and with them the shards
        term = np.zeros(len(triples))
        for _, part, lo, hi in self._by_shard(shard[context]):
            rows = lo + np.flatnonzero((node[context[lo:hi]] >= 0) & (word[lo:hi] >= 0))
            to, found = self.step(part, 3, node[context[rows]], word[rows])
            term[rows[found]] = 10 ** (part["3.code"][to[found]] * -STEP)
        p[later] = term[back] + after[before] * p[later]
        return p


class Model:
    """Paths and sizes of a fitted model; small enough to go with every task."""

    def __init__(self, words: list[str], sizes: list[int], tries: list[str], tokens: int, order: int, delta: float, hot: np.ndarray, hot_left: np.ndarray):
        self.words, self.sizes, self.tries, self.tokens, self.order, self.delta = words, sizes, tries, tokens, order, delta
        self.hot, self.hot_left = hot, hot_left  # hot words and the start, and what their stored terms leave

    def open(self) -> Trie:
        return Trie(self.tries, Vocabulary(self.words, self.sizes), self.order, self.hot, self.hot_left)


def fit(train: DataFrame, text_col: str = "text", order: int = ORDER, least: int = LEAST, discount: float = DISCOUNT, delta: float = DELTA) -> Model:
    """Count all texts of ``train`` and write the trie (order 2 or 3) to the shared
    folder. Null and empty texts are one end token; an empty table gives an empty model."""
    if order not in (2, 3):
        raise ValueError("order is 2 or 3")
    spark: SparkSession = train.sparkSession
    shards, root = width(spark), scratch(spark, "ngram")
    fs, at = filesystem(root)
    fs.create_dir(at, recursive=True)
    texts = train.select(F.col(text_col).alias("text"))

    def summed(blobs: DataFrame, write) -> dict[int, tuple]:
        made = _dealt(blobs, shards).mapInArrow(write, _MADE)
        return {r["shard"]: (r["path"], r["size"], r["total"], bytes(r["hot"])) for r in made.collect()}  # one row per shard
    words = summed(texts.mapInArrow(_count_words(shards), _BLOB), _write_words(root))
    paths, sizes = [words.get(s, ("", 0))[0] for s in range(shards)], [words.get(s, ("", 0))[1] for s in range(shards)]
    offsets, tokens, hot, ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64), sum(w[2] for w in words.values()), {}, 0
    for s, w in words.items():
        for place, n, end in np.frombuffer(w[3], np.int64).reshape(-1, 3).tolist():
            if end:
                ends = n
            elif n * HOT * shards >= tokens:
                hot[int(offsets[s]) + place] = n
    hot[int(offsets[-1])] = ends  # the start comes once for each end
    heads = np.array(sorted(hot), np.int64)
    counts = np.array([hot[h] for h in sorted(hot)], float)
    tries = summed(texts.mapInArrow(_count_ngrams(paths, sizes, order, heads), _BLOB), _write_trie(root, sizes, order, least, discount, heads, counts))
    spent = sum((np.frombuffer(t[3], float) for t in tries.values()), np.zeros(len(heads)))
    return Model(paths, sizes, [tries.get(s, ("",))[0] for s in range(shards)], tokens, order, delta, heads, np.clip(1 - spent, 1e-6, 1))


def lm_scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_tokens (words and one end), n_known
    (seen in training), base_score (additive unigram) and score, both log10 of the text's probability.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, held as 64-bit hashes. Null text
    counts as empty: one end token. Rows are scored one by one, so repeated rows and null
    ids need no rule. Other columns are not read; an empty table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        trie = model.open()
        scale = model.tokens + model.delta * (trie.vocabulary.size + 1)
        for batch in batches:
            for lo, hi, texts in text_slices(batch, 1, SCORED):
                numbers, counts, token, at = trie.vocabulary.distinct(texts)
                counts = counts[token]
                unigram = (counts + model.delta) / scale if scale else np.ones(len(counts))
                p = trie.probabilities(numbers, token, at, unigram)
                sums = [np.add.reduceat(x, at[:-1]) for x in (np.log10(unigram), np.log10(p), (counts > 0).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(at)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1])],
                                                 names=["id", "n_tokens", "n_known", "base_score", "score"])
    got = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    return got.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def held_out(ident: Column) -> Column:
    """Contract: rows whose crc32 of the id as text, modulo 10, is 0 are not learnt from; null ids are."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 10 == 0, F.lit(False))
