"""Phrases whose words occur together, counted in HAT-tries.

Each task counts the phrases that start at each word in burstable hash
containers under a shallow trie of word ids: a container holds all phrases of one first word, and
bursts into one for each second word when it grows. A phrase of four words also stands
for its first three; pairs are counted by themselves, so that no prefix
gathers all continuations of a frequent pair. When the tries exceed their budget the largest
subtrees are emptied as sorted runs, cut by prefix partition (a hash of the first three
words). Spark deals the runs; one prefix partition at a time is merged,
and only phrases that reach the least count leave it. Words, and then pairs of words, that
are rarer than that can't be part of one: they are counted first, and bits of a fixed number
tell which may be frequent. A false bit costs a few entries, never a result.

Inside a task words are numbered exactly, by their bytes. Between tasks a word is
named by 64 bits of a keyed digest; the vocabulary of the corpus is checked for two
words of one name, and counted anew under another key if there are any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import look_up, mix, raw_bytes, stage, text_slices, width

#: Phrases that a task's tries hold before their largest subtrees are spilled.
ENTRIES = 600_000
#: Phrases that a container holds before it bursts.
BURST = 8192
#: Words that a task numbers before it starts anew (numbers have 16 bits, 0 is none).
VOCABULARY = 65_535
#: Tokens that are counted in one step; with those that follow they never exceed the vocabulary.
TOKENS = 60_000
#: Prefix partitions for each shuffle partition.
BINS = 2
#: Bits (2 to this power) that mark the frequent words or pairs: at most 16 MB go to each task.
BITS = 27
#: Phrases (with repeats) that are combined by sorting before they go to the tries.
PENDING = 400_000
#: Bytes of text whose words are counted in one step.
WORD_STEP = 2 << 20
#: Words that a task remembers as rare.
RARE = 300_000
_SHIFTS = (48, 32, 16, 0)
_TERMS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

_GAP = np.zeros(256, bool)
_GAP[[0x20, 9]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts (A-Z as a-z) and the number of the piece that each lies in."""
    body, offsets = raw_bytes(texts)
    stop = _STOP[body]
    inside = ~(stop | _GAP[body])
    edge = np.zeros(len(body) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.concatenate((inside[1:], [False])) & ~edge[1:]
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    piece = np.cumsum(stop + edge[:-1])[starts]
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_LOWER[body[inside]])])
    return words, piece


def word_name(word: bytes, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8, key=seed.to_bytes(2, "little")).digest(), "little")


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    langs = batch.column("lang").dictionary_encode()
    codes = langs.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    cuts = np.flatnonzero(np.diff(codes[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield langs.dictionary[int(codes[rows[0]])].as_py(), batch.take(pa.array(rows))


# ------------------------------------------------------------------ single words

def _count_words(seed: int, budget: int):
    """(lang, text) -> (lang, name, word, n) for the words of some texts."""
    def out(counts):
        rows = [(lang, word_name(w, seed), w, n) for lang, words in counts.items() for w, n in words.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array(np.array([r[1] for r in rows], np.uint64).view(np.int64), pa.int64()),
                                           pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.int64())], names=["lang", "name", "word", "n"])

    def run(batches):
        counts, held = {}, 0
        for batch in batches:
            for lang, part in _by_lang(batch):
                own = counts.setdefault(lang, {})
                for _, _, texts in text_slices(part, "text", WORD_STEP):
                    got = pieces(texts)[0].value_counts()
                    for w, n in zip(got.field("values").to_pylist(), got.field("counts").to_pylist()):
                        if w in own:
                            own[w] += n
                        else:
                            own[w] = n
                            held += 1
                    if held > budget:
                        yield out(counts)
                        counts, held = {}, 0
                        own = counts.setdefault(lang, {})
        if held:
            yield out(counts)
    return run


# ------------------------------------------------------------------ tries

class HatTrie:
    """Counts of packed phrases (four numbers of 16 bits, 0 for none): first
    number -> hash container, or, once burst, second number -> hash container."""

    def __init__(self, burst: int = BURST):
        self.burst, self.top, self.size = burst, {}, {}

    def add(self, keys: np.ndarray, counts: np.ndarray) -> int:
        """Add distinct sorted phrases; returns how many are new."""
        if not len(keys):
            return 0
        first = keys >> np.uint64(48)
        cuts = [0, *(np.flatnonzero(np.diff(first)) + 1).tolist(), len(keys)]
        names, keys, counts, new = first[cuts[:-1]].tolist(), keys.tolist(), counts.tolist(), 0
        for name, lo, hi in zip(names, cuts[:-1], cuts[1:]):
            node = self.top.get(name)
            if node is None:
                self.top[name] = dict(zip(keys[lo:hi], counts[lo:hi]))
                grown = hi - lo
            elif isinstance(node, list):  # burst
                grown, children = 0, node[0]
                for key, n in zip(keys[lo:hi], counts[lo:hi]):
                    child = children.setdefault(key >> 32 & 0xFFFF, {})
                    have = child.get(key)
                    child[key] = n if have is None else have + n
                    grown += have is None
            else:
                before = len(node)
                for key, n in zip(keys[lo:hi], counts[lo:hi]):
                    node[key] = node.get(key, 0) + n
                grown = len(node) - before
                if len(node) > self.burst:
                    children = {}
                    for key, n in node.items():
                        children.setdefault(key >> 32 & 0xFFFF, {})[key] = n
                    self.top[name] = [children]
            self.size[name] = self.size.get(name, 0) + grown
            new += grown
        return new

    def cut(self, names: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Detach the subtrees of some first words: phrases and counts, unsorted."""
        parts = []
        for name in names:
            node = self.top.pop(name)
            del self.size[name]
            parts += node[0].values() if isinstance(node, list) else [node]
        total = sum(len(p) for p in parts)
        keys = np.fromiter((k for p in parts for k in p), np.uint64, total)
        return keys, np.fromiter((n for p in parts for n in p.values()), np.int64, total)


def pack(run: tuple[np.ndarray, list[np.ndarray], np.ndarray]) -> bytes:
    """A sorted run (names of its words in ascending order; four columns of ranks from 1, 0 for none; counts) as bytes."""
    names, columns, counts = run
    raw = b"".join([names.astype(np.uint64).tobytes(), *(c.astype(np.uint16).tobytes() for c in columns), counts.astype(np.int64).tobytes()])
    return np.array([len(names), len(counts)], np.int64).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    m, n = np.frombuffer(blob[:16], np.int64).tolist()
    raw = pa.decompress(blob[16:], decompressed_size=8 * m + 16 * n, codec="zstd", asbytes=True)
    at = 8 * m
    columns = [np.frombuffer(raw, np.uint16, n, at + 2 * n * i) for i in range(4)]
    return np.frombuffer(raw, np.uint64, m), columns, np.frombuffer(raw, np.int64, n, at + 8 * n)


def _runs(keys: np.ndarray, counts: np.ndarray, names: np.ndarray, bins: int) -> Iterator[tuple[int, bytes]]:
    """Phrases in a task's numbers -> (prefix partition, run sorted by the words' names)."""
    columns = [(keys >> np.uint64(s) & np.uint64(0xFFFF)).astype(np.int64) for s in _SHIFTS]
    dealt = mix(sum(names[c] * t for c, t in zip(columns, _TERMS))) % np.uint64(bins)
    rank = np.zeros(len(names), np.int64)
    rank[1:][np.argsort(names[1:])] = np.arange(1, len(names))
    inverse = np.sort(names[1:])  # the name of a rank
    columns = [rank[c] for c in columns]
    order = np.lexsort((*columns[::-1], dealt))
    for rows in np.split(order, np.flatnonzero(np.diff(dealt[order])) + 1):
        own = [c[rows] for c in columns]
        used = np.unique(np.concatenate(own))
        used = used[used > 0]
        yield int(dealt[rows[0]]), pack((inverse[used - 1], [np.where(c > 0, np.searchsorted(used, c) + 1, 0) for c in own], counts[rows]))


def _marked(bits: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = marks & np.uint64(64 * len(bits) - 1)
    return bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1) > 0


def _pair_marks(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * _TERMS[0] + second * _TERMS[1])


class _Numbers:
    """A task's numbers of frequent words, language by language; 0 for rare ones."""

    def __init__(self, seed: int, bits: np.ndarray):
        self.seed, self.bits = seed, bits
        self.clear()

    def clear(self) -> None:
        self.known, self.names, self.rare = {}, [0], 0

    def missing(self, lang: str, words: list[bytes]) -> list[bytes]:
        own = self.known.setdefault(lang, {})
        return [w for w in words if w not in own]

    def learn(self, lang: str, lang_mark: int, words: list[bytes]) -> None:
        if self.rare > RARE:
            self.known = {k: {w: n for w, n in own.items() if n} for k, own in self.known.items()}
            self.rare = 0
        own = self.known.setdefault(lang, {})
        names = [word_name(w, self.seed) for w in words]
        often = _marked(self.bits, np.array(names, np.uint64) ^ np.uint64(lang_mark))
        for word, name, yes in zip(words, names, often.tolist()):
            if yes:
                own[word] = len(self.names)
                self.names.append(name)
            else:
                own[word] = 0
                self.rare += 1


def _count_phrases(seed: int, bins: int, entries: int, frequent, pairs=None):
    """(lang, mark, text) -> (lang, bin, run). Without ``pairs`` (bits of the frequent
    ones) pairs are counted, with them phrases of three and four words."""
    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.string()), pa.array([r[1] for r in found], pa.int32()), pa.array([r[2] for r in found], pa.binary())],
                                          names=["lang", "bin", "run"])

    def keys(ids, where, n, lang_mark, table):
        """The longest phrase of frequent words from each of n tokens, packed; and whether it counts."""
        key, same = ids[:n] << np.uint64(48), ids[:n] > 0
        if pairs is None:
            same &= (where[1:n + 1] == where[:n]) & (ids[1:n + 1] > 0)
            return (key | ids[1:n + 1] << np.uint64(32))[same]
        linked = (where[1:] == where[:-1]) & (ids[:-1] > 0) & (ids[1:] > 0)
        names = table[ids.astype(np.int64)]
        at = np.flatnonzero(linked)
        linked[at] = _marked(pairs.value, _pair_marks(names[at], names[at + 1]) ^ np.uint64(lang_mark))
        counts = same
        for step in (1, 2, 3):
            same = same & linked[step - 1:step - 1 + n]
            key = key | np.where(same, ids[step:step + n], np.uint64(0)) << np.uint64(_SHIFTS[step])
            if step == 2:
                counts = same
        return key[counts]

    def run(batches):
        tries, held, numbers = {}, 0, _Numbers(seed, frequent.value)
        pending, waiting = {}, 0

        def settle():
            """Bring the pending phrases into the tries."""
            nonlocal held, waiting
            for lang, parts in pending.items():
                held += tries.setdefault(lang, HatTrie()).add(*np.unique(np.concatenate(parts), return_counts=True))
            pending.clear()
            waiting = 0

        def spill(all_of_it):
            """Empty the tries, or their largest subtrees down to half the budget."""
            nonlocal held
            found, table = [], np.array(numbers.names, np.uint64)
            if all_of_it:
                chosen = {lang: list(t.top) for lang, t in tries.items()}
            else:
                chosen, freed = {}, 0
                for size, lang, name in sorted(((s, lang, n) for lang, t in tries.items() for n, s in t.size.items()), reverse=True):
                    if freed >= entries // 2:
                        break
                    chosen.setdefault(lang, []).append(name)
                    freed += size
            for lang, some in chosen.items():
                got, counts = tries[lang].cut(some)
                held -= len(got)
                if len(got):
                    found += [(lang, b, blob) for b, blob in _runs(got, counts, table, bins)]
            return found

        for batch in batches:
            for lang, part in _by_lang(batch):
                mark = part.column("mark")[0].as_py() & (1 << 64) - 1
                for _, _, texts in text_slices(part, "text"):
                    words, piece = pieces(texts)
                    for lo in range(0, len(words), TOKENS):
                        hi = min(lo + TOKENS, len(words))
                        coded = words.slice(lo, min(hi + 3, len(words)) - lo).dictionary_encode()
                        known = coded.dictionary.to_pylist()
                        new = numbers.missing(lang, known)
                        if len(numbers.names) + len(new) > VOCABULARY:
                            settle()
                            if found := spill(True):
                                yield rows(found)
                            tries.clear()
                            numbers.clear()
                            new = known
                        numbers.learn(lang, mark, new)
                        own = numbers.known[lang]
                        number = np.array([own.get(w, 0) for w in known], np.uint64)
                        ids = np.concatenate((number[coded.indices.to_numpy(zero_copy_only=False)], np.zeros(3, np.uint64)))
                        where = np.concatenate((piece[lo:lo + len(coded)], np.full(3, -1)))
                        got = keys(ids, where, hi - lo, mark, np.array(numbers.names, np.uint64))
                        pending.setdefault(lang, []).append(got)
                        waiting += len(got)
                        if waiting > PENDING:
                            settle()
                        if held > entries:
                            yield rows(spill(False))
        settle()
        if found := spill(True):
            yield rows(found)
    return run


def _totals(key: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a sorted key changes, and the sums of the counts from there."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
    return starts, np.add.reduceat(counts, starts)


def _merged(runs: list[tuple], least: int | None):
    """Runs of one prefix partition as one. With ``least``: the phrases that reach
    it instead, as (names: n x 4, counts, sizes)."""
    names = np.unique(np.concatenate([r[0] for r in runs]))
    place = [np.concatenate(([0], np.searchsorted(names, r[0]) + 1)) for r in runs]
    columns = [np.concatenate([p[r[1][i]] for p, r in zip(place, runs)]) for i in range(4)]
    counts = np.concatenate([r[2] for r in runs])
    order = np.lexsort(columns[::-1])
    table, counts = np.stack([c[order] for c in columns], axis=1), counts[order]
    starts, sums = _totals(table, counts)
    table = table[starts]
    if least is None:
        return names, [table[:, i] for i in range(4)], sums
    wide = np.concatenate((np.zeros(1, np.uint64), names))
    four, two = table[:, 3] > 0, table[:, 2] == 0
    longer = np.flatnonzero(~two)
    at, three = _totals(table[longer, :3], sums[longer])
    prefix = np.concatenate((table[longer[at], :3], np.zeros((len(at), 1), np.int64)), axis=1)
    found = [(table[four], sums[four], 4), (prefix, three, 3), (table[two], sums[two], 2)]
    keep = [(t[s >= least], s[s >= least], n) for t, s, n in found]
    return wide[np.concatenate([t for t, _, _ in keep])], np.concatenate([s for _, s, _ in keep]), np.repeat([n for *_, n in keep], [len(s) for _, s, _ in keep])


def _merge(least: int, entries: int):
    """Rows sorted by (lang, bin) -> (lang, size, w1, w2, w3, w4, f): phrases of two to
    four words that occur ``least`` times or more. Runs are merged whenever they exceed ``entries``."""
    def out(lang, runs):
        words, sums, sizes = _merged(runs, least)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(sums), pa.string()), pa.array(sizes, pa.int32()),
                                           *(pa.array(np.ascontiguousarray(words[:, i]).view(np.int64), pa.int64()) for i in range(4)), pa.array(sums, pa.int64())],
                                          names=["lang", "size", "w1", "w2", "w3", "w4", "f"])

    def run(batches):
        now, runs, held, limit = None, [], 0, entries
        for batch in batches:
            for lang, place, blob in zip(*(batch.column(c).to_pylist() for c in ("lang", "bin", "run"))):
                if (lang, place) != now:
                    if runs:
                        yield out(now[0], runs)
                    now, runs, held, limit = (lang, place), [], 0, entries
                runs.append(unpack(blob))
                held += len(runs[-1][2])
                if held > limit:
                    runs = [_merged(runs, None)]
                    held = len(runs[0][2])
                    limit = max(entries, 2 * held)
        if runs:
            yield out(now[0], runs)
    return run


# ------------------------------------------------------------------ tables

WORDS = ["w1", "w2", "w3", "w4"]


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", budget: int = 200_000) -> tuple[DataFrame, int]:
    """(lang, name, word, f) of all words, and the key under which no two words share a name."""
    src = _texts(docs, lang_col, text_col)
    for seed in range(16):
        counted = src.mapInArrow(_count_words(seed, budget), "lang string, name long, word binary, n long")
        words = stage(counted.groupBy("lang", "name", "word").agg(F.sum("n").alias("f")), "words")
        if words.groupBy("name").agg(F.min("word").alias("a"), F.max("word").alias("b")).filter("a <> b").isEmpty():
            return words, seed
    raise RuntimeError("every key gives two words one name")


def _bits(spark: SparkSession, marks: DataFrame):
    """The broadcast bits of ``marks`` (mark: long): at most 2^(BITS - 6) rows come to the driver."""
    at = F.col("mark").bitwiseAND(F.lit((1 << BITS) - 1))
    rows = marks.select(F.shiftright(at, 6).alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    found = rows.groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    bits = np.zeros(1 << BITS - 6, np.uint64)
    bits[found.column("at").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bits)


def _pair_bits_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, second, lang = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("w1", "w2", "lang_mark"))
        yield pa.RecordBatch.from_arrays([pa.array((_pair_marks(first, second) ^ lang).view(np.int64))], names=["mark"])


def phrase_counts(docs: DataFrame, words: DataFrame, seed: int, least: int, lang_col: str = "lang", text_col: str = "text", entries: int = ENTRIES) -> DataFrame:
    """(lang, size, w1, w2, w3, w4, f): phrases of two to four words inside pieces
    that occur ``least`` times or more; words by name, 0 for none. ``words``: see ``word_counts``."""
    spark = docs.sparkSession
    parts = width(spark)
    mark = F.xxhash64("lang")
    src = _texts(docs, lang_col, text_col).select("lang", mark.alias("mark"), "text")

    def counted(frequent, pairs):
        runs = src.mapInArrow(_count_phrases(seed, parts * BINS, entries, frequent, pairs), "lang string, bin int, run binary")
        dealt = runs.repartition(parts, "lang", "bin").sortWithinPartitions("lang", "bin")
        return stage(dealt.mapInArrow(_merge(least, entries), "lang string, size int, w1 long, w2 long, w3 long, w4 long, f long"), "phrases")

    often = words.filter(F.col("f") >= least)
    frequent = _bits(spark, often.select(F.col("name").bitwiseXOR(mark).alias("mark")))
    two = counted(frequent, None)
    longer = counted(frequent, _bits(spark, two.select("w1", "w2", mark.alias("lang_mark")).mapInArrow(_pair_bits_rows, "mark long")))
    return two.unionByName(longer)


def _part(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` (from 1) of a phrase as a phrase."""
    own = [F.col(f"w{i}") for i in range(first, last + 1)]
    return F.struct(F.lit(last - first + 1).alias("size"), *(c.alias(w) for c, w in zip([*own, *[F.lit(0).cast("long")] * (4 - len(own))], WORDS)))


def _by_size(arrays: dict[int, list[Column]]) -> Column:
    """The array for a phrase of the size that a row has."""
    found = None
    for size, items in arrays.items():
        found = F.when(F.col("size") == size, F.array(*items)) if found is None else found.when(F.col("size") == size, F.array(*items))
    return found


def _scored(phrases: DataFrame, table: DataFrame) -> DataFrame:
    """``phrases`` with l, r and score of their lowest-scoring cut, the smallest of equals."""
    key = ["lang", "size", *WORDS]
    cuts = {n: [F.struct(F.lit(f"{side}{k}").alias("side"), part.alias("part")) for k in range(1, n)
                for side, part in (("l", _part(1, k)), ("r", _part(k + 1, n)))] for n in (2, 3, 4)}
    wanted = phrases.select(*key, "f", F.explode(_by_size(cuts)).alias("cut"))
    wanted = stage(wanted.select("lang", F.col("size").alias("of"), *(F.col(w).alias(f"p{w}") for w in WORDS), F.col("f").alias("a"), "cut.side", "cut.part.*"), "parts")
    asked = wanted.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).join(table, key)
    got = look_up(wanted, asked, key, "n", wanted.count())
    sides = [f"{side}{k}" for k in (1, 2, 3) for side in "lr"]
    wide = got.groupBy("lang", F.col("of").alias("size"), *(F.col(f"p{w}").alias(w) for w in WORDS), "a").agg(
        *(F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in sides))
    counts = {k: (F.col(f"l{k}"), F.col(f"r{k}")) for k in (1, 2, 3)}
    scores = [F.when(left.isNotNull(), F.struct(F.expr(f"cast(cast(2000000 as decimal(8, 0)) * cast(a as decimal(20, 0)) div (cast(l{k} as decimal(20, 0)) + r{k}) as bigint)").alias("score"),
                                                F.lit(k).alias("k"), left.alias("l"), right.alias("r"))) for k, (left, right) in counts.items()]
    return wide.withColumn("cut", F.array_min(F.filter(F.array(*scores), lambda c: c.isNotNull()))).select(*key, "a", "cut.l", "cut.r", "cut.score")


def _uncovered(phrases: DataFrame) -> DataFrame:
    """Phrases that no longer one with 80 % of their count contains."""
    key = ["lang", "size", *WORDS]
    inner = {3: [_part(1, 2), _part(2, 3)], 4: [_part(1, 3), _part(2, 4), _part(1, 2), _part(2, 3), _part(3, 4)]}
    held = phrases.filter("size > 2").select("lang", "f", F.explode(_by_size(inner)).alias("part")).select("lang", "part.*", "f")
    most = held.groupBy(*key).agg(F.max("f").alias("longer"))
    covered = F.expr("cast(100 as decimal(3, 0)) * cast(longer as decimal(20, 0)) >= cast(80 as decimal(3, 0)) * cast(f as decimal(20, 0))")
    return phrases.join(most, key, "left").filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def _spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with phrase: its words' texts, joined by spaces."""
    key = ["lang", "size", *WORDS]
    placed = found.select(*key, F.posexplode(F.slice(F.array(*WORDS), 1, F.col("size"))).alias("place", "name"))
    asked = placed.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    texts = asked.join(words.select("name", "word").distinct(), "name")
    spelt = look_up(placed, texts, ["name"], "n", placed.count()).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("texts"))
    return found.join(spelt, key).withColumn("phrase", F.array_join(F.transform("texts", lambda t: t["word"].cast("string")), " ")).drop("texts")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, lang_col: str = "lang", text_col: str = "text", entries: int = ENTRIES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to four
    words that occur ``least`` times or more, by score, then a (descending), then phrase.

    Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these at spaces and tabs into words;
    phrases lie inside a piece. a, l, r: how often the phrase and the two parts
    of its lowest-scoring cut occur; n: all words of the language; score: floor(2000000 a / (l + r)). A
    phrase inside a longer one of 80 % of its count or more is left out. A null language is ``und``; null and
    empty texts have no words. Repeated rows count each time. Other columns are
    not read; an empty table gives no rows.
    """
    key = ["lang", "size", *WORDS]
    words, seed = word_counts(docs, lang_col, text_col)
    phrases = phrase_counts(docs, words, seed, least, lang_col, text_col, entries)
    none = F.lit(0).cast("long")
    single = words.filter(F.col("f") >= least).select("lang", F.lit(1).alias("size"), F.col("name").alias("w1"), none.alias("w2"), none.alias("w3"), none.alias("w4"), "f")
    scored = _scored(_uncovered(phrases), phrases.unionByName(single))
    by = Window.partitionBy("lang")
    best = [F.col("score").desc(), F.col("a").desc()]
    near = stage(scored.withColumn("_rank", F.rank().over(by.orderBy(*best))).filter(F.col("_rank") <= top).drop("_rank"), "ranked")
    ranked = _spelled(near, words).withColumn("rank", F.row_number().over(by.orderBy(*best, F.col("phrase").asc()))).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
    g AS (SELECT lang, ws[i:i + k - 1] AS ph, count(*) AS f FROM w, unnest(range(1, len(ws) + 1)) AS t(i), range(1, 5) AS s(k)
      WHERE i + k - 1 <= len(ws) GROUP BY ALL),
    c AS (SELECT lang, ph, f FROM g WHERE len(ph) > 1 AND f >= 30),
    cuts AS (SELECT c.lang, c.ph, c.f, k, a.f AS l, b.f AS r, 2000000::HUGEINT * c.f // (a.f + b.f) AS s FROM c, unnest(range(1, len(c.ph))) AS t(k)
      JOIN g a ON a.lang = c.lang AND a.ph = c.ph[1:k] JOIN g b ON b.lang = c.lang AND b.ph = c.ph[k + 1:len(c.ph)]),
    low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY s, k) = 1),
    held AS (SELECT lang, ph[i:i + k - 1] AS ph, max(f) AS longer FROM c, unnest(range(2, len(ph))) AS t(k), range(1, 4) AS s(i) WHERE i + k - 1 <= len(ph) GROUP BY ALL),
    free AS (SELECT low.*, array_to_string(low.ph, ' ') AS phrase FROM low LEFT JOIN held USING (lang, ph) WHERE held.longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * f),
    best AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s DESC, f DESC, phrase) AS rank FROM free)
    SELECT lang, rank, phrase, best.f AS a, l, r, n, s::BIGINT AS score FROM best
      JOIN (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE len(ph) = 1 GROUP BY lang) USING (lang) WHERE rank <= 2000"""
