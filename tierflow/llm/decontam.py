"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so the similarity of whole sets is
tiny. Items are therefore partitioned by size (their distinct shingles) into powers of two,
and for each size class a document is cut into blocks of that many shingles: item and block
sets are then of like size, whatever the document's length. A block whose
minimum under one of 64 hash functions equals an item's makes the document a
candidate; the expected number of such hits for a contained item is at least
64 * 0.8 / 3 = 17, wherever in the document its shingles lie, so that the chance
of a miss is about e^-17. Blocks of clean documents share no shingle with an
item and can give no candidate. Minima say too little of a few shingles: items of at most
``LEAST_BLOCK`` are found by looking up all shingles of a document among so many of
theirs that a contained item shares one, and items shorter than a shingle by
looking up the document's word sequences of their length; neither can miss. Candidates are
verified by exact containment of the item's shingles (the words themselves) in the whole document.

The benchmark is the query set: it is cut into blocks of bounded rows and
bytes (``BLOCK_ITEMS``, ``BLOCK_BYTES``) and the documents are scanned once for each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import lower_words, mix, shingle_hashes, shingle_set, text_slices, word_hashes

HASHES = 64
LEAST_BLOCK = 8
BLOCK_ITEMS = 100_000
BLOCK_BYTES = 32 << 20
_RNG = np.random.Generator(np.random.PCG64(19))
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FILTER_BITS = 20


def _table(keys: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, the item of each, and a filter of their leading bits."""
    order = np.argsort(keys, kind="stable")
    seen = np.zeros(1 << _FILTER_BITS, bool)
    seen[(mix(keys) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return keys[order], own[order], seen


def _hits(values: np.ndarray, keys: np.ndarray, own: np.ndarray, seen: np.ndarray):
    """(place in ``values``, items) of the values that are among the keys of a :func:`_table`."""
    hits = np.flatnonzero(seen[(mix(values) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    if len(hits):
        lo = np.searchsorted(keys, values[hits], "left")
        hi = np.searchsorted(keys, values[hits], "right")
        for b, x, y in zip(hits, lo, hi):
            if y > x:
                yield b, own[x:y]


class Index:
    """One block of items: minima by size class, shingles of small items, and items shorter than a shingle by length."""

    def __init__(self, items: list[tuple], k: int, percent: int):
        self.k, self.percent = k, percent
        words = [lower_words(text) for _, text in items]
        self.items = [(ident, min(k, len(w)), shingle_set(w, k)) for (ident, _), w in zip(items, words)]
        self.by_class: dict[int, list] = {}
        hashes, offsets = word_hashes(pa.array([t or "" for _, t in items], pa.string()))
        found: dict[int, list] = {}  # length of the shingles looked up -> (item, shingle)
        minima: dict[int, list] = {}
        for length in range(1, k + 1):
            shingles, at = shingle_hashes(hashes, offsets, length)
            for i, (_, own, _) in enumerate(self.items):
                if own == length and words[i]:
                    distinct = np.unique(shingles[at[i]:at[i + 1]])
                    n = len(distinct)
                    if n <= LEAST_BLOCK:
                        least = max(1, -(-percent * n // 100))  # as many are shared, so one of these is
                        found.setdefault(length, []).extend((i, x) for x in distinct[:max(1, n - least + 1)])
                    else:
                        minima.setdefault(1 << math.ceil(math.log2(n)), []).append((i, (distinct[:, None] * _A).min(axis=0)))
        self.exact = {length: _table(np.array([x for _, x in rows], np.uint64), np.array([i for i, _ in rows])) for length, rows in found.items()}
        for size, rows in minima.items():
            own = np.array([i for i, _ in rows])
            values = np.stack([m for _, m in rows])
            self.by_class[size] = [_table(values[:, h], own) for h in range(HASHES)]

    def looked_up(self, shingles: np.ndarray, at: np.ndarray, length: int) -> set[tuple[int, int]]:
        """(row, item) pairs of items found by their shingles of ``length`` words."""
        found: set[tuple[int, int]] = set()
        for b, own in _hits(shingles, *self.exact[length]):
            r = int(np.searchsorted(at, b, "right")) - 1
            found.update((r, int(i)) for i in own)
        return found

    def candidates(self, shingles: np.ndarray, at: np.ndarray) -> set[tuple[int, int]]:
        """(row, item) pairs that share a minimum."""
        found: set[tuple[int, int]] = set()
        n = np.diff(at)
        if not len(shingles) or not self.by_class:
            return found
        sizes = sorted(self.by_class)
        fine = sizes[0]
        blocks = -(-n // fine)
        first = np.concatenate(([0], np.cumsum(blocks)))
        row = np.repeat(np.arange(len(n)), blocks)
        inside = np.arange(first[-1]) - first[row]
        starts = at[row] + inside * fine
        groups = {size: np.flatnonzero(inside % (size // fine) == 0) for size in sizes}
        for h in range(HASHES):
            least = np.minimum.reduceat(shingles * _A[h], starts)
            for size in sizes:
                heads = groups[size]
                mins = least if size == fine else np.minimum.reduceat(least, heads)
                for b, own in _hits(mins, *self.by_class[size][h]):
                    r = int(row[heads[b]])
                    found.update((r, int(i)) for i in own)
        return found

    def search(self, texts: pa.Array):
        """(row, item id, item size, shared) of every item contained in a row's text."""
        hashes, offsets = word_hashes(texts)
        shingles, at = shingle_hashes(hashes, offsets, self.k)
        pairs = self.candidates(shingles, at)
        for length in self.exact:
            pairs |= self.looked_up(*((shingles, at) if length == self.k else shingle_hashes(hashes, offsets, length)), length)
        rows: dict[int, list[int]] = {}
        for r, i in pairs:
            rows.setdefault(r, []).append(i)
        for r, items in rows.items():
            words = lower_words(texts[r].as_py())
            own = {length: shingle_set(words, length) for length in {self.items[i][1] for i in items}}
            for i in items:
                ident, length, wanted = self.items[i]
                shared = len(own[length] & wanted)
                if shared and 100 * shared >= self.percent * len(wanted):
                    yield r, ident, len(wanted), shared


def _blocks(bench: DataFrame) -> list[list[tuple]]:
    n, size = bench.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    cut = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for b in range(blocks):
        yield [tuple(r) for r in bench.filter(cut == b).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """Pairs (id_col, item_col, item_shingles, shared_shingles, containment) of
    every row and test item with 100 * shared >= ``percent`` * item_shingles, where
    an item's shingles are its distinct ``shingle_words``-word sequences (A-Z
    lower-cased; an item of fewer words is one shingle, found wherever a text
    has that word sequence).

    Null and empty texts, of rows or items, contain nothing and are contained in
    nothing. Items that repeat or share an id are each reported; repeated rows
    each give their pairs; null ids pass through. Other columns are not read. An
    empty table on either side gives no pairs.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    spark, kinds = docs.sparkSession, [src.schema["id"].dataType.simpleString(), bench.schema["item"].dataType.simpleString()]
    schema = f"id {kinds[0]}, item {kinds[1]}, item_shingles long, shared_shingles long"
    parts = []
    for items in _blocks(bench):
        held = spark.sparkContext.broadcast(items)  # at most BLOCK_ITEMS items and about BLOCK_BYTES bytes

        def run(batches, held=held):
            index = Index(held.value, shingle_words, percent)
            for batch in batches:
                for lo, _, texts in text_slices(batch):
                    got = list(index.search(texts))
                    if got:
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([lo + g[0] for g in got])), pa.array([g[1] for g in got], pa.int64()) if kinds[1] == "bigint" else pa.array([g[1] for g in got]),
                             pa.array([g[2] for g in got], pa.int64()), pa.array([g[3] for g in got], pa.int64())],
                            names=["id", "item", "item_shingles", "shared_shingles"])
        parts.append(src.mapInArrow(run, schema))
    got = parts[0]
    for p in parts[1:]:
        got = got.union(p)
    return got.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "item_shingles", "shared_shingles",
                      (F.col("shared_shingles") / F.col("item_shingles")).alias("containment"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, without the rows that contain a test item (as in
    :func:`contaminated`). Rows are judged one by one and nothing is shuffled."""
    bench = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    at = docs.columns.index(text_col)
    for items in _blocks(bench):
        held = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, held=held):
            index = Index(held.value, shingle_words, percent)
            for batch in batches:
                dirty = {lo + g[0] for lo, _, texts in text_slices(batch, at) for g in index.search(texts)}
                yield batch.filter(pa.array([i not in dirty for i in range(batch.num_rows)], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
