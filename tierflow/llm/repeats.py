"""Passages that repeat across documents, by level-wise doubling.

Windows of half the wanted length come first, thinned: of the half windows that
lie in one whole window only the one of the smallest hash counts (its anchor).
Equal passages choose equal anchors, so nothing is lost, and about one word in
13 starts one. Anchors that occur in documents of different ids survive; those
alone are extended to the wanted length, the survivors to twice that, and so on
until no candidate survives; each further length takes half of the anchors (by a bit of their
hash), as its windows cover twice as much. A window that also starts in a document of a smaller id
settles all words it covers, at whatever level. What the levels leave open (the
first document of a passage, and the rims of copies) is then compared window by
window. So the rows grow with the distinct repeated text, not with its copies.

Hashes of half windows have 64 bits and only choose candidates; all others have
128 bits, over 64-bit hashes of the words.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import mix, stage, text_slices, word_hashes

_RNG = np.random.Generator(np.random.PCG64(77120251))
#: Two odd bases of the window hashes, and their inverses.
_BASES = [int(_RNG.integers(1, 2**62)) * 8 + 5 for _ in range(2)]
_UP: list[np.ndarray] = []
_DOWN: list[np.ndarray] = []
_LAST = np.uint64(2**64 - 1)


def _powers(n: int) -> None:
    if not _UP or len(_UP[0]) < n:
        size = max(n, 1 << 17)
        for table, bases in ((_UP, _BASES), (_DOWN, [pow(b, -1, 2**64) for b in _BASES])):
            table.clear()
            for base in bases:
                p = np.full(size, base, np.uint64)
                p[0] = 1
                table.append(np.cumprod(p, dtype=np.uint64))


class Windows:
    """Hashes of any windows of the words of some texts."""

    def __init__(self, texts: pa.Array):
        self.words, self.at = word_hashes(texts, fold=False)
        n = len(self.words)
        _powers(n + 1)
        self.sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.words * up[:n], dtype=np.uint64))) for up in _UP]
        self.end = np.repeat(self.at[1:], np.diff(self.at))  # the end of each word's text

    def hashes(self, start: np.ndarray, length: int, which: int) -> np.ndarray:
        total = self.sums[which]
        return mix((total[start + length] - total[start]) * _DOWN[which][start] + np.uint64(length))

    def anchors(self, half: int, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each word: the hash of the half window there, and the smallest
        one of the whole window there (the last value where no window fits);
        and the words that start an anchor."""
        n = len(self.words)
        g = np.full(n, _LAST, np.uint64)
        fits = np.flatnonzero(np.arange(n) + half <= self.end)
        g[fits] = np.minimum(self.hashes(fits, half, 0), _LAST - np.uint64(1))
        least = _slide(g, whole - half + 1, np.minimum, _LAST)
        inside = np.arange(n) + whole <= self.end
        least[~inside] = _LAST
        most = _slide(np.where(inside, least, np.uint64(0))[::-1], whole - half + 1, np.maximum, np.uint64(0))[::-1]
        # an anchor is the smallest of some window that covers it: no window there has a larger smallest hash
        return g, least, np.flatnonzero((g != _LAST) & (most == g))


def _slide(x: np.ndarray, width: int, best, pad) -> np.ndarray:
    """The best of x[i : i + width] for each i, in log2(width) steps."""
    have, out = 1, x.copy()
    while have < width:
        step = min(have, width - have)
        out = best(out, np.concatenate((out[step:], np.full(min(step, len(out)), pad, x.dtype)))[:len(out)])
        have += step
    return out


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _take(batch: pa.RecordBatch, rows: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    at = pa.array(rows)
    return pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("doc", "key")), *columns.values()], names=["doc", "key", *columns])


def _anchor_rows(half: int, whole: int):
    """(doc, key, text) -> a row for each anchor: its place and its hash."""
    def run(batches):
        for batch in batches:
            for lo, _, texts in text_slices(batch, "text"):
                w = Windows(texts)
                g, _, anchors = w.anchors(half, whole)
                doc = np.searchsorted(w.at, anchors, side="right") - 1
                yield _take(batch, lo + doc, {"place": pa.array(anchors - w.at[doc], pa.int64()), "name": _long(g[anchors])})
    return run


def _level_rows(half: int, whole: int):
    """(doc, key, text, spans) -> a row for each anchor in spans: its place, and pairs of
    hashes of the windows of one, two, four ... times ``whole`` that start there; as
    many as fit the text and its hash has low zero bits, and one."""
    def run(batches):
        for batch in batches:
            spans = batch.column("spans")
            for lo, hi, texts in text_slices(batch, "text"):
                w = Windows(texts)
                places = [np.asarray(spans[row].values.field("place"), np.int64) for row in range(lo, hi)]
                anchors = np.concatenate([a + p for a, p in zip(w.at, places)])
                doc = np.repeat(np.arange(hi - lo), [len(p) for p in places])
                room, left = w.end[anchors] - anchors, w.hashes(anchors, half, 0)
                names, levels, length, level = [], np.zeros(len(anchors), np.int64), whole, 0
                while len(fit := np.flatnonzero((room >= length) & (left & np.uint64((1 << level) - 1) == 0) & (levels == level))):
                    names.append([w.hashes(anchors[fit], length, which) for which in (0, 1)])
                    levels[fit] += 1
                    length, level = 2 * length, level + 1
                offsets = np.concatenate(([0], np.cumsum(2 * levels)))
                flat = np.zeros(offsets[-1], np.uint64)
                for level, pair in enumerate(names):
                    fit = np.flatnonzero(levels > level)
                    for which in (0, 1):
                        flat[offsets[fit] + 2 * level + which] = pair[which]
                yield _take(batch, lo + doc, {"place": pa.array(anchors - w.at[doc], pa.int64()), "names": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), _long(flat))})
    return run


def _covered(n: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, np.minimum(starts + lengths, n), -1)
    return np.cumsum(depth[:-1]) > 0


def _open_rows(half: int, whole: int):
    """(doc, key, text, spans) -> a row for each whole window whose anchor
    repeats and that no longer span has settled: its place and its two hashes."""
    def run(batches):
        for batch in batches:
            spans = batch.column("spans")
            for lo, hi, texts in text_slices(batch, "text"):
                w = Windows(texts)
                g, least, _ = w.anchors(half, whole)
                found, docs = [], []
                for row in range(lo, hi):
                    a, b = w.at[row - lo], w.at[row - lo + 1]
                    if b - a < whole or not spans[row].is_valid:
                        continue
                    at, length = (np.asarray(f, np.int64) for f in spans[row].values.flatten())
                    wanted = np.isin(least[a:b - whole + 1], g[a + at])
                    settled = length > 0
                    if settled.any():  # windows inside one span; those that reach over its end stay open
                        wanted &= ~_covered(b - a - whole + 1, at[settled], length[settled] - whole + 1)
                    places = np.flatnonzero(wanted) + a
                    found.append(places)
                    docs.append(np.full(len(places), row))
                if not found:
                    continue
                places, doc = np.concatenate(found), np.concatenate(docs)
                yield _take(batch, doc, {"place": pa.array(places - w.at[doc - lo], pa.int64()), "name1": _long(w.hashes(places, whole, 0)),
                                         "name2": _long(w.hashes(places, whole, 1))})
    return run


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) -> (id, n_words, n_removed, kept_text, removed)."""
    for batch in batches:
        out = {"n_words": [], "n_removed": [], "kept_text": [], "removed": []}
        spans = batch.column("spans")
        for row, text in enumerate(batch.column("text")):
            words = (text.as_py() or b"").split()
            gone = []
            kept = words
            if spans[row].is_valid and len(words):
                starts, lengths = (np.asarray(f, np.int64) for f in spans[row].values.flatten())
                dead = _covered(len(words), starts, lengths)
                kept = list(itertools.compress(words, ~dead))
                edges = np.flatnonzero(np.diff(np.concatenate(([False], dead, [False])).astype(np.int8)))
                gone = [{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2])]
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_text"].append(b" ".join(kept))
            out["removed"].append(gone)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_text"], pa.binary()),
             pa.array(out["removed"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["id", "n_words", "n_removed", "kept_text", "removed"])


#: Buckets of window names in which hot names are looked for.
BUCKETS = 1 << 16


def _repeated(rows: DataFrame, names: list[str], share: int = 1000) -> DataFrame:
    """``rows`` (doc, key, place, names, ...) whose names occur in documents of different ids,
    with first: the smallest of these. Rows are dealt by name. Names that one in ``share`` of all rows
    or more have (at most ``share``; looked for in the buckets as full as that) are
    aggregated first, their rows spread over all tasks."""
    total, bucket = rows.count(), F.pmod(F.col(names[0]), F.lit(BUCKETS))
    many = F.col("n") * share >= F.lit(max(total, 1))
    full = [r[0] for r in rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("n")).filter(many).drop("n").collect()]
    if not full:
        rows = rows.withColumns({"hot_first": F.lit(None).cast(rows.schema["doc"].dataType), "hot_last": F.lit(None).cast(rows.schema["doc"].dataType)})
    else:
        hot = (rows.filter(bucket.isin(full)).groupBy(*names).agg(F.min("doc").alias("hot_first"), F.max("doc").alias("hot_last"), F.count(F.lit(1)).alias("n"))
               .filter(many).drop("n"))
        rows = rows.join(F.broadcast(hot), names, "left")
    spread = F.when(F.col("hot_first").isNotNull(), F.pmod(F.xxhash64("doc", "key", "place"), F.lit(BUCKETS))).otherwise(-1)
    by = Window.partitionBy(*names, "spread")
    met = rows.withColumn("spread", spread).withColumns({"first": F.min("doc").over(by), "last": F.max("doc").over(by)})
    return (met.withColumns({"first": F.coalesce("hot_first", "first"), "last": F.coalesce("hot_last", "last")})
            .filter("first < last").drop("last", "hot_first", "hot_last", "spread"))


def repeated_spans(docs: DataFrame, hot: DataFrame, words: int = 50) -> DataFrame:
    """``docs`` (doc, key, text: binary), where id and key stand for a row -> (doc, key, spans):
    the spans (place, length) of ``words`` words or more whose word sequences also start
    in a row of a smaller id. Rows without spans have none. ``hot``: see ``_copied``."""
    half = (words + 1) // 2
    src = docs.filter("doc is not null")
    kind = src.schema["doc"].dataType.simpleString()
    row = ["doc", "key"]
    pairs = ["name1", "name2"]

    def span(length):
        return F.struct("place", F.lit(length).cast("long").alias("length"))

    anchors = stage(src.mapInArrow(_anchor_rows(half, words), f"doc {kind}, key long, place long, name long"), "anchors")
    found = stage(_repeated(anchors, ["name"]).groupBy(*row).agg(F.collect_set(span(0)).alias("spans")), "repeated")
    alive = stage(_with_spans(src, found, hot, "inner").mapInArrow(_level_rows(half, words), f"doc {kind}, key long, place long, names array<long>"), "level")
    parts, length = [found.select(*row, F.explode("spans").alias("span"))], words
    while True:
        named = alive.filter(F.size("names") > 0).select(*row, "place", F.get("names", F.lit(0)).alias("name1"), F.get("names", F.lit(1)).alias("name2"),
                                                         F.slice("names", 3, 1 << 20).alias("names"))
        alive = stage(_repeated(named, pairs).drop(*pairs), "level")
        if alive.isEmpty():
            break
        parts.append(alive.filter("first < doc").select(*row, span(length).alias("span")))
        alive, length = alive.drop("first"), 2 * length
    spans = parts[0]
    for more in parts[1:]:
        spans = spans.union(more)
    settled = stage(spans.groupBy(*row).agg(F.collect_set("span").alias("spans")), "settled")
    rest = stage(_with_spans(src, settled, hot, "inner").mapInArrow(_open_rows(half, words), f"doc {kind}, key long, place long, name1 long, name2 long"), "open")
    owned = _repeated(rest, pairs).filter("first < doc")
    longer = settled.select(*row, F.explode(F.filter("spans", lambda s: s["length"] > 0)).alias("span"))
    return stage(longer.union(owned.select(*row, span(words).alias("span"))).groupBy(*row).agg(F.collect_set("span").alias("spans")), "spans")


#: Parts that rows of one document that repeats very often are dealt to.
SALTS = 64


def _copied(docs: DataFrame) -> DataFrame:
    """Keys of rows that occur very often, id and text alike; broadcast below a checked number."""
    copies = stage(docs.groupBy("doc", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SALTS).select("doc", "key"), "copied")
    return F.broadcast(copies) if copies.count() <= 10_000 else copies


def _with_spans(docs: DataFrame, spans: DataFrame, hot: DataFrame, how: str) -> DataFrame:
    """Documents joined with their spans. A row that occurs very often is one
    key; its copies are dealt to parts, each with the spans."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    marked = hot.withColumn("hot", F.lit(True))
    left = docs.join(marked, ["doc", "key"], "left").withColumn("salt", F.when(F.col("hot"), salt).otherwise(0)).drop("hot")
    right = spans.join(marked, ["doc", "key"], "left")
    right = right.withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot")
    return left.join(right, ["doc", "key", "salt"], how).drop("salt")


def drop_repeats(docs: DataFrame, words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id_col, n_words, n_removed, kept_text (the words that
    stay, joined by one space), removed (word spans, end exclusive).

    A word goes when a window of ``words`` consecutive words over it also starts
    in a row of a smaller id; windows are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.
    A null text has no words; texts shorter than ``words`` lose none. Rows
    without an id neither lose words nor make others lose them; rows of one id don't
    make each other lose words. Repeats inside one document stay. Other columns are not read;
    an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    src = docs.select(F.col(id_col).alias("doc"), text.alias("text"))
    loose = F.monotonically_increasing_id()  # rows without an id match nothing and spread
    src = src.select("doc", F.when(F.col("doc").isNull(), loose).otherwise(F.xxhash64("text")).alias("key"), "text")
    kind = src.schema["doc"].dataType.simpleString()
    hot = _copied(src)
    cut = _with_spans(src, repeated_spans(src, hot, words), hot, "left").select(F.col("doc").alias("id"), "text", "spans").mapInArrow(
        _without, f"id {kind}, n_words long, n_removed long, kept_text binary, removed array<struct<start:long,end:long>>")
    return cut.select(F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept_text").cast("string").alias("kept_text"), "removed")


ORACLE = r"""WITH d AS (
      SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
    w AS (SELECT row, doc_id, p, sha256(array_to_string(words[p:p + 49], ' ')) AS name FROM d, unnest(range(1, len(words) - 48)) AS t(p)),
    f AS (SELECT row, p FROM (SELECT row, doc_id, p, min(doc_id) OVER (PARTITION BY name) AS first FROM w) WHERE first < doc_id),
    g AS (SELECT DISTINCT row, q FROM f, unnest(range(p, p + 50)) AS t(q)),
    k AS (SELECT row, list(q) AS gone FROM g GROUP BY row),
    s AS (SELECT doc_id, words, CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM d LEFT JOIN k USING (row))
    SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - len(kept))::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM s"""
