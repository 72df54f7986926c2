"""Near-duplicate documents: many universal hash minima with banding, signature
check, exact check on whole shingle sets, and components by alternating stars.

1. Every text gets 128 universal hash minima of its distinct word shingles and
   a 16-byte digest of its word sequence. Texts of equal word sequence form one
   class; only classes are compared.
2. 32 bands of 4 minima give buckets. In each bucket every member is paired
   with a hub (chosen by hash, eight different orders over the bands), so the
   pairs are linear in the buckets' rows whatever a bucket's size.
3. Pairs pass a check on the signatures, then an exact one on the full shingle
   sets. Links are joined into components.
4. Members of one bucket that are still in different components are compared in
   blocks of bounded size, on longer signatures made for them alone: two rounds (256 minima) with
   each member's best partner only, which join most of them, and a last one
   (1024 minima) with every pair that is left. What passes both checks adds links: so no
   linked pair that shares a bucket is lost. Two texts of similarity 0.8 share a bucket
   with probability 1 - (1 - 0.8^4)^32 = 1 - 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import lower_words, mix, shingle_hashes, shingle_set, stage, text_slices, width, word_hashes
from tierflow.llm.components import components

BANDS, ROWS, HUBS, BLOCK, SALTS = 32, 4, 8, 1024, 32
SHORT, MIDDLE, LONG = BANDS * ROWS, 256, 1024
_RNG = np.random.Generator(np.random.PCG64(7))
_A = _RNG.integers(1, 2**63, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 2**63, LONG, dtype=np.uint64)


def minima(shingles: np.ndarray, offsets: np.ndarray, places: int) -> np.ndarray:
    """(texts, ``places``) minima of the first multiply-shift hashes; texts without shingles get the largest value."""
    n = np.diff(offsets)
    out = np.full((len(n), places), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(n > 0)
    if len(some):
        starts = offsets[some]
        for k in range(places):
            out[some, k] = np.minimum.reduceat(((shingles * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(texts, 32) 64-bit bucket keys; the band is part of the key."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _A[0], parts.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key ^ (parts[:, :, r] * _A[r + 1] + _B[r]))
    return key.view(np.int64)


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, texts in text_slices(batch):
                words, offsets = word_hashes(texts)
                shingles, at = shingle_hashes(words, offsets, k)
                distinct = np.array([len(np.unique(shingles[a:b])) for a, b in zip(at[:-1], at[1:])], np.int64)
                sig = minima(shingles, at, SHORT)
                low = np.ascontiguousarray(sig.astype(np.uint8))
                cls = [hashlib.blake2b(b" ".join(t.as_py().encode().lower().split()), digest_size=16).digest() for t in texts]
                keys = band_keys(sig)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(cls, pa.binary()), pa.array(distinct), pa.array([r.tobytes() for r in low], pa.binary()), bands],
                    names=["id", "cls", "n_shingles", "sig", "bands"])
    return run


def _long_signed(k: int):
    """(cls, text) -> (cls, long signature)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls = batch.column("cls")
            for lo, hi, texts in text_slices(batch):
                sig = minima(*shingle_hashes(*word_hashes(texts), k), LONG).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([cls.slice(lo, hi - lo), pa.array([r.tobytes() for r in sig], pa.binary())], names=["cls", "sig"])
    return run


def _similar_signatures(least: int):
    """Keep pairs whose short signatures agree in at least ``least`` places."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SHORT) for c in ("su", "sv"))
                yield batch.filter(pa.array((a == b).sum(axis=1) >= least)).select(["u", "v"])
    return run


def _class_texts(batches):
    """(id, text) -> (cls, text)."""
    for batch in batches:
        texts = [(t or "") for t in batch.column("text").to_pylist()]
        cls = [hashlib.blake2b(b" ".join(lower_words(t)), digest_size=16).digest() for t in texts]
        yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), pa.array(texts, pa.string())], names=["cls", "text"])


def _exact(k: int, percent: int):
    """Rows sorted by (hub, salt, kind): the hub's text, then its partners'."""
    def run(batches):
        hub, own, last = None, set(), None
        for batch in batches:
            u, v, n, m = [], [], [], []
            for a, b, text in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), batch.column("text").to_pylist()):
                if b is None:
                    if a != hub:
                        hub, own, last = a, shingle_set(lower_words(text), k), None
                elif a == hub and b != last:
                    last, other = b, shingle_set(lower_words(text), k)
                    both = len(own & other)
                    union = len(own) + len(other) - both
                    if both and 100 * both >= percent * union:
                        u.append(a), v.append(b), n.append(both), m.append(union)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary()), pa.array(n, pa.int64()), pa.array(m, pa.int64())],
                                             names=["u", "v", "shared", "joint"])
    return run


def _rest_pairs(least: int, best: bool):
    """Rows sorted by unit (bucket, block, block): pairs of different components
    whose long signatures agree, each in the first band that the two share; with
    ``best`` only each member's best partner, by the first MIDDLE places and
    whatever the band (``bands`` is null). A unit has some thousand rows at most (BLOCK)."""
    def pairs(unit, rows):
        sig = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
        label = np.unique(np.array([r[1] for r in rows], dtype=object), return_inverse=True)[1]
        own = np.array([r[3] for r in rows])
        both = own.min() != own.max()
        found = set()
        bands = None if best else np.array([r[4] for r in rows], np.int64).reshape(-1, BANDS)
        band = 0 if best else int(np.flatnonzero(bands[0] == unit[0])[0])
        for i in range(len(rows)):
            after = 0 if best else i + 1
            may = label[after:] != label[i]
            if both:
                may &= own[after:] != own[i]
            may = np.flatnonzero(may) + after
            if len(may):
                agree = (sig[may] == sig[i]).sum(axis=1)
                near = may[agree >= least]
                if best and len(near):
                    near = may[[int(agree.argmax())]]
                elif band:
                    near = near[~(bands[near, :band] == bands[i, :band]).any(axis=1)]
                for j in near:
                    a, b = rows[i][0], rows[j][0]
                    found.add((a, b) if a < b else (b, a))
        return found

    def out(got):
        got = list(got)
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in got], pa.binary()) for k in (0, 1)], names=["u", "v"])

    def run(batches):
        unit, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("bk", "i", "j", "node", "label", "sig", "own", "bands")]
            for bk, i, j, *row in zip(*cols):
                if (bk, i, j) != unit:
                    if len(rows) > 1:
                        yield out(pairs(unit, rows))
                    unit, rows = (bk, i, j), []
                rows.append(row)
        if len(rows) > 1:
            yield out(pairs(unit, rows))
    return run


def _texts(wanted: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(cls, text) of the classes in ``wanted``, from each one's representative;
    a class comes more than once where rows repeat its id."""
    reps = wanted.join(classes.select("cls", "rep"), "cls").select(F.col("rep").alias("_rep")).distinct()
    rows = docs.join(reps, docs["id"].eqNullSafe(reps["_rep"]), "left_semi").select("id", "text")
    return rows.mapInArrow(_class_texts, "cls binary, text string")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """Links among ``pairs`` (u, v of classes), confirmed on the full texts.
    Only texts in a pair are shuffled; a hub's text goes to each of its salts
    once, so a hub with very many partners is dealt over many tasks."""
    spark = docs.sparkSession
    ends = pairs.select(F.col("u").alias("cls")).union(pairs.select(F.col("v").alias("cls"))).distinct()
    texts = stage(_texts(ends, classes, docs), f"{name}-texts")
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    hubs = (salted.select("u", "salt").distinct().join(texts.withColumnRenamed("cls", "u"), "u")
            .select("u", "salt", F.lit(None).cast("binary").alias("v"), "text"))
    rows = hubs.union(salted.join(texts.withColumnRenamed("cls", "v"), "v").select("u", "salt", "v", "text"))
    return stage(rows.repartition(width(spark), "u", "salt").sortWithinPartitions("u", "salt", F.col("v").asc_nulls_first())
                 .mapInArrow(_exact(k, percent), "u binary, v binary, shared long, joint long"), f"{name}-links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: (id_col, n_shingles, component_id, kept).

    ``n_shingles`` is the size of the row's set of distinct shingles (words
    ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer words than a shingle make
    one; none without words). Two rows are linked when 100 * |intersection| >=
    ``percent`` * |union|; ``component_id`` is the smallest id reachable.

    A null text is an empty one. Empty texts are linked with nothing: their
    component is their own id. Rows with a null id take part in the links, but
    a component's id is the smallest non-null one (null if it has none); a
    null id is kept only where its component has no other id. Repeated rows
    each return a row, so repeated ids are all kept or all dropped. Other columns of ``docs`` are not
    read. An empty table gives no rows.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    signed = stage(src.mapInArrow(_signed(shingle_words), f"id {kind}, cls binary, n_shingles long, sig binary, bands array<long>"), "signed")
    classes = stage(signed.filter("n_shingles > 0").groupBy("cls").agg(F.min("id").alias("rep"), F.min("sig").alias("sig"), F.min("bands").alias("bands")), "classes")

    rows = classes.select("cls", F.explode("bands").alias("bk"))
    hub = F.struct(F.xxhash64("cls", F.pmod("bk", F.lit(HUBS))).alias("h"), "cls")
    buckets = rows.groupBy("bk").agg(F.min(hub).alias("hub"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    members = stage(rows.join(buckets, "bk").select("bk", F.col("cls").alias("node"), F.col("hub.cls").alias("hub"), "m"), "members")

    def bound(places, sigmas):
        """Agreement below which a pair of the wanted similarity falls with a chance of about 1e-5."""
        return int(places * percent / 100 - sigmas * (places * percent / 100 * (1 - percent / 100)) ** 0.5)

    short = classes.select("cls", F.substring("sig", 1, SHORT).alias("sig"))
    pairs = members.filter("hub <> node").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()
    pairs = (pairs.join(short.select(F.col("cls").alias("v"), F.col("sig").alias("sv")), "v").join(short.select(F.col("cls").alias("u"), F.col("sig").alias("su")), "u")
             .select("u", "v", "su", "sv").mapInArrow(_similar_signatures(bound(SHORT, 4.5)), "u binary, v binary"))
    links = _verified(stage(pairs, "pairs"), classes, src, shingle_words, percent, "hub")
    label = components(links)

    long = None
    for best in (True, True, False):
        # members of one bucket that are in different components; buckets of two were compared above
        named = label.withColumnRenamed("u", "node").withColumnRenamed("v", "label")
        open_rows = members.filter("m > 2").join(named, "node", "left").withColumn("label", F.coalesce("label", "node"))
        split = (open_rows.groupBy("bk").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("left"))
                 .filter("lo <> hi").select("bk", F.ceil(F.col("left") / BLOCK).cast("int").alias("blocks")))
        if long is None:  # only these classes, and in later rounds a part of them, need long signatures
            wanted = stage(open_rows.join(split, "bk").select(F.col("node").alias("cls")).distinct(), "open")
            long = (_texts(wanted, classes, src).join(wanted, "cls", "left_semi").mapInArrow(_long_signed(shingle_words), "cls binary, sig binary")
                    .groupBy("cls").agg(F.min("sig").alias("sig")))
            long = stage(long.withColumnRenamed("cls", "node"), "long")
        # the best rounds need no more than a part of the signature, and no bands: a quarter of the bytes in the shuffle
        places = MIDDLE if best else LONG
        held = long.select("node", F.substring("sig", 1, places).alias("sig"))
        if best:
            held = held.withColumn("bands", F.lit(None).cast("array<long>"))
        else:
            held = held.join(classes.select(F.col("cls").alias("node"), "bands"), "node")
        rest = open_rows.join(split, "bk").join(held, "node")
        rest = rest.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rest = rest.select("bk", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label", "sig", "own", "bands")
        more = stage(rest.repartition(width(docs.sparkSession), "bk", "i", "j").sortWithinPartitions("bk", "i", "j")
                     .mapInArrow(_rest_pairs(bound(places, 4.2), best), "u binary, v binary").distinct(), "rest")
        if more.isEmpty():
            break
        more_links = _verified(more, classes, src, shingle_words, percent, "rest")
        if not more_links.isEmpty():
            label = components(label.union(more_links.select("u", "v")))

    of = (signed.select("id", "cls", "n_shingles").join(label.withColumnRenamed("u", "cls").withColumnRenamed("v", "label"), "cls", "left")
          .withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "cls"))))
    linked = label.select("u").union(label.select("v")).distinct().withColumnRenamed("u", "cls")
    first = (classes.join(linked, "cls").join(label.withColumnRenamed("u", "cls").withColumnRenamed("v", "label"), "cls", "left")
             .groupBy(F.coalesce("label", "cls").alias("label")).agg(F.min("rep").alias("first_linked")))
    got = (of.join(classes.select("cls", "rep"), "cls", "left").join(first, "label", "left")
           .withColumn("component_id", F.when(F.col("n_shingles") == 0, F.col("id")).otherwise(F.coalesce("first_linked", "rep"))))
    return got.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
