"""Each operator against a brute-force version on a small table with nulls,
empty and long texts, repeated rows and columns whose names clash."""

import base64
import collections
import hashlib
import io
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierflow.llm import common, components, decontam, exactdup, mixing, neardup, ngram_lm, pii, registry, sharding, tokencount, toxicity, warc


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_vectorised_words_and_shingles(doc_rows):
    texts = [r[1] or "" for r in doc_rows]
    hashes, at = common.word_hashes(pa.array(texts))
    assert [b - a for a, b in zip(at[:-1], at[1:])] == [len(words(t)) for t in texts]
    seen = {}
    for h, w in zip(hashes, [w for t in texts for w in words(t)]):
        assert seen.setdefault(int(h), w) == w
    assert len(seen) == len({w for t in texts for w in words(t)})
    got, off = common.shingle_hashes(hashes, at, 4)
    assert [len(set(got[a:b])) for a, b in zip(off[:-1], off[1:])] == [len(shingles(t, 4)) for t in texts]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (100, 95), (7, 7), (None, 3)] + [(200, 200 + i) for i in range(1, 30)]
    got = {r.u: r.v for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90, **{200 + i: 200 for i in range(1, 30)}}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, no_docs, doc_rows, k):
    sets = [shingles(r[1], k) for r in doc_rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    want = collections.Counter()
    for i, r in enumerate(doc_rows):
        ids = [doc_rows[j][0] for j in range(len(sets)) if root(j) == root(i) and doc_rows[j][0] is not None]
        comp = (min(ids) if ids else None) if sets[i] else r[0]
        want[(r[0], len(sets[i]), comp, r[0] == comp)] += 1
    got = collections.Counter(tuple(r) for r in neardup.near_duplicates(docs, shingle_words=k).collect())
    assert got == want
    assert neardup.near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_a_large_family(spark, monkeypatch):
    """One text with many variants: pairs stay linear and buckets beyond a block are still compared."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        w = list(base)
        for p in rng.choice(80, int(rng.integers(0, 7)), replace=False):
            w[p] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(w)))
    sets = [shingles(t, 5) for _, t in rows]
    label = list(range(90))
    for _ in range(90):
        new = [min(label[j] for j in range(90) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for i in range(90)]
        if new == label:
            break
        label = new
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(label))


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("budget", [64 << 20, 2000])
def test_exact_duplicates(docs, no_docs, doc_rows, keep, budget):
    groups = collections.defaultdict(list)
    for r in doc_rows:
        groups[r[1] or ""].append(r[0])
    got = exactdup.exact_duplicates(docs, keep=keep, budget=budget).collect()
    want = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max(known) if keep == "max" else min(known)) if known else None
        for i in ids:
            want[(i, best, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exactdup.exact_duplicates(no_docs).count() == 0


def test_trie_spills_by_subtree_and_merges():
    rng = np.random.default_rng(1)
    keys = [bytes(rng.integers(97, 100, rng.integers(0, 9)).astype(np.uint8)) for _ in range(600)]
    rows = [(k, (i, i), 1, i) for i, k in enumerate(keys)]
    want = {i: (min(j for j, x in enumerate(keys) if x == k), keys.count(k)) for i, k in enumerate(keys)}
    for budget in (1 << 20, 3000, 300):
        got = {part: (owner[0], n) for part, owner, n in exactdup.owners(iter(rows), False, budget)}
        assert got == want


def test_spilling_skips_a_common_beginning_and_keeps_its_budget(monkeypatch):
    rng = np.random.default_rng(2)
    head = b"h" * 80
    keys = [head + bytes(rng.integers(97, 101, 12).astype(np.uint8)) for _ in range(3000)] + [head, b"", head[:40], head + b"x" * 300]
    rows = [(k, (i, i), 1, i) for i, k in enumerate(keys)]
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    n = collections.Counter(keys)
    largest, levels, cut = [], [], exactdup.Patricia.cut

    def watched(self, room):
        largest.append(self.bytes)
        return cut(self, room)

    def leveled(rows, largest, budget, depth=0, run=exactdup.owners):
        levels.append(depth)
        return run(rows, largest, budget, depth)
    monkeypatch.setattr(exactdup.Patricia, "cut", watched)
    monkeypatch.setattr(exactdup, "owners", leveled)
    got = {part: (owner[0], c) for part, owner, c in exactdup.owners(iter(rows), False, 20_000)}
    assert got == {i: (first[k], n[k]) for i, k in enumerate(keys)}
    assert max(largest) <= 20_000 + 2 * 400 + 300
    assert max(levels) <= 86 and len(set(levels)) <= 8  # not a level for each byte of the beginning


def test_containment(spark, docs, no_docs, doc_rows):
    items = [(1, doc_rows[0][1][:200]), (2, "one two three"), (3, None), (4, ""), (5, doc_rows[1][1]), (5, doc_rows[2][1] + " zz yy xx"), (None, doc_rows[4][1]), (7, "never in any text at all here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = collections.Counter()
    for r in doc_rows:
        own = shingles(r[1], 5)
        for i, t in items:
            s = shingles(t, 5)
            if s and 100 * len(own & s) >= 80 * len(s):
                want[(r[0], i, len(s), len(own & s))] += 1
    got = decontam.contaminated(docs, bench).collect()
    assert collections.Counter(tuple(r)[:4] for r in got) == want and want
    clean = decontam.decontaminated(docs, bench)
    assert clean.columns == docs.columns
    assert collections.Counter(clean.collect()) == collections.Counter(
        r for r in docs.collect() if not any(s and 100 * len(shingles(r.text, 5) & s) >= 80 * len(s) for s in (shingles(t, 5) for _, t in items)))
    assert decontam.contaminated(no_docs, bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_containment_of_repeated_small_and_short_items(spark):
    rng = np.random.default_rng(12)

    def line(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    rows, items = [], []
    for i in range(60):
        unit, rest, three = line(20), line(300), line(3)
        items += [(4 * i, " ".join([unit] * 60)), (4 * i + 1, " ".join([unit[:6]] * 90)), (4 * i + 2, three), (4 * i + 3, line(9 + i % 4))]
        rows += [(2 * i, f"{rest} {unit} {unit} {three} {line(50)}"), (2 * i + 1, f"{rest} {unit[:6]} {unit[:6]} {unit[:6]} {unit[:6]} {unit[:6]} {items[-1][1]} {line(3)}")]
    rows += [(900, line(2)), (901, items[2][1].upper()), (902, items[2][1] + " more"), (903, items[2][1].rsplit(" ", 1)[0])]
    want = set()
    for r, text in rows:
        for i, t in items:
            s = shingles(t, min(5, len(words(t))))
            both = len(s & shingles(text, min(5, len(words(t)))))
            if both and 100 * both >= 80 * len(s):
                want.add((r, i, len(s), both))
    got = decontam.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(want)
    assert len({i for _, i, _, _ in want}) == len(items)


def test_benchmark_in_blocks(spark, docs, monkeypatch):
    bench = docs.select(F.col("doc_id").alias("item_id"), "text").filter("length(text) < 2000")
    one = collections.Counter(decontam.contaminated(docs, bench).collect())
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 20)
    assert collections.Counter(decontam.contaminated(docs, bench).collect()) == one


def test_raking_meets_the_targets(docs, no_docs):
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.form_topic(F.col("text"))}
    got = mixing.mix(docs, dims).collect()
    assert len(got) == docs.count()
    counts = docs.select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in counts] == [len(words(r.text)) for r in counts]
    cells = [{"a": a, "b": b, "tokens": n} for a, b, n in (("x", "p", 50.0), ("x", "q", 10.0), ("y", "p", 5.0), ("y", "q", 35.0), ("z", "q", 0.0))]
    w = mixing.rake(cells, {"a": {"x": 0.3, "y": 0.7}, "b": {"p": 0.5, "q": 0.5}}, 60)
    assert w[:2].sum() / w.sum() == pytest.approx(0.3) and (w[0] + w[2]) / w.sum() == pytest.approx(0.5)
    assert all(0 <= r.probability <= 1 for r in got) and max(r.probability for r in got) == 1.0
    draw = {r.doc_id: int(hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{mixing.SEED}".encode()).hexdigest()[:13], 16) / 2**52 for r in got}
    assert all(r.selected == (draw[r.doc_id] < r.probability) for r in got)
    assert mixing.mix(no_docs, dims).count() == 0


@pytest.mark.parametrize("limit", [20_000, 10])
def test_every_value_has_its_own_marginal(spark, monkeypatch, limit):
    """The fitted weights of 90 sources on the driver, and as staged tables."""
    monkeypatch.setattr(mixing, "DRIVER_CELLS", limit)
    rounds = 12 if limit > 10 else 2
    monkeypatch.setattr(mixing._rake_cells, "__defaults__", (rounds,))
    rows = [(i, " ".join(["w"] * (3 + i % 90)), f"s{i % 90}", ["en", "de", None][i % 7 % 3]) for i in range(600)] + [(999, "", "none", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    dims = {"source": F.col("source"), "lang": F.col("lang")}
    cells = collections.Counter()
    for _, t, s, la in rows:
        cells[s, la or "(none)"] += len(t.split())
    every = sum(cells.values())
    share = [{v: sum(n for c, n in cells.items() if c[d] == v) / every for v in {c[d] for c in cells}} for d in (0, 1)]
    flat = [{v: n**0.9 / sum(x**0.9 for x in s.values() if x) for v, n in s.items()} for s in share]
    free = 1 - share[0]["s1"] - share[0]["s2"]
    given = [{**share[0], "s1": (1 - free) * 0.75, "s2": (1 - free) * 0.25}, {"en": 0.5, "de": 0.2, "(none)": 0.3}]
    asked = {"source": {"s1": 0.6, "s2": 0.2}, "lang": {"en": 0.5, "de": 0.2, mixing.OTHER: 0.3}}
    for targets, want in ((None, flat), (asked, given)):
        got = {(r.dim_source, r.dim_lang): r.probability for r in mixing.mix(docs, dims, targets).collect()}
        assert set(got) == set(cells)  # no value is folded
        fitted = dict(cells)
        for _ in range(rounds):
            for d in (0, 1):
                total = collections.Counter()
                for c, n in fitted.items():
                    total[c[d]] += n
                fitted = {c: n * want[d][c[d]] * every / total[c[d]] if total[c[d]] else 0.0 for c, n in fitted.items()}
        factor = {c: fitted[c] / n if n else 1.0 for c, n in cells.items()}
        top = max(f for c, f in factor.items() if cells[c])
        assert got == pytest.approx({c: min(1.0, f / top) for c, f in factor.items()}, abs=2e-9) and min(got.values()) > 0


def test_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(2)
    supply = [int(x) for x in rng.integers(0, 1000, 6)]
    capacity = [sum(supply) // 8 + 1] * 8
    flow = sharding.min_cost_flow(supply, capacity, lambda i, j: int(i != j))
    assert flow.sum(axis=1).tolist() == supply and (flow.sum(axis=0) <= capacity).all() and (flow >= 0).all()
    assert sum(flow[i, i] for i in range(6)) == sum(min(s, c) for s, c in zip(supply, capacity))
    costs = rng.integers(0, 9, (3, 3))
    best = min(sum(costs[i, p[i]] for i in range(3)) for p in ([0, 1, 2], [0, 2, 1], [1, 0, 2], [1, 2, 0], [2, 0, 1], [2, 1, 0]))
    assert (sharding.min_cost_flow([1, 1, 1], [1, 1, 1], lambda i, j: int(costs[i, j])) * costs).sum() == best


def test_reshard(docs, no_docs, doc_rows):
    short = docs.filter("text is null or length(text) < 5000")
    rows = [r for r in doc_rows if r[1] is None or len(r[1]) < 5000]
    got = sharding.reshard(short, shards=5, old_shards=4).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert sorted(by) == list(range(5)) and all(sorted(r.slot for r in rs) == list(range(len(rs))) for rs in by.values())
    sizes = [sum(r.size for r in rs) for rs in by.values()]
    assert max(sizes) - min(sizes) <= max(r.size for r in got)
    assert sharding.reshard(no_docs).count() == 0
    assert sharding.reshard(docs).count() == len(doc_rows)
    still = sharding.reshard(short, old_shard=F.lit(0), old_shards=1, shards=1).collect()  # nothing moves, nothing is rewritten
    assert sorted(r.slot for r in still) == list(range(len(rows)))


def test_reshard_keeps_equal_texts_together(spark):
    rows = [(i, f"text {i} " * (1 + i % 40)) for i in range(1500)]
    share = sum(len(t) + 16 for _, t in rows) // 20
    for g in range(6):  # groups between an eighth of a share and nearly a whole one
        text = f"group {g} " * 30
        rows += [(10_000 * (g + 1) + i, text) for i in range(share * (g + 1) // 8 // (len(text) + 16))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.reshard(docs, shards=20, old_shards=16)
    shards, sizes = collections.defaultdict(set), collections.Counter()
    for r in got.collect():
        shards[r.text_crc32].add(r.shard)
        sizes[r.shard] += r.size
    assert len(sizes) == 20 and all(len(s) == 1 for s in shards.values())
    assert max(sizes.values()) - min(sizes.values()) <= max(len(t) for _, t in rows) + 16
    moved = sharding.moved_bytes(got, 20).first()
    assert moved.total_bytes == sum(sizes.values()) and moved.least_bytes <= moved.moved_bytes <= 1.2 * moved.least_bytes
    # one text above a share, its ids null or repeated: rows are dealt singly, nothing is lost
    hot = rows[:1500] + [(None if i % 2 else 7, "the same again") for i in range(9000)]
    got = sharding.reshard(spark.createDataFrame(hot, "doc_id long, text string"), shards=20, old_shards=16).collect()
    assert collections.Counter((r.doc_id, r.text_crc32) for r in got) == collections.Counter((i, zlib.crc32(t.encode())) for i, t in hot)
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) < 1.1 * min(sizes.values())


def test_long_white_space_is_counted_as_the_pattern_has_it(monkeypatch):
    count = tokencount.encoder()
    assert count("a" + " " * 2_000_000 + "b") > 2 and count("\n" * 2_000_000) > 0 and count(" \t\u3000" * 700_000 + "'s") > 0
    rng = np.random.default_rng(5)
    parts = ["a", "bc ", "12", "'s", "!?", " ", "  ", "\n", "\t \n", "\u3000\xa0", "\x1c", "é", "   \r\n"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(3000)]
    plain = [count(t) for t in texts]  # no run is long here
    monkeypatch.setattr(tokencount, "_LONG_RUN", re.compile(tokencount._LONG_RUN.pattern.replace("{10000,}", "{2,}")))
    assert [count(t) for t in texts] == plain


def test_toxicity(spark, docs, no_docs):
    rng = np.random.default_rng(4)
    calm = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    rows = []
    for i in range(400):
        w = list(rng.choice(calm, 40))
        if i % 4 == 0:
            w[int(rng.integers(40))] = ["vuxxor", "zyqqle"][i % 8 // 4]
        rows.append((i, " ".join(w), int(i % 4 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = table.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int"))
    model = common.stage(toxicity.train(table, labels, learn=toxicity.learnable), "m")
    scored = toxicity.toxicity_scores(table, model).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    bad, good = ([r.score for r in held if r.toxic == t] for t in (1, 0))
    assert sum(b > g for b in bad for g in good) / (len(bad) * len(good)) > 0.9  # held-out accuracy (area under the curve)
    odd = toxicity.toxicity_scores(spark.createDataFrame([(calm[0] + " vuxxorr " + " ".join(calm[1:30]),), (" ".join(calm[:30]),)], "text string"), model).collect()
    assert odd[0].score > odd[1].score  # an unseen misspelling shares n-grams
    got = toxicity.toxicity_scores(docs, model)  # replaces the clashing column, keeps the others
    assert sorted(got.columns) == sorted(docs.columns) and got.filter("score between 0 and 1").count() == docs.count()
    assert toxicity.toxicity_scores(no_docs, toxicity.train(no_docs, labels.limit(0))).count() == 0
    s = toxicity.scorer(np.arange(toxicity.BUCKETS) / 1e7, 0.0)
    w = "café"
    assert s(w) == pytest.approx(1 / (1 + math.exp(-np.mean(np.array(toxicity.grams(w)) / 1e7) / (1 + toxicity.NEUTRAL))))


def _pages(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a/1", big), (2, "http://a/\n2", big), (9, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (None, "u", big),
            (7, "u", "é中" * 900), (8, "u", "é中" * 900), (9, None, big), (10, "u", "y" * 3_000_000)]
    return rows, spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, owner string")


def test_warc_round_trip(spark):
    rows, pages = _pages(spark)
    manifest = warc.write_archives(pages.repartition(3))
    for split in (700, 8 << 20):
        got = warc.read_archives(manifest, split_bytes=split).collect()
        assert len(got) == len(rows) and all(r.digest_ok for r in got)
        want = collections.Counter()
        for i, _, html in rows:
            body = (html or "").encode()
            owner = max(j for j, _, h in rows if (h or "").encode() == body and j is not None) if len(body) >= 1000 else i
            refers = owner if owner != i else None
            want[(warc._urn(i), len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", None if refers is None else warc._urn(refers),
                  body if refers is None else b"")] += 1
        assert collections.Counter((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got) == want
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_many_duplicates_take_the_shuffled_way(spark, monkeypatch):
    _, pages = _pages(spark)
    one = collections.Counter(warc.read_archives(warc.write_archives(pages)).drop("path", "offset").collect())
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "heavy_keys", lambda c, k, n, t: common.heavy_keys(c, k, n, t, 2))
    assert collections.Counter(warc.read_archives(warc.write_archives(pages)).drop("path", "offset").collect()) == one


def test_warc_ranges_own_each_record_once():
    parts = [warc.record(i, "u", bytes([i]) * (i * 50), i * 50, hashlib.sha1(bytes([i]) * (i * 50)).hexdigest(), None) for i in range(40)]
    data = b"junk" + parts[0] + warc.MAGIC + b"not a member" + b"".join(parts[1:]) + parts[5][:-9]

    class File(io.BytesIO):
        def read_at(self, n, at):
            return self.getvalue()[at:at + n]
    for step in (1, 37, 500, len(data)):
        got = [h["warc-record-id"] for a in range(0, len(data), step) for _, h, _ in warc.records_in(File(data), len(data), a, min(len(data), a + step))]
        assert got == [warc._urn(i) for i in range(40)]
    assert base64.b32decode(warc._header(warc._member(warc._Window(File(data), 0, len(data)), 4)[0])[0]["warc-payload-digest"][5:]) == hashlib.sha1(b"").digest()


def test_length_histogram(docs, no_docs, doc_rows):
    count = tokencount.encoder()
    lengths = [count(r[1] or "") for r in doc_rows]
    counted = tokencount.token_counts(docs.select("doc_id", "text"))
    assert collections.Counter(r.n_tokens for r in counted.collect()) == collections.Counter(lengths)
    hist = tokencount.length_histogram(counted, block=16)
    for r in hist.collect():
        n = r.n_tokens
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least, r.cut_docs, r.truncated_tokens) == (
            lengths.count(n), sum(x >= n for x in lengths), sum(x for x in lengths if x >= n), sum(x > n for x in lengths), sum(min(x, n) for x in lengths))
        assert r.quantile == sum(x <= n for x in lengths) / len(lengths)
    for limit in (0, 1, 20, 33, 10**6):
        assert tokencount.truncated_total(hist, limit) == sum(min(x, limit) for x in lengths)
    by = tokencount.length_histogram(tokencount.token_counts(docs.select("lang", "text")), by=["lang"])
    assert {(r.lang, r.total_docs) for r in by.collect()} == set(collections.Counter(r[2] for r in doc_rows).items())
    assert tokencount.length_histogram(tokencount.token_counts(no_docs.select("text"))).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def base_spans(text):
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in pii.PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_base_spans_equal_the_patterns(docs, no_docs):
    rng = np.random.default_rng(8)
    alphabet = list("aB1234567890.@+- ()-xé\n@.") + ["4111 1111 1111 1111", "a@b.co", "10.0.0.1", "+49 30 1234567", "://", "http", "IBAN DE89 3704 0044 0532 0130 00 "]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 30))))
        assert [s for s in pii.spans(text) if s[0] in pii.BASE] == base_spans(text), text
    text = "see https://x.org/a?b=1, IBAN: DE89 3704 0044 0532 0130 00; account no. 123-456 789. 12 Old Mill Road, or a.b@c.de \U0001f600 10.1.2.3"
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)] == [
        ("url", "https://x.org/a?b=1"), ("iban", "DE89 3704 0044 0532 0130 00"), ("account", "123-456 789"), ("address", "12 Old Mill Road"),
        ("email", "a.b@c.de"), ("ip", "10.1.2.3")]
    assert "[email]" in pii.redact(text, pii.spans(text)) and "10.1.2.3" not in pii.redact(text, pii.spans(text))
    got = pii.digest(pii.pii_spans(docs)).collect()
    marks = {r.doc_id: r for r in got}
    for r in docs.collect():
        own = base_spans(r.text or "")
        if r.doc_id is not None:
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
            assert marks[r.doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and marks[r.doc_id].n_email == sum(s[0] == "email" for s in own)
    assert len(got) == docs.count() and pii.pii_spans(no_docs, redacted=True).count() == 0


def test_long_addresses_cues_in_any_case_and_long_zeros():
    names = " ".join(["Saint" + "a" * 40, "Maria" + "b" * 40, "Old", "Mill"])
    for number, cue in (("12", "Road"), ("7b,", "sTrEEt"), ("99999", "AvenuE")):
        text = f"went to {number} {names} {cue}, then home"
        assert [(k, text[a:b]) for k, a, b in pii.spans(text)] == [("address", f"{number} {names} {cue}")]
    assert pii.spans(f"12 One Two Three Four Five Road, Road, \n road x{names} Road") == []
    text = "\u0130 my iBaN DE89 3704 0044 0532 0130 00"
    assert [(k, text[a:b]) for k, a, b in pii.spans(text)] == [("iban", "DE89 3704 0044 0532 0130 00")]
    zeros = "0" * 5000
    assert [s[0] for s in pii.spans(f"{zeros}.1.2.{zeros}3 ")] == ["ip"] and pii.spans(f"{zeros}.1.2.{zeros}300 ") == []
    assert pii.spans("12 Road") == [] and [s[0] for s in pii.spans("12 Elm Road")] == ["address"]


def test_elias_fano_finds_and_returns_every_value():
    rng = np.random.default_rng(6)
    for values in (np.zeros(0, np.int64), np.array([0]), np.array([5, 5, 5]), np.cumsum(rng.integers(0, 3, 3000)), np.cumsum(rng.integers(1, 10**9, 500)), np.cumsum(rng.integers(1, 2, 700))):
        ef = ngram_lm.EliasFano(ngram_lm.EliasFano.build(values, "x"), "x")
        if len(values):
            assert (ef.get(np.arange(len(values))) == values).all()
            asked = np.concatenate((values, values + 1, rng.integers(0, int(values[-1]) + 5, 300), [int(values[-1]) + 10**6]))
            at, same = ef.find(asked)
            assert (at == np.searchsorted(values, asked)).all() and (same == np.isin(asked, values)).all()


@pytest.mark.parametrize(("order", "least"), [(2, 1), (2, 2), (3, 1), (3, 2)])
def test_scores_equal_a_plain_model(docs, no_docs, doc_rows, order, least):
    model = ngram_lm.fit(docs.filter(~ngram_lm.held_out(F.col("doc_id"))), order=order, least=least)
    got = ngram_lm.lm_scores(docs, model).collect()
    uni, bi, tri = collections.Counter(), collections.Counter(), collections.Counter()
    for r in doc_rows:
        if r[0] is None or zlib.crc32(str(r[0]).encode()) % 10:
            t = ["^", *words(r[1]), "$"]
            uni.update(t[1:]), bi.update(zip(t, t[1:])), tri.update(zip(t, t[1:], t[2:]))
    n, v = sum(uni.values()), len(uni)
    seen = collections.Counter()
    for (a, _), c in bi.items():
        seen[a] += c

    def term(c, total):
        return (c - 0.75) / total if c >= least else 0.0
    spent2, spent3 = collections.Counter(), collections.Counter()
    for (a, _), c in bi.items():
        spent2[a] += term(c, seen[a])
    for (a, b, _), c in tri.items():
        spent3[a, b] += term(c, bi[a, b])
    want = collections.defaultdict(list)
    for r in doc_rows:
        t, base, score = ["^", *words(r[1]), "$"], 0.0, 0.0
        for i in range(1, len(t)):
            p = (uni[t[i]] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            if t[i - 1] in seen:
                p = term(bi[t[i - 1], t[i]], seen[t[i - 1]]) + max(1e-6, 1 - spent2[t[i - 1]]) * p
            if order == 3 and i > 1 and bi[t[i - 2], t[i - 1]] >= least:
                p = term(tri[t[i - 2], t[i - 1], t[i]], bi[t[i - 2], t[i - 1]]) + max(1e-6, 1 - spent3[t[i - 2], t[i - 1]]) * p
            score += math.log10(p)
        want[r[0]].append((len(t) - 1, sum(w in uni for w in t[1:]), base, score))
    for r in got:
        near = [w for w in want[r.doc_id] if w[:2] == (r.n_tokens, r.n_known) and abs(w[2] - r.base_score) < 1e-6 * max(1, -w[2])]
        assert near and r.train_tokens == n
        assert min(abs(w[3] - r.score) for w in near) <= 1e-3 * r.n_tokens  # 16-bit codes
    assert len(got) == len(doc_rows)
    assert ngram_lm.lm_scores(no_docs, model).count() == 0
    empty = ngram_lm.lm_scores(docs, ngram_lm.fit(no_docs, order=order)).collect()
    assert len(empty) == len(doc_rows) and all(r.n_known == 0 for r in empty)


def plain_scores(texts, order=3):
    """Score of each text under a model of all n-grams of all texts."""
    uni, bi, tri = collections.Counter(), collections.Counter(), collections.Counter()
    tokens = [["^", *words(t), "$"] for t in texts]
    for t in tokens:
        uni.update(t[1:]), bi.update(zip(t, t[1:])), tri.update(zip(t, t[1:], t[2:]))
    n, v, seen, after, after2 = sum(uni.values()), len(uni), collections.Counter(), collections.Counter(), collections.Counter()
    for (a, _), c in bi.items():
        seen[a] += c
        after[a] += 1
    for a, b, _ in tri:
        after2[a, b] += 1
    out = []
    for t in tokens:
        score = 0.0
        for i in range(1, len(t)):
            p = (uni[t[i]] + 0.1) / (n + 0.1 * (v + 1))
            p = ((bi[t[i - 1], t[i]] - 0.75) + after[t[i - 1]] * 0.75 * p) / seen[t[i - 1]]
            if order == 3 and i > 1:
                c = bi[t[i - 2], t[i - 1]]
                p = ((tri[t[i - 2], t[i - 1], t[i]] - 0.75) + after2[t[i - 2], t[i - 1]] * 0.75 * p) / c
            score += math.log10(p)
        out.append((len(t) - 1, score))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_a_hot_word_spreads_over_the_files(spark, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "RUN", 200)
    rng = np.random.default_rng(7)
    texts = [" ".join(f"the w{x}" if x % 2 else f"w{x}" for x in rng.integers(0, 300, 40)) for _ in range(60)] + ["", "the the the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = plain_scores(texts, order)
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for shards in ("8", "3"):
        spark.conf.set("spark.sql.shuffle.partitions", shards)
        try:
            model = ngram_lm.fit(docs, order=order, least=1)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        got = {r.doc_id: r.score for r in ngram_lm.lm_scores(docs, model).collect()}
        assert all(abs(got[i] - score) <= 1e-3 * n for i, (n, score) in enumerate(want))  # n-grams seen once count
        sizes = [len(ngram_lm.open_arrays(p)[f"{order}.code"]) for p in model.tries if p]
        assert max(sizes) < 2.5 * sum(sizes) / int(shards)
        seen.append(got)
    assert seen[0] == pytest.approx(seen[1], abs=1e-6)  # whatever the number of shards


def test_registered_scores_use_all_ngrams(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    whole = ngram_lm.lm_scores(docs, ngram_lm.fit(docs.filter(~ngram_lm.held_out(F.col("doc_id"))), least=1))
    want = {r.doc_id: r.score for r in whole.collect()}
    assert {r.doc_id: r.score for r in registry.op9_lm_scoring(spark, sf).collect()} == pytest.approx(want, abs=1e-6)


def test_a_shard_is_a_task_of_its_own(spark):
    blobs = spark.range(300).select((F.col("id") % 60).cast("int").alias("shard"))
    got = ngram_lm._dealt(blobs, 60).groupBy(F.spark_partition_id()).agg(F.count_distinct("shard").alias("shards"), F.count(F.lit(1)).alias("rows")).collect()
    assert len(got) == 60 and {(r.shards, r.rows) for r in got} == {(1, 5)}


def test_merged_counts_let_go_of_their_parts():
    rows = [[np.array(x, np.int64) for x in ([3, 1], [0, 2], [1, 1])], [np.array(x, np.int64) for x in ([1, 1], [2, 5], [4, 1])]]
    a, b, n = ngram_lm._merged(rows)
    assert (a.tolist(), b.tolist(), n.tolist()) == ([1, 1, 3], [2, 5, 0], [5, 1, 1]) and rows == []
