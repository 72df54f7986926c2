"""Merkle manifest, repeated passages and phrases against brute force, on rows with
nulls, ties, repeated rows, empty and long texts and columns of clashing names."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from tierflow.llm import merkle, phrases, repeats

# ------------------------------------------------------------------ Merkle manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def steps(tree, at):
    out = []
    for level in tree[:-1]:
        run = level[at // 2 * 2:at // 2 * 2 + 2]
        out.append([None if i == at % 2 else x for i, x in enumerate(run)])
        at //= 2
    return out


def brute_audit(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        ordered = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((ordered, levels([leaf(r) for r in ordered])))
    top, out = levels([t[-1][0] for _, t in trees]), []
    for at, (ordered, tree) in enumerate(trees):
        for i, r in enumerate(ordered):
            proof, changed = steps(tree, i) + steps(top, at), list(r)
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                changed[3] += 1
            folded = leaf(changed)
            for step in proof:
                folded = h(*(x or folded for x in step))
            root = top[-1][0]
            out.append((r[0], tree[0][i], tree[-1][0], root, h(*(x for s in proof for x in s if x)), folded, folded == root))
    return sorted(out, key=repr)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.fixture(scope="module")
def leaf_rows():
    rng = random.Random(1)
    rows = [(rng.choice([None, rng.randint(0, 10**6)]) if rng.random() < 0.3 else i * 3, rng.choice([None, "s1", "sé"]),
             rng.choice([None, "en", "en", "en", "de", "", "\U0001f600", "zz"]), rng.choice([None, rng.randint(0, 99)]),
             rng.choice([None, "", "x" * rng.randint(0, 50), "ü" * 9, "long " * 20_000 if i == 5 else "y"])) for i in range(900)]
    return rows + [rows[3]] * 50 + [(9, "a", "one", 1, "t")]


@pytest.mark.parametrize(("height", "budget"), [(8, 100_000), (2, 3)])
def test_merkle_audit(spark, leaf_rows, height, budget, monkeypatch):
    monkeypatch.setattr(merkle.manifest, "__defaults__", ((), height, budget))
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in leaf_rows], FIELDS + ", grp string, proof string, n long").repartition(6)
    got = sorted((tuple(r) for r in merkle.audit(docs).collect()), key=repr)
    assert got == brute_audit(leaf_rows)


def test_merkle_small_tables(spark):
    assert merkle.audit(spark.createDataFrame([], FIELDS)).collect() == []
    one = [(9, "a", "one", 1, "t")]
    assert [tuple(r) for r in merkle.audit(spark.createDataFrame(one, FIELDS)).collect()] == brute_audit(one)
    big = [(9, None, None, 2**63 - 1, ""), (0, None, None, 2**63 - 1, "")]  # one more than the largest number
    assert sorted((tuple(r) for r in merkle.audit(spark.createDataFrame(big, FIELDS)).collect()), key=repr) == brute_audit(big)


def test_merkle_sql(leaf_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", leaf_rows)
    got = con.execute(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({merkle.ORACLE})").fetchall()
    assert sorted(got, key=repr) == brute_audit(leaf_rows)


def test_external_queue():
    rng, queue = random.Random(4), merkle.ExternalQueue(10)
    items = [((rng.randint(0, 50), i), i) for i in range(500)]
    for label, item in items[:400]:
        queue.push(label, item)
    got = [queue.pop() for _ in range(100)]
    for label, item in items[400:]:
        queue.push((label[0] + 60, label[1]), item)
    while queue.top() is not None:
        got.append(queue.pop())
    assert len(queue.runs) > 5 and got == sorted(got) and len(got) == 500
    queue.close()


# ------------------------------------------------------------------ repeated passages

def brute_repeats(rows, size):
    first, texts = {}, [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    for (i, _), w in zip(rows, texts):
        if i is not None:
            for p in range(len(w) - size + 1):
                key = tuple(w[p:p + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, texts):
        dead = [False] * len(w)
        if i is not None:
            for p in range(len(w) - size + 1):
                if first[tuple(w[p:p + size])] < i:
                    dead[p:p + size] = [True] * size
        out.append((i, len(w), sum(dead), b" ".join(x for x, d in zip(w, dead) if not d).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [6, 7, 50])
def test_drop_repeats(spark, size):
    rng = random.Random(3)
    vocab = ["".join(rng.choice("abcAé") for _ in range(2)) for _ in range(9 if size < 10 else 40)]
    passages = [[rng.choice(vocab) for _ in range(rng.randint(size - 1, 5 * size))] for _ in range(12)]
    rows = []
    for k in range(100):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(vocab) + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 2 * size))]
        if rng.random() < 0.2 and len(w) > 3:
            w[rng.randrange(len(w))] = "X"
        rows.append((rng.choice([None, *range(40)]) if rng.random() < 0.5 else 100 + k, rng.choice([" ", "\t", "  "]).join(w)))
    rows += [(5, None), (6, ""), (7, "a " * 4000), (8, "a " * 3000)] + [rows[3]] * 100 + [(None, "")] * 100
    docs = spark.createDataFrame([(i, t, "x", None, "z", 1) for i, t in rows], "doc_id long, text string, spans string, key string, doc string, place long").repartition(5)
    got = repeats.drop_repeats(docs, size).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=repr) == brute_repeats(rows, size)
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got)
    assert repeats.drop_repeats(docs.limit(0), size).collect() == []


def test_anchors_are_smallest_of_a_window():
    import pyarrow as pa
    rng = random.Random(9)
    texts = pa.array([" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in (0, 3, 50, 200, 49, 61)])
    w = repeats.Windows(texts)
    g, least, anchors = w.anchors(25, 50)
    want = set()
    for a, b in zip(w.at[:-1], w.at[1:]):
        for q in range(a, b - 49):
            assert least[q] == g[q:q + 26].min()
            want |= {q + int(i) for i in np.flatnonzero(g[q:q + 26] == g[q:q + 26].min())}
    assert sorted(want) == anchors.tolist()


# ------------------------------------------------------------------ phrases

def brute_phrases(rows, least, top):
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().lower()):
            w = re.findall(rb"[^\x20\x09]+", piece)
            for k in (1, 2, 3, 4):
                for i in range(len(w) - k + 1):
                    counts["und" if lang is None else lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        total = sum(n for p, n in f.items() if len(p) == 1)
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        inner = {p[i:i + k] for p, n in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * n >= 80 * often[p[i:i + k]]}
        best = []
        for p, a in often.items():
            if p not in inner:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, b" ".join(p), f[p[:k]], f[p[k:]]))
        out += [(lang, r, p.decode(), -a, left, right, total, -s) for r, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(25)] + ["É", "é", "ß", "A", "a", "B"]
    gaps = [" "] * 12 + ["\t", " . ", ", ", "\n", "  ", "; ", "\x0b", "!", "-"]
    rows = [(rng.choice([None, "en", "en", "de", "und", "", "\U0001f600"]), "".join(rng.choice(vocab) + rng.choice(gaps) for _ in range(rng.randint(0, 120))))
            for _ in range(300)]
    return rows + [("en", None), ("en", ""), ("de", "of the x " * 3000)] + [rows[5]] * 40


@pytest.mark.parametrize(("least", "top", "entries"), [(30, 2000, 600_000), (3, 60, 50)])
def test_collocations(spark, phrase_rows, least, top, entries):
    docs = spark.createDataFrame([(a, b, 1, "q", 2) for a, b in phrase_rows], "lang string, text string, f long, word string, n long").repartition(7)
    got = phrases.collocations(docs, least, top, entries=entries).collect()
    assert sorted(tuple(r) for r in got) == brute_phrases(phrase_rows, least, top)
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_trie_bursts_and_spills():
    rng = np.random.default_rng(5)
    trie, want = phrases.HatTrie(burst=20), collections.Counter()
    for _ in range(20):
        parts = rng.integers(1, 9, (200, 4)).astype(np.uint64)
        keys, counts = np.unique(parts[:, 0] << np.uint64(48) | parts[:, 1] << np.uint64(32) | parts[:, 2] << np.uint64(16) | parts[:, 3], return_counts=True)
        before = len(want)
        want.update(dict(zip(keys.tolist(), counts.tolist())))
        assert trie.add(keys, counts) == len(want) - before
    assert any(isinstance(node, list) for node in trie.top.values())
    assert sum(trie.size.values()) == len(want)
    names, got = rng.integers(1, 2**63, 10).astype(np.uint64), collections.Counter()
    table = np.concatenate((np.zeros(1, np.uint64), names))
    runs = collections.defaultdict(list)
    for some in ([1, 2, 3], [4, 5, 6, 7, 8]):
        for place, blob in phrases._runs(*trie.cut(some), table, 4):
            runs[place].append(phrases.unpack(blob))
    place = {int(n): i for i, n in enumerate(table)}
    for found in runs.values():
        own, columns, counts = phrases._merged(found, None)
        rows = [tuple(c) for c in np.stack(columns, axis=1).tolist()]
        assert rows == sorted(rows)
        wide = np.concatenate((np.zeros(1, np.uint64), own))
        for row, n in zip(rows, counts.tolist()):
            got[sum(place[int(wide[r])] << s for r, s in zip(row, (48, 32, 16, 0)))] += n
    assert got == want and not trie.top
