"""Exact duplicates by Patricia-trie owners.

Each task inserts the full byte strings of its rows into a compressed radix
trie whose terminal nodes hold the owner (the smallest or the largest
identifier) and the number of rows. The first pass works on the input's own
partitions and leaves one row for each distinct text of a task, so that a text
that a third of all rows share is one row a task. The second deals these to
partitions by length and content hash and finds the owners of the whole
corpus. A trie that outgrows its budget spills whole subtrees, the largest
below its first branching node, to task-local files, which it reads one after the other
and removes; what all texts of a file begin with is skipped there.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stage, width

#: Bytes of text that a task's trie holds before it is emptied (first pass) or spills (second).
TRIE_BYTES = 64 << 20


class Patricia:
    """Compressed radix trie over byte strings. A node is [edge, children by
    first byte, terminal]; a terminal is a list that the caller fills."""

    def __init__(self):
        self.root = [b"", {}, None]
        self.bytes = 0

    def terminal(self, key: bytes) -> list:
        """The terminal of ``key``, made when new."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                if node[2] is None:
                    node[2] = []
                return node[2]
            child = node[1].get(key[at])
            if child is None:
                leaf = [key[at:], {}, []]
                node[1][key[at]] = leaf
                self.bytes += len(leaf[0]) + 200
                return leaf[2]
            edge = child[0]
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            lo, hi = 1, min(len(edge), len(key) - at)  # the first byte agrees, the whole edge does not
            while lo < hi:
                mid = (lo + hi + 1) // 2
                if key.startswith(edge[:mid], at):
                    lo = mid
                else:
                    hi = mid - 1
            upper = [edge[:lo], {edge[lo]: child}, None]
            child[0] = edge[lo:]
            node[1][key[at]] = upper
            self.bytes += 200
            node, at = upper, at + lo

    def items(self, node: list | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, list]]:
        stack = [(node or self.root, prefix)]
        while stack:
            n, before = stack.pop()
            if n[2] is not None:
                yield before + n[0], n[2]
            stack.extend((c, before + n[0]) for c in n[1].values())

    def cut(self, room: int) -> list[tuple[bytes, list]]:
        """Detach the largest subtrees below the first branching node until at most
        ``room`` bytes are left: (what leads to the subtree, the subtree)."""
        above, node = b"", self.root
        while node[2] is None and len(node[1]) == 1:
            node = next(iter(node[1].values()))
            above += node[0]
        sizes = {byte: sum(len(n[0]) + 200 for n in self._nodes(child)) for byte, child in node[1].items()}
        left, gone = sum(sizes.values()), []
        for byte in sorted(sizes, key=sizes.get, reverse=True):
            if gone and left <= room:
                break
            left -= sizes[byte]
            gone.append((above + bytes([byte]), node[1].pop(byte)))
        self.bytes = left
        return gone

    @staticmethod
    def _nodes(node):
        stack = [node]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(n[1].values())


def better(a, b, largest: bool):
    """The owner of two (id, uid): non-null ids first, then by id, then the smaller uid."""
    if (a[0] is None) != (b[0] is None):
        return b if a[0] is None else a
    if a[0] != b[0]:
        return a if (a[0] > b[0]) == largest else b
    return a if a[1] <= b[1] else b


def _merge(into: list, owner: tuple, count: int, parts: list, largest: bool) -> None:
    if into:
        into[0] = better(into[0], owner, largest)
        into[1] += count
        into[2] += parts
    else:
        into[:] = [owner, count, parts]


class _Spilled:
    """Task-local files of subtrees, by what their keys begin with. A key goes to the longest beginning."""

    MOST_OPEN = 100

    def __init__(self, folder: str):
        self.folder, self.number, self.lengths, self.open = folder, {}, [], {}

    def add(self, start: bytes) -> None:
        self.number.setdefault(start, len(self.number))
        self.lengths = sorted({len(s) for s in self.number}, reverse=True)

    def of(self, rest: bytes) -> bytes | None:
        return next((rest[:n] for n in self.lengths if rest[:n] in self.number), None)

    def path(self, start: bytes) -> str:
        return os.path.join(self.folder, str(self.number[start]))

    def put(self, start: bytes, key: bytes, value: list) -> None:
        if start not in self.open:
            if len(self.open) >= self.MOST_OPEN:
                self.close()
            self.open[start] = open(self.path(start), "ab")  # noqa: SIM115
        pickle.dump((key, value), self.open[start])

    def close(self) -> None:
        for file in self.open.values():
            file.close()
        self.open = {}

    def rows(self, start: bytes) -> Iterator[tuple[bytes, tuple, int, int]]:
        if not os.path.exists(self.path(start)):
            return  # a node whose subtrees had all gone before
        with open(self.path(start), "rb") as f:
            while True:
                try:
                    key, (owner, count, parts) = pickle.load(f)
                except EOFError:
                    return
                yield key, owner, count, parts[0]
                for p in parts[1:]:
                    yield key, owner, 0, p
        os.remove(self.path(start))


def owners(rows: Iterator[tuple[bytes, tuple, int, int]], largest: bool, budget: int, depth: int = 0) -> Iterator[tuple[int, tuple, int]]:
    """(key, owner, count, part) rows -> (part, owner, count) of the key's whole
    group. All keys agree in their first ``depth`` bytes. Beyond ``budget`` bytes subtrees go to files."""
    trie = Patricia()
    with tempfile.TemporaryDirectory(prefix="trie-") as folder:
        files = _Spilled(folder)
        for key, owner, count, part in rows:
            rest = key[depth:]
            start = files.of(rest)
            if start is not None:
                files.put(start, key, [owner, count, [part]])
                continue
            _merge(trie.terminal(rest), owner, count, [part], largest)
            if trie.bytes > budget:
                for start, node in trie.cut(budget // 2):
                    files.add(start)
                    for tail, value in trie.items(node, start[:-1]):
                        files.put(start, key[:depth] + tail, value)
        for _, (owner, count, parts) in trie.items():
            for part in parts:
                yield part, owner, count
        del trie
        files.close()
        for start in files.number:
            yield from owners(files.rows(start), largest, budget, depth + len(start))


def _combine(largest: bool, budget: int):
    """(id, uid, text) -> a row for each input row: (id, uid, part: the uid of its
    text's first row here) and, on that first row, the text, its digest, owner and count."""
    def flush(trie, rows, ids):
        out = {k: [] for k in ("uid", "part", "text", "digest", "length", "owner_id", "owner_uid", "n")}
        heads = {}
        for key, (owner, count, parts) in trie.items():
            heads[parts[0]] = (key, owner, count)
        for uid, terminal in rows:
            head = heads[uid] if terminal[2][0] == uid else None
            out["uid"].append(uid)
            out["part"].append(terminal[2][0])
            out["text"].append(head[0] if head else None)
            out["digest"].append(hashlib.sha256(head[0]).hexdigest() if head else None)
            out["length"].append(len(head[0]) if head else None)
            out["owner_id"].append(head[1][0] if head else None)
            out["owner_uid"].append(head[1][1] if head else None)
            out["n"].append(head[2] if head else None)
        ids = pa.concat_arrays(ids)
        kinds = {"uid": pa.int64(), "part": pa.int64(), "text": pa.binary(), "digest": pa.string(), "length": pa.int64(), "owner_id": ids.type,
                 "owner_uid": pa.int64(), "n": pa.int64()}
        return pa.RecordBatch.from_arrays([ids, *[pa.array(out[k], t) for k, t in kinds.items()]], names=["id", *kinds])

    def run(batches):
        trie, rows, ids = Patricia(), [], []
        for batch in batches:
            if batch.num_rows:
                ids.append(batch.column(0))
            for ident, uid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                terminal = trie.terminal(text or b"")
                _merge(terminal, (ident, uid), 1, [] if terminal else [uid], largest)
                rows.append((uid, terminal))
            if trie.bytes + 100 * len(rows) > budget:
                yield flush(trie, rows, ids)
                trie, rows, ids = Patricia(), [], []
        if rows:
            yield flush(trie, rows, ids)
    return run


def _owners_task(largest: bool, budget: int, id_type):
    def run(batches):
        def rows():
            for batch in batches:
                cols = [batch.column(c).to_pylist() for c in ("text", "owner_id", "owner_uid", "n", "part")]
                for text, oid, uid, n, part in zip(*cols):
                    yield text, (oid, uid), n, part
        held = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1][0] for h in held], id_type),
                                               pa.array([h[1][1] for h in held], pa.int64()), pa.array([h[2] for h in held], pa.int64())],
                                              names=["part", "keep_id", "keep_uid", "group_size"])
        for row in owners(rows(), largest, budget):
            held.append(row)
            if len(held) >= 10_000:
                yield out()
                held = []
        if held:
            yield out()
    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: id_col, keep_id (the id of the row that stays),
    group_size, kept, text_sha256. Texts are equal when their UTF-8 bytes are.

    ``keep`` is ``min`` or ``max``: the row with the smallest or largest id stays.
    Null text counts as empty, empty texts are one group. A null id stays only
    in a group without other ids; of rows that tie on the id exactly one is kept. Other columns
    are not read; an empty table gives no rows.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    largest = keep == "max"
    src = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid"), F.col(text_col).cast("binary").alias("text"))
    kind = src.schema["id"].dataType
    name = kind.simpleString()
    local = stage(src.mapInArrow(_combine(largest, budget), f"id {name}, uid long, part long, text binary, digest string, length long, owner_id {name}, owner_uid long, n long"), "trie")
    heads = local.filter("text is not null").select("text", "length", "owner_id", "owner_uid", "n", "part")
    dealt = heads.withColumn("hash", F.xxhash64("text")).repartition(width(docs.sparkSession), "length", "hash")
    found = dealt.mapInArrow(_owners_task(largest, budget, to_arrow_type(kind)), f"part long, keep_id {name}, keep_uid long, group_size long")
    group = found.join(local.filter("text is not null").select("part", "digest"), "part")
    return (local.select("id", "uid", "part").join(group, "part")
            .select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.col("digest").alias("text_sha256")))


ORACLE = """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
      row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""
