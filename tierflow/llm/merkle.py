"""Merkle manifest of a table by time-forward processing.

Nodes are labelled by level and place. A task holds an aligned block of
consecutive nodes and sweeps it in the order of the labels: an external
priority queue hands every node the digests of its children, the node's own
digest is sent to its parent. Blocks' roots are the leaves of the next round,
until each group has one root; the groups' roots make a last tree in the same way.
Then the sweep is reversed, from the last round to the first: a node takes its proof
suffix from the queue and sends each child that suffix with the siblings before
it, until the leaves have their whole proofs.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tierflow.llm.common import stage, width

#: A block has 2 to this power leaves.
HEIGHT = 8
#: Messages that a queue holds in memory before it writes them as a sorted run.
QUEUE_ITEMS = 100_000


class ExternalQueue:
    """Priority queue of (label, message). Beyond ``budget`` items the later half
    goes to a task-local file as a sorted run, read item by item while popping."""

    def __init__(self, budget: int = QUEUE_ITEMS):
        self.budget, self.heap, self.runs = budget, [], []
        self.folder = None

    def push(self, label: tuple, message) -> None:
        heapq.heappush(self.heap, (label, message))
        if len(self.heap) > self.budget:
            self.heap.sort()
            self._spill(self.heap[self.budget // 2:])
            del self.heap[self.budget // 2:]

    def _spill(self, items: list) -> None:
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="queue-")
        file = open(os.path.join(self.folder.name, str(len(self.runs))), "w+b")  # noqa: SIM115
        for item in items:
            pickle.dump(item, file)
        file.seek(0)
        self.runs.append([pickle.load(file), file])

    def _least(self):
        best = min((run for run in self.runs if run[0] is not None), key=lambda run: run[0], default=None)
        if self.heap and (best is None or self.heap[0] <= best[0]):
            return None
        return best

    def top(self) -> tuple | None:
        """The least label, or None."""
        run = self._least()
        return run[0][0] if run else self.heap[0][0] if self.heap else None

    def pop(self) -> tuple:
        run = self._least()
        if run is None:
            return heapq.heappop(self.heap)
        item = run[0]
        try:
            run[0] = pickle.load(run[1])
        except EOFError:
            run[0] = None
            run[1].close()
        return item

    def close(self) -> None:
        for _, file in self.runs:
            file.close()
        if self.folder is not None:
            self.folder.cleanup()


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def sweep(leaves: Iterator[str], height: int, budget: int = QUEUE_ITEMS) -> Iterator[tuple[int, int, list[str]]]:
    """Forward sweep over a block: (level, place, children's digests) of every inner
    node in the order of the labels; the last one is the block's root."""
    queue = ExternalQueue(budget)
    for place, digest in enumerate(leaves):
        if height:
            queue.push((1, place // 2, place % 2), digest)
    while (label := queue.top()) is not None:
        level, place, _ = label
        children = []
        while (label := queue.top()) is not None and label[:2] == (level, place):
            children.append(queue.pop()[1])
        yield level, place, children
        if level < height:
            queue.push((level + 1, place // 2, place % 2), _digest(children))
    queue.close()


def reversed_sweep(nodes: list[tuple[int, int, list[str]]], suffix: list[str], budget: int = QUEUE_ITEMS) -> Iterator[tuple[int, list[str]]]:
    """The nodes of ``sweep`` in reverse: (place, proof) of every leaf, from the last."""
    queue = ExternalQueue(budget)
    level, place, _ = nodes[-1]
    queue.push((-level, -place), suffix)
    for level, place, children in reversed(nodes):
        own = queue.pop()[1]
        for side in range(len(children) - 1, -1, -1):
            if len(children) == 1:
                step = [""]
            else:
                step = ["R" + children[1]] if side == 0 else ["L" + children[0]]
            proof = step + own
            if level == 1:
                yield 2 * place + side, proof
            else:
                queue.push((1 - level, -(2 * place + side)), proof)
    queue.close()


def _blocks(batches: Iterator[pa.RecordBatch], key: list[str], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows of equal ``key``, as (key, rows): rows are sorted by key."""
    held, now = [], None
    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in key))
        rows = zip(*(batch.column(c).to_pylist() for c in names))
        for k, row in zip(keys, rows):
            if k != now:
                if held:
                    yield now, held
                held, now = [], k
            held.append(row)
    if held:
        yield now, held


def _height(n: int, height: int) -> int:
    """Levels of a block in a group of ``n`` nodes: to the single root, where that is in reach."""
    return min(height, (n - 1).bit_length())


def _up(height: int, budget: int):
    def run(batches):
        out = []
        for (group, block), rows in _blocks(batches, ["grp", "block"], ["digest", "n"]):
            n, root = rows[0][1], rows[0][0]
            for _, _, children in sweep((r[0] for r in rows), _height(n, height), budget):
                root = children
            out.append((group, block, _digest(root) if isinstance(root, list) else root, (n - 1 >> height) + 1))
            if len(out) >= 10_000:
                yield _rows(out)
                out = []
        if out:
            yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64()))],
                                          names=["grp", "place", "digest", "n"])
    return run


def _down(height: int, budget: int, columns: list[str], brought: list[str], schema: pa.Schema):
    """Rows of a block, the first of them (place -1) with the block's suffix and what
    is ``brought`` to all -> (columns, brought, proof)."""
    def run(batches):
        out = [[] for _ in schema]
        for _, rows in _blocks(batches, ["grp", "block"], ["place", "digest", "n", "proof", *brought, *columns]):
            head, rows = rows[0], rows[1:]
            nodes = list(sweep((r[1] for r in rows), _height(rows[0][2], height), budget))
            proofs = dict(reversed_sweep(nodes, head[3], budget)) if nodes else {0: head[3]}
            for place, row in enumerate(rows):
                for column, value in zip(out, (*row[4 + len(brought):], *head[4:4 + len(brought)], proofs[place])):
                    column.append(value)
            if len(out[0]) >= 4_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
                out = [[] for _ in schema]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
    return run


def numbered(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``df`` with place (from 0, gapless, by ``order``) and n (rows) of each group.
    Rows are dealt in ranges, so that a group of any size spreads; each range is
    counted, the counts' running sums give the places."""
    spark = df.sparkSession
    parts = width(spark)
    dealt = stage(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")  # rows keep their order, also when read again
    keys = [F.col(group), *order, F.col("_tie")]
    ranged = stage(dealt.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # at most one row a range
    counts = counts.select("_part", group, F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"),
                           F.sum("_count").over(Window.partitionBy(group)).alias("n"))
    inside = Window.partitionBy("_part", group).orderBy(*order, F.col("_tie"))
    return (ranged.withColumn("_row", F.row_number().over(inside)).join(counts, ["_part", group])
            .withColumn("place", F.col("_before") + F.col("_row") - 1).drop("_part", "_row", "_before", "_tie"))


def _dealt(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("place", height))


def _in_order(nodes: DataFrame) -> DataFrame:
    return nodes.repartition(width(nodes.sparkSession), "grp", "block").sortWithinPartitions("grp", "block", "place")


def _raise(nodes: DataFrame, height: int, budget: int) -> tuple[list[DataFrame], DataFrame]:
    """All rounds up from ``nodes`` (grp, place, digest, n, ...): the nodes of each round, and the root of each group."""
    rounds = [nodes]
    while True:
        up = _in_order(_dealt(rounds[-1].select("grp", "place", "digest", "n"), height)).mapInArrow(
            _up(height, budget), "grp string, place long, digest string, n long")
        up = stage(up, "merkle")
        if up.filter("n > 1").isEmpty():
            return rounds, up.select("grp", "digest")
        rounds.append(up)


def _lower(rounds: list[DataFrame], suffix: DataFrame, height: int, budget: int, carry: list[str]) -> DataFrame:
    """All rounds down: ``suffix`` (grp, proof, ...) of the groups' roots -> the columns ``carry`` of
    the first round's nodes, the further columns of ``suffix``, and the proofs."""
    brought = [c for c in suffix.columns if c not in ("grp", "proof")]
    suffix = suffix.withColumn("place", F.lit(0).cast("long"))
    for nodes in reversed(rounds):
        keep = carry if nodes is rounds[0] else ["grp", "place"]
        schema = StructType([*nodes.select(*keep).schema, *suffix.select(*brought).schema, StructField("proof", ArrayType(StringType()))])
        named = [f"c_{i}" for i in range(len(keep))]
        rows = _dealt(nodes, height).select("grp", "block", "place", "digest", "n", *(F.col(c).alias(a) for c, a in zip(keep, named)))
        heads = suffix.select("grp", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "proof", *brought)
        both = _in_order(rows.unionByName(heads, allowMissingColumns=True))
        suffix = both.mapInArrow(_down(height, budget, named, brought, _arrow(schema)), schema)
        if nodes is not rounds[0]:
            suffix = stage(suffix, "proofs")
    return suffix


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def field(column: Column) -> Column:
    """A value as it enters a leaf: byte count, colon, value; ``-`` where null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    def step(held, side):
        other = F.substring(side, 2, 64)
        return F.sha2(F.when(F.startswith(side, F.lit("L")), F.concat(other, held)).otherwise(F.concat(held, other)), 256)
    return F.aggregate(proof, digest, step)


def proof_digest(proof: Column) -> Column:
    """SHA-256 of the siblings' digests, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.substring(s, 2, 64)), ""), 256)


def manifest(rows: DataFrame, group: str, order: str, digest: str, carry: list[str] = (), height: int = HEIGHT, budget: int = QUEUE_ITEMS) -> DataFrame:
    """One row per row of ``rows``: the columns ``carry``, the leaf ``digest``, subroot,
    root, and proof: a step for each level, ``L`` or ``R`` with the sibling's
    digest, or empty where a node has none.

    Leaves of a group ascend by ``order`` (nulls first; ties by digest); while more
    than one node remains, each two consecutive ones become the SHA-256 of their
    digests as text, a last single one the SHA-256 of its own. The groups' roots,
    null first, then by the bytes of the group's name, give the root likewise. An empty table gives no rows.
    """
    names = [f"v_{i}" for i in range(len(carry))]
    known = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))  # "-" sorts before "="
    src = rows.select(known.alias("grp"), F.col(order).alias("key"), F.col(digest).alias("digest"), *(F.col(c).alias(a) for c, a in zip(carry, names)))
    leaves = stage(numbered(src, "grp", [F.col("key").asc_nulls_first(), F.col("digest").asc()]).drop("key"), "leaves")
    rounds, subroots = _raise(leaves, height, budget)
    tops = stage(numbered(subroots.withColumns({"top": F.lit("all"), "name": F.col("grp")}).drop("grp"), "top", [F.col("name").asc()])
                 .withColumnRenamed("top", "grp"), "tops")
    upper, root = _raise(tops, height, budget)
    start = root.select("grp", F.array().cast("array<string>").alias("proof"), F.col("digest").alias("root"))
    proofs = stage(_lower(upper, start, height, budget, ["name", "digest"]), "proofs")
    down = proofs.select(F.col("name").alias("grp"), "proof", F.col("digest").alias("subroot"), "root")
    return _lower(rounds, down, height, budget, [*names, "digest"]).select(*(F.col(a).alias(c) for c, a in zip(carry, names)), F.col("digest").alias("leaf"), "subroot", "root", "proof")


def document_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """The manifest of ``documents``: doc_id, leaf, subroot, root, proof, and changed: the leaf
    that a row has after tampering (``tampered``: rows whose n_chars grows by 1; null n_chars stay), else null.
    Other columns are not read."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text")]
    other = [*fields[:3], F.col("n_chars").cast("decimal(38,0)") + 1, fields[4]]
    changed = F.when(tampered & F.col("n_chars").isNotNull(), leaf(other)) if tampered is not None else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.col("lang").alias("grp"), leaf(fields).alias("digest"), changed.alias("changed"))
    return manifest(rows, "grp", "doc_id", "digest", ["doc_id", "changed"])


def audit(docs: DataFrame) -> DataFrame:
    """Every document's proof, held against a copy in which n_chars is one more
    where 7 divides crc32(doc_id): verified is false for those."""
    proven = document_manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return proven.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                         fold(F.coalesce("changed", "leaf"), F.col("proof")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _crc32(text: str) -> str:
    """DuckDB: CRC-32 (reflected polynomial 0xEDB88320) of an ASCII text."""
    bit = "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(range(0, 8), {bit}, xor(c, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {byte}, 4294967295), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


_LEAF = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_CHANGED = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "(n_chars + 1)", "text"))


def _tree(name: str, start: str) -> str:
    """All nodes above ``start`` (grp, place, d), by level."""
    return f"""{name} AS (SELECT grp, 0 AS level, place, d, count(*) OVER (PARTITION BY grp) AS n FROM {start}
      UNION ALL SELECT grp, any_value(level) + 1, place // 2, sha256(string_agg(d, '' ORDER BY place)), (any_value(n) + 1) // 2 FROM {name} WHERE n > 1 GROUP BY grp, place // 2)"""


def _path(name: str, tree: str, start: str) -> str:
    """Proof texts and folded digests from ``start`` (row, grp, place, proof, folded) to the root of its group."""
    return f"""{name} AS (SELECT row, grp, 0 AS level, place, proof, folded FROM {start}
      UNION ALL SELECT row, p.grp, p.level + 1, p.place // 2, proof || coalesce(s.d, ''),
        sha256(CASE WHEN p.place % 2 = 1 THEN coalesce(s.d, '') || folded ELSE folded || coalesce(s.d, '') END)
      FROM {name} p JOIN {tree} o ON o.grp = p.grp AND o.level = p.level AND o.place = p.place AND o.n > 1
      LEFT JOIN {tree} s ON s.grp = p.grp AND s.level = p.level AND s.place = xor(p.place, 1))"""


ORACLE = f"""WITH RECURSIVE
    leaves AS (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || lang, '-') AS grp, sha256({_LEAF}) AS d,
      CASE WHEN n_chars IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN sha256({_CHANGED}) END AS changed FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, d) - 1 AS place FROM leaves),
    {_tree("low", "placed")},
    subroots AS (SELECT grp AS name, d FROM low WHERE n = 1),
    tops AS (SELECT 'all' AS grp, name, d, row_number() OVER (ORDER BY name) - 1 AS place FROM subroots),
    {_tree("high", "tops")},
    begin AS (SELECT row, grp, place, '' AS proof, coalesce(changed, d) AS folded FROM placed),
    {_path("climb", "low", "begin")},
    half AS (SELECT c.row, 'all' AS grp, t.place, c.proof, c.folded FROM climb c JOIN low o ON o.grp = c.grp AND o.level = c.level AND o.n = 1 JOIN tops t ON t.name = c.grp),
    {_path("rise", "high", "half")},
    done AS (SELECT r.row, r.proof, r.folded, o.d AS root FROM rise r JOIN high o ON o.level = r.level AND o.n = 1)
    SELECT doc_id, p.d AS leaf, s.d AS subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM placed p JOIN done USING (row) JOIN subroots s ON s.name = p.grp"""
