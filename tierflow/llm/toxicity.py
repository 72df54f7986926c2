"""Toxicity score: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the embeddings of its character n-grams (hashed
to a fixed number of buckets), a text's vector the mean over its distinct words
(a word repeated a thousand times tells no more than once), and a linear
softmax on it gives the score. Embeddings and softmax are trained
jointly, in numpy, in one task over a bounded labelled sample. Unseen
misspellings share n-grams, and so vectors, with the words seen.

The trained model is linear in the bag, so scoring needs one number per bucket
(the embedding times the softmax difference): the model table has a fixed size
of ``BUCKETS`` rows whatever the corpus.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tierflow.llm.common import stage

BUCKETS = 1 << 18
MASK = BUCKETS - 1
DIM = 6
GRAMS = (3, 5)
#: Labelled documents learnt from: at most so many of each class, by hash of the id.
MAX_PER_CLASS = {1: 1500, 0: 2500}
STEPS, BATCH, RATE, DECAY = 260, 128, 0.05, 1e-4
#: N-grams found in fewer training texts keep no weight.
LEAST_TEXTS = 6
SHARE = np.float32(100)
#: Neutral words added to every mean, so that few words cannot tell much.
NEUTRAL = 40
EDGES = ".,;:!?\"'()[]{}<>"


def grams(word: str) -> list[int]:
    """Buckets of a word's character n-grams, with marks at both ends."""
    marked = f"<{word.strip(EDGES)}>"
    raw = [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)] or [marked]
    return [crc32(g.encode("utf-8", "surrogatepass")) & MASK for g in raw]


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """A text's buckets and their weights: distinct words weigh the same, as do a word's n-grams."""
    words = set((text or "").lower().split())
    own = [grams(w) for w in words]
    if not own:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    n = np.array([len(g) for g in own])
    found, at = np.unique(np.concatenate(own), return_inverse=True)
    return found, np.bincount(at, weights=np.repeat(1 / ((len(own) + NEUTRAL) * n), n)).astype(np.float32)


def fit(texts: list[str], toxic: np.ndarray, prior: float | None = None) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax together; returns each bucket's weight and
    the bias of the log odds. ``prior``: the odds of class 1 among all labels,
    where they differ from the sample's."""
    rng = np.random.default_rng(11)
    bags = [bag(t) for t in texts]
    seen = np.zeros(BUCKETS, np.int64)
    for ids, _ in bags:
        seen[ids] += 1
    bags = [(i[k], w[k]) for i, w in bags for k in [seen[i] >= LEAST_TEXTS]]
    live = np.flatnonzero(seen >= LEAST_TEXTS)
    place = np.zeros(BUCKETS, np.int64)
    place[live] = np.arange(len(live))
    emb = rng.normal(0, 0.1, (DIM, len(live))).astype(np.float32)
    out = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    y = np.eye(2, dtype=np.float32)[np.asarray(toxic, dtype=int)]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (emb, out, bias)]
    order = np.zeros(0, np.int64)
    for step in range(1, 1 + STEPS * bool(len(live))):
        if len(order) < min(BATCH, len(bags)):
            order = np.concatenate((order, rng.permutation(len(bags))))
        rows, order = order[:BATCH], order[BATCH:]
        ids = np.concatenate([place[bags[r][0]] for r in rows])
        # SHARE stands for the usual share of a telling word: means over whole texts are small
        weights = SHARE * np.concatenate([bags[r][1] for r in rows])
        doc = np.repeat(np.arange(len(rows)), [len(bags[r][0]) for r in rows])
        hidden = np.stack([np.bincount(doc, weights * e[ids], len(rows)) for e in emb], 1).astype(np.float32)
        logits = hidden @ out + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - y[rows]) / len(rows)
        back = g @ out.T
        g_emb = np.stack([np.bincount(ids, weights * b[doc], len(live)) for b in back.T]).astype(np.float32) + DECAY * emb
        for param, grad, (m, v) in zip((emb, out, bias), (g_emb, hidden.T @ g + DECAY * out, g.sum(0)), state):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            param -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weight = np.zeros(BUCKETS)
    weight[live] = SHARE * (out[:, 1] - out[:, 0]) @ emb
    shift = 0.0
    if prior and 0 < np.sum(toxic) < len(toxic):
        shift = np.log(prior) - np.log(np.sum(toxic) / (len(toxic) - np.sum(toxic)))
    return weight, float(bias[1] - bias[0] + shift)


def _fit_task(prior: float | None):
    def run(batches):
        texts, toxic = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            toxic += batch.column("toxic").to_pylist()
        weight, bias = fit(texts, np.array(toxic, int), prior) if texts else (np.zeros(BUCKETS), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array([weight.astype(np.float64).tobytes()], pa.binary()), pa.array([bias])], names=["weight", "bias"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          learn=None) -> DataFrame:
    """One row (weight binary, bias double). ``learn`` is a condition on
    ``id_col`` for labels that may be learnt from. The sample is bounded by
    ``MAX_PER_CLASS``; whole texts are read. Labels or ids that are null are not
    used; of several labels of one id the largest counts; rows that repeat an id
    each count. Without labels the score is 0.5 everywhere."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    if learn is not None:
        marks = marks.filter(learn(F.col("id")))
    marks = marks.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi").groupBy("id").agg(F.max("toxic").alias("toxic"))
    marks = stage(marks, "toxicity-labels")
    count = dict(marks.groupBy("toxic").count().filter(F.col("toxic").isin(0, 1)).collect())  # two rows
    prior = count.get(1, 0) / count[0] if count.get(0) else None
    picked = [marks.filter(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(n) for c, n in MAX_PER_CLASS.items()]
    sample = F.broadcast(picked[0].union(picked[1]))  # at most the sum of MAX_PER_CLASS rows
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(sample, "id").select("id", "toxic", "text")
    return rows.repartition(1).sortWithinPartitions("id", "text").mapInArrow(_fit_task(prior), "weight binary, bias double")


class _WordScores(dict):
    """A word's mean n-gram weight, computed on first use."""

    def __init__(self, weight):
        self.weight = weight.tolist()

    def __missing__(self, word):
        if len(self) >= 400_000:
            self.clear()
        weight, marked = self.weight, f"<{word.strip(EDGES)}>"
        if marked.isascii():  # the same n-grams as in grams(), cut from bytes
            raw = marked.encode()
            found = [weight[crc32(raw[i:i + n]) & MASK] for n in GRAMS for i in range(len(raw) - n + 1)] or [weight[crc32(raw) & MASK]]
        else:
            found = [weight[g] for g in grams(word)]
        value = self[word] = sum(found) / len(found)
        return value


def scorer(weight: np.ndarray, bias: float):
    scores = _WordScores(weight)

    def score(text: str | None) -> float:
        words = set((text or "").lower().split())
        odds = bias + sum(map(scores.__getitem__, words)) / (len(words) + NEUTRAL)
        return float(1 / (1 + np.exp(-max(-60.0, min(60.0, odds)))))
    return score


def toxicity_scores(docs: DataFrame, model: DataFrame, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with ``out_col`` (0 to 1, higher: likelier toxic) added, replacing a
    column of that name. Whole texts count; null and empty texts get the score
    of the bias alone. Rows are scored one by one, so repeated rows, ties, null
    ids and an empty table need no rule; all other columns pass through."""
    row = model.first()  # one row of fixed size; none without labels
    held = docs.sparkSession.sparkContext.broadcast((row["weight"], row["bias"]) if row else (np.zeros(BUCKETS).tobytes(), 0.0))
    docs = docs.drop(out_col)
    at = docs.columns.index(text_col)

    def run(batches):
        score = scorer(np.frombuffer(held.value[0]), held.value[1])
        for batch in batches:
            got = pa.array([score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out_col])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out_col, DoubleType())]))


def learnable(ident):
    """Contract: labels are learnt only where crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(ident.cast("string").cast("binary")) % 4 != 2


def fitted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return stage(train(docs, labels, learn=learnable), "toxicity-model")
