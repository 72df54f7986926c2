"""Mixing sources to target weights: iterative proportional fitting of token
weights to source, language and topic marginals, then sampling of documents by
the calibrated probabilities.

Every value of a dimension has a target of its own. A table of at most
``DRIVER_CELLS`` cells is raked on the driver; a larger one stays a staged DataFrame
and every step is an aggregate and joins on it, with the same result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import stage

OTHER, NONE = "(other)", "(none)"
DRIVER_CELLS = 20_000
ROUNDS = 12
EXPONENT = 0.9
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    t = F.coalesce(text, F.lit(""))
    edge = F.lit("^[\\x20\\x09-\\x0D]"), F.lit("[\\x20\\x09-\\x0D]$")
    return (F.size(F.split(t, "[\\x20\\x09-\\x0D]+", -1)) - F.regexp_like(F.substring(t, 1, 1), edge[0]).cast("int")
            - F.regexp_like(F.right(t, F.lit(1)), edge[1]).cast("int") - (t == "").cast("int")).cast("long")


def form_topic(text: Column) -> Column:
    """The topic of the registered query, from a text's form: table, contact, shout, long or prose."""
    t = F.coalesce(text, F.lit(""))
    return (F.when((F.length(t) - F.length(F.replace(t, F.lit("|"), F.lit("")))) * 50 > F.length(t), "table")
            .when(F.contains(t, F.lit("@")) | F.contains(t, F.lit("://")), "contact")
            .when(F.contains(t, F.lit("!!")), "shout").when(F.length(t) > 5000, "long").otherwise("prose"))


def tempered(cells: list[dict], dims: list[str], exponent: float = EXPONENT) -> dict[str, dict[str, float]]:
    """Targets for every dimension: its values' token shares, flattened by ``exponent``."""
    out = {}
    for d in dims:
        total: dict[str, float] = {}
        for c in cells:
            total[c[d]] = total.get(c[d], 0.0) + c["tokens"]
        flat = {v: n**exponent for v, n in total.items() if n > 0}
        out[d] = {v: n / sum(flat.values()) for v, n in flat.items()}
    return out


def completed(cells: list[dict], targets: dict[str, dict[str, float]], dims: list[str]) -> dict[str, dict[str, float]]:
    """Targets that name every value (see :func:`mix`)."""
    out = {}
    for d in dims:
        named, total = targets.get(d, {}), {}
        for c in cells:
            total[c[d]] = total.get(c[d], 0.0) + c["tokens"]
        rest = {v: n for v, n in total.items() if v not in named or v == OTHER}
        every, left, given = sum(total.values()), sum(rest.values()), sum(t for v, t in named.items() if v != OTHER)
        if OTHER in named:
            ours, theirs = 1.0, named[OTHER] / left if left else 0.0
        else:
            ours, theirs = (1 - left / every) / given if every and given else 0.0, 1 / every if every else 0.0
        out[d] = {v: t * ours for v, t in named.items() if v != OTHER} | {v: n * theirs for v, n in rest.items()}
    return out


def rake(cells: list[dict], targets: dict[str, dict[str, float]], rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the cells: tokens scaled to one target after the other.
    Values without tokens cannot be weighted up and are skipped."""
    weight = np.array([float(c["tokens"]) for c in cells])
    places = [(np.unique([c[d] for c in cells], return_inverse=True), t) for d, t in targets.items()] if cells else []
    for _ in range(rounds):
        for (values, at), target in places:
            total = np.bincount(at, weight, len(values))
            want = np.array([target.get(v, 0.0) for v in values]) * weight.sum()
            weight = weight * np.divide(want, total, out=np.zeros(len(values)), where=total > 0)[at]
    return weight


def _rake_cells(cells: DataFrame, names: list[str], targets: dict[str, dict[str, float]] | None, exponent: float, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (staged: dim_<name>, tokens) with their ``factor``, as from :func:`rake`.
    A weight is the cell's tokens times one scale for each dimension's value, so
    a step reads the cells and the other dimensions' scales and writes one scale table."""
    spark = cells.sparkSession
    shares = {}
    every = cells.agg(F.sum("tokens")).first()[0] or 0
    for d in names:
        total = cells.groupBy(f"dim_{d}").agg(F.sum("tokens").cast("double").alias("n"))
        if targets is None:
            flat = F.when(F.col("n") > 0, F.pow("n", F.lit(exponent))).otherwise(0.0)
            total = stage(total.select(f"dim_{d}", flat.alias("share")), "shares")
            whole = total.agg(F.sum("share")).first()[0] or 1.0
            shares[d] = total.withColumn("share", F.col("share") / F.lit(whole or 1.0))
            continue
        named = targets.get(d, {})
        given = spark.createDataFrame([(v, float(t)) for v, t in named.items() if v != OTHER], f"dim_{d} string, target double")
        total = total.join(given, f"dim_{d}", "left")
        left = total.filter("target is null").agg(F.sum("n")).first()[0] or 0.0
        whole = sum(t for v, t in named.items() if v != OTHER)
        if OTHER in named:
            ours, theirs = 1.0, named[OTHER] / left if left else 0.0
        else:
            ours, theirs = (1 - left / every) / whole if every and whole else 0.0, 1 / every if every else 0.0
        shares[d] = total.select(f"dim_{d}", F.coalesce(F.col("target") * F.lit(float(ours)), F.col("n") * F.lit(float(theirs))).alias("share"))
    shares = {d: stage(s, "shares") for d, s in shares.items()}
    scales = {d: s.select(f"dim_{d}", F.lit(1.0).alias(f"scale_{d}")) for d, s in shares.items()}

    def weighed(others: list[str]) -> DataFrame:
        out = cells.withColumn("weight", F.col("tokens").cast("double"))
        for e in others:
            out = out.join(scales[e], f"dim_{e}").withColumn("weight", F.col("weight") * F.col(f"scale_{e}")).drop(f"scale_{e}")
        return out
    weight = float(every)
    for _ in range(rounds):
        for d in names:
            total = weighed([e for e in names if e != d]).groupBy(f"dim_{d}").agg(F.sum("weight").alias("total"))
            step = stage(shares[d].join(total, f"dim_{d}").select(f"dim_{d}", F.when(F.col("total") > 0, F.col("share")).otherwise(0.0).alias("met"), "total"), "scale")
            scales[d] = step.select(f"dim_{d}", F.when(F.col("total") > 0, F.col("met") * F.lit(weight) / F.col("total")).otherwise(0.0).alias(f"scale_{d}"))
            weight *= step.agg(F.sum("met")).first()[0] or 0.0
    return weighed(names).withColumn("factor", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0))


def mix(docs: DataFrame, dims: dict[str, Column], targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id",
        text_col: str = "text", exponent: float = EXPONENT, seed: str = SEED) -> DataFrame:
    """``docs`` with ``n_tokens``, one column ``dim_<name>`` for each of ``dims``,
    ``probability`` and ``selected`` added (columns of these names are replaced).

    ``targets`` gives each dimension's shares; without it the corpus's own
    token shares to the power ``exponent`` are the target. A cell's factor is
    its fitted over its present tokens; probabilities are factors over the
    largest factor, so no probability is cut at 1 and the sample's expected
    marginals are the targets. A document is selected when the first 52 bits of
    md5(id:seed) as a fraction are below its probability.

    Values that ``targets`` does not name keep their present share of the tokens,
    and the named ones share what is left in the ratio of their targets; if
    ``(other)`` is named, its target is theirs, dealt by their present tokens.
    Only a target of 0 leaves a value out.

    A null dimension value counts as ``(none)``, null text as empty; texts
    without words weigh nothing and have the factor 1. Rows that repeat an id
    share its draw; null ids draw as the empty id. An empty table stays empty.
    """
    spark, names = docs.sparkSession, list(dims)
    kept = [c for c in docs.columns if c not in {"n_tokens", "probability", "selected", *(f"dim_{d}" for d in names)}]
    src = docs.select(*kept, word_count(F.col(text_col)).alias("n_tokens"),
                      *[F.coalesce(e.cast("string"), F.lit(NONE)).alias(f"dim_{d}") for d, e in dims.items()])
    keys = [f"dim_{d}" for d in names]
    table = stage(src.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")), "cells")
    rows = table.limit(DRIVER_CELLS + 1).collect()
    if len(rows) <= DRIVER_CELLS:
        cells = [{**{d: r[f"dim_{d}"] for d in names}, "tokens": r["tokens"]} for r in rows]
        cells.sort(key=lambda c: [c[d] for d in names])
        weight = rake(cells, tempered(cells, names, exponent) if targets is None else completed(cells, targets, names))
        tokens = np.array([c["tokens"] for c in cells], float)
        factor = np.divide(weight, tokens, out=np.ones(len(cells)), where=tokens > 0)
        top = factor[tokens > 0].max() if (tokens > 0).any() else 1.0
        found = [(*(c[d] for d in names), min(1.0, round(float(f / top), 9))) for c, f in zip(cells, factor)] if top else []
        held = F.broadcast(spark.createDataFrame(found, ", ".join([*(f"{k} string" for k in keys), "probability double"])))  # as many rows as cells
    else:
        factors = stage(_rake_cells(table, names, targets, exponent), "factors")
        top = factors.filter("tokens > 0").agg(F.max("factor")).first()[0]
        top = 1.0 if top is None else top
        held = factors.select(*keys, F.least(F.lit(1.0), F.round(F.col("factor") / F.lit(top), 9)).alias("probability")) if top else factors.select(*keys, F.lit(0.0).alias("probability"))
    got = src.join(held, keys, "left")
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 13), 16, 10)
    got = got.withColumn("probability", F.coalesce("probability", F.lit(0.0)))
    return got.withColumn("selected", draw.cast("double") / float(2**52) < F.col("probability"))


def oracle(dims: dict[str, str], exponent: float = EXPONENT, rounds: int = ROUNDS, seed: str = SEED, table: str = "documents") -> str:
    """The same as SQL, with the rounds written out; ``dims`` gives each dimension's SQL expression."""
    names = list(dims)
    keys = ", ".join(f"dim_{d}" for d in names)
    ctes = [f"""base AS MATERIALIZED (SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
      {', '.join(f"coalesce(CAST({e} AS VARCHAR), '{NONE}') AS dim_{d}" for d, e in dims.items())} FROM {table})""",
            f"cells AS MATERIALIZED (SELECT {keys}, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM base GROUP BY {keys})"]
    for d in names:
        ctes.append(f"""t_{d} AS MATERIALIZED (SELECT dim_{d}, share / sum(share) OVER () AS share FROM
      (SELECT dim_{d}, pow(sum(tokens), {exponent}) AS share FROM cells GROUP BY dim_{d} HAVING sum(tokens) > 0))""")
    last = f"(SELECT {keys}, tokens, tokens AS weight FROM cells)"
    for r in range(rounds):
        for d in names:
            ctes.append(f"""w_{r}_{d} AS MATERIALIZED (SELECT {', '.join(f'w.dim_{x}' for x in names)}, tokens,
      CASE WHEN sum(weight) OVER (PARTITION BY w.dim_{d}) > 0 THEN weight * coalesce(share, 0) * sum(weight) OVER () / sum(weight) OVER (PARTITION BY w.dim_{d}) ELSE 0 END AS weight
      FROM {last} w LEFT JOIN t_{d} t ON w.dim_{d} = t.dim_{d})""")
            last = f"w_{r}_{d}"
    ctes.append(f"factors AS MATERIALIZED (SELECT {keys}, tokens, CASE WHEN tokens > 0 THEN weight / tokens ELSE 1 END AS factor FROM {last})")
    ctes.append(f"""probs AS MATERIALIZED (SELECT {keys}, least(1.0, round(factor / (SELECT coalesce(max(factor) FILTER (WHERE tokens > 0), 1.0) FROM factors), 9)) AS probability FROM factors)""")
    return f"""WITH {', '.join(ctes)}
    SELECT doc_id, n_tokens, {keys}, probability,
      CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{seed}'), 1, 13)) AS BIGINT) / 4503599627370496.0 < probability AS selected
    FROM base JOIN probs USING ({keys})"""
