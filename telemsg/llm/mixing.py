"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources get shares of the wanted total by weight; no source gives more than ``limit`` times its size, and what it
cannot give is reshared by weight. Every source is cut into shards of about ``tokens_per_shard`` words by a seeded
hash of its documents (so a hot source is many shards), every shard into blocks of about ``block`` words along its
documents in seeded order. Sources get integer numbers of blocks, and each source's blocks go to its shards by
highest quotients. In a shard a seeded permutation picks which blocks are taken once more than the others.

Only ids, sources and sizes are shuffled. Defined cases: null text has size 0; a null source is a source of its
own, last in order; null ids and repeated rows are rows like any other; an empty table gives an empty mix; extra
columns are not read. Reruns agree: every choice is a hash of the seed and the data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_or_empty, words_of, written

WEIGHTS = (5, 2, 1)


def sainte_lague(votes: np.ndarray, seats: int, caps: np.ndarray | None = None) -> np.ndarray:
    """Seats by highest quotients ``votes / (2 a + 1)``, none above its cap; ties go to the earlier entry.

    Starts from the seats that every party surely has (its quota by a slightly large divisor) and hands out the
    rest one by one, which is the same as handing out all of them one by one.
    """
    votes = np.asarray(votes, dtype=float)
    caps = np.full(len(votes), float(max(seats, 0))) if caps is None else np.asarray(caps, dtype=float)
    caps = np.where(votes > 0, caps, 0.0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64)

    def given(divisor: float) -> np.ndarray:
        return np.minimum(caps, np.floor(votes / divisor + 0.5)).astype(np.int64)

    low, high = 0.0, 2 * votes.max() + 1.0  # given(low) is too many, given(high) is none
    for _ in range(100):
        mid = (low + high) / 2
        if mid in (0.0, low, high):
            break
        if given(mid).sum() > seats:
            low = mid
        else:
            high = mid
    out = given(high)
    for _ in range(seats - int(out.sum())):
        quotient = np.where(out < caps, votes / (2 * out + 1), -1.0)
        out[int(np.argmax(quotient))] += 1
    return out


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows: one row per source, a summary."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    nth = F.row_number().over(by_name) - 1
    weight = F.array(*map(F.lit, weights))[nth % len(weights)]
    per = per.withColumn("w", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    fill = Window.partitionBy(F.lit(0)).orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns(
        {
            "total": F.sum("source_size").over(everything) * F.lit(float(share)),
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "w_left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)),
        }
    )
    full = (F.col("total") - F.col("cap_before")) * F.col("w") >= F.col("cap") * F.col("w_left")
    per = per.withColumn("full", full)
    rest = F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    w_rest = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(rest * F.col("w") / w_rest)
    return per.select("source", "source_size", target.alias("target"))


def _quotas(seed: int):
    def per_source(shards: pd.DataFrame) -> pd.DataFrame:
        """Blocks for each shard of one source: a row per shard, a summary of the source."""
        shards = shards.sort_values("shard")
        blocks = shards["blocks"].to_numpy()
        size, target = int(shards["source_size"].iloc[0]), float(shards["target"].iloc[0])
        seats = math.floor(target * blocks.sum() / size + 0.5) if size else 0
        quota = sainte_lague(blocks.astype(float), seats, caps=2 * blocks)
        step = []
        for m in blocks.tolist():  # a stride near the golden section of the shard, coprime to its blocks
            a = max(1, int(m * 0.6180339887))
            while math.gcd(a, m) != 1:
                a += 1
            step.append(a)
        out = shards[["source", "shard", "tokens", "blocks"]].copy()
        out["quota"], out["step"] = quota, step
        out["shift"] = (shards["shard"].to_numpy() * 7919 + seed) % np.maximum(blocks, 1)
        return out

    return per_source


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = 1.5,
    limit: float = 2.0,
    block: int = 16,
    tokens_per_shard: int = 1 << 18,
    seed: int = 17,
) -> DataFrame:
    """One row per document: ``(doc_id, size, source, source_size, target, taken, copies, spans)``.

    ``copies`` is how often the whole text is taken, ``spans`` the word ranges ``[from, to)`` taken once more, and
    ``taken`` the words of both, at most ``2 * size``.
    """
    sizes = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.size(words_of(text_or_empty(text_col))).cast("long").alias("size"),
            F.col(source_col).alias("source"),
        ),
        "mix-sizes",
    )
    targets = written(source_targets(sizes, weights, share, limit), "mix-targets")
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(tokens_per_shard)))
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    s, t = sizes.alias("s"), targets.alias("t")
    rows = (
        s.join(t, F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("doc_id", "size", "s.source", "source_size", "target")
        .withColumn("shard", F.pmod(key, n_shards))
        .withColumn("order", F.xxhash64(key))
    )
    blocks = F.greatest(F.lit(1), F.round(F.col("tokens") / F.lit(block))).cast("long")
    shards = (
        rows.groupBy("source", "shard", "source_size", "target")
        .agg(F.sum("size").alias("tokens"))
        .withColumn("blocks", blocks)
    )
    quotas = shards.groupBy("source").applyInPandas(
        _quotas(seed), "source string, shard long, tokens long, blocks long, quota long, step long, shift long"
    )
    w = Window.partitionBy("source", "shard").orderBy("order", F.col("doc_id").asc_nulls_first(), "size")
    ends = F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("end", ends).withColumn("start", F.col("end") - F.col("size"))
    p, q = placed.alias("p"), quotas.alias("q")
    j = p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")) & (F.col("p.shard") == F.col("q.shard"))).select(
        "doc_id", "size", "p.source", "source_size", "target", "start", "end", "tokens", "blocks", "quota", "step",
        "shift",
    )
    m, n = F.col("blocks"), F.col("tokens")

    def edge(b: Column) -> Column:
        return F.call_function("div", b * n, m)

    def block_of(pos: Column) -> Column:
        return F.call_function("div", pos * m, n)

    extra = F.col("quota") % m
    around = F.sequence(
        F.greatest(block_of(F.col("start")) - 1, F.lit(0).cast("long")),
        F.least(block_of(F.col("end") - 1) + 1, m - 1),
    )
    again = F.filter(around, lambda b: F.pmod(b * F.col("step") + F.col("shift"), m) < extra)
    cut = F.transform(
        again,
        lambda b: F.struct(
            (F.greatest(edge(b), F.col("start")) - F.col("start")).alias("from"),
            (F.least(edge(b + 1), F.col("end")) - F.col("start")).alias("to"),
        ),
    )
    spans = F.filter(cut, lambda x: x["to"] > x["from"])
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")
    out = j.withColumn("copies", F.call_function("div", F.col("quota"), m)).withColumn(
        "spans", F.when((F.col("size") > 0) & (extra > 0), spans).otherwise(none)
    )
    more = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"])
    return out.withColumn("taken", F.col("copies") * F.col("size") + more).select(
        "doc_id", "size", "source", "source_size", "target", "taken", "copies", "spans"
    )


def mixed_texts(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself, ``(doc_id, part, text)``: whole texts ``copies`` times, then the words of each span. Needs
    unique ids."""
    d = docs.select(F.col(id_col).alias("__mx_id"), text_or_empty(text_col).alias("__mx_text"))
    j = plan.join(d, plan["doc_id"].eqNullSafe(d["__mx_id"]))
    whole = F.array_repeat(F.col("__mx_text"), F.col("copies").cast("int"))
    words = F.transform(
        "spans",
        lambda x: F.array_join(
            F.slice(words_of(F.col("__mx_text")), (x["from"] + 1).cast("int"), (x["to"] - x["from"]).cast("int")), " "
        ),
    )
    return j.select("doc_id", F.posexplode(F.concat(whole, words)).alias("part", "text"))
