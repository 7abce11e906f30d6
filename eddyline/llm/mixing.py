"""Operator 7, mixing sources to target weights by Poisson replication.

Each source ``s`` with target weight ``w`` and ``n`` documents gets the mean
repetition rate ``w * total / n``.  A document's number of copies is a Poisson
number of that mean, found by inverting the distribution at a number in [0, 1)
made from a hash of ``(seed, id, text digest)``: the same document gives the
same copies on every run and after a lost executor.  Copies are exploded and the
result is sorted by a hash of ``(seed, id, text digest, copy)``, a global shuffle in which
hot sources and repeated texts spread evenly; a hash is uniform, so it is cut into ranges without
a pass to sample it.

A mean above ``PIECE`` is split into equal parts, each inverted with its own
hash and summed (a sum of Poisson numbers is one), so the recurrence never
underflows and the table of probabilities stays short.

Weights are normalised to sum 1 over the sources that have documents.  Without
given weights, a source's weight is proportional to ``n ** 0.5``, which lifts
small sources and holds back a dominant one.  ``total`` is the number of
documents times ``epochs``.

Nulls: a null source is a source of its own; a null id or text hashes as a
marker.  Rows that are equal in id and text draw the same number (they are the
same document).  A source that the weights do not name has weight 0 and is left
out: give every source a weight to keep it.  An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import fresh, materialize

PIECE = 16           # largest mean inverted at once
TERMS = 96           # terms of the table; beyond, less than 2 ** -100 is left at mean 16
SEED = "mix-1"
WEIGHT_UNIT = 1_000_000      # weights are whole numbers of this fraction
BROADCAST_SOURCES = 10_000   # sources whose rates are small enough to broadcast
SALTS = 64


def unit(key: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of ``key``."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def poisson_table(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... up to ``TERMS``, those
    below 1."""
    zero = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    step = lambda s, i: F.struct(
        (s["p"] * mean / i).alias("p"),
        F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * mean / i)).alias("c"))
    table = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), zero, step, lambda s: s["c"])
    return F.filter(table, lambda c: c < 1.0)


def poisson_inverse(table: Column, u: Column) -> Column:
    """The smallest ``k`` whose cumulative probability exceeds ``u``."""
    return F.size(F.filter(table, lambda c: c <= u)).cast("bigint")


def repetition_rates(docs: DataFrame, source_col: str = "source",
                     weights: Mapping[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """``source, n, rate``: documents and mean repetitions of each source.
    Weights count in millionths of the largest unit given (whole numbers, so
    their sum does not depend on the order of the rows)."""
    n = docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        n = n.withColumn("w", F.floor(F.sqrt(F.col("n").cast("double")) * WEIGHT_UNIT))
    else:
        scale = WEIGHT_UNIT / max([1e-300, *weights.values()])
        given = docs.sparkSession.createDataFrame(
            [(k, round(v * scale)) for k, v in weights.items()], "g string, w bigint")
        n = n.join(given, F.col("source").eqNullSafe(F.col("g")), "left").drop("g")
    n = materialize(n)
    total, sum_w = n.agg(F.sum("n"), F.sum("w")).first()
    return n.where("w > 0").select("source", "n", (
        F.lit(float(epochs) * (total or 0)) * F.col("w").cast("double")
        / F.lit(float(sum_w or 1)) / F.col("n")).alias("rate"))


def with_rates(docs: DataFrame, rates: DataFrame, source_col: str, key: str, rate: str) -> DataFrame:
    """``docs`` joined to their source's rate, number of parts and table of
    probabilities, which is made once per source.  The rates are broadcast only
    after a check of their size; beyond it, both sides are dealt out by source
    and a salt, so a hot source is spread over ``SALTS`` tasks."""
    parts = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    r = (rates.withColumn("parts", parts)
         .select(F.col("source").alias(key), F.struct("rate", "parts", poisson_table(
             F.col("rate") / F.col("parts")).alias("table")).alias(rate)))
    on = F.col(f"`{source_col}`").eqNullSafe(F.col(key))
    rows, chars = rates.agg(F.count(F.lit(1)), F.sum(F.length("source"))).first()
    if rows <= BROADCAST_SOURCES and (chars or 0) <= 100 * BROADCAST_SOURCES:
        return docs.join(F.broadcast(r), on).drop(key)
    salt = fresh(docs, "_salt")
    other = fresh(docs, salt + "_r")
    r = r.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "array", "struct")]
    d = docs.withColumn(salt, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    return d.join(r, on & (F.col(salt) == F.col(other))).drop(key, salt, other)


def poisson_mix(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: str = SEED, copy_col: str | None = "copy", key_col: str | None = "shuffle_key",
                rate_col: str | None = None) -> DataFrame:
    """``docs`` replicated to the target weights and globally shuffled; the
    added columns (each left out if its name is None; a column of that name is replaced) hold the
    copy number from 0, the shuffle key and the document's mean rate."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rate, key, digest, copies, copy, order = (fresh(docs, x) for x in (
        "_rate", "_src", "_digest", "_copies", "_copy", "_order"))
    rates = repetition_rates(docs, source_col, weights, epochs)
    named = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))
    d = (with_rates(docs, rates, source_col, key, rate)
         .withColumn(digest, F.concat_ws("|", F.lit(seed), named(id_col), F.md5(named(text_col)))))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col(rate)["parts"]), F.lit(0).cast("bigint"),
        lambda acc, i: acc + poisson_inverse(
            F.col(rate)["table"], unit(F.concat_ws("|", F.col(digest), F.lit("n"), i.cast("string")))))
    d = d.withColumn(copies, drawn).where(F.col(copies) > 0)
    d = d.withColumn(copy, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1)))
    d = d.withColumn(order, F.md5(F.concat_ws("|", F.col(digest), F.lit("o"), F.col(copy).cast("string"))))
    # The key is uniform, so ranges of it are known without sampling, which would read every text again.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint") * parts / F.lit(1 << 32)).cast("int")
    d = d.repartitionById(parts, place).sortWithinPartitions(order)
    added = [c.alias(n) for c, n in ((F.col(copy), copy_col), (F.col(order), key_col),
                                     (F.col(rate)["rate"], rate_col)) if n]
    replaced = {n.lower() for n in (copy_col, key_col, rate_col) if n}
    return d.select(*[c for c, n in zip(cols, docs.columns) if n.lower() not in replaced], *added)
