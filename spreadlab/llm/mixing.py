"""Mixing sources to target weights by Poisson replication.  DataFrame functions only.

Source s with n_s of N rows and target share w_s gets the mean repetition rate
w_s * N / n_s.  Every row inverts a Poisson distribution of that mean at a
uniform number from a digest of (seed, id, part), is repeated by the count, and
the copies are sorted by a digest of (seed, id, copy): a global shuffle that any
run repeats.  Rates above ``PART`` are drawn as a sum of equal parts, so the
inversion never underflows.  Without stated shares they follow the square root
of the sources' sizes.

Cases: a null source is a source of its own; rows of one id draw alike (rows with
a null id too); a source without a stated share is left out; a share without rows
is ignored; an empty table gives an empty result; a row's other columns, text
included, are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sized

SEED = 20240501
PART = 32.0
POWER = 0.5


def uniform(*parts: Column) -> Column:
    """Number in (0, 1) from the first 52 bits of an md5 digest."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, shares: dict | None = None, source_col: str = "source", power: float = POWER) -> DataFrame:
    """(__source, rate) of every source; one row per source."""
    size = docs.groupBy(F.col(source_col).alias("__source")).agg(F.count("*").alias("n"))
    if shares is None:
        weight = size.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(power)))
    else:
        pairs = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])
        weight = size.withColumn("w", pairs[F.col("__source")].cast("double")).where("w > 0")
    total = weight.agg(F.sum("w").alias("w_all"))
    everything = size.agg(F.sum("n").alias("n_all"))
    row, rows = total.first(), everything.first()           # two numbers
    return weight.select("__source", (F.col("w") / F.lit(float(row[0] or 1)) * F.lit(float(rows[0] or 0)) / F.col("n")).alias("rate"))


def poisson(rate: Column, *key: Column) -> Column:
    """Poisson count of mean ``rate`` by inversion at uniforms that depend on ``key``."""
    parts = F.greatest(F.ceil(rate / F.lit(PART)), F.lit(1)).cast("int")
    mean = rate / parts
    top = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")

    def draw(j: Column) -> Column:
        u = uniform(*key, j.cast("string"))
        start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("n"))

        def step(acc, k):
            p = acc["p"] * mean / k
            more = acc["c"] <= u
            return F.struct(p.alias("p"), F.when(more, acc["c"] + p).otherwise(acc["c"]).alias("c"),
                            (acc["n"] + more.cast("int")).alias("n"))

        return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda acc: acc["n"])

    return F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda s, j: s + draw(j))


def mix_sources(docs: DataFrame, shares: dict | None = None, seed: int = SEED, id_col: str = "doc_id",
                source_col: str = "source") -> DataFrame:
    """Rows of ``docs`` repeated to the target weights and shuffled globally, with
    rate, copies, copy (from 1) and shuffle_key."""
    rates = sized(source_rates(docs, shares, source_col), "rates")
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    drawn = (docs.join(rates, docs[source_col].eqNullSafe(rates["__source"])).drop("__source")
             .withColumn("copies", poisson(F.col("rate"), F.lit(str(seed)), ident)).where("copies > 0"))
    return (drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .withColumn("shuffle_key", F.md5(F.concat_ws("|", F.lit(f"{seed}:order"), ident, F.col("copy").cast("string"))))
            .orderBy("shuffle_key"))


def report(docs: DataFrame) -> DataFrame:
    return (mix_sources(docs).withColumn("rate", F.round("rate", 6))
            .select("doc_id", "source", "rate", "copies", "copy", "shuffle_key", "text"))
