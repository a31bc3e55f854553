"""Divergence of the sources of a language, from the words of whole texts.

Each text is cut by a translate table: ``bytes.translate`` lowers the letters and
blanks the separators in one pass over the raw bytes, ``bytes.split`` yields the
terms and a ``Counter`` the frequencies of the document.  A task adds them up per
(lang, source, term) and sends one row for each, so that what is shuffled is sparse
and pre-aggregated: the most frequent word is one row a task and source.

A language keeps the terms that at least ``MIN_DOCS`` of its documents hold.  With
count its occurrences in a group, N their sum and V the kept terms, a term has
p = 1 + floor(10^9 (count + 5) / (N + 5 V)) there, all in whole numbers.

* ``pair``: L1 distance of the p of every two sources of a language.  Kept terms are
  dealt to buckets; a bucket's task lays its terms out against the language's
  sources (absent ones hold the group's p of count 0), sums |p - q| for the pairs of
  columns, and the partial sums are added.  A bucket has ``TERMS`` terms or 16 a
  source, so partial sums stay fewer than the counts that go in.
* ``term``: the kept terms of a group whose p is above the language's, first ``TOP``.

Cases: null text, lang and source are ''; texts without a term still make their
(lang, source) group; very long texts are counted whole; repeated rows are documents
of their own; a language without kept terms has distance 0 between its sources; a
language of one source has no pair rows; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sized

MIN_DOCS = 30
TOP = 50
TERMS = 4096
HELD = 300_000           # terms a task adds up before it sends them
CELLS = 1 << 20

#: letters lowered, other bytes of ASCII blank, bytes of other characters kept
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def frequencies(text: bytes) -> Counter:
    return Counter(text.translate(TABLE).split())


def group_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs), added up per task."""

    def run(batches):
        held: dict[tuple, tuple[dict, dict]] = {}
        size = 0

        def out():
            for (lang, source), (total, within) in held.items():
                terms = pa.array(list(total), pa.binary()).cast(pa.string())
                yield pa.record_batch(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                     terms, pa.array(list(total.values()), pa.int64()), pa.array(list(within.values()), pa.int64())],
                    names=["lang", "source", "term", "n", "docs"])

        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                total, within = held.setdefault((lang, source), ({}, {}))
                was = len(total)
                for term, n in frequencies(text).items():
                    total[term] = total.get(term, 0) + n
                    within[term] = within.get(term, 0) + 1
                size += len(total) - was
                if size > HELD:
                    yield from out()
                    held.clear()
                    size = 0
        yield from out()

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")


def share(count, total, kept) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exact; null where no term is kept."""
    wide = (F.col(count) if isinstance(count, str) else count).cast("decimal(19,0)") + 5
    by = (F.col(total) + 5 * F.col(kept)).cast("decimal(20,0)")
    return F.when(F.col(kept) > 0, (F.call_function("div", wide * F.lit(1_000_000_000).cast("decimal(10,0)"), by) + 1))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n, by): the terms that enough documents of a language hold, with their
    occurrences in it and in each of its sources that has them."""
    # one shuffle: the two groupings below find the rows of a (lang, term) together already
    dealt = group_counts(docs).repartition("lang", "term")
    return (dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"),
                                         F.collect_list(F.struct("source", "n")).alias("by"))
            .where(F.col("docs") >= min_docs).select("lang", "term", "n", "by"))


def _partial(width: int):
    def add(cells: pa.Table, sides: pa.Table) -> pa.Table:
        """|p - q| of every pair of columns i < j, summed over the bucket's terms."""
        order = np.argsort(sides.column("idx").to_numpy(), kind="stable")
        names = sides.column("source").take(pa.array(order))
        empty = sides.column("p0").to_numpy(zero_copy_only=False)[order]
        term = cells.column("term").combine_chunks().dictionary_encode()
        rows = np.asarray(term.indices, dtype=np.int64) if len(term) else np.zeros(0, np.int64)
        col, p = cells.column("idx").to_numpy().astype(np.int64), cells.column("p").to_numpy()
        size, terms = len(order), len(term.dictionary) if len(term) else 0
        total = np.zeros((size, size), dtype=np.int64)
        by_row = np.argsort(rows, kind="stable")
        rows, col, p = rows[by_row], col[by_row], p[by_row]
        tile = max(width // size, 1)
        for lo in range(0, terms, tile):
            hi = min(lo + tile, terms)
            a, z = np.searchsorted(rows, [lo, hi])
            grid = np.tile(empty.astype(np.int64), (hi - lo, 1))
            grid[rows[a:z] - lo, col[a:z]] = p[a:z]
            for i in range(size - 1):
                total[i, i + 1:] += np.abs(grid[:, i + 1:] - grid[:, i: i + 1]).sum(axis=0)
        i, j = np.triu_indices(size, 1)
        lang = sides.column("lang")[0].as_py() if size else None
        return pa.table({"lang": pa.repeat(pa.scalar(lang, pa.string()), len(i)), "a": names.take(pa.array(i)),
                         "b": names.take(pa.array(j)), "value": pa.array(total[i, j], pa.int64())})
    return add


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, lang_col: str = "lang",
          source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): see the module's text."""
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n)
                          for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    kept = sized(kept_terms(plain, min_docs), "divergence-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    counts = kept.select("lang", F.explode("by").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(
        F.sum("x.n").alias("total"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = (plain.select("lang", "source").distinct().join(langs, "lang", "left").join(counts, ["lang", "source"], "left")
              .na.fill(0, ["kept", "lang_total", "total"])
              .withColumn("idx", F.row_number().over(by_source) - 1)
              .withColumn("sources", F.count("*").over(Window.partitionBy("lang")))
              .withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("kept") / F.greatest(F.lit(TERMS), 16 * F.col("sources")))))
              .withColumn("p0", share(F.lit(0), "total", "kept")))
    groups = sized(groups, "divergence-groups")            # one row a (lang, source)
    cells = (kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("by").alias("x"))
             .select("lang", "term", "lang_n", F.col("x.source").alias("source"), F.col("x.n").alias("n"))
             .join(groups.drop("p0"), ["lang", "source"])
             .withColumn("p", share("n", "total", "kept")))

    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(best).alias("rank"))

    terms = cells.select("lang", "source", F.col("term").alias("item"),
                         (F.col("p") - share("lang_n", "lang_total", "kept")).alias("value")).where("value > 0")
    dealt = cells.select("lang", F.pmod(F.xxhash64("term"), "parts").alias("bucket"), "term", "idx", "p")
    sides = groups.where("sources > 1").select(          # columns of their own beside those of ``cells``
        F.col("lang").alias("lang"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("bucket"),
        F.col("idx").alias("idx"), F.col("source").alias("source"), F.col("p0").alias("p0"))
    sums = (dealt.groupBy("lang", "bucket").cogroup(sides.groupBy("lang", "bucket"))
            .applyInArrow(_partial(CELLS), "lang string, a string, b string, value bigint")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    pairs = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"),
                        "value").select("lang", "x.source", "x.item", "value")
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))


def report(docs: DataFrame) -> DataFrame:
    return audit(docs)
