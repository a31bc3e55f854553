"""Personal data: base patterns and information-theoretic sanitisation.  DataFrame
functions only.

Base spans are the matches of four patterns (email, ip, card, phone) that pass
their checks; offsets are code points, end exclusive.  The patterns below are the
stated ones, written with possessive repeats and a start condition so that a
long run of digits or letters is scanned once and needs no recursion; they match
the same text.

A base value is a protected entity.  A term (a word outside the base spans of a
text that holds the entity, however far from it) discloses it if, over the
distinct texts of the whole corpus, the entity and the term occur together in at
least ``MIN_SUPPORT`` texts and the surprise of the entity given the term,
-log2 P(entity | term), is at most ``MAX_BITS`` bits, while without the term it is
larger by ``MIN_GAIN`` bits.  All counts are exact.
Every occurrence of such a term outside base spans is marked (kind ``term``) in the
texts that hold the entity, and ``sanitise`` replaces them and the base spans by
their kind; texts without personal data are left as they are.

Entities of too few texts to reach the support, or of too many to leave the gain,
can't be disclosed; only texts with another entity have their words cut.  Entities
found in the same texts are one class, as are terms of the same texts (exclusive or
of two hashes of their texts, and their number); co-occurrence is counted between
classes, so a group of near copies makes one pair of classes, not a pair for each
entity and term.  A term found in too many of the texts of one part of ``PARTS`` (by
digest) can't meet the threshold whatever the others hold; the rest are counted
over all texts.

Cases: null and empty texts have no spans; repeated rows are judged alike; exact
copies count as one text in the statistics; overlapping spans are replaced as
one; a word that overlaps a base span is part of it and not marked again; very long
texts are cut into words whole, by segments of ``SEGMENT`` words; an empty table
gives an empty result; extra columns are kept by ``sanitise`` and ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import digest_of, saved, sized

KINDS = ("email", "ip", "card", "phone", "term")
MIN_SUPPORT = 3
MAX_BITS = 1.0
MIN_GAIN = 2.0
SEGMENT = 256
PARTS = 16

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: cheap conditions without which a pattern cannot have a valid match
HINTS = {
    "email": lambda t: F.instr(t, "@") > 0,
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
    "phone": lambda t: F.instr(t, "+") > 0,
}
WORD = r"[0-9A-Za-z\u0080-\uFFFF]++"
WORD_GAP = r"[^0-9A-Za-z\u0080-\uFFFF]+"

_FOUND = "array<struct<k:int,s:bigint,e:bigint,v:string>>"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    d = F.split(F.reverse(_digits(v)), "")

    def add(total, i):
        x = F.element_at(d, i).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.size(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: p.rlike(r"^0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    n = F.length(_digits(v))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(v)).otherwise(False)
    return n.between(8, 15)


def _passes(kind: str):
    return lambda x: _valid(kind, x["v"])


def _of_kind(i: int):
    return lambda x: x["k"] == i


def _placed(text: Column, pattern: str, kind: int, offset: Column) -> Column:
    """All matches with their offsets: the text between matches gives the distances."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("bigint"))
    empty = F.array().cast(_FOUND)
    start = F.struct(offset.cast("bigint").alias("at"), empty.alias("out"))

    def step(acc, x):
        s = acc["at"] + x["gaps"]
        e = s + F.length(x["found"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(
            F.struct(F.lit(kind).alias("k"), s.alias("s"), e.alias("e"), x["found"].alias("v")))).alias("out"))

    pairs = F.filter(F.arrays_zip(found.alias("found"), gaps.alias("gaps")), lambda x: x["found"].isNotNull())
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def base_spans(text: Column) -> Column:
    """Valid base spans: array of (k, s, e, v) in the order of kinds, then start."""
    t = F.coalesce(text, F.lit(""))
    parts = []
    for i, kind in enumerate(KINDS[:4]):
        here = F.filter(_placed(t, PATTERNS[kind], i, F.lit(0)), _passes(kind))
        parts.append(F.when(HINTS[kind](t), here).otherwise(F.array().cast(_FOUND)))
    return F.concat(*parts)


def _entity(x: Column) -> Column:
    """Normal form of a protected value, with its kind."""
    plain = F.when(x["k"] == 0, F.lower(x["v"])).when(x["k"] == 1, x["v"]).otherwise(_digits(x["v"]))
    return F.concat_ws(":", x["k"].cast("string"), plain)


def find_base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, key, base) of every row; the key only where there are spans."""
    step = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       base_spans(F.col(text_col)).alias("base"))
    return step.select("doc_id", digest_of(F.col("text")).alias("digest"),
                       F.when(F.size("base") > 0, F.md5("text")).alias("key"), "base")


def _classed(rows: DataFrame, name: str, n: str) -> DataFrame:
    """(name, class, n) of (key, name) rows: values of the same keys are of one class."""
    first, second = F.bit_xor(F.xxhash64("key")), F.bit_xor(F.xxhash64("key", F.lit(n)))
    return (rows.groupBy(name).agg(F.count("*").alias(n), first.alias("x"), second.alias("y"))
            .select(name, n, F.concat_ws(":", n, "x", "y").alias(f"{name}_class")))


def _occurrences(docs: DataFrame, texts: DataFrame, keys: DataFrame, text_col: str) -> DataFrame:
    """(key, t, s, e): every word outside the base spans of the distinct texts (key, base) that ``keys`` names."""
    rows = docs.select(F.md5(text_col).alias("key"), F.col(text_col).alias("text"))
    rows = rows.join(keys.select("key"), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    segment = f"(?:{WORD}(?:{WORD_GAP})?+){{1,{SEGMENT}}}+"
    parts = rows.join(texts, "key").select("key", "base", F.explode(_placed(F.col("text"), segment, 4, F.lit(0))).alias("p"))
    close = F.filter("base", lambda b: (b["s"] < F.col("p.e")) & (F.col("p.s") < b["e"]))
    parts = parts.select("key", "p", close.alias("close"))
    free = F.filter(_placed(F.col("p.v"), WORD, 4, F.col("p.s")),
                    lambda w: ~F.exists("close", lambda b: (b["s"] < w["e"]) & (w["s"] < b["e"])))
    return (parts.select("key", F.explode(free).alias("w"))
            .select("key", F.lower("w.v").alias("t"), F.col("w.s").alias("s"), F.col("w.e").alias("e")))


def _texts_with(docs: DataFrame, terms: DataFrame, text_col: str, kept: Column) -> DataFrame:
    """(t, n_all): distinct texts that hold a term, of those of a condition."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text_col, F.lit(""))), WORD_GAP))
    each = docs.where(kept).select(digest_of(F.col(text_col)).alias("digest"), F.explode(words).alias("t"))
    return each.join(terms.select("t"), "t", "left_semi").distinct().groupBy("t").agg(F.count("*").alias("n_all"))


def term_spans(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(key, extra): spans of disclosing terms by text."""
    total = float(found.select("digest").distinct().count())
    dirty = found.where("key IS NOT NULL").groupBy("key").agg(F.first("base").alias("base"))
    held = dirty.select("key", F.explode("base").alias("x")).select("key", _entity(F.col("x")).alias("v")).distinct()
    able = _classed(held, "v", "n_v").where((F.col("n_v") >= MIN_SUPPORT) & (F.col("n_v") * 2 ** MIN_GAIN <= total))
    owners = sized(held.join(able, "v").select("key", "v_class", "n_v").distinct(), "owners")

    places = sized(_occurrences(docs, dirty, owners, text_col), "places")
    words = places.select("key", "t").distinct()
    enough = _classed(words, "t", "n_here").where(F.col("n_here") >= MIN_SUPPORT)
    members = sized(words.join(enough, "t"), "members")                    # key, t, n_here, t_class

    # n_here texts hold the term among those with an entity, so it is in that many of the corpus at least
    pairs = (owners.join(members.select("key", "t_class", "n_here").distinct(), "key")
             .where(F.col("n_here") <= F.col("n_v") * 2 ** MAX_BITS))
    together = (pairs.groupBy("v_class", "t_class", "n_v", "n_here").agg(F.count("*").alias("n_vt"))
                .where((F.col("n_vt") >= MIN_SUPPORT) & (F.col("n_here") <= F.col("n_vt") * 2 ** MAX_BITS)))
    together = sized(together, "together")

    most = together.groupBy("t_class").agg((F.max("n_vt") * 2 ** MAX_BITS).alias("most"))
    asked = sized(members.join(most, "t_class").select("t", "t_class", "n_here", "most").distinct(), "asked")
    some = _texts_with(docs, asked, text_col, F.pmod(digest_of(F.col(text_col)), F.lit(PARTS)) == 0)
    some = some.withColumnRenamed("n_all", "n_some")
    asked = sized(asked.join(some, "t", "left").where(F.coalesce("n_some", F.lit(0)) <= F.col("most"))
                  .select("t", "t_class", "n_here"), "rare")
    seen = _texts_with(docs, asked, text_col, F.lit(True))
    counted = sized(asked.join(seen, "t", "left").select("t", "t_class", F.greatest("n_all", "n_here").alias("n_t")), "counted")

    # P(v | t) = n_vt / n_t against 2^-MAX_BITS, and against P(v) = n_v / total times 2^MIN_GAIN
    telling = (together.join(counted.select("t_class", "n_t").distinct(), "t_class")
               .where((F.col("n_t") <= F.col("n_vt") * 2 ** MAX_BITS)
                      & (F.col("n_t") * F.col("n_v") * 2 ** MIN_GAIN <= F.col("n_vt") * F.lit(total)))
               .select("v_class", "t_class", "n_t"))
    marked = pairs.select("key", "v_class", "t_class").join(telling, ["v_class", "t_class"])
    marked = (members.select("key", "t", "t_class").join(counted, ["t", "t_class"])
              .join(marked.select("key", "t_class", "n_t"), ["key", "t_class", "n_t"], "left_semi").select("key", "t"))
    span = F.struct(F.lit(4).alias("k"), F.col("s"), F.col("e"))
    return (places.join(marked, ["key", "t"], "left_semi")
            .groupBy("key").agg(F.array_sort(F.collect_set(span)).alias("extra")))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


_SPAN = "array<struct<k:int,s:bigint,e:bigint>>"


def _bare(base: Column) -> Column:
    return F.transform(base, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and spans of every document."""
    found = saved(find_base(docs, id_col, text_col))
    extra = term_spans(docs, found, text_col)
    rows = found.where("key IS NOT NULL").join(extra, "key", "left").select("doc_id", "base", "extra")
    rows = rows.unionByName(found.where("key IS NULL").select("doc_id", "base", F.lit(None).cast(_SPAN).alias("extra")))
    count = [F.size(F.filter("base", _of_kind(i))).cast("bigint").alias(f"n_{k}")
             for i, k in enumerate(KINDS[:4])]
    every = F.concat(_bare(F.col("base")), F.coalesce("extra", F.array().cast(_SPAN)))
    return rows.select("doc_id", *count, F.sha2(_joined(_bare(F.col("base"))), 256).alias("base_sha256"),
                       _joined(every).alias("spans"),
                       F.coalesce(F.size("extra"), F.lit(0)).cast("bigint").alias("n_term"))


def _masked(text: Column, spans: Column) -> Column:
    """Text with every span replaced by its kind; overlapping spans count as one."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        put = F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int")),
                       F.element_at(names, x["k"] + 1))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"),
                        F.when(x["s"] >= acc["at"], put).otherwise(acc["out"]).alias("out"))

    return F.aggregate(order, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns; base spans and disclosing terms replaced by their kind."""
    found = saved(find_base(docs, id_col, text_col))
    extra = term_spans(docs, found, text_col)
    with_base = docs.withColumn("__base", base_spans(F.col(text_col)))
    plain = with_base.where(F.size("__base") == 0).drop("__base")
    dirty = (with_base.where(F.size("__base") > 0).withColumn("__key", F.md5(F.col(text_col)))
             .join(extra.select(F.col("key").alias("__key"), F.col("extra").alias("__extra")), "__key", "left"))
    spans = F.concat(_bare(F.col("__base")), F.coalesce("__extra", F.array().cast(_SPAN)))
    dirty = dirty.withColumn(text_col, _masked(F.col(text_col), spans))
    if length_col in docs.columns:
        dirty = dirty.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return plain.unionByName(dirty.select(*docs.columns))
