"""Screened-symbol documents (S11-S13, K5): polymorphic JSON read as VARIANT.

A document may carry its symbols under ``symbols`` / ``selected_symbols`` /
``top_symbols`` (strings), under ``pairs`` / ``selected_pairs`` /
``cointegrated_pairs`` (strings or objects with ``symbol``, ``pair`` or a leg
pair ``symbol1|base|s1`` + ``symbol2|quote|s2``), nested under ``data``, or be
a bare list.  Each file is parsed by ``try_parse_json`` on the executors; the
symbol list is exploded with positions and de-duplicated keeping the first
position (a grouped min, no ordering task).  Files that are not one JSON
document are read again as JSON lines, skipping bad lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The key names the reader accepts, in priority order.
SYMBOL_KEYS = ("symbols", "selected_symbols", "top_symbols")
PAIR_KEYS = ("pairs", "selected_pairs", "cointegrated_pairs")
LEG1_KEYS = ("symbol1", "base", "s1")
LEG2_KEYS = ("symbol2", "quote", "s2")


def _is_str(v: str) -> str:
    return f"(schema_of_variant({v}) = 'STRING')"


def _str(v: str) -> str:
    return f"variant_get({v}, '$', 'string')"


def _field(v: str, key: str) -> str:
    return f"try_variant_get({v}, '$.{key}', 'variant')"


def _first_truthy(v: str, keys) -> str:
    """Value of the first key whose value is present and not empty/false/zero."""
    fields = ", ".join(_field(v, k) for k in keys)
    truthy = ("f IS NOT NULL AND NOT is_variant_null(f) AND "
              "coalesce(try_variant_get(f, '$', 'string'), 'x') NOT IN ('', 'false', '0', '0.0', '[]', '{}')")
    return f"try_element_at(filter(array({fields}), f -> {truthy}), 1)"


def _symbols_of_list(arr: str) -> str:
    """array<variant> of pair entries -> array<string> of symbols."""
    s1, s2 = _first_truthy("x", LEG1_KEYS), _first_truthy("x", LEG2_KEYS)
    one = (f"CASE WHEN {_is_str('x')} THEN array({_str('x')}) "
           f"WHEN schema_of_variant(x) LIKE 'OBJECT%' THEN CASE "
           f"WHEN {_is_str(_field('x', 'symbol'))} THEN array({_str(_field('x', 'symbol'))}) "
           f"WHEN {_is_str(_field('x', 'pair'))} THEN array({_str(_field('x', 'pair'))}) "
           f"ELSE filter(array(CASE WHEN {_is_str(s1)} THEN {_str(s1)} END, "
           f"CASE WHEN {_is_str(s2)} THEN {_str(s2)} END), y -> y IS NOT NULL) END "
           f"ELSE CAST(array() AS array<string>) END")
    return f"flatten(transform(coalesce({arr}, CAST(array() AS array<variant>)), x -> {one}))"


def _strings_of(arr: str) -> str:
    return (f"transform(filter(coalesce({arr}, CAST(array() AS array<variant>)), x -> {_is_str('x')}), "
            f"x -> {_str('x')})")


def _nonempty(*cands: str) -> str:
    """First non-empty array among candidates (empty array when none); each is evaluated once."""
    return (f"coalesce(try_element_at(filter(array({', '.join(cands)}), c -> size(c) > 0), 1), "
            f"CAST(array() AS array<string>))")


def _own_symbols(v: str) -> str:
    """Symbols a JSON object carries itself: symbol keys first, then pair keys."""
    as_arr = lambda key: f"try_variant_get({v}, '$.{key}', 'array<variant>')"
    return _nonempty(*[_strings_of(as_arr(k)) for k in SYMBOL_KEYS],
                     *[_symbols_of_list(as_arr(k)) for k in PAIR_KEYS])


def _array_symbols(v: str) -> str:
    bare = f"try_variant_get({v}, '$', 'array<variant>')"
    return (f"CASE WHEN forall(coalesce({bare}, CAST(array() AS array<variant>)), x -> {_is_str('x')}) "
            f"THEN {_strings_of(bare)} ELSE {_symbols_of_list(bare)} END")


def _level(doc: str, depth: int) -> str:
    """The value ``depth`` levels of ``data`` below a document (null when there is none)."""
    return f"try_variant_get({doc}, '${'.data' * depth}', 'variant')"


def data_depth(df: DataFrame, doc: str = "doc") -> int:
    """An upper bound of the ``data`` levels that the documents really have, a power of two: the
    first depth at which none has a value, asked of all documents in one small aggregate a doubling."""
    depth = 8
    while df.agg(F.expr(f"coalesce(bool_or({_level(doc, depth)} IS NOT NULL), false)")).first()[0]:
        depth *= 2
    return depth


def with_doc_symbols(df: DataFrame, doc: str = "doc", out: str = "symbols", depth: int | None = None) -> DataFrame:
    """Add ``out`` = the document's symbol list: of the document itself and the values below its
    ``data`` levels, the first list that isn't empty.  The levels are the elements of one array and
    the rule is one expression over it, so the plan doesn't grow with the keys of a document, and
    by one path a level with its depth (a list or scalar ends the levels: nothing is below it)."""
    depth = data_depth(df, doc) if depth is None else depth
    levels = ", ".join(_level(doc, d) for d in range(depth))
    rule = (f"CASE WHEN schema_of_variant(v) LIKE 'OBJECT%' THEN {_own_symbols('v')} "
            f"WHEN schema_of_variant(v) LIKE 'ARRAY%' THEN {_array_symbols('v')} "
            f"ELSE CAST(array() AS array<string>) END")
    lists = f"transform(filter(array({levels}), v -> v IS NOT NULL), v -> {rule})"
    first = f"try_element_at(filter({lists}, l -> size(l) > 0), 1)"
    return df.withColumn(out, F.expr(f"coalesce({first}, CAST(array() AS array<string>))"))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def read_screened(spark: SparkSession, path: str) -> DataFrame:
    """Symbols in first-appearance order (file, line, position) over all documents.
    Whole-file JSON first; files that do not parse are read as JSON lines; a
    missing file has no symbols."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "symbol string, file string, line_no long, pos int")
    files = (spark.read.text(path, wholetext=True)
             .select(F.input_file_name().alias("file"),
                     # wrapped in brackets so that trailing content (JSON lines, junk)
                     # fails the whole-document parse instead of being ignored
                     F.expr("try_variant_get(try_parse_json(concat('[', value, ']')), '$[0]', 'variant')")
                     .alias("doc")))
    whole = files.filter(F.col("doc").isNotNull())
    bad_files = files.filter(F.col("doc").isNull()).select("file")
    lines = (spark.read.text(path)
             .select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"),
                     F.expr("try_parse_json(trim(value))").alias("doc"))
             .join(bad_files, "file", "left_semi")
             .filter(F.col("doc").isNotNull()))
    docs = whole.select("file", F.lit(0).cast("long").alias("line_no"), "doc").unionByName(lines)
    exploded = with_doc_symbols(docs).select("file", "line_no", F.posexplode("symbols").alias("p", "symbol"))
    order = F.struct("file", "line_no", "p")
    firsts = exploded.groupBy("symbol").agg(F.min(order).alias("o"))
    return (firsts.select("symbol", F.col("o.file").alias("file"), F.col("o.line_no").alias("line_no"),
                          F.col("o.p").alias("pos"))
            .orderBy("file", "line_no", "pos"))


def load_screened(spark: SparkSession, path: str, fallback: DataFrame) -> DataFrame:
    """Parsed symbols, else the fallback universe (distinct symbols); error if both empty."""
    got = read_screened(spark, path)
    if not got.isEmpty():
        return got
    fb = fallback.select("symbol").distinct()
    if fb.isEmpty():
        raise RuntimeError("neither the symbol file nor the fallback universe names a symbol")
    return fb.select("symbol", F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("line_no"),
                     F.lit(None).cast("int").alias("pos"))


def read_pair_list(spark: SparkSession, path: str, bars: DataFrame, max_symbols: int | None = None,
                   lines: bool = False) -> DataFrame:
    """Symbols of {"pairs": [[a, b], ...]} (two-element entries only),
    distinct; without pairs or without the file, all symbols of the bars, or the
    first ``max_symbols`` in sorted order if the caller asks for a limit.
    ``lines``: such a document a line, as ``write_pair_list`` writes them."""
    if path_exists(spark, path):
        doc = spark.read.text(path, wholetext=not lines).select(F.expr("try_parse_json(value)").alias("doc"))
        pairs = doc.select(F.expr("try_variant_get(doc, '$.pairs', 'array<array<string>>')").alias("p"))
        syms = (pairs.select(F.explode(F.filter("p", lambda x: F.size(x) == 2)).alias("pr"))
                .select(F.explode("pr").alias("symbol")).filter(F.col("symbol").isNotNull()).distinct())
        if not syms.isEmpty():
            return syms
    universe = bars.select("symbol").distinct()
    return universe if max_symbols is None else universe.orderBy("symbol").limit(max_symbols)


def write_pair_list(pairs: DataFrame, path: str) -> str:
    """Pairs (sym_a, sym_b) as JSON lines from Spark's partitions, a pair a line; no list of
    all pairs is gathered."""
    (pairs.select(F.array(F.array("sym_a", "sym_b")).alias("pairs")).write.mode("overwrite").json(path))
    return path
