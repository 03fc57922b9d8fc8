"""Per-document word rules and cross-document line frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept, session

#: ASCII white space, as a character class.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
#: Documents with fewer words fail.
MIN_WORDS = 50
#: A document fails if more than this percentage of its words lies in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
#: A line is boilerplate of its host if it occurs in more distinct documents than this, however many the host has ...
LINE_DOCS = 5
#: ... a line of more words than LONG_LINE in more than LONG_DOCS ...
LONG_LINE, LONG_DOCS = 50, 2
#: ... and if more than this share of these documents differ beside it: the lines of near copies are no boilerplate.
LINE_APART = 0.8
#: Lines of fewer words are not judged: in a large host they recur by chance.
LINE_WORDS = 5
#: Orders of a document's lines, each by other digits of their digest: the first other line is what stands beside a line.
ORDERS = 4
#: A document is depleted if boilerplate lines hold more than this share of its words, or leave fewer than MIN_WORDS.
MAX_LOST_SHARE = 0.5


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def _normal(line: Column) -> Column:
    """A line as it is compared: lower case, digits as 0, one space between words."""
    small = F.regexp_replace(F.lower(line), "[0-9]", "0")
    return F.regexp_replace(F.regexp_replace(small, SPACE + "+", " "), "^ | $", "")


def text_rules(df: DataFrame, text: Column) -> DataFrame:
    """``df`` plus ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    All row by row. Windows are compared by their 64-bit hash. Their positions are only ordered
    by hash where some hash repeats; sorting keeps very long texts at n log n.
    """
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE + "+", "")) > 0)
    df = df.select("*", _words(text).alias("__w"), lines.alias("__lines"), text.alias("__t"))
    n = F.size("__w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.arrays_zip(
                F.slice("__w", 1, n - 2).alias("a"), F.slice("__w", 2, n - 2).alias("b"), F.slice("__w", 3, n - 2).alias("c")
            ),
            lambda x: F.xxhash64(x["a"], x["b"], x["c"]),
        ),
    )
    df = df.select("*", windows.alias("__h"))
    placed = F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.sort_array(F.arrays_zip(F.col("__h").alias("h"), F.sequence(F.lit(0), F.size("__h") - 1).alias("p"))),
    )
    df = df.select("*", placed.alias("__s"))
    size = F.size("__s")
    neighbours = F.arrays_zip(
        F.col("__s").alias("own"),
        F.concat(F.array(F.lit(None)), F.slice("__s", 1, F.greatest(size - 1, F.lit(0)))).alias("before"),
        F.slice("__s", 2, F.greatest(size, F.lit(0))).alias("after"),
    )
    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    again = F.filter(neighbours, lambda x: same(x["own"], x["before"]) | same(x["own"], x["after"]))
    df = df.select("*", F.sort_array(F.transform(again, lambda x: x["own"]["p"])).alias("__p"))
    covered = F.aggregate(
        "__p",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    df = df.select(
        "*",
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("__t", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    ).drop("__w", "__lines", "__t", "__h", "__s", "__p")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _keyed(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Own columns only, so that nothing in ``docs`` can clash: id, host, text and the text's hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"), F.xxhash64(text).alias("text_key")
    )


def frequent_lines(docs: DataFrame, line_docs: int = LINE_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """``(host, h)`` of lines in more distinct documents of their host than the limits, whatever the host's size.

    ``docs`` has ``host, text, text_key``. Equal texts are one document, so that a group of copies does not turn its
    own lines into boilerplate. A document adds each of its lines once. Lines of fewer than LINE_WORDS words are left out.
    """
    found = F.filter(F.transform(F.split("text", "\n"), _normal), lambda x: F.size(F.split(x, " ")) >= LINE_WORDS)
    marked = F.transform(found, lambda x: F.struct(F.xxhash64(x).alias("h"), (F.size(F.split(x, " ")) > LONG_LINE).alias("long")))
    each = docs.select("host", "text_key", F.explode_outer(F.array_distinct(marked)).alias("line")).where("line IS NOT NULL")
    each = each.select("host", "text_key", F.col("line.h").alias("h"), F.col("line.long").alias("long")).distinct()
    counts = each.groupBy("host", "h").agg(F.count("*").alias("n_docs"), F.max("long").alias("long"))
    often = (F.col("n_docs") > line_docs) | (F.col("long") & (F.col("n_docs") > long_docs))
    return kept(counts.where(often).select("host", "h"), "frequent-lines")


def line_hits(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``(doc_id, host, text_key, at, h, n, beside)`` of the places at which ``lines`` occur, with their ``n`` words.

    ``beside`` tells documents apart: for each of ORDERS orders the least digest among a document's other lines. Repeated
    rows give one. Texts are not moved.
    """
    normal = F.filter(F.transform(F.split("text", "\n"), _normal), lambda x: x != "")
    found = F.transform(normal, lambda x: F.struct(F.xxhash64(x).alias("h"), F.md5(x).alias("m"), F.size(F.split(x, " ")).alias("n")))
    whole = docs.select("doc_id", "host", "text_key", found.alias("lines"))
    digests = F.array_distinct(F.transform("lines", lambda x: x["m"]))
    least = [F.slice(F.sort_array(F.transform(digests, _digits_of(k))), 1, 2) for k in range(ORDERS)]
    whole = whole.select("*", F.array(*least).alias("least"))
    # Outer, as otherwise the planner adds a test that the exploded array is not empty, and makes it twice.
    each = whole.select("doc_id", "host", "text_key", "least", F.posexplode_outer("lines").alias("at", "line"))
    own = lines.select(F.col("host").alias("host_"), F.col("h").alias("h_"))
    hits = each.join(own, F.col("host").eqNullSafe(F.col("host_")) & (F.col("line.h") == F.col("h_")))
    beside = [
        F.when(F.get(F.col("least")[k], F.lit(0)) == _digits_of(k)(F.col("line.m")), F.get(F.col("least")[k], F.lit(1)))
        .otherwise(F.get(F.col("least")[k], F.lit(0)))
        for k in range(ORDERS)
    ]
    hits = hits.select("doc_id", "host", "text_key", "at", "line.h", "line.n", F.array(*beside).alias("beside"))
    return kept(hits.distinct(), "line-hits")


def _digits_of(order: int):
    """The digits of a digest that an order goes by."""
    return lambda digest: F.substring(digest, 1 + 8 * order, 8)


def boilerplate_lines(hits: DataFrame) -> DataFrame:
    """``(host, h)`` of the lines in ``hits`` that are no near copies' own.

    In near copies the line beside another is the same one in most of them, by any order; documents that only share some
    lines differ, at least by an order that does not put one of the shared lines first.
    """
    sides = [F.count_distinct(F.coalesce(F.col("beside")[k], F.lit(""))).alias(f"n{k}") for k in range(ORDERS)]
    counts = hits.groupBy("host", "h").agg(F.count_distinct("text_key").alias("n_docs"), *sides)
    return counts.where(F.greatest(*[F.col(f"n{k}") for k in range(ORDERS)]) > LINE_APART * F.col("n_docs")).select("host", "h")


def lost_words(docs: DataFrame, line_docs: int = LINE_DOCS, long_docs: int = LONG_DOCS) -> DataFrame:
    """``(doc_id, host, text_key, lost, removed)`` of documents with boilerplate lines.

    ``lost`` counts the words in such lines, repeats included; ``removed`` holds their hashes. A
    document's lines are gathered only where they are boilerplate. Repeated rows give one row.
    """
    hits = line_hits(docs, frequent_lines(docs, line_docs, long_docs))
    lines = boilerplate_lines(hits).select(F.col("host").alias("host_"), F.col("h").alias("h_"))
    found = hits.join(lines, F.col("host").eqNullSafe(F.col("host_")) & (F.col("h") == F.col("h_")), "left_semi")
    return found.groupBy("doc_id", "host", "text_key").agg(F.sum("n").alias("lost"), F.collect_set("h").alias("removed"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return (
        a["doc_id"].eqNullSafe(b["doc_id"]) & a["host"].eqNullSafe(b["host"]) & (a["text_key"] == b["text_key"])
    )


def _judged(own: DataFrame, line_docs: int, long_docs: int, max_lost: float) -> DataFrame:
    """Rules and verdict per row of ``own``, with the hashes of boilerplate lines in ``removed``."""
    lost = lost_words(own, line_docs, long_docs)
    rules = text_rules(own, F.col("text")).drop("text")
    found = rules.join(lost, _same(rules, lost), "left")
    found = found.select(rules["*"], F.coalesce(lost["lost"], F.lit(0)).cast("long").alias("n_lost_words"), lost["removed"])
    left = F.col("n_words") - F.col("n_lost_words")
    depleted = (F.col("n_lost_words") > max_lost * F.col("n_words")) | (left < MIN_WORDS)
    return found.withColumn("kept", ~F.col("base_failed") & ~depleted)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    line_docs: int = LINE_DOCS,
    long_docs: int = LONG_DOCS,
    max_lost: float = MAX_LOST_SHARE,
) -> DataFrame:
    """One row per row of ``docs``: the text rules, ``n_lost_words`` and ``kept``.

    A document is kept unless the text rules fail it or boilerplate lines deplete it: they hold more than
    ``max_lost`` of its words or leave fewer than MIN_WORDS. Nulls: a null text has no words; a null host is a host of its own; a
    null id is carried along. Repeated rows are kept and judged alike, and count as one document in
    line frequencies. An empty table gives no rows. Other columns are ignored.
    """
    session(docs.sparkSession)
    own = _keyed(docs, id_col, text_col, host_col)
    return _judged(own, line_docs, long_docs, max_lost).drop("text_key", "removed")


def keep_good(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    length_col: str | None = "n_chars",
    line_docs: int = LINE_DOCS,
    long_docs: int = LONG_DOCS,
    max_lost: float = MAX_LOST_SHARE,
) -> DataFrame:
    """``docs`` without rejected documents and without boilerplate lines in the others.

    Columns stay as they are; ``length_col`` follows the shortened text where ``docs`` has it. Verdicts are a
    small table, written first, so that the rules are computed once; documents meet theirs in one
    merge join on id, host and text hash, the only step that moves texts. Nulls, repeated rows and empty tables as in
    ``quality_rules``; repeated rows stay or go together.
    """
    session(docs.sparkSession)
    verdicts = kept(_judged(_keyed(docs, id_col, text_col, host_col), line_docs, long_docs, max_lost), "verdicts")
    good = verdicts.where("kept").select("doc_id", "host", "text_key", "removed").dropDuplicates(["doc_id", "host", "text_key"])
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(row, F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.xxhash64(text).alias("text_key"))
    joined = rows.join(good.hint("merge"), _same(rows, good)).select("row", good["removed"])
    whole = F.col(f"row.`{text_col}`")
    stay = F.filter(F.split(whole, "\n"), lambda x: ~F.array_contains("removed", F.xxhash64(_normal(x))))
    out = joined.select("row", F.when(F.col("removed").isNull(), whole).otherwise(F.array_join(stay, "\n")).alias("short"))
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text_col:
            value = F.col("short")
        elif c == length_col:
            value = F.when(F.col("short") == whole, value).otherwise(F.length("short").cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return out.select(*columns)


#: The same result in DuckDB's SQL.
ORACLE = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT doc_id, host, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM d),
lines AS (
    SELECT DISTINCT host, text, unnest(list_transform(l, lambda x: trim(regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'),
        '[\x20\x09-\x0D]+', ' ', 'g'), ' '))) AS line FROM words),
often AS (
    SELECT host, line FROM (SELECT host, line, count(*) AS n_docs FROM lines GROUP BY host, line)
    WHERE (n_docs > 5 AND len(string_split(line, ' ')) >= 5) OR (n_docs > 2 AND len(string_split(line, ' ')) > 50)),
orders AS (SELECT unnest([1, 9, 17, 25]) AS k),
least AS (
    SELECT host, text, k, list_sort(list(substr(md5(line), k, 8)))[1:2] AS m FROM lines CROSS JOIN orders GROUP BY host, text, k),
beside AS (
    SELECT o.host, o.line, k, l.text, coalesce(CASE WHEN m[1] = substr(md5(o.line), k, 8) THEN m[2] ELSE m[1] END, '') AS other
    FROM often o JOIN lines l ON o.host = l.host AND o.line = l.line JOIN least ON least.host = l.host AND least.text = l.text),
common AS (
    SELECT DISTINCT host, line FROM (
        SELECT host, line, k, count(DISTINCT text) AS n_docs, count(DISTINCT other) AS n_apart FROM beside GROUP BY host, line, k)
    WHERE n_apart > 0.8 * n_docs),
each_line AS (
    SELECT doc_id, host, unnest(l) AS line FROM words),
lost AS (
    SELECT e.doc_id, sum(len(list_filter(regexp_split_to_array(e.line, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS n
    FROM each_line e JOIN common c ON e.host = c.host
        AND trim(regexp_replace(regexp_replace(lower(e.line), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') = c.line
    GROUP BY e.doc_id),
windows AS (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 3)),
again AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1),
repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
ruled AS (
    SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(lost.n, 0) AS BIGINT) AS n_lost_words
    FROM words LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM ruled)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lost_words, base_failed,
    NOT base_failed AND n_lost_words <= 0.5 * n_words AND n_words - n_lost_words >= 50 AS kept
FROM failed
"""
