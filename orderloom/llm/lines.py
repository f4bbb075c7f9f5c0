"""Lines that many documents share: exploded, hashed, counted per document, dropped, and the rest put together by position.

Native DataFrame code.

1. Every line's key (stripped, A-Z lower-cased) becomes a 128-bit hash with the document and the position; texts stay behind.
2. The distinct documents of each hash are counted; both phases combine in the map tasks, and a hot hash is split by document.
3. Lines of hashes at or above the threshold go.  The join that finds them broadcasts only hashes that hold a
   fixed share of all lines, of which there is a bounded number; see ``join_weighted``.
4. A document's dropped positions, in order, cut its lines into the runs that stay.

Defined cases: a null or empty text is one empty line; lines with keys below ``least_chars`` stay; rows of equal id and
text are one document for the counts, and each of them is returned; rows of null id are told apart by their text; a document may
lose all lines and is then empty; an empty table gives an empty one; other columns pass through untouched.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Stored, free_name, join_weighted

LEAST_DOCUMENTS, LEAST_CHARS = 10, 1
BLANK = " \t\n\x0b\f\r"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.transform(F.split(lower, "\n", -1), lambda line: F.trim(line, F.lit(BLANK)))


def _document(key: Column, text: Column) -> list[Column]:
    """128 bits that name the rows of one id and text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(key, whole).alias("d1"), F.xxhash64(F.lit(1), key, whole).alias("d2")]


def hashed_lines(docs: DataFrame, key: str, text: str, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``d1, d2, at, h1, h2``: one row per line whose key is long enough."""
    lines = docs.select(*_document(F.col(key), F.col(text)), F.posexplode(line_keys(F.col(text))).alias("at", "line"))
    return lines.where(F.length("line") >= least_chars).select(
        "d1", "d2", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def common_lines(lines: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``h1, h2, documents, rows`` of hashes found in enough documents."""
    counts = lines.groupBy("h1", "h2").agg(F.count_distinct("d1", "d2").alias("documents"), F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("documents") >= least_documents)


def drop_common_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_documents: int = LEAST_DOCUMENTS,
                      least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` without their common lines, and ``n_lines``, ``n_dropped`` (with ``_`` appended while a column is called so)."""
    lines = Stored(hashed_lines(docs, key, text, least_chars), "lines").df
    common = Stored(common_lines(lines, least_documents), "common-lines").df
    found = join_weighted(lines, common, ["h1", "h2"], "rows", lines.count())
    dropped = found.groupBy("d1", "d2").agg(F.sort_array(F.collect_set("at")).alias("_dropped"))
    # The lines are split below the join: above it they would be split again for every run.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text])
    whole = docs.select(row.alias("_row"), lines_of(F.col(text)).alias("_lines"), *_document(F.col(key), F.col(text)))
    joined = whole.join(dropped, ["d1", "d2"], "left").withColumn(
        "_dropped", F.coalesce("_dropped", F.array().cast("array<int>")))
    gone, n = F.col("_dropped"), F.size("_lines")

    def run(k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(gone, k - 1) + 1)
        return F.slice("_lines", start + 1, F.coalesce(F.get(gone, k), n) - start)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run)), "\n")
    columns = [kept.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return joined.select(*columns, n.cast("long").alias(free_name("n_lines", docs.columns)),
                         F.size(gone).cast("long").alias(free_name("n_dropped", docs.columns)))
