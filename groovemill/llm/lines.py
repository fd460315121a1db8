"""Line dedup across documents by range-partitioned hashes, in DataFrame operations only."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, ascii_lower, documents, guarded, let, staged

MIN_CHARS = 20
MIN_DOCS = 3
#: A key with about this many lines is counted by partial sums instead of being streamed in one partition.
HOT_LINES = 2_000
#: Items that the frequent-items sketch tracks; no key outside the hot ones holds more than about 1 / (0.75 * this) of all lines.
HOT_TRACKED = 8_192
HOT_KEYS = 4_096
NULL_DOC = -(2**63)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each line whose key is long enough: key hash h1, h2, document d and t, position."""
    lower = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    key = lambda x: let(F.btrim(x, F.lit(SPACES)), lambda k: F.when(F.length(k) >= min_chars, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2"))))
    keyed = docs.select(doc_key(), text_key(), F.posexplode(F.transform(F.split(lower, "\n"), key)).alias("position", "key"))
    return keyed.filter(F.col("key").isNotNull()).select("key.h1", "key.h2", "d", "t", "position")


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("d")


def text_key() -> Column:
    return F.xxhash64("text").alias("t")


def dropped_lines(occ: DataFrame, min_docs: int = MIN_DOCS, hot_lines: int = HOT_LINES) -> DataFrame:
    """(d, t, position) of the lines to drop.

    Hashes are range-partitioned and sorted by document, largest first, and position; a window streams each key and
    marks what isn't in the first document. Keys that a frequent-items sketch over all lines finds to be hot would
    stand in one partition: those are counted by partial sums, at most HOT_KEYS of them, and looked up by broadcast.
    """
    spark = occ.sparkSession
    sketch = occ.agg(F.expr(f"approx_top_k(h1, {HOT_KEYS}, {HOT_TRACKED})").alias("top")).first()
    hot = sorted({x["item"] for x in (sketch.top or []) if x["count"] >= hot_lines})
    cold = occ
    found = None
    if hot:
        keys = F.broadcast(spark.range(1, numPartitions=1).select(F.explode(F.from_json(F.lit(json.dumps(hot)), "array<long>")).alias("hot")))
        cold = occ.join(keys, F.col("h1") == F.col("hot"), "left_anti")
        warm = occ.join(keys, F.col("h1") == F.col("hot"), "left_semi")
        total = warm.groupBy("h1", "h2", "d").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("d").alias("keeper"))
        total = F.broadcast(total.filter(F.col("n_docs") >= min_docs).withColumnsRenamed({"h1": "k1", "h2": "k2"}))
        found = warm.join(total, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))).filter(F.col("d") != F.col("keeper")).select("d", "t", "position")
    by = Window.partitionBy("h1", "h2")
    stream = by.orderBy(F.col("d").desc(), "t", "position")
    cold = cold.repartitionByRange("h1", "h2")
    new = F.lag("d").over(stream).isNull() | (F.lag("d").over(stream) != F.col("d"))
    cold = cold.withColumn("new", new.cast("int")).withColumn("n_docs", F.sum("new").over(by)).withColumn("keeper", F.max("d").over(by))
    cold = cold.filter((F.col("n_docs") >= min_docs) & (F.col("d") != F.col("keeper"))).select("d", "t", "position")
    return cold if found is None else cold.unionByName(found)


def bitmaps(dropped: DataFrame) -> DataFrame:
    """(d, t, keep_bitmap, n_dropped): the run-length form of a document's keep bitmap, the ascending positions at which
    its bits change, the first bit being keep."""

    def runs(p: Column) -> Column:
        starts = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1) != x - 1, F.lit(True)))
        ends = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) != x + 1, F.lit(True)))
        return F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b + 1)))

    out = dropped.groupBy("d", "t").agg(F.collect_set("position").alias("p"))
    return out.select("d", "t", let(F.sort_array("p"), runs).alias("keep_bitmap"), F.size("p").cast("long").alias("n_dropped"))


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot_lines: int = HOT_LINES) -> DataFrame:
    """Keep bitmaps of the documents that lose lines.

    A key is a line stripped of blanks with A-Z lower-cased; keys of at least min_chars code points in at least min_docs
    documents lose all their lines except in the largest doc_id. Rows with one doc_id are one document; each of its
    texts has a bitmap. Null doc_ids together are one document, smaller than all others. Null text is one empty line.
    """
    return bitmaps(dropped_lines(staged(occurrences(docs, min_chars), "lines"), min_docs, hot_lines))


def keep_lines(lines: Column, bitmap: Column) -> Column:
    """The text of the kept lines; a null bitmap keeps all."""
    froms = F.concat(F.array(F.lit(0)), F.filter(bitmap, lambda x, i: i % 2 == 1))
    upto = F.concat(F.filter(bitmap, lambda x, i: i % 2 == 0), F.array(F.size(lines)))
    kept = F.flatten(F.zip_with(froms, upto, lambda a, b: F.slice(lines, a + 1, b - a)))
    return F.array_join(F.when(bitmap.isNull(), lines).otherwise(kept), "\n")


def dedup_lines(docs: DataFrame, **rules) -> DataFrame:
    """docs with gm_kept, the text without dropped lines, and gm_dropped, their number; see line_bitmaps()."""
    own, back = guarded(docs, "doc_id", "text")
    out = own.select("*", doc_key(), text_key()).join(line_bitmaps(own, **rules), ["d", "t"], "left")
    kept = F.when(F.col("keep_bitmap").isNull(), F.coalesce("text", F.lit(""))).otherwise(let(split_lines(F.col("text")), lambda x: keep_lines(x, F.col("keep_bitmap"))))
    return back(out.withColumns({"gm_kept": kept, "gm_dropped": F.coalesce("n_dropped", F.lit(0)).cast("long")}), "gm_kept", "gm_dropped")


def op9(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = dedup_lines(docs)
    text = F.coalesce("text", F.lit(""))
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + F.lit(1)
    return out.select("doc_id", n_lines.cast("long").alias("n_lines"), F.col("gm_dropped").alias("n_dropped"), F.sha2("gm_kept", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), x AS (
  SELECT doc_id, i, l[i] AS line,
         translate(regexp_replace(l[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)
), r AS (
  SELECT k, max(doc_id) AS keeper FROM x WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT x.doc_id, count(*)::BIGINT AS n_lines, count(r.k)::BIGINT AS n_dropped,
       sha256(coalesce(array_to_string(list(line ORDER BY i) FILTER (WHERE r.k IS NULL), chr(10)), '')) AS kept_sha256
FROM x LEFT JOIN r ON x.k = r.k AND x.doc_id <> r.keeper GROUP BY x.doc_id
"""
