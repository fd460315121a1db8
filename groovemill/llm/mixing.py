"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, guarded, sized, staged, word_count

#: Documents a bucket holds on average; a source's fractional share is drawn within each of its buckets.
BUCKET_DOCS = 65_536
SEED = "mix-1"


def _order(seed: str):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """One row per source: n_docs, source_size, weight and target.

    Sources by code point, null last, take the weights in turn. The targets share the total of all sizes by weight;
    a source whose share exceeds max_epochs times its size is clamped there and the excess goes to the others by weight,
    again and again until none exceeds. Each round is one aggregation over the table of sources that returns one row.
    A source of size 0 gets 0; no rows give no rows.
    """
    by = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    by = staged(by.withColumn("weight", F.element_at(kinds, (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))), "mix-sources")
    cap = F.col("source_size") * max_epochs
    level, clamped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * level
        row = by.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(full, cap).otherwise(0)).alias("clamped_size"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free_weight"),
            F.count_if(full).alias("n"),
        ).first()
        if row.n == clamped or not row.free_weight:
            break
        clamped, level = row.n, (row.total - row.clamped_size) / row.free_weight
    return by.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


def mix_plan(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(sources, cuts) for sizes(doc_id, source, size): source_targets() with whole and n_buckets, and for each source and
    bucket the seeded place `cut` up to which its documents get one repetition more."""
    src = source_targets(sizes, weights, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    src = src.withColumn("whole", F.floor(rate)).withColumn("part", rate - F.floor(rate))
    src = src.withColumn("n_buckets", F.ceil(F.col("n_docs") / F.lit(BUCKET_DOCS)))
    placed = _placed(sizes, src, seed).filter(F.col("part") > 0)
    by = Window.partitionBy("source", "bucket")
    ties = placed.groupBy("source", "bucket", "place", "part").agg(F.sum("size").alias("tied"))
    ties = ties.withColumn("upto", F.sum("tied").over(by.orderBy("place"))).withColumn("in_bucket", F.sum("tied").over(by))
    left = F.floor(F.col("part") * F.col("in_bucket") + 0.5)
    cuts = ties.filter(F.col("upto") > left).groupBy("source", "bucket").agg(F.min_by(F.struct(F.col("place").alias("cut"), (left - F.col("upto") + F.col("tied")).alias("cut_words"), F.col("tied").alias("cut_size")), "place").alias("c"))
    return src, staged(cuts.select("source", "bucket", "c.*"), "mix-cuts")


def _placed(rows: DataFrame, src: DataFrame, seed: str) -> DataFrame:
    """rows with their source's columns, bucket and place."""
    src = sized(src.withColumnRenamed("source", "mix_source"))
    out = rows.join(src, rows["source"].eqNullSafe(src["mix_source"])).drop("mix_source").withColumn("place", _order(seed))
    return out.withColumn("bucket", F.pmod(F.conv(F.substring("place", 1, 8), 16, 10).cast("long"), F.col("n_buckets")))


def mix(rows: DataFrame, sizes: DataFrame | None = None, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3, seed: str = SEED) -> DataFrame:
    """rows(doc_id, source, size, ...) with source_size, target and taken: the words of the document that the mix takes.

    A document is taken floor(target / source_size) times whole; the fractional rest of a source is met by one
    repetition more of documents in an order seeded by doc_id, and a fraction of the document at which it is reached,
    so taken differs from the target by a word for each bucket of about BUCKET_DOCS documents. The order of rows and the
    partitions don't matter, so reruns agree. Rows that tie (one doc_id) share that fraction by size. Null doc_ids tie.
    Other columns stay, whatever their names; sizes, by default rows, may be a narrower table of the same rows.
    """
    src, cuts = mix_plan((rows if sizes is None else sizes).select("doc_id", "source", "size"), weights, max_epochs, seed)
    own, back = guarded(rows, "doc_id", "source", "size")
    out = _placed(own, src, seed)
    cuts = sized(cuts.withColumnsRenamed({"source": "cut_source", "bucket": "cut_bucket"}))
    out = out.join(cuts, out["source"].eqNullSafe(cuts["cut_source"]) & (out["bucket"] == cuts["cut_bucket"]), "left")
    more = (
        F.when((F.col("part") <= 0), 0)
        .when(F.col("cut").isNull() | (F.col("place") < F.col("cut")), F.col("size"))
        .when(F.col("place") == F.col("cut"), F.floor(F.col("cut_words") * F.col("size") / F.col("cut_size")))
        .otherwise(0)
    )
    return back(out.withColumn("taken", (F.col("whole") * F.col("size") + more).cast("long")), "source_size", "target", "taken")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sizes = staged(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    return mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS MATERIALIZED (
  SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size,
         ([1.0, 2.0, 3.0])[((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM d GROUP BY source
), o AS (
  SELECT 3 * source_size / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT s.*, least((3 * source_size)::DOUBLE, weight * (SELECT level::DOUBLE FROM o WHERE ratio > level ORDER BY ratio LIMIT 1)) AS target FROM s
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
         ceil(n_docs / 65536.0)::BIGINT AS n_buckets FROM t
), p AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target, floor(rate) AS whole, rate - floor(rate) AS part,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS place,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % n_buckets AS bucket
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), q AS (
  SELECT *, sum(size) OVER (PARTITION BY source, bucket) AS in_bucket,
         sum(size) OVER (PARTITION BY source, bucket ORDER BY place) AS upto,
         sum(size) OVER (PARTITION BY source, bucket, place) AS tied FROM p
)
SELECT doc_id, size, source_size, target,
       (whole * size + CASE WHEN part <= 0 OR size = 0 THEN 0
          ELSE greatest(0, least(size, floor((floor(part * in_bucket + 0.5) - upto + tied) * size / tied))) END)::BIGINT AS taken
FROM q
"""
