"""Host-level quality rules with an empirical beta prior, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, documents, guarded, let, sized, staged

#: Words of a window in which repetition is looked for.
WINDOW = 8
#: The base rules' limits, and the characters counted as symbols.
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
#: A host is rejected if more than this share of its documents is expected to fail.
MAX_HOST_RATE = 0.5


def split_words(text: Column) -> Column:
    """The words of the text as an array; empty where there is none."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window that occurs twice or more. Windows are compared by hash; documents without a
    repeated window, most of them, end after one pass over a set."""

    def covered(h: Column) -> Column:
        def found(s: Column) -> Column:
            hit = F.filter(s, lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]))
            at = F.sort_array(F.transform(hit, lambda e: e["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
            step = lambda acc, x: F.struct((acc["n"] + x + window - F.greatest(x, acc["end"])).alias("n"), (x + window).alias("end"))
            return F.aggregate(at, start, step, lambda acc: acc["n"])

        return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), found)

    windows = let(F.transform(words, lambda w: F.xxhash64(w)), lambda v: F.transform(F.sequence(F.lit(1), F.size(v) - (window - 1)), lambda i: F.xxhash64(F.slice(v, i, window))))
    none_twice = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    return F.when(F.size(words) > window, let(windows, none_twice)).otherwise(F.lit(0))


def base_rules(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed.

    Null text has no words. Columns of docs with these names are replaced."""
    own, back = guarded(docs)
    text = F.coalesce(F.col(f"`{own.columns[docs.columns.index('text')]}`"), F.lit(""))
    out = own.select("*", text.alias("gm_text")).select("*", split_words(F.col("gm_text")).alias("gm_words"))
    bare = F.translate("gm_text", SPACES, "")
    lines = F.filter(F.split("gm_text", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    numbers = {
        "n_words": F.size("gm_words"),
        "word_chars": F.length(bare),
        "n_symbols": F.length("gm_text") - F.length(F.translate("gm_text", SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(F.col("gm_words")),
    }
    out = out.select(*own.columns, *[v.cast("long").alias(k) for k, v in numbers.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return back(out.withColumn("base_failed", failed), *numbers, "base_failed")


def host_verdicts(rows: DataFrame, host: str = "source", failed: str = "base_failed", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: n, n_failed, shrunk_rate and host_kept.

    Failures are summed by host; the beta prior has the rate of all documents as its mean, and its strength comes from how
    much the hosts' rates, weighted by their documents, vary beyond what counting explains. Each host's rate is
    shrunk towards the mean: hosts with few documents follow the prior. Where the hosts vary no more than by counting, the
    prior is as strong as all documents, so the same shares give the same verdicts at every size. A null host is a
    host of its own. One host alone, or hosts that all agree, give a prior of the mean rate.
    """
    by = staged(rows.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.count_if(failed).alias("n_failed")), "hosts")
    n, x = F.col("n").cast("double"), F.col("n_failed").cast("double")
    m = by.agg(F.sum(n).alias("n"), F.sum(x).alias("x"), F.sum(n * n).alias("nn"), F.sum(x * x / n).alias("xx"), F.count("*").alias("hosts")).first()
    total = m["n"] or 1.0
    mean = (m["x"] or 0.0) / total
    spread = mean * (1 - mean)
    # the share of variance between hosts, as weighted moments of a beta-binomial estimate it
    free = total - (m["nn"] or 0.0) / total - (m["hosts"] - 1)
    share = ((m["xx"] - m["x"] * mean) / spread - (m["hosts"] - 1)) / free if spread > 0 and free > 0 else 0.0
    strength = min(max(1 / share - 1, 1.0), total) if share > 0 else total
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return by.withColumn("shrunk_rate", shrunk).withColumn("host_kept", F.col("shrunk_rate") <= max_rate)


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """base_rules() of docs with kept: false if the document fails a base rule or its host is rejected. All rows stay."""
    rows = staged(base_rules(docs), "rules")
    hosts = sized(host_verdicts(rows, host, max_rate=max_rate).select(F.col("host").alias("gm_host"), F.col("host_kept").alias("gm_host_kept")))
    out = rows.join(hosts, F.col(host).eqNullSafe(F.col("gm_host")), "left")
    names = [f"`{c}`" for c in rows.columns if c != "kept"]
    return out.select(*names, (~F.col("base_failed") & F.col("gm_host_kept")).alias("kept"))


def op6(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    rows = staged(base_rules(docs).drop("text"), "rules")
    hosts = sized(host_verdicts(rows).select("host", "host_kept"))
    out = rows.join(hosts, rows["source"].eqNullSafe(hosts["host"]), "left")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), hit AS (
  SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) >= 2
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM hit, range(8) AS r(k) GROUP BY doc_id
), b AS (
  SELECT d.doc_id, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)
), f AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM b
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS x FROM f GROUP BY source
), m AS (
  SELECT sum(n)::DOUBLE AS n_all, sum(x) / sum(n) AS mu, sum(x)::DOUBLE AS x_all, sum(x * x / n) AS xx, sum(n)::DOUBLE - sum(n * n) / sum(n) - (count(*) - 1) AS free, count(*) - 1 AS others FROM h
), s AS (
  SELECT *, CASE WHEN mu > 0 AND mu < 1 AND free > 0 THEN ((xx - x_all * mu) / (mu * (1 - mu)) - others) / free ELSE 0 END AS share FROM m
), p AS (
  SELECT mu, CASE WHEN share > 0 THEN least(greatest(1 / share - 1, 1.0), n_all) ELSE n_all END AS strength FROM s
), v AS (
  SELECT source, (x + mu * strength) / (n + strength) <= 0.5 AS host_kept FROM h, p
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND host_kept) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
