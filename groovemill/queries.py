"""Named queries that show each operator on the driver's tables, and the SQL they are held against.

Roots are orders, relation rows lineitems, references customers and parts; events are dumps and chunks. Tables that only
an import would have are made by SQL which both engines run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates, hashing, text
from .operators import canonical, merge, relations
from .plans import admission, catalog, ledger
from .sources import catalog_index, xml_dump

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None, *days: str):
    """Registers a function under its name with its SQL. Columns in days are dates and come out as text in both."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in days})

        QUERIES[f.__name__] = run if days else f
        if sql:
            texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in days)
            ORACLES[f.__name__] = f"SELECT * REPLACE ({texts}) FROM ({sql})" if days else sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def made(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """A frame from SQL that both engines run, over tables given as {name}."""
    return spark.sql(sql, **{n: t(spark, sf_dir, n) for n in tables})


# --- projections, filters, expansion -------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_name AS name, NULLIF(c_mktsegment, 'BUILDING') AS contact_info, CASE WHEN c_acctbal > 0 THEN c_name END AS profile, 'Correct' AS data_quality FROM customer WHERE c_custkey >= 1 AND c_custkey % 7 <> 3")
def root_projection(spark, d):
    """Labels from customers: ids that aren't positive numbers go, texts are trimmed, blank ones are null."""
    made_id = F.when(F.col("c_custkey") % 7 == 3, F.concat(F.lit("-"), F.col("c_custkey"))).otherwise(F.concat(F.lit(" "), F.col("c_custkey")))
    segment = F.when(F.col("c_mktsegment") == "BUILDING", " \t").otherwise(F.col("c_mktsegment"))
    dump = t(spark, d, "customer").select(
        made_id.alias("id"), F.concat(F.lit(" \t"), "c_name", F.lit("\n")).alias("name"), segment.alias("contactinfo"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("profile"), F.lit("Correct ").alias("data_quality"), F.col("c_custkey").alias("ordinal"),
    )
    return relations.root_rows(relations.valid_roots(dump, "label"), "label", F.lit(None).cast("timestamp_ntz")).drop("created_at", "last_modified_at")


@query("SELECT l_orderkey AS id, l_returnflag AS title, CASE WHEN l_linenumber < 4 THEN year(l_shipdate) END::SMALLINT AS year FROM lineitem WHERE l_orderkey >= 1 QUALIFY l_partkey * 10 + l_linenumber = max(l_partkey * 10 + l_linenumber) OVER (PARTITION BY l_orderkey)")
def repeated_roots(spark, d):
    """Masters from line items: of elements that repeat an id the last in the source stays; a year that is none is null."""
    year = F.when(F.col("l_linenumber") < 4, F.date_format("l_shipdate", " yyyy ")).otherwise("unknown")
    dump = t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("_id"), F.col("l_returnflag").alias("title"), year.alias("year"), F.lit(None).cast("string").alias("main_release"), F.lit(None).cast("string").alias("data_quality"), (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("ordinal"))
    return relations.root_rows(relations.valid_roots(dump, "master"), "master", F.lit(None).cast("timestamp_ntz")).select("id", "title", "year")


@query("SELECT p_partkey AS label_id, (i - 1)::INT AS place, w[i] AS url FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)) WHERE w[i] <> 'red'")
def explode_relation(spark, d):
    """Urls of labels from the words of part names; blank ones are no rows."""
    words = F.transform(F.split("p_name", " "), lambda x: F.when(x == "red", " ").otherwise(F.concat(x, F.lit("\n"))))
    rows = t(spark, d, "part").select(F.col("p_partkey").alias("root_id"), F.struct(words.alias("url")).alias("urls"))
    return relations.child_rows(rows, relations.BY_TABLE["label_url"])


@query("SELECT o_custkey AS master_id, o_orderkey::INT AS place, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS title, NULL::VARCHAR AS description, o_orderstatus AS url FROM orders WHERE o_orderstatus <> 'O'")
def master_videos(spark, d):
    """Videos of masters from the orders of customers: a video without a url is no row, one without a title is."""
    video = F.struct(F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("_src"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("title"), F.lit(" ").alias("description"))
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("root_id"), F.struct(F.array(video).alias("video")).alias("videos"), "o_orderkey")
    spec = relations.BY_TABLE["master_video"]
    # a list of one video for each order, so the order tells the lists apart
    return relations.child_rows(rows.withColumn("root_id", F.struct("root_id", "o_orderkey")), spec).select("master_id.root_id", F.col("master_id.o_orderkey").cast("int").alias("place"), "title", "description", "url").withColumnRenamed("root_id", "master_id")


@query("SELECT p_partkey, NULLIF(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|'), '') AS words FROM (SELECT p_partkey, list_filter(list_transform(string_split(p_name || ',  ,' || p_type || ', ' || p_name, ','), lambda x: trim(x)), lambda x: x <> '') AS l FROM part)")
def array_clean(spark, d):
    parts = F.split(F.concat("p_name", F.lit(",  ,"), "p_type", F.lit(", "), "p_name"), ",")
    return t(spark, d, "part").select("p_partkey", F.array_join(text.clean_distinct(parts), "|").alias("words"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE NULLIF(l_returnflag, 'N') IS NOT NULL OR NULLIF(l_linestatus, 'O') IS NOT NULL OR NULLIF(l_linenumber, 1) IS NOT NULL")
def any_not_null(spark, d):
    null = lambda c, v: F.nullif(F.col(c), F.lit(v))
    return t(spark, d, "lineitem").filter(text.any_text(null("l_returnflag", "N"), null("l_linestatus", "O"), null("l_linenumber", 1))).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("SELECT p_partkey FROM part WHERE NULLIF(p_brand, 'Brand#1') IS NOT NULL OR NULLIF(p_type, 'ECONOMY') IS NOT NULL OR len(string_split(p_name, ' ')) > 2")
def format_identity(spark, d):
    null = lambda c, v: F.nullif(F.col(c), F.lit(v))
    many = F.filter(F.split("p_name", " "), lambda x: F.size(F.split("p_name", " ")) > 2)
    return t(spark, d, "part").filter(text.has_format_identity(null("p_brand", "Brand#1"), null("p_type", "ECONOMY"), many)).select("p_partkey")


# --- joins ----------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25) AND l_returnflag IN (SELECT DISTINCT l_returnflag FROM lineitem WHERE l_tax > 0.05)")
def ref_semi_join(spark, d):
    rows = t(spark, d, "lineitem")
    refs = {"part": t(spark, d, "part").filter("p_size > 25").select(F.col("p_partkey").alias("id")), "flag": rows.filter("l_tax > 0.05").select(F.col("l_returnflag").alias("name"))}
    spec = relations.Relation("lineitem", "release", "l_orderkey", lambda: F.col("x"), lambda x, trim: {}, refs=(("l_partkey", "part"), ("l_returnflag", "flag")))
    return relations.referenced(rows, spec, refs).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey AS id, c_custkey AS master_id, o_orderstatus = 'F' AS is_master FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def nullable_fk(spark, d):
    releases = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("master_id"), (F.col("o_orderstatus") == "F").alias("is_master"))
    return relations.with_known_master(releases, t(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("id")))


@query("SELECT DISTINCT 'lineitem' AS \"table\", l_orderkey AS root FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey + 5 FROM orders) UNION ALL SELECT DISTINCT 'orders', o_orderkey FROM orders WHERE o_orderkey IN (SELECT o_orderkey + 5 FROM orders)")
def existing_roots_union(spark, d):
    roots = t(spark, d, "orders").select((F.col("o_orderkey") + 5).alias("root"))
    return merge.existing_roots({"lineitem": (t(spark, d, "lineitem"), "l_orderkey"), "orders": (t(spark, d, "orders"), "o_orderkey")}, roots)


# All rows of a table are on both sides. Roots that only one side has are given by a minus sign: of every third root on
# the old side, of the ones after those on the new side. A new row with a small quantity has another part. Touched are the
# new side's roots and all with a minus sign, so the old side's have lost all their rows.
_PART = "CASE WHEN l_linenumber % 5 <> 0 THEN {} END AS part"
_OLD = f"SELECT DISTINCT CASE WHEN l_orderkey % 3 = 0 THEN -l_orderkey ELSE l_orderkey END AS root, {_PART.format('l_partkey')}, 'old' AS stamp FROM {{lineitem}}"
_NEW_ROOT = "CASE WHEN l_orderkey % 3 = 1 THEN -l_orderkey ELSE l_orderkey END AS root"
_NEW = f"SELECT DISTINCT {_NEW_ROOT}, {_PART.format('l_partkey + CASE WHEN l_quantity > 10 THEN 0 ELSE 1 END')}, 'new' AS stamp FROM {{lineitem}}"
_TOUCHED = f"SELECT {_NEW_ROOT} FROM {{lineitem}} UNION SELECT -l_orderkey FROM {{lineitem}}"
_WITH = f"WITH o AS ({_OLD}), n AS ({_NEW}), r AS ({_TOUCHED})".replace("{lineitem}", "lineitem")


def _old_new(spark, d):
    return [made(spark, d, q, "lineitem") for q in (_OLD, _NEW, _TOUCHED)]


@query(_WITH + " SELECT root, part, stamp FROM o WHERE root IN (SELECT root FROM r) AND NOT EXISTS (SELECT 1 FROM n WHERE n.root = o.root AND n.part IS NOT DISTINCT FROM o.part)")
def stale_anti_join(spark, d):
    old, new, touched = _old_new(spark, d)
    return merge.stale_rows(old, new, "root", ["root", "part"], touched)


@query(_WITH + " SELECT * FROM o WHERE root NOT IN (SELECT root FROM r) OR EXISTS (SELECT 1 FROM n WHERE n.root = o.root AND n.part IS NOT DISTINCT FROM o.part) UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.root = o.root AND n.part IS NOT DISTINCT FROM o.part)")
def converge_relation(spark, d):
    old, new, touched = _old_new(spark, d)
    return merge.converge(old, new, "root", ["root", "part"], touched)


_UOLD = "SELECT CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END AS id, o_orderpriority AS title, o_custkey AS main, DATE '2020-01-01' AS created_at, DATE '2020-01-01' AS last_modified_at FROM {orders}"
_UNEW = "SELECT CASE WHEN o_orderkey % 3 = 1 THEN -o_orderkey ELSE o_orderkey END AS id, CASE WHEN o_orderkey % 2 = 0 THEN NULLIF(o_orderpriority, '5-LOW') ELSE o_orderpriority END AS title, o_custkey + 1 AS main, DATE '2021-01-01' AS created_at, DATE '2021-01-01' AS last_modified_at FROM {orders}"


@query(f"WITH o AS ({_UOLD}), n AS ({_UNEW})".replace("{orders}", "orders") + " SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL OR (n.id IS NOT NULL AND o.title IS DISTINCT FROM n.title) THEN n.title ELSE o.title END AS title, coalesce(o.main, n.main) AS main, coalesce(o.created_at, n.created_at) AS created_at, CASE WHEN o.id IS NULL OR (n.id IS NOT NULL AND o.title IS DISTINCT FROM n.title) THEN n.last_modified_at ELSE o.last_modified_at END AS last_modified_at FROM o FULL JOIN n ON o.id = n.id", "created_at", "last_modified_at")
def merge_upsert(spark, d):
    return merge.merge_upsert(made(spark, d, _UOLD, "orders"), made(spark, d, _UNEW, "orders"), ["id"], keep=("main",))


@query(_WITH + " SELECT * FROM o UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE n.root = o.root AND n.part IS NOT DISTINCT FROM o.part)")
def insert_ignore(spark, d):
    old, new, _ = _old_new(spark, d)
    return merge.insert_ignore(old, new, ["root", "part"])


@query("SELECT DISTINCT unnest(string_split(p_name, ' ')) AS name FROM part UNION SELECT DISTINCT p_type FROM part")
def dictionary_build(spark, d):
    p = t(spark, d, "part")
    return relations.dictionary([p.select(F.explode(F.split("p_name", " ")).alias("name")), p.select(F.col("p_type").alias("name"))], "name")


# --- identities ------------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity) = 1")
def semantic_dedupe(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    out = canonical.collapse(rows, ["l_orderkey", "l_linenumber"], ["l_partkey"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"], strict=False)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")


@query("SELECT l_orderkey, l_linenumber, count(DISTINCT (l_partkey, l_returnflag)) AS n_payloads FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_returnflag)) > 1")
def payload_conflicts(spark, d):
    return canonical.conflicts(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_returnflag"])


_JAVA = "CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END"
_FOLD = "list_reduce(list_prepend(0::BIGINT, list_transform(list_filter(string_split({0}, ''), lambda c: c <> ''), lambda c: unicode(c)::BIGINT)), lambda a, b: (a * 31 + b) % 4294967296)"


_NAMES = "SELECT DISTINCT p_size, p_name, p_brand FROM part"
_TRACK = "encode('catalog/release-relation-{}/v1') || unhex('00') || encode('track') || unhex('00')"
_FRAME = "CASE WHEN NULLIF({0}, '') IS NULL THEN unhex('00') ELSE unhex('01') || unhex(printf('%08x', octet_length(encode({0})))) || encode({0}) END"
_ASKED = f"('0x' || substr(sha256({_TRACK.format('slot')} || unhex(digest) || unhex('00000000')), 1, 8))::BIGINT"


@query(
    f"WITH n AS ({_NAMES}), h AS (SELECT *, (({_FOLD.format('p_name')} % 13) + 13) % 13 AS h, sha256({_TRACK.format('identity')} || {_FRAME.format('p_name')} || {_FRAME.format('p_brand')}) AS digest FROM n), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY p_size, h ORDER BY digest) AS k, {_ASKED} AS n FROM h) SELECT p_size, p_name, p_brand, (CASE WHEN k = 1 THEN h WHEN n >= 2147483648 THEN n - 4294967296 ELSE n END)::INT AS hash FROM r"
)
def slot_allocation(spark, d):
    """Names whose hashes are forced to collide: the smallest digest of a hash keeps it, others get the slot that they ask
    for first, which is free here."""
    p = t(spark, d, "part").select("p_size", "p_name", "p_brand").distinct()
    spec = relations.Relation("t", "release", "p_size", lambda: F.col("x"), lambda x, trim: {}, payload=("p_name", "p_brand"), digest="track")
    wrapped = F.pmod(F.pmod(hashing.java_hash(F.col("p_name")).cast("long"), F.lit(1 << 32)), F.lit(13)).cast("int")
    rows = p.select("p_size", "p_name", "p_brand", wrapped.alias("hash"), hashing.digest("track", F.col("p_name"), F.col("p_brand")).alias("identity_sha256"))
    return canonical.with_slots(rows, spec).select("p_size", "p_name", "p_brand", "hash")


@query(f"SELECT p_partkey, ({_JAVA.replace('h', '(' + _FOLD.format('s') + ')')})::INT AS hash FROM (SELECT p_partkey, p_name || chr(0) || chr(1) || chr(0) || p_size::VARCHAR || chr(0) AS s FROM part)")
def format_hashes(spark, d):
    return t(spark, d, "part").select("p_partkey", hashing.format_hash(F.col("p_name"), F.lit(None).cast("string"), F.col("p_size").cast("string"), F.lit("")).alias("hash"))


# --- aggregates, windows, catalog ----------------------------------------------------------------------------------


@query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC")
def distinct_on(spark, d):
    return merge.newest(t(spark, d, "orders").filter("o_orderstatus = 'F'"), "o_custkey", "o_orderkey", ["o_orderdate", "o_orderkey"])


def _masters(spark, d):
    m = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") * 7).alias("main_release_id"))
    r = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("master_id"), (F.col("o_orderstatus") == "F").alias("is_master"), F.col("o_orderdate").alias("last_modified_at"))
    return m, r


@query("WITH d AS (SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC) SELECT c_custkey AS id, o_orderkey AS main_release_id FROM customer LEFT JOIN d ON c_custkey = o_custkey")
def reconcile_main(spark, d):
    return merge.reconcile_main(*_masters(spark, d))


@query("SELECT c_custkey AS id, c_custkey * 7 AS main_release_id FROM customer WHERE c_custkey % 2 = 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = c_custkey * 7 AND o_custkey = c_custkey AND o_orderstatus = 'F')")
def stale_links(spark, d):
    return merge.stale_links(*_masters(spark, d))


_DUMPS = "SELECT event_id AS id, event_type AS entity_type, CAST(ts AS DATE) AS dump_date, CAST(user_id AS STRING) AS etag, CAST(value * 100 AS BIGINT) AS size_bytes FROM {events}"
_D = _DUMPS.replace("{events}", "events").replace("CAST(value * 100 AS BIGINT)", "CAST(trunc(value * 100) AS BIGINT)")


@query(f"WITH d AS ({_D}) SELECT id, entity_type, dump_date FROM d QUALIFY row_number() OVER (PARTITION BY entity_type ORDER BY dump_date DESC, etag DESC, size_bytes DESC) = 1", "dump_date")
def latest_per_key(spark, d):
    return catalog.latest_per_type(made(spark, d, _DUMPS, "events")).select("id", "entity_type", "dump_date")


@query(f"WITH d AS ({_D}) SELECT id, entity_type, dump_date FROM d WHERE entity_type = 'click' AND dump_date >= DATE '2024-01-10' AND dump_date < DATE '2024-01-20' ORDER BY dump_date DESC, id DESC LIMIT 1", "dump_date")
def top_by_type(spark, d):
    return catalog.top_of(made(spark, d, _DUMPS, "events"), "click", dt.date(2024, 1, 10), dt.date(2024, 1, 20)).select("id", "entity_type", "dump_date")


@query(f"WITH d AS ({_D}) SELECT id, entity_type, dump_date FROM d WHERE dump_date >= DATE '2024-01-01' AND dump_date < DATE '2024-02-01' AND entity_type = 'view'", "dump_date")
def catalog_range(spark, d):
    return catalog.in_range(made(spark, d, _DUMPS, "events"), *dates.month_window("2024-01"), "view").select("id", "entity_type", "dump_date")


@query(f"WITH d AS ({_D}), n AS (SELECT entity_type, dump_date, max(id) AS id FROM d GROUP BY ALL) SELECT d.id, d.entity_type, d.dump_date, n.dump_date AS asof_dump_date, n.id AS asof_id FROM d ASOF LEFT JOIN n ON d.entity_type = n.entity_type AND d.dump_date > n.dump_date", "dump_date", "asof_dump_date")
def asof_dump(spark, d):
    dumps = made(spark, d, _DUMPS, "events")
    left = dumps.select("id", "entity_type", "dump_date")
    return admission.asof(left, dumps, "entity_type", "dump_date", "dump_date", "id", ["dump_date", "id"])


@query("WITH x AS (SELECT p_brand AS entity_type, CAST(o_orderdate AS DATE) AS dump_date, p_type AS dependency FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey) SELECT dependency, array_to_string(list_sort(list(DISTINCT entity_type)), ',') AS consumers, CAST(date_trunc('month', max(dump_date)) + INTERVAL 1 MONTH AS DATE) AS horizon FROM x WHERE dependency <> 'ECONOMY' GROUP BY dependency", "horizon")
def dependency_requirements(spark, d):
    """Brands depend on the kinds of their parts; ECONOMY is selected itself, so nothing has to be there for it."""
    line = t(spark, d, "lineitem").select("l_partkey", "l_orderkey")
    rows = line.join(t(spark, d, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey")).join(t(spark, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    day = F.max(F.col("o_orderdate").cast("date")).alias("dump_date")
    pair = F.concat_ws("/", "p_brand", "p_type")
    # an entity is a brand and a kind of part, with the latest date, so that each has one dump and one dependency
    dumps = rows.groupBy(pair.alias("entity_type")).agg(day).unionByName(spark.sql("SELECT 'ECONOMY' AS entity_type, DATE '1990-01-01' AS dump_date"))
    depends = t(spark, d, "part").select(pair.alias("entity_type"), F.col("p_type").alias("dependency")).distinct()
    out = admission.requirement_rows(dumps, depends)
    brands = F.array_sort(F.array_distinct(F.transform(F.split("consumers", ","), lambda x: F.element_at(F.split(x, "/"), 1))))
    return out.select("dependency", F.array_join(brands, ",").alias("consumers"), "horizon")


# --- chunks and runs --------------------------------------------------------------------------------------------------


@query("SELECT event_id // 500 AS chunk_index, min(event_id) AS first_item_index, count(*) AS item_count FROM events GROUP BY 1")
def source_chunks(spark, d):
    return xml_dump.source_chunks(t(spark, d, "events"), 500, "event_id")


_RUNS = "SELECT o_orderkey AS id, o_orderpriority AS manifest_sha256, CASE WHEN o_orderkey % 3 = 0 THEN 'success' WHEN o_orderkey % 3 = 1 AND o_orderdate < DATE '1998-01-01' THEN 'failed' ELSE 'running' END AS status, o_custkey % 7 = 0 AS force_requested, o_orderdate AS completed_at FROM {orders}"
_ENTITY = "CASE l_linenumber % 4 WHEN 0 THEN 'artist' WHEN 1 THEN 'label' WHEN 2 THEN 'master' ELSE 'release' END"
_RUN_DUMPS = f"SELECT l_orderkey AS import_run_id, {_ENTITY} AS entity_type, min(l_partkey % 3) AS dump_id, CAST(CASE WHEN min(l_suppkey) % 13 = 0 THEN 20 ELSE 10 END AS INT) AS chunk_size, CAST(CASE WHEN min(l_suppkey) % 11 = 0 THEN 9 WHEN min(l_linenumber % 4) = 3 THEN 3 ELSE 1 END AS INT) AS import_contract_revision, count(*) * 2 AS processed_items FROM {{lineitem}} GROUP BY l_orderkey, {_ENTITY}"
_CHUNKS = f"SELECT l_orderkey AS import_run_id, {_ENTITY} AS entity_type, CAST(0 AS BIGINT) AS chunk_index, CAST(CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END AS BIGINT) AS first_item_index, count(*) * 2 + CASE WHEN l_orderkey % 19 = 0 THEN 1 ELSE 0 END AS item_count FROM {{lineitem}} GROUP BY l_orderkey, {_ENTITY}"
_CHECKS = "SELECT entity_type, import_run_id, applied_at, dump_date FROM (SELECT d.entity_type, r.id AS import_run_id, r.completed_at AS applied_at, CAST(r.completed_at AS DATE) AS dump_date, row_number() OVER (PARTITION BY d.entity_type ORDER BY r.completed_at DESC, r.id DESC) AS k FROM {runs} r JOIN {run_dumps} d ON d.import_run_id = r.id WHERE r.status = 'success' AND (d.entity_type IN ('artist', 'label') OR r.completed_at < DATE '1997-01-01')) WHERE k = 1"
_CONTROL = "WITH runs AS (" + _RUNS.replace("{orders}", "orders") + "), run_dumps AS (" + _RUN_DUMPS.replace("{lineitem}", "lineitem") + "), chunks AS (" + _CHUNKS.replace("{lineitem}", "lineitem") + "), checks AS (" + _CHECKS.replace("{runs}", "runs").replace("{run_dumps}", "run_dumps") + ") "
_REV = "CASE x.entity_type WHEN 'release' THEN 3 ELSE 1 END"


def _control(spark, d):
    runs, run_dumps, chunks = made(spark, d, _RUNS, "orders"), made(spark, d, _RUN_DUMPS, "lineitem"), made(spark, d, _CHUNKS, "lineitem")
    return runs, run_dumps, chunks, spark.sql(_CHECKS, runs=runs, run_dumps=run_dumps)


@query(_CONTROL + "SELECT import_run_id, entity_type, total, n AS completed_chunks, items AS completed_items, bad AS invalid_chunks, n = ceil(total / 10.0) AND items = total AND bad = 0 AS is_complete FROM (SELECT import_run_id, entity_type, processed_items AS total, count(c.chunk_index) AS n, coalesce(sum(item_count), 0)::BIGINT AS items, count(*) FILTER (WHERE c.chunk_index >= ceil(processed_items / 10.0) OR first_item_index <> c.chunk_index * 10 OR item_count <> CASE WHEN c.chunk_index = ceil(processed_items / 10.0) - 1 THEN processed_items - first_item_index ELSE 10 END) AS bad FROM run_dumps LEFT JOIN chunks c USING (import_run_id, entity_type) GROUP BY ALL)")
def chunk_coverage(spark, d):
    _, run_dumps, chunks, _ = _control(spark, d)
    totals = run_dumps.select("import_run_id", "entity_type", F.col("processed_items").alias("total"), F.lit(10).alias("chunk_size"))
    return ledger.coverage(chunks, totals).drop("chunk_size")


@query(_CONTROL + "SELECT import_run_id, entity_type, count(*) AS total_chunks, coalesce(sum(item_count), 0)::BIGINT AS total_items FROM chunks GROUP BY ALL")
def progress_summary(spark, d):
    return ledger.summary(_control(spark, d)[2])


@query("SELECT event_id, event_id // 500 AS chunk_index FROM events WHERE event_id // 500 NOT IN (SELECT event_id // 500 FROM events WHERE event_type = 'signup' AND value > 40 AND user_id < 3)")
def resume_anti_join(spark, d):
    e = t(spark, d, "events").withColumn("chunk_index", xml_dump.chunk_index(F.col("event_id"), 500))
    return ledger.remaining(e, e.filter("event_type = 'signup' AND value > 40 AND user_id < 3").select("chunk_index").distinct()).select("event_id", "chunk_index")


@query(_CONTROL + "SELECT id FROM runs WHERE status = 'running' AND EXISTS (SELECT 1 FROM run_dumps x WHERE x.import_run_id = id AND x.entity_type IN ('artist', 'master'))")
def abandoned_runs(spark, d):
    runs, run_dumps, _, _ = _control(spark, d)
    return admission.abandoned(runs, run_dumps, ["artist", "master"]).select("id")


@query(_CONTROL + f"""SELECT id FROM runs r WHERE manifest_sha256 = '1-URGENT' AND status = 'success'
  AND NOT EXISTS (SELECT 1 FROM run_dumps x WHERE x.import_run_id = r.id AND x.import_contract_revision IS DISTINCT FROM {_REV})
  AND NOT EXISTS (SELECT 1 FROM run_dumps x LEFT JOIN checks c ON c.entity_type = x.entity_type LEFT JOIN run_dumps y ON y.import_run_id = c.import_run_id AND y.entity_type = c.entity_type WHERE x.import_run_id = r.id AND y.dump_id IS DISTINCT FROM x.dump_id)
  AND r.id NOT IN (SELECT x.import_run_id FROM run_dumps x JOIN checks c ON c.entity_type = x.entity_type JOIN (SELECT z.entity_type, max(f.completed_at) AS at FROM run_dumps z JOIN runs f ON f.id = z.import_run_id WHERE f.status = 'failed' GROUP BY 1) w ON w.entity_type = x.entity_type
    WHERE w.at > c.applied_at OR EXISTS (SELECT 1 FROM run_dumps z JOIN runs f ON f.id = z.import_run_id WHERE f.status = 'failed' AND z.entity_type = x.entity_type AND f.completed_at = c.applied_at AND f.id > c.import_run_id))""")
def current_success(spark, d):
    runs, run_dumps, _, checks = _control(spark, d)
    return admission.current_successes(runs, run_dumps, checks, "1-URGENT").select("id")


@query(_CONTROL + f"""SELECT id FROM runs r WHERE manifest_sha256 = '1-URGENT' AND status = 'failed' AND NOT force_requested
  AND NOT EXISTS (SELECT 1 FROM run_dumps x WHERE x.import_run_id = r.id AND x.import_contract_revision IS DISTINCT FROM {_REV})
  AND (SELECT count(*) FROM run_dumps x WHERE x.import_run_id = r.id) = 2
  AND NOT EXISTS (SELECT 1 FROM run_dumps x WHERE x.import_run_id = r.id AND x.chunk_size IS DISTINCT FROM 10)
  AND NOT EXISTS (SELECT 1 FROM run_dumps x LEFT JOIN (SELECT import_run_id, entity_type, sum(item_count) AS s FROM chunks GROUP BY ALL) k USING (import_run_id, entity_type) WHERE x.import_run_id = r.id AND x.processed_items <> coalesce(k.s, 0))
  AND NOT EXISTS (SELECT 1 FROM chunks k JOIN run_dumps x USING (import_run_id, entity_type) WHERE k.import_run_id = r.id AND (k.first_item_index <> k.chunk_index * x.chunk_size OR k.item_count > x.chunk_size))
  AND NOT EXISTS (SELECT 1 FROM run_dumps x JOIN checks c ON c.entity_type = x.entity_type JOIN run_dumps y ON y.import_run_id = c.import_run_id AND y.entity_type = c.entity_type WHERE x.import_run_id = r.id
    AND (y.dump_id <> x.dump_id OR y.import_contract_revision <> x.import_contract_revision) AND (c.applied_at > r.completed_at OR (c.applied_at = r.completed_at AND c.import_run_id > r.id)))""")
def resumable_run(spark, d):
    runs, run_dumps, chunks, checks = _control(spark, d)
    return admission.resumable_runs(runs, run_dumps, chunks, checks, "1-URGENT", 2, 10).select("id")


@query(_CONTROL + "SELECT import_run_id, entity_type, item_count FROM chunks WHERE import_run_id NOT IN (SELECT f.id FROM runs f WHERE f.status = 'failed' AND NOT EXISTS (SELECT 1 FROM run_dumps x LEFT JOIN checks c ON c.entity_type = x.entity_type LEFT JOIN run_dumps y ON y.import_run_id = c.import_run_id AND y.entity_type = c.entity_type WHERE x.import_run_id = f.id AND (y.dump_id IS DISTINCT FROM x.dump_id OR y.import_contract_revision IS DISTINCT FROM x.import_contract_revision)))")
def prune_progress(spark, d):
    runs, run_dumps, chunks, checks = _control(spark, d)
    return admission.pruned(chunks, runs, run_dumps, checks).select("import_run_id", "entity_type", "item_count")


@query(_CONTROL + "SELECT d.import_run_id, d.entity_type, CASE WHEN k.s IS NULL THEN d.processed_items ELSE d.processed_items + k.s END::BIGINT AS processed_items FROM run_dumps d LEFT JOIN (SELECT import_run_id, entity_type, sum(item_count) AS s FROM chunks WHERE first_item_index = 1 GROUP BY ALL) k USING (import_run_id, entity_type)")
def update_from(spark, d):
    _, run_dumps, chunks, _ = _control(spark, d)
    source = chunks.filter("first_item_index = 1").groupBy("import_run_id", "entity_type").agg(F.sum("item_count").alias("items"))
    target = run_dumps.select("import_run_id", "entity_type", "processed_items")
    return merge.update_from(target, source, ["import_run_id", "entity_type"], {"processed_items": F.col("processed_items") + F.col("s_items")})


@query(_CONTROL + "SELECT d.import_run_id, d.entity_type, CAST(r.completed_at AS DATE) AS dump_date FROM run_dumps d JOIN runs r ON r.id = d.import_run_id JOIN checks c ON c.entity_type = d.entity_type WHERE CAST(r.completed_at AS DATE) < c.dump_date", "dump_date")
def downgrade_check(spark, d):
    runs, run_dumps, _, checks = _control(spark, d)
    dumps = run_dumps.join(runs.select(F.col("id").alias("import_run_id"), F.col("completed_at").cast("date").alias("dump_date")), "import_run_id").select("import_run_id", "entity_type", "dump_date")
    return admission.downgrades(dumps, checks).select("import_run_id", "entity_type", "dump_date")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)")
def fk_validation(spark, d):
    return merge.missing_references(t(spark, d, "lineitem"), "l_partkey", t(spark, d, "part").filter("p_size <= 40"), "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query("WITH s AS (SELECT n_nationkey AS k, CASE n_regionkey WHEN 0 THEN 'importing' ELSE 'ready' END AS status FROM nation) SELECT k AS id, CASE WHEN k % 2 = 0 THEN 'importing' ELSE status END AS status, CASE WHEN k % 2 = 0 THEN CASE WHEN k % 3 = 0 THEN 'bootstrap' ELSE 'refresh' END END AS operation FROM s")
def entity_states(spark, d):
    n = t(spark, d, "nation").select(
        F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 2 == 0, "mine").otherwise("other").alias("entity_type"), F.when(F.col("n_regionkey") == 0, "importing").otherwise("ready").alias("status"), F.lit(None).cast("string").alias("operation"),
        F.lit(None).cast("long").alias("active_import_run_id"), F.when(F.col("n_nationkey") % 3 != 0, 1).cast("long").alias("last_successful_import_run_id"), F.lit(None).cast("timestamp_ntz").alias("ready_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.lit(None).cast("string").alias("failure_message"),
    )
    return admission.states(n, ["mine"], 7, "importing", F.lit(None).cast("timestamp_ntz")).select("id", "status", "operation")


# --- scalar functions ----------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, NULLIF(CASE WHEN p_size % 5 = 0 THEN '' ELSE p_name END, '') AS trimmed FROM part")
def unicode_trim(spark, d):
    padded = F.concat(F.lit(" 　 \t"), F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_name")), F.lit(" \u0085\n"))
    return t(spark, d, "part").select("p_partkey", text.unicode_trim(padded).alias("trimmed"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN NULL WHEN 1 THEN chr(160) ELSE p_name || chr(160) END AS trimmed FROM part")
def legacy_trim(spark, d):
    k = F.col("p_size") % 3
    padded = F.when(k == 0, "\u0001 \t　\n").when(k == 1, "   ").otherwise(F.concat(F.lit("\u001f "), "p_name", F.lit("  \r")))
    return t(spark, d, "part").select("p_partkey", text.legacy_trim(padded).alias("trimmed"))


@query("SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: '[d:' || x || ']'), ',') AS reduced FROM part")
def string_join(spark, d):
    return t(spark, d, "part").select("p_partkey", text.reduced_description(F.split("p_name", " ")).alias("reduced"))


@query(f"SELECT p_partkey, ({_JAVA.replace('h', '(' + _FOLD.format('s') + ')')})::INT AS hash FROM (SELECT p_partkey, p_name || p_brand || 'Яд' AS s FROM part)")
def java_hash(spark, d):
    return t(spark, d, "part").select("p_partkey", hashing.joined_hash(F.col("p_name"), F.lit(" "), F.col("p_brand"), F.lit("Яд")).alias("hash"))


@query(f"WITH x AS (SELECT p_partkey, sha256({_TRACK.format('identity')} || {_FRAME.format('p_name')} || {_FRAME.format('p_brand')} || unhex('00')) AS digest FROM part) SELECT p_partkey, digest, (CASE WHEN n >= 2147483648 THEN n - 4294967296 ELSE n END)::INT AS slot FROM (SELECT *, ('0x' || substr(sha256({_TRACK.format('slot')} || unhex(digest) || unhex('00000000')), 1, 8))::BIGINT AS n FROM x)")
def sha256_identity(spark, d):
    rows = t(spark, d, "part").select("p_partkey", hashing.digest("track", F.concat(F.lit(" "), "p_name"), F.col("p_brand"), F.lit(" ")).alias("raw"))
    return rows.select("p_partkey", F.lower(F.hex("raw")).alias("digest"), hashing.slot("track", F.col("raw"), F.lit(0)).alias("slot"))


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) || repeat('0', (p_size % 12)::BIGINT) AS quantity_text, TRY_CAST(CAST(p_partkey AS VARCHAR) || repeat('0', (p_size % 12)::BIGINT) AS INT) AS quantity FROM part WHERE p_partkey > 0")
def canonical_quantity(spark, d):
    q = F.concat(F.lit("　000"), F.col("p_partkey").cast("string"), F.repeat(F.lit("0"), F.col("p_size") % 12), F.lit(" "))
    rows = t(spark, d, "part").filter("p_partkey > 0").select("p_partkey", text.canonical_quantity(q).alias("quantity_text"))
    return rows.withColumn("quantity", text.integer_quantity(F.col("quantity_text")))


_RAW = "CASE o_orderkey % 9 WHEN 0 THEN s WHEN 1 THEN substr(s, 1, 7) WHEN 2 THEN substr(s, 1, 6) || 'x-1c' WHEN 3 THEN replace(s, '-', '') WHEN 4 THEN substr(s, 1, 3) || 'x-xx' WHEN 5 THEN substr(s, 1, 4) || '-02-31' WHEN 6 THEN replace(s, '-', '/') WHEN 7 THEN 'xxxx' ELSE substr(s, 1, 4) || '-13-' || substr(s, 9, 2) END"
_RAWS = f"SELECT o_orderkey, {_RAW} AS raw FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS s FROM {{orders}})"
_R = _RAWS.replace("{orders}", "orders")
_DAY = " OR ".join(rf"regexp_full_match({{0}}, '\d{{{{4}}}}{s}0*([1-9]|1[0-2]){s}0*(3[01]|[12][0-9]|[1-9])')" for s in ("-", " ", "/", "[.]"))
_DATED = (
    "WITH r AS (" + _R + r"), c AS (SELECT *, regexp_replace({0}, '[^\d._/ -]', '0', 'g') AS s FROM r), f AS (SELECT *, regexp_full_match(s, '\d{8}') AS flat FROM c), "
    r"y AS (SELECT *, CASE WHEN s SIMILAR TO '\d{4}.*' AND substr(s, 1, 4)::INT BETWEEN 1001 AND 2026 THEN substr(s, 1, 4)::INT END AS y, "
    r"CASE WHEN flat AND substr(s, 5, 2)::INT BETWEEN 1 AND 12 THEN substr(s, 5, 2)::INT WHEN NOT flat AND regexp_full_match(s, '\w{2,4}[- /.]0*\w{1,2}.*') THEN TRY_CAST(regexp_extract(s, '^\w{2,4}[- /.](0*\w{1,2})', 1) AS INT) END AS m0 FROM f), "
    r"m AS (SELECT *, CASE WHEN m0 BETWEEN 1 AND 12 THEN m0 END AS m FROM y), "
    "d AS (SELECT *, CASE WHEN y IS NOT NULL AND m IS NOT NULL THEN CASE WHEN flat THEN substr(s, 7, 2)::INT WHEN " + _DAY.format("s").replace("{{", "{").replace("}}", "}") + r" THEN regexp_extract(s, '(\d+)$', 1)::INT END END AS d0 FROM m), "
    "e AS (SELECT *, CASE WHEN d0 BETWEEN 1 AND day(last_day(make_date(y, m, 1))) THEN d0 END AS d FROM d) "
)


@query(_DATED.replace("{0}", "raw") + "SELECT o_orderkey, raw, CASE WHEN y IS NOT NULL THEN make_date(y, coalesce(m, 1), CASE WHEN m IS NULL THEN 1 ELSE coalesce(d, 1) END) END AS parsed FROM e", "parsed")
def malformed_date(spark, d):
    raws = made(spark, d, _RAWS, "orders")
    return raws.withColumn("parsed", dates.parse_malformed(F.col("raw"), 2026))


@query(_DATED.replace("regexp_replace({0}, '[^\\d._/ -]', '0', 'g')", "raw").replace("WHEN NOT flat AND", "WHEN NOT flat AND NOT raw LIKE '%x%' AND") + r"SELECT o_orderkey, raw SIMILAR TO '\d{4}.*' AS has_valid_year, regexp_full_match(raw, '\w{2,4}[- /.](0*[1-9]|1[0-2])([- /.].*)?') AS has_valid_month, d IS NOT NULL AS has_valid_day FROM e")
def date_flags(spark, d):
    raw = F.col("raw")
    return made(spark, d, _RAWS, "orders").select("o_orderkey", dates.is_year_valid(raw).alias("has_valid_year"), dates.is_month_valid(raw).alias("has_valid_month"), dates.is_day_valid(raw, 2026).alias("has_valid_day"))


@query("SELECT page_id, l AS href, string_split(l, '/')[-1] AS file FROM (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1))) AS l FROM pages)")
def html_links(spark, d):
    found = F.array_distinct(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1)))
    return t(spark, d, "pages").select("page_id", F.explode(found).alias("href")).withColumn("file", text.file_name(F.col("href")))


@query("SELECT o_orderkey AS id, 'data/x_' || strftime(o_orderdate, '%Y%m%d') || '_masters.xml.gz' AS uri, 'master' AS entity_type, CAST(o_orderdate AS DATE) AS dump_date, (2 + o_orderkey % 7) * 1024 AS size_bytes, 'u?download=data%2Fx_' || strftime(o_orderdate, '%Y%m%d') || '_CHECKSUM.txt' AS checksum_url FROM orders WHERE o_orderkey % 4 <> 0", "dump_date")
def listing_entries(spark, d):
    """Year listings written from orders and parsed back; a listing without a checksum of its date lists nothing."""
    o = t(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day"))
    entry = F.format_string('2026-07-01 10:00:00 %d KB <a href="u?download=data%%2Fx_%s_masters.xml.gz">x_%s_masters.xml.gz</a>\n', 2 + F.col("o_orderkey") % 7, "day", "day")
    check = F.when(F.col("o_orderkey") % 4 != 0, F.format_string('<a href="u?download=data%%2Fx_%s_CHECKSUM.txt">x_%s_CHECKSUM.txt</a>', "day", "day")).otherwise("")
    pages = o.select("o_orderkey", F.concat(entry, check).alias("html"))
    found = pages.select("o_orderkey", F.explode(catalog_index.entries_of(F.col("html"))).alias("e")).select(F.col("o_orderkey").alias("id"), "e.*")
    return found.filter("checksum_url IS NOT NULL").select("id", "uri", "entity_type", "dump_date", "size_bytes", "checksum_url")


@query("SELECT p_partkey, p_partkey::VARCHAR || '.xml.gz' AS file, sha256(p_name) AS checksum_sha256 FROM part")
def checksum_lines(spark, d):
    p = t(spark, d, "part")
    lines = p.select(F.concat(F.upper(F.sha2("p_name", 256)), F.lit("  "), F.col("p_partkey").cast("string"), F.lit(".xml.gz")).alias("value"))
    dumps = p.select("p_partkey", F.concat(F.lit("data/"), F.col("p_partkey").cast("string"), F.lit(".xml.gz")).alias("uri"))
    return catalog_index.pinned(dumps, catalog_index.manifest(lines)).select("p_partkey", text.file_name(F.col("uri")).alias("file"), "checksum_sha256")


@query("SELECT DISTINCT year(o_orderdate)::VARCHAR AS year, 'https://c.example/?prefix=data%2F' || year(o_orderdate) || '%2F' AS url FROM orders")
def year_listings(spark, d):
    """The years that pages written from orders link to."""
    pages = t(spark, d, "orders").select(F.format_string('<a href="?prefix=data%%2F%d%%2F">x</a> <a HREF=\'?prefix=data%%2F%d%%2F\'> <a href="?prefix=data%%2Fx%%2F">', F.year("o_orderdate"), F.year("o_orderdate")).alias("html"))
    return catalog_index.year_urls(pages, base="https://c.example/")


@query("SELECT page_id, url_encode(url) AS encoded, url AS decoded FROM pages")
def url_codec(spark, d):
    return t(spark, d, "pages").select("page_id", F.url_encode("url").alias("encoded"), F.url_decode(F.url_encode("url")).alias("decoded"))


@query("SELECT o_orderkey AS id, o_orderdate - INTERVAL 2 HOUR AS listed_at FROM orders", "listed_at")
def offset_times(spark, d):
    """Offset timestamps as local times in UTC."""
    return t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), dates.utc_timestamp(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("listed_at"))


@query("SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'artist' WHEN 1 THEN 'label' WHEN 2 THEN 'master' WHEN 3 THEN 'release' WHEN 4 THEN 'artist' END AS entity FROM orders")
def classify_regex(spark, d):
    names = F.array(*map(F.lit, ("data/ARTISTS.xml.gz", "x_labels.xml", "2008/masters", "Releases", "labels_of_artists", "images")))
    return t(spark, d, "orders").select("o_orderkey", text.classify(F.get(names, (F.col("o_orderkey") % 6).cast("int"))).alias("entity"))


@query("SELECT p_partkey, CAST(round(CAST(p_size AS DECIMAL(18,6)) / 8 * CASE p_size % 5 WHEN 0 THEN 1 WHEN 1 THEN 1024 WHEN 2 THEN 1048576 WHEN 3 THEN 1073741824 ELSE 1099511627776 END, 0) AS BIGINT) AS bytes FROM part")
def display_size(spark, d):
    unit = F.get(F.array(*map(F.lit, ("B", "kb", "MB", "GB", "TB"))), F.col("p_size") % 5)
    return t(spark, d, "part").select("p_partkey", text.display_size((F.col("p_size") / 8).cast("string"), unit).alias("bytes"))
