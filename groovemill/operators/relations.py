"""The relations of the four roots: what their keys, payloads, references and identities are, and how rows come from a dump."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, hashing, text

Trim = Callable[[Column], Column]
#: Artists, labels and masters were trimmed by the older rule; releases are by the newer one.
TRIM: dict[str, Trim] = {"artist": text.legacy_trim, "label": text.legacy_trim, "master": text.legacy_trim, "release": text.unicode_trim}
ROOT_ID = {"artist": "id", "label": "id", "master": "_id", "release": "_id"}
ROOT_TABLE = {"artist": "artist", "label": "label", "master": "master", "release": "release_item"}


def number(c: Column) -> Column:
    return F.btrim(c).try_cast("int")


#: What the columns of a relation's identity may be.
SHAPES = (("int", "int"), ("int", "binary"), ("int", "text"), ("int", "int", "text"), ("int", "int", "binary"))


@dataclass(frozen=True)
class Relation:
    """One child table. `items` is the array in the dump, `fields` build a row from an element x with a trim; `keys`
    come after the root's id; `refs` maps a column to the table whose ids or names it must be in; a row without `needs`
    is no row; `digest` names the relation for identities over `digest_fields`, `hash_of` gives the legacy hash."""

    table: str
    entity: str
    root: str
    items: Callable[[], Column]
    fields: Callable[[Column, Trim], dict[str, Column]]
    keys: tuple[str, ...] = ()
    payload: tuple[str, ...] = ()
    refs: tuple[tuple[str, str], ...] = ()
    needs: Callable[[], Column] | None = None
    digest: str | None = None
    digest_fields: tuple[str, ...] = ()
    hash_of: Callable[[], Column] | None = None

    @property
    def identity(self) -> list[str]:
        """Columns that make two rows the same one."""
        return [self.root, *self.keys, *(["identity_sha256"] if self.digest else [])]

    @property
    def shape(self) -> tuple[str, ...]:
        """The types of the identity's columns."""
        return tuple("binary" if c == "identity_sha256" else "int" if c.endswith("_id") else "text" for c in self.identity)

    @property
    def stale_key(self) -> list[str]:
        """Columns that must all be equal, nulls included, for a stored row to stay."""
        return [self.root, *self.keys, *(["hash", "identity_sha256"] if self.digest else [])]

    @property
    def scope(self) -> list[str]:
        """Columns within which hashes must differ."""
        return [self.root, *self.keys]

    @property
    def columns(self) -> list[str]:
        return [*self.stale_key, *self.payload]


def _texts(table: str, entity: str, root: str, path: str, name: str, digest: str) -> Relation:
    return Relation(table, entity, root, lambda: F.col(path), lambda x, trim: {name: trim(x)}, payload=(name,), needs=lambda: F.col(name).isNotNull(), digest=digest, digest_fields=(name,), hash_of=lambda: hashing.joined_hash(F.col(name)))


def _ids(table: str, entity: str, root: str, path: str, key: str, ref: str, get: Callable[[Column], Column]) -> Relation:
    return Relation(table, entity, root, lambda: F.col(path), lambda x, trim: {key: number(get(x))}, keys=(key,), refs=((key, ref),), needs=lambda: F.col(key).isNotNull())


def _names(table: str, entity: str, root: str, path: str, key: str, ref: str | None) -> Relation:
    return Relation(table, entity, root, lambda: F.col(path), lambda x, trim: {key: trim(x)}, keys=(key,), refs=((key, ref),) if ref else (), needs=lambda: F.col(key).isNotNull())


def _triple(table: str, path: str, digest: str, order: tuple[str, str, str], hashed: tuple[str, str, str], fields: Callable[[Column, Trim], dict[str, Column]], entity: str = "release", root: str = "release_item_id", needs: Callable[[], Column] | None = None) -> Relation:
    """A relation of three texts, any of which is enough."""
    joined = lambda: hashing.joined_hash(*[F.col(c) for c in hashed])
    return Relation(table, entity, root, lambda: F.col(path), fields, payload=order, needs=needs or (lambda: text.any_text(*[F.col(c) for c in order])), digest=digest, digest_fields=order, hash_of=joined)


def _video(x: Column, trim: Trim) -> dict[str, Column]:
    return {"title": trim(x["title"]), "description": trim(x["description"]), "url": trim(x["_src"])}


def _format(x: Column, trim: Trim) -> dict[str, Column]:
    quantity = text.canonical_quantity(x["_qty"])
    return {"name": trim(x["_name"]), "description": text.reduced_description(x["descriptions"]["description"]), "quantity_text": quantity, "quantity": text.integer_quantity(quantity), "text": trim(x["_text"])}


_ID, _VALUE_ID = (lambda x: x["id"]), (lambda x: x["_id"])
RELATIONS = (
    _ids("artist_alias", "artist", "artist_id", "aliases.name", "alias_id", "artist", _VALUE_ID),
    _ids("artist_group", "artist", "artist_id", "groups.name", "group_id", "artist", _VALUE_ID),
    _ids("artist_member", "artist", "artist_id", "members.name", "member_id", "artist", _VALUE_ID),
    _texts("artist_name_variation", "artist", "artist_id", "namevariations.name", "name_variation", "artist_name_variation"),
    _texts("artist_url", "artist", "artist_id", "urls.url", "url", "artist_url"),
    _ids("label_sub_label", "label", "parent_label_id", "sublabels.label", "sub_label_id", "label", _VALUE_ID),
    _texts("label_url", "label", "label_id", "urls.url", "url", "label_url"),
    _ids("master_artist", "master", "master_id", "artists.artist", "artist_id", "artist", _ID),
    _names("master_genre", "master", "master_id", "genres.genre", "genre", "genre"),
    _names("master_style", "master", "master_id", "styles.style", "style", "style"),
    _triple("master_video", "videos.video", "master_video", ("title", "description", "url"), ("title", "description", "url"), _video, "master", "master_id", lambda: F.col("url").isNotNull()),
    Relation("label_release_item", "release", "release_item_id", lambda: F.col("labels.label"), lambda x, trim: {"label_id": number(x["_id"]), "category_notation": trim(x["_catno"])}, keys=("label_id", "category_notation"), refs=(("label_id", "label"),), needs=lambda: F.col("label_id").isNotNull()),
    _ids("release_item_artist", "release", "release_item_id", "artists.artist", "artist_id", "artist", _ID),
    Relation("release_item_credited_artist", "release", "release_item_id", lambda: F.col("extraartists.artist"), lambda x, trim: {"artist_id": number(x["id"]), "role": trim(x["role"])}, ("artist_id",), ("role",), (("artist_id", "artist"),), lambda: F.col("role").isNotNull() & F.col("artist_id").isNotNull(), "credited_artist", ("role",), lambda: hashing.joined_hash(F.col("role"))),
    Relation("release_item_format", "release", "release_item_id", lambda: F.col("formats.format"), _format, (), ("description", "name", "quantity", "quantity_text", "text"), (), lambda: text.any_text(F.col("name"), F.col("text"), F.col("description")), "format", ("name", "description", "quantity_text", "text"), lambda: hashing.format_hash(F.col("name"), F.col("description"), F.col("quantity_text"), F.col("text"))),
    _names("release_item_genre", "release", "release_item_id", "genres.genre", "genre", None),
    _triple("release_item_identifier", "identifiers.identifier", "identifier", ("type", "description", "value"), ("type", "description", "value"), lambda x, trim: {"type": trim(x["_type"]), "description": trim(x["_description"]), "value": trim(x["_value"])}),
    _names("release_item_style", "release", "release_item_id", "styles.style", "style", None),
    _triple("release_item_track", "tracklist.track", "track", ("position", "title", "duration"), ("position", "title", "duration"), lambda x, trim: {"position": trim(x["position"]), "title": trim(x["title"]), "duration": trim(x["duration"])}),
    _triple("release_item_video", "videos.video", "video", ("title", "description", "url"), ("title", "description", "url"), _video),
    Relation("release_item_work", "release", "release_item_id", lambda: F.col("companies.company"), lambda x, trim: {"label_id": number(x["id"]), "work": trim(x["entity_type_name"])}, ("label_id",), ("work",), (("label_id", "label"),), lambda: F.col("work").isNotNull() & F.col("label_id").isNotNull(), "work", ("work",), lambda: hashing.joined_hash(F.col("work"))),
)
BY_TABLE = {r.table: r for r in RELATIONS}


def of_entity(entity: str) -> list[Relation]:
    return [r for r in RELATIONS if r.entity == entity]


def valid_ids(dump: DataFrame, entity: str) -> DataFrame:
    """The distinct positive ids of the dump's elements: reads one column."""
    return dump.select(number(F.col(ROOT_ID[entity])).alias("id")).filter("id >= 1").distinct()


def valid_roots(dump: DataFrame, entity: str) -> DataFrame:
    """The dump's elements with `root_id`; those without a positive id are dropped, and of elements that repeat an id
    the last in the source stays. Repeats are looked for in two columns first, so that whole elements are only joined
    if there are any."""
    rows = dump.withColumn("root_id", number(F.col(ROOT_ID[entity]))).filter("root_id >= 1")
    again = rows.groupBy("root_id").agg(F.max("ordinal").alias("last"), F.count("*").alias("times")).filter("times > 1").select(F.col("root_id").alias("again_id"), "last")
    if again.isEmpty():
        return rows
    return rows.join(again, F.col("root_id") == F.col("again_id"), "left").filter("again_id IS NULL OR ordinal = last").drop("again_id", "last")


def root_rows(rows: DataFrame, entity: str, observed_at: Column, seed_main_release: bool = False, as_of: int | None = None) -> DataFrame:
    """Rows of the root's table from valid_roots(). master_id isn't checked here, see with_known_master()."""
    trim = TRIM[entity]
    col = lambda name: trim(F.col(name))
    stamps = [observed_at.alias("created_at"), observed_at.alias("last_modified_at")]
    if entity == "artist":
        out = [col("name").alias("name"), col("realname").alias("real_name"), col("profile").alias("profile"), col("data_quality").alias("data_quality")]
    elif entity == "label":
        out = [col("name").alias("name"), col("contactinfo").alias("contact_info"), col("profile").alias("profile"), col("data_quality").alias("data_quality")]
    elif entity == "master":
        main = number(F.col("main_release")) if seed_main_release else F.lit(None).cast("int")
        out = [col("title").alias("title"), F.btrim("year").try_cast("smallint").alias("year"), col("data_quality").alias("data_quality"), main.alias("main_release_id")]
    else:
        raw = F.col("released")
        out = [col("title").alias("title"), col("_status").alias("status"), col("country").alias("country"), col("data_quality").alias("data_quality")]
        out += [dates.parse_malformed(raw, as_of).alias("release_date"), dates.is_day_valid(raw, as_of).alias("has_valid_day"), dates.is_month_valid(raw).alias("has_valid_month"), dates.is_year_valid(raw).alias("has_valid_year")]
        out += [trim(raw).alias("listed_release_date"), F.coalesce(F.btrim("master_id._is_main_release").try_cast("boolean"), F.lit(False)).alias("is_master"), number(F.col("master_id._VALUE")).alias("master_id"), col("notes").alias("notes")]
    return rows.select(F.col("root_id").alias("id"), *out, *stamps)


def with_known_master(releases: DataFrame, masters: DataFrame) -> DataFrame:
    """releases with master_id null where masters(id) lacks it; the row and is_master stay."""
    known = masters.select(F.col("id").alias("known_id"))
    out = releases.join(known, releases["master_id"] == known["known_id"], "left")
    return out.withColumn("master_id", F.col("known_id")).drop("known_id").select(*releases.columns)


def child_rows(rows: DataFrame, spec: Relation) -> DataFrame:
    """Rows of a relation from valid_roots(), before references are checked and identities given: root id, fields, place."""
    trim = TRIM[spec.entity]
    items = rows.select(F.col("root_id").alias(spec.root), F.posexplode(F.filter(spec.items(), lambda x: x.isNotNull())).alias("place", "item"))
    out = items.select(spec.root, "place", *[c.alias(k) for k, c in spec.fields(F.col("item"), trim).items()])
    return out.filter(spec.needs()) if spec.needs else out


def referenced(rows: DataFrame, spec: Relation, tables: dict[str, DataFrame]) -> DataFrame:
    """rows whose references exist; tables: ids (`id`) or names (`name`) by table. Left semi joins, broadcast or not as
    adaptive execution measures."""
    for column, table in spec.refs:
        ids = tables[table]
        key = "id" if "id" in ids.columns else "name"
        rows = rows.join(ids.select(F.col(key).alias(column)).distinct(), column, "left_semi")
    return rows


def identified(rows: DataFrame, spec: Relation, owner: str = hashing.OWNER) -> DataFrame:
    """rows with the legacy hash and the digest, where the relation has them."""
    if not spec.digest:
        return rows
    return rows.withColumn("hash", spec.hash_of()).withColumn("identity_sha256", hashing.digest(spec.digest, *[F.col(c) for c in spec.digest_fields], owner=owner))


def dictionary(frames: list[DataFrame], column: str) -> DataFrame:
    """Distinct names of a column in several frames."""
    out = frames[0].select(F.col(column).alias("name"))
    for f in frames[1:]:
        out = out.unionByName(f.select(F.col(column).alias("name")))
    return out.filter("name IS NOT NULL").distinct()
