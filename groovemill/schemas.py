"""Read schemas of the dumps, every leaf a string, and the tables that come out of them."""

from __future__ import annotations

#: Attributes carry an underscore, the text beside them is _VALUE.
_NAMED = "array<struct<_VALUE:string,_id:string>>"
_VIDEO = "struct<video:array<struct<_src:string,title:string,description:string>>>"
DUMP = {
    "artist": f"""id string, name string, realname string, profile string, data_quality string,
        aliases struct<name:{_NAMED}>, groups struct<name:{_NAMED}>, members struct<id:array<string>,name:{_NAMED}>,
        namevariations struct<name:array<string>>, urls struct<url:array<string>>""",
    "label": f"""id string, name string, contactinfo string, profile string, data_quality string,
        sublabels struct<label:{_NAMED}>, urls struct<url:array<string>>""",
    "master": f"""_id string, main_release string, year string, title string, data_quality string,
        artists struct<artist:array<struct<id:string>>>, genres struct<genre:array<string>>, styles struct<style:array<string>>,
        videos {_VIDEO}""",
    "release": f"""_id string, _status string, title string, country string, notes string, data_quality string, released string,
        master_id struct<_VALUE:string,_is_main_release:string>,
        artists struct<artist:array<struct<id:string>>>, extraartists struct<artist:array<struct<id:string,role:string>>>,
        labels struct<label:array<struct<_catno:string,_id:string>>>,
        formats struct<format:array<struct<_name:string,_qty:string,_text:string,descriptions:struct<description:array<string>>>>>,
        genres struct<genre:array<string>>, styles struct<style:array<string>>,
        tracklist struct<track:array<struct<position:string,title:string,duration:string>>>,
        identifiers struct<identifier:array<struct<_type:string,_description:string,_value:string>>>,
        companies struct<company:array<struct<id:string,entity_type_name:string>>>, videos {_VIDEO}""",
}

_STAMPS = "created_at timestamp_ntz, last_modified_at timestamp_ntz"
ROOTS = {
    "artist": f"id int, name string, real_name string, profile string, data_quality string, {_STAMPS}",
    "label": f"id int, name string, contact_info string, profile string, data_quality string, {_STAMPS}",
    "master": f"id int, title string, year smallint, data_quality string, main_release_id int, {_STAMPS}",
    "release_item": f"""id int, title string, status string, country string, data_quality string, release_date date,
        has_valid_day boolean, has_valid_month boolean, has_valid_year boolean, listed_release_date string, is_master boolean,
        master_id int, notes string, {_STAMPS}""",
    "genre": "name string",
    "style": "name string",
}

CONTROL = {
    "dump": "id long, etag string, dump_date date, entity_type string, checksum_sha256 string, size_bytes long, uri string",
    "run": "id long, manifest_sha256 string, status string, force_requested boolean, allow_downgrade_requested boolean, processor string, processor_version string, resumed_from_run_id long, completed_at timestamp_ntz, failure_message string",
    "run_dump": "import_run_id long, entity_type string, dump_id long, chunk_size int, import_contract_revision int, processed_items long, total_items long, total_chunks long, last_progress_at timestamp_ntz, completed_at timestamp_ntz",
    "run_chunk": "import_run_id long, entity_type string, chunk_index long, first_item_index long, item_count long, completed_at timestamp_ntz",
    "checkpoint": "entity_type string, dump_date date, import_run_id long, applied_at timestamp_ntz",
    "entity_state": "entity_type string, status string, operation string, active_import_run_id long, last_successful_import_run_id long, ready_at timestamp_ntz, updated_at timestamp_ntz, failure_message string",
}
