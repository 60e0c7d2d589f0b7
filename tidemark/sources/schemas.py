"""Table schemas. Ids are upper-case hex text; null means "absent"."""

from __future__ import annotations

ENTRY = (
    "id bigint, uuid string, type_id int, etag string, archive int, "
    "created timestamp_ntz, changed timestamp_ntz"
)
ENTRY_TYPE = "id int, alias string, dbtable string"
ACCESS = "entry_id bigint, user_id int, mode string"
NAME = "entry_id bigint, lang_id int, name string"
TAG = "entry_id bigint, tag string"
LINK = "entry_id bigint, peer_id bigint"

JOB = (
    "job_id bigint, source_uuid string, source_version string, collection_key string, "
    "job_type string, state string, priority int, attempts int, locked_until timestamp_ntz, "
    "created_at timestamp_ntz, updated_at timestamp_ntz, error_message string"
)
SEEN = (
    "source_uuid string, last_seen_version string, last_seen_changed timestamp_ntz, "
    "last_seen_at timestamp_ntz, last_seen_collection_key string, "
    "missing_since timestamp_ntz, delete_job_id bigint, deleted_at timestamp_ntz"
)
CURSOR = "last_changed timestamp_ntz, last_uuid string, last_run_at timestamp_ntz"

# The identity of a job: inserting a second row with the same values is ignored.
JOB_KEY = ["source_uuid", "source_version", "collection_key", "job_type"]


def columns(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]
