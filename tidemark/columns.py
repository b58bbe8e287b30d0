"""Reserved column names and fixed values of the data model."""

TENANT = "tenant_id"
KEY = "entity_key"
HASH = "_row_hash"
SEQ = "_ingest_seq"
INGESTED = "_ingest_ts"
BATCH = "_batch_id"
FILE = "_source_file"
MODE = "_load_mode"

FULL, DELTA = "full", "delta"
#: The hash of a synthetic version that says: deleted.
DELETED = "__deleted__"
#: The end of an interval that is still open; never null.
OPEN_END = "9999-12-31 00:00:00"

NEW, CHANGED, GONE = "new", "changed", "deleted"
