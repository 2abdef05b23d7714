from .files import (  # noqa: F401
    last_modified,
    list_files,
    modified_since,
    newest_snapshot,
    read_alike,
    read_files,
    tagged_latest,
    unprocessed_files,
)
from .jsonpages import read_json_dump, read_json_pages  # noqa: F401
from .tables import (  # noqa: F401
    describe_columns,
    existing_tables,
    jdbc_table,
    query,
    read_csv_table,
    tables_present,
)
