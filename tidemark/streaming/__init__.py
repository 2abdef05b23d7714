from .incremental import IncrementalTable, load_incremental  # noqa: F401
from .records import land_record_batches  # noqa: F401
from .stateful import (  # noqa: F401
    commit_parent_and_child,
    dedup_stream,
    join_when_parent_arrives,
    read_committed,
    run_to_folder,
)
