from .conform import UnknownColumnsError, conform  # noqa: F401
from .landing import land_batch, land_delta, land_snapshot, seed_if_empty, snapshot_if_changed  # noqa: F401
from .state import LostRace, StateLog  # noqa: F401
from .versioned import VersionedTable  # noqa: F401
