from .aggregate import (  # noqa: F401
    centroid_and_modes,
    count_rows,
    distinct_values,
    max_or_default,
    value_counts,
)
from .changes import content_fingerprint, has_changed, max_version  # noqa: F401
from .checks import Check, accepted, check_contract, not_null, relationship, run_checks, unique  # noqa: F401
from .dedup import first_per_key  # noqa: F401
from .delta import delta_since  # noqa: F401
from .paging import number_pages, page_after, page_answer, page_by_key, top_k  # noqa: F401
from .sets import concat_frames, split_known  # noqa: F401
from .slicing import children_of, time_slice, up_to  # noqa: F401
