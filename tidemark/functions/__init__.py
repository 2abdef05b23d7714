from .scalars import (  # noqa: F401
    clean_label,
    display_name,
    int_round,
    parse_timestamp,
    surrogate_key,
    to_money,
    to_zip,
    varchar,
    word_case,
)
from .paths import base_name, dataset_of, partition_value, split_name  # noqa: F401
from .records import json_record, nan_to_null  # noqa: F401
