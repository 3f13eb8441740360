from dimspark.functions.casts import cast_type_columns, rename_columns, select_renamed, try_cast
from dimspark.functions.keys import concat_text, increasing_id, md5_key
from dimspark.functions.textfn import (
    blank_to_null,
    last_part_len,
    py_title,
    regex_pairs,
    split_part,
    truncate_chars,
)
from dimspark.functions.timefn import (
    cut_to_second,
    epoch_ms_to_second,
    epoch_ms_to_timestamp,
    sas_days_to_date,
    time_parts,
    weekday,
)

__all__ = [
    "blank_to_null",
    "cast_type_columns",
    "concat_text",
    "cut_to_second",
    "epoch_ms_to_second",
    "epoch_ms_to_timestamp",
    "increasing_id",
    "last_part_len",
    "md5_key",
    "py_title",
    "regex_pairs",
    "rename_columns",
    "sas_days_to_date",
    "select_renamed",
    "split_part",
    "time_parts",
    "truncate_chars",
    "try_cast",
    "weekday",
]
