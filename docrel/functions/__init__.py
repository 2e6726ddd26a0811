from docrel.functions.arrays import (
    array_any,
    array_size0,
    is_subset,
    map_lookup,
    md5_int,
    rand_in_range,
    sorted_join,
    unwind,
    zero_pad,
)

__all__ = ["array_any", "array_size0", "is_subset", "map_lookup", "md5_int",
           "rand_in_range", "sorted_join", "unwind", "zero_pad"]
