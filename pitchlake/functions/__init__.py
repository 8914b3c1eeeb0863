from pitchlake.functions.parse import (coerce_numeric_zero, coord, list_index, null_if_missing,
                                       split_list, strip_brackets, to_bool_default_false,
                                       to_double, to_float, to_int)
from pitchlake.functions.labels import competition_label, match_label, metric_label, title_label

__all__ = ["coerce_numeric_zero", "coord", "list_index", "null_if_missing", "split_list",
           "strip_brackets", "to_bool_default_false", "to_double", "to_float", "to_int",
           "competition_label", "match_label", "metric_label", "title_label"]
