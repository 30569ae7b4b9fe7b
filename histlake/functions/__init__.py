"""Column-level functions (all built from pyspark.sql.functions, no UDFs)."""

from histlake.functions.casts import (
    clean_offline_timestamp,
    is_missing,
    parse_flag,
    typed_plays,
)
from histlake.functions.keys import key_text, surrogate_key
from histlake.functions.paths import path_components

__all__ = [
    "clean_offline_timestamp", "is_missing", "parse_flag", "typed_plays",
    "key_text", "surrogate_key", "path_components",
]
