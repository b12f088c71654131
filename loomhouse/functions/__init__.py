from .text import (
    encode_parts,
    hash_key,
    join_parts,
    piece_of,
    string_to_list,
    strip_trailing,
)
from .versioning import OPEN_DATE, OPEN_TIMESTAMP, as_date, as_timestamp, day, is_open

__all__ = [
    "OPEN_DATE",
    "OPEN_TIMESTAMP",
    "as_date",
    "as_timestamp",
    "day",
    "encode_parts",
    "hash_key",
    "is_open",
    "join_parts",
    "piece_of",
    "string_to_list",
    "strip_trailing",
]
