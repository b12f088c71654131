"""Column expressions for composite text fields and hash keys. All run inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator between the parts of a hashed text.
HASH_SEPARATOR = "|"


def _literal_pattern(delim: str) -> str:
    """Regex that matches `delim` literally.

    For a single character Java's String.split then takes its no-regex path, so no pattern
    is compiled per row.
    """
    return "".join(c if c.isalnum() else "\\" + c for c in delim)


def string_to_list(text: Column, delim: str) -> Column:
    """Split into an array; NULL and '' both give an empty array."""
    nothing = F.array().cast("array<string>")
    filled = text.isNotNull() & (text != F.lit(""))
    return F.when(filled, F.split(text, _literal_pattern(delim))).otherwise(nothing)


def piece_of(text: Column, path: Sequence[tuple[str, int]]) -> Column:
    """Walk down nested delimiters: each step takes the n-th (1-based) part.

    A missing part is '', a NULL text stays NULL.
    """
    for delim, n in path:
        text = _part(text, delim, n)
    return text


def _part(text: Column, delim: str, n: int) -> Column:
    """Like split_part, which makes an array of all parts by a pattern; one character is looked
    for in the bytes instead."""
    if len(delim) != 1 or n < 1:
        return F.split_part(text, F.lit(delim), F.lit(n))
    until = F.substring_index(text, delim, n)
    if n == 1:
        return until
    # Where there are fewer parts, nothing of `until` is left behind the parts before.
    before = F.length(F.substring_index(text, delim, n - 1))
    return F.substr(until, before + F.lit(2))


def strip_trailing(text: Column, chars: str) -> Column:
    return F.rtrim(text, F.lit(chars))


def join_parts(*parts: Column) -> Column:
    """Text of the parts with '|' between them; NULL if any part is NULL."""
    texts = [p.cast("string") for p in parts]
    spaced = [texts[0]]
    for t in texts[1:]:
        spaced += [F.lit(HASH_SEPARATOR), t]
    return F.concat(*spaced) if len(spaced) > 1 else spaced[0]


def encode_parts(*parts: Column) -> Column:
    """Like join_parts but one-to-one: NULL has its own mark and lengths keep a '|'
    inside a value from looking like a separator."""
    marked = []
    for p in parts:
        t = p.cast("string")
        sized = F.concat(F.length(t).cast("string"), F.lit(":"), t)
        marked.append(F.coalesce(sized, F.lit("-")))
    return F.concat_ws(HASH_SEPARATOR, *marked)


def hash_key(*parts: Column, null_safe: bool = False) -> Column:
    """md5 hex of the joined parts."""
    text = encode_parts(*parts) if null_safe else join_parts(*parts)
    return F.md5(text)
