"""Composite text fields to atomic typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import piece_of, strip_trailing


@dataclass(frozen=True)
class Piece:
    """Where an output column sits inside a composite field."""

    source: str
    path: tuple[tuple[str, int], ...] = ()
    strip: str = ""
    type: str = "string"

    def text(self) -> Column:
        found = piece_of(F.col(self.source), self.path)
        return strip_trailing(found, self.strip) if self.strip else found

    def value(self) -> Column:
        return self.text() if self.type == "string" else self.text().try_cast(self.type)

    def unreadable(self) -> Column:
        return self.text().isNotNull() & self.value().isNull()


def parse_composite(df: DataFrame, pieces: Mapping[str, Piece], keep: Sequence[str] = (),
                    strict: bool = True) -> DataFrame:
    """One narrow projection. `strict` fails the job on text that does not fit the type;
    otherwise the value is NULL and `parse_rejects` lists the row."""
    columns = [F.col(c) for c in keep]
    for name, piece in pieces.items():
        value = piece.value()
        if strict and piece.type != "string":
            problem = F.concat(F.lit(f"{name} is not {piece.type}: "), piece.text())
            # In this order the text is looked up again only where it has no value.
            value = F.coalesce(value, F.when(piece.unreadable(),
                                             F.raise_error(problem).cast(piece.type)))
        columns.append(value.alias(name))
    return df.select(*columns)


def parse_rejects(df: DataFrame, pieces: Mapping[str, Piece]) -> DataFrame:
    """Raw rows with at least one unreadable piece, and the names of those pieces."""
    typed = {n: p for n, p in pieces.items() if p.type != "string"}
    if not typed:
        return df.withColumn("unreadable", F.lit("")).filter(F.lit(False))
    names = F.concat_ws(",", *[F.when(p.unreadable(), F.lit(n)) for n, p in typed.items()])
    return df.withColumn("unreadable", names).filter(F.col("unreadable") != "")
