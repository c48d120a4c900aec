"""Generic names for dimensions and metadata: decided on column lists, before any plan exists."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

_METADATA_COLUMN = re.compile(r"^metadata_\d+$")


@dataclass(frozen=True)
class GenericNames:
    """Numbered slots in the order the attributes were first met.

    A slot keeps its number across frames, so that a dimension has the same column in
    history, backtest and forecast.
    """

    target_fields: tuple[str, ...]
    metadata_fields: tuple[str, ...]
    reserved: tuple[str, ...]
    dimensions: tuple[str, ...] = ()
    metadata: tuple[str, ...] = ()

    @classmethod
    def for_spec(cls, target_spec, metadata_spec=None) -> "GenericNames":
        return cls(
            target_fields=tuple(target_spec.fields),
            metadata_fields=tuple(metadata_spec.fields) if metadata_spec else (),
            reserved=(target_spec.identifier, target_spec.target, "identifier", "metric", "timestamp"),
        )

    def discover(self, columns: Sequence[str]) -> "GenericNames":
        """Give slots to the attributes of one more series or export frame.

        An attribute of the target is a dimension, also if the metadata has it too; one of
        the metadata alone is metadata. A name that has a slot keeps it.
        """
        dimensions = _in_order(self.dimensions, columns, set(self.target_fields) - {*self.reserved, *self.metadata})
        metadata = _in_order(
            self.metadata, columns, set(self.metadata_fields) - {*self.reserved, *self.target_fields, *dimensions}
        )
        return self._with(dimensions, metadata)

    def discover_metadata(self, columns: Sequence[str]) -> "GenericNames":
        """Give slots to the metadata frame; there every attribute is metadata."""
        return self._with(self.dimensions, _in_order(self.metadata, columns, set(columns) - set(self.reserved)))

    def renames(self, columns: Sequence[str]) -> dict[str, str]:
        numbered = {n: f"metadata_{i}" for i, n in enumerate(self.metadata, start=1)}
        numbered |= {n: f"dimension_{i}" for i, n in enumerate(self.dimensions, start=1)}
        return {name: numbered[name] for name in columns if name in numbered}

    def metadata_renames(self, columns: Sequence[str]) -> dict[str, str]:
        numbered = {n: f"metadata_{i}" for i, n in enumerate(self.metadata, start=1)}
        return {name: numbered[name] for name in columns if name in numbered}

    def _with(self, dimensions: Sequence[str], metadata: Sequence[str]) -> "GenericNames":
        return GenericNames(
            self.target_fields, self.metadata_fields, self.reserved, tuple(dimensions), tuple(metadata)
        )


def _in_order(slots: Sequence[str], columns: Sequence[str], allowed: set[str]) -> list[str]:
    """The slots so far and, behind them, the allowed columns that are new, each once."""
    return list(dict.fromkeys([*slots, *[name for name in columns if name in allowed]]))


def drop_metadata(df: DataFrame) -> DataFrame:
    """Drop generically named metadata columns; the metadata join brings them back."""
    return df.drop(*[c for c in df.columns if _METADATA_COLUMN.match(c)])
