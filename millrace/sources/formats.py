"""File formats of a file stream and the reader options each one takes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# Accepted options per format, with their defaults. ``multiLine`` is off because
# on newline-delimited JSON it would keep only the first record of each file, and because it
# stops Spark from splitting large files.
READER_OPTIONS: dict[str, dict[str, Any]] = {
    "csv": {"header": False, "sep": ","},
    "json": {"multiLine": False, "mode": "PERMISSIVE"},
    "parquet": {},
}


@dataclass(frozen=True)
class FormatSpec:
    """A format name and its options, checked and completed with the defaults."""

    fmt: str
    options: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.fmt not in READER_OPTIONS:
            reason = "has no data source here" if self.fmt == "avro" else "is not known"
            raise ValueError(f"message format {self.fmt!r} {reason}; use one of {[*READER_OPTIONS]}")
        defaults = READER_OPTIONS[self.fmt]
        unknown = sorted(set(self.options) - set(defaults))
        if unknown:
            raise TypeError(f"{self.fmt} does not take the options {unknown}")
        object.__setattr__(self, "options", {**defaults, **self.options})

    def reader_options(self) -> dict[str, str]:
        """Options for a batch or stream reader, with the name filter ``*.<format>``."""
        values = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in self.options.items()}
        return {**values, "pathGlobFilter": f"*.{self.fmt}", "recursiveFileLookup": "true"}
