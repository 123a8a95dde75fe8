"""Where the layers live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """A directory all executors can reach (HDFS, object store, ...)."""

    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"
