"""Where a lake keeps its layers.

A ``Lake`` is a plain value passed to every job, so two lakes can live side by side in one session and
nothing in the library depends on the process working directory.  ``root`` may be any URI that the
cluster's Hadoop file systems understand.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    """Layer roots below one directory: raw, bronze, silver, gold and ops."""

    root: str

    def _join(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def raw(self, *parts: str) -> str:
        return self._join("raw", *parts)

    def bronze(self, table: str) -> str:
        return self._join("bronze", table)

    def rejects(self, table: str) -> str:
        return self._join("bronze", f"{table}_rejects")

    def malformed(self, table: str) -> str:
        return self._join("bronze", f"{table}_malformed")

    def silver(self, table: str) -> str:
        return self._join("silver", table)

    def gold(self, table: str) -> str:
        return self._join("gold", table)

    def product(self, name: str) -> str:
        return self._join("gold", "data_products", name)

    def staging(self, name: str) -> str:
        return self._join("ops", "staging", name)

    def models(self, name: str) -> str:
        return self._join("models", name)

    @property
    def pipeline_runs(self) -> str:
        return self._join("ops", "pipeline_runs")

    @property
    def ingested_files(self) -> str:
        return self._join("ops", "ingested_files")

    @property
    def load_intents(self) -> str:
        return self._join("ops", "load_intents")

    def layer_root(self, layer: str) -> str:
        return self._join(layer)
