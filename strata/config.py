"""Datasets as configuration: one YAML file per dataset."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

DEFAULT_DIRECTORY = Path(__file__).parent / "conf"


@dataclass(frozen=True)
class LayerConfig:
    """Bronze or silver settings of a dataset."""

    table: str
    partition_by: tuple[str, ...] = ()
    validation: tuple[Mapping[str, Any], ...] = ()
    primary_key: tuple[str, ...] = ()
    filter: Mapping[str, Any] | None = None
    prep: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class DatasetConfig:
    name: str
    path: str
    format: str = "csv"
    schema_version: str = "1.0"
    update_path: str | None = None
    read: Mapping[str, Any] = field(default_factory=dict)
    bronze: LayerConfig = LayerConfig("")
    silver: LayerConfig = LayerConfig("")

    @property
    def expected(self) -> dict[str, str]:
        """Declared columns and logical types of the first schema rule."""
        for rule in self.bronze.validation:
            if rule.get("rule") == "schema":
                return dict(rule.get("expected") or {})
        return {}

    @property
    def infer_schema(self) -> bool:
        """Infer only when nothing is declared: inference costs a pass over the text."""
        return bool(self.read.get("inferSchema", True)) and not (self.format == "csv" and self.expected)


def _layer(block: Mapping[str, Any] | None, name: str) -> LayerConfig:
    block = dict(block or {})
    return LayerConfig(
        table=block.pop("table", name),
        partition_by=tuple(block.pop("partition_by", None) or ()),
        validation=tuple(block.pop("validation", None) or ()),
        primary_key=tuple(block.pop("primary_key", None) or ()),
        filter=block.pop("filter", None),
        prep=block.pop("prep", None),
        options=block,
    )


def parse_dataset(raw: Mapping[str, Any], name: str) -> DatasetConfig:
    name = raw.get("name", name)
    return DatasetConfig(
        name=name,
        path=raw["path"],
        format=raw.get("format", "csv"),
        schema_version=str(raw.get("schema_version", "1.0")),
        update_path=raw.get("update_path"),
        read=dict(raw.get("read") or {}),
        bronze=_layer(raw.get("bronze"), name),
        silver=_layer(raw.get("silver"), name),
    )


def load_dataset(name: str, directory: Path | str = DEFAULT_DIRECTORY) -> DatasetConfig:
    path = Path(directory) / f"{name}.yaml"
    if not path.exists():
        raise FileNotFoundError(f"{path} is missing; every dataset needs a configuration file of its name")
    return parse_dataset(yaml.safe_load(path.read_text()) or {}, name)


def list_datasets(directory: Path | str = DEFAULT_DIRECTORY) -> list[str]:
    return sorted(p.stem for p in Path(directory).glob("*.yaml"))
