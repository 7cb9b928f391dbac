"""Where the tables of a run live: ``root/catalog/schema/table``."""

from __future__ import annotations

from dataclasses import dataclass, field

SCHEMAS = {
    "bronze": "bronze",
    "silver": "silver",
    "gold_participantes": "gold_participantes",
    "gold_comite": "gold_comite",
}


@dataclass(frozen=True)
class Layout:
    root: str
    catalog: str = "seguimiento"
    schemas: dict[str, str] = field(default_factory=lambda: dict(SCHEMAS))

    def override(self, catalog: str | None) -> "Layout":
        """Another catalog for this run; ``None`` or an empty string keeps the configured one."""
        return Layout(self.root, catalog or self.catalog, self.schemas)

    def schema_name(self, layer: str) -> str:
        return f"{self.catalog}.{self.schemas[layer]}"

    def table_name(self, layer: str, table: str) -> str:
        return f"{self.schema_name(layer)}.{table}"

    def session_name(self, layer: str, table: str) -> str:
        """The same name in two parts, for catalogs that have databases but no further level."""
        return f"{self.catalog}_{self.schemas[layer]}.{table}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.catalog}/{self.schemas[layer]}/{table}"
