"""Paths of the layers below one base folder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    base: str

    def _at(self, *parts: str | None) -> str:
        return "/".join([self.base.rstrip("/"), *[p for p in parts if p]])

    def bronze(self, entity: str, date: str | None = None) -> str:
        return self._at("bronze", entity, f"date={date}" if date else None)

    def silver(self, entity: str) -> str:
        return self._at("silver", entity)

    def quarantine(self, entity: str) -> str:
        return self._at("quarantine", entity)

    def gold(self, table: str) -> str:
        return self._at("gold", table)

    def features(self, domain: str, name: str | None = None) -> str:
        return self._at("features", domain, name)

    def catalog(self, table: str) -> str:
        return self._at("catalog", table)
