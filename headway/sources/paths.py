"""Paths below one project folder."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Paths:
    """Builds locations relative to a root, which may be a URI of any store."""

    root: str

    def at(self, *parts: object) -> str:
        return "/".join([self.root.rstrip("/"), *[str(p).strip("/") for p in parts]])
