"""Identifier rules for flattened tables and path fragments."""

from __future__ import annotations

import hashlib
import re

MAX_IDENTIFIER = 63
SEPARATOR = "__"
VALUE_COLUMN = "value"


def identifier(text: str) -> str:
    """Lower-case words of ``text`` joined by single underscores."""
    words = re.findall(r"[a-z0-9]+", text.lower())
    return "_".join(words) or VALUE_COLUMN


def joined(segments: list[str]) -> str:
    return SEPARATOR.join(identifier(s) for s in segments)


def path_fragment(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", text) or "unknown"


class NameRegistry:
    """Hands out unique names; a long or taken name gets a hash of its logical path."""

    def __init__(self, max_length: int = MAX_IDENTIFIER):
        self.max_length = max_length
        self.owner: dict[str, str] = {}

    def claim(self, segments: list[str], logical_path: str) -> str:
        name = joined(segments)
        if len(name) > self.max_length or self.owner.get(name, logical_path) != logical_path:
            tail = SEPARATOR + hashlib.sha256(logical_path.encode()).hexdigest()[:8]
            room = self.max_length - len(tail)
            if room < 1:
                raise ValueError(f"identifiers of {self.max_length} characters cannot hold a hash")
            name = name[:room].rstrip("_") + tail
            if self.owner.get(name, logical_path) != logical_path:
                raise ValueError(f"{logical_path} and {self.owner[name]} share the name {name}")
        self.owner[name] = logical_path
        return name
