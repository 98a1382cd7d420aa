"""Configuration: a YAML tree read by dotted paths, with connection settings from the environment."""

from __future__ import annotations

import os
from copy import deepcopy
from pathlib import Path
from typing import Any

#: Environment variable for each connection setting.
ENVIRONMENT = {
    f"snowflake.{k}": f"SNOWFLAKE_{k.upper()}" for k in (
        "account", "user", "password", "warehouse", "database", "schema", "role", "authenticator",
    )
}


class ConfigManager:
    def __init__(self, path: str | None = None, values: dict[str, Any] | None = None, environment: dict[str, str] | None = None) -> None:
        self.path, self.environment = path, ENVIRONMENT if environment is None else environment
        self._given = values
        self.reload()

    def reload(self) -> None:
        if self._given is not None:
            self.tree = deepcopy(self._given)
        else:
            import yaml

            if not self.path or not Path(self.path).exists():
                raise FileNotFoundError(f"no configuration at {self.path}")
            self.tree = yaml.safe_load(Path(self.path).read_text()) or {}
        for path, variable in self.environment.items():
            if value := os.environ.get(variable):
                self.set(path, value)

    def get(self, path: str, default: Any = None) -> Any:
        """The value at a dotted path; the default where there is none."""
        at: Any = self.tree
        for key in path.split("."):
            if not isinstance(at, dict) or key not in at:
                return default
            at = at[key]
        return at

    def set(self, path: str, value: Any) -> None:
        for key in reversed(path.split(".")):
            value = {key: value}
        self.update(value)

    def update(self, values: dict[str, Any]) -> None:
        """Merge a tree into this one, key by key."""
        merge(self.tree, values)


def merge(into: dict[str, Any], values: dict[str, Any]) -> None:
    for key, value in values.items():
        if isinstance(value, dict) and isinstance(into.get(key), dict):
            merge(into[key], value)
        else:
            into[key] = value
