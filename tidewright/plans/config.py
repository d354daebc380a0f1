"""Layered configuration: defaults, table, environment, the environment's override of the table."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass
from pathlib import Path
from typing import Any

PASSES = 5
_REF = re.compile(r"\$\{([A-Za-z0-9_.]+)\}")


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Listed:
    """A list that extends the layer below: whole (key None) or entry by entry, matched by key."""

    items: tuple
    key: str | None = None

    def onto(self, base: Any) -> list:
        base = list(base) if isinstance(base, list) else []
        if self.key is None:
            return base + list(self.items)
        if any(self.key not in x for x in (*base, *self.items)):
            raise ConfigError(f"an entry lacks the key {self.key!r}")
        new = {x[self.key]: x for x in self.items}
        old = [merge(x, new.pop(x[self.key], {})) for x in base]
        return old + list(new.values())


def load(path: Path) -> dict:
    import yaml

    class Loader(yaml.SafeLoader):
        pass

    def mapping(loader, node):
        keys = [loader.construct_object(k, deep=True) for k, _ in node.value]
        for i, k in enumerate(keys):
            if k in keys[:i]:
                raise ConfigError(f"{path}:{node.value[i][0].start_mark.line + 1}: key {k!r} stands twice")
        return loader.construct_mapping(node, deep=True)

    Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    Loader.add_constructor("!append", lambda lo, n: Listed(tuple(lo.construct_sequence(n, deep=True))))
    Loader.add_multi_constructor("!merge_by:", lambda lo, key, n: Listed(tuple(lo.construct_sequence(n, deep=True)), key))
    try:
        out = yaml.load(path.read_text(), Loader)  # noqa: S506 - a SafeLoader
    except yaml.YAMLError as e:
        raise ConfigError(f"{path}: {e}") from None
    if out is not None and not isinstance(out, dict):
        raise ConfigError(f"{path}: the top level must be a mapping")
    return out or {}


def merge(base: Any, over: Any) -> Any:
    """Maps merge, all else (null too) replaces; neither input changes."""
    if isinstance(over, Listed):
        return over.onto(base)
    if not isinstance(over, dict):
        return over
    base = base if isinstance(base, dict) else {}
    return {**base, **{k: merge(base.get(k), v) for k, v in over.items()}}


def interpolate(config: dict, identity: dict[str, str]) -> dict:
    def value(name: str) -> str:
        at: Any = config
        if name in identity:
            return identity[name]
        for part in name.split("."):
            if not isinstance(at, dict) or part not in at:
                raise ConfigError(f"${{{name}}} names nothing")
            at = at[part]
        if isinstance(at, (dict, list)) or at is None:
            raise ConfigError(f"${{{name}}} is no single value")
        return str(at)

    def walk(x):
        if isinstance(x, dict):
            return {k: walk(v) for k, v in x.items()}
        if isinstance(x, list):
            return [walk(v) for v in x]
        return _REF.sub(lambda m: value(m[1]), x) if isinstance(x, str) else x

    for _ in range(PASSES):
        now = walk(config)
        if now == config:
            break
        config = now
    if _REF.search(json.dumps(config, default=str)):
        raise ConfigError("references form a circle or nest too deep")
    return config


@dataclass(frozen=True)
class Resolved:
    table_fqn: str
    env: str
    config: dict
    sources: tuple[str, ...]

    @property
    def json(self) -> str:
        return json.dumps(self.config, sort_keys=True, separators=(",", ":"), default=str)

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.json.encode()).hexdigest()


def tables(root: str | Path) -> list[str]:
    found = [p for p in Path(root).glob("tables/*/*.y*ml") if not p.name.startswith("_")]
    return sorted(f"{p.parent.name}.{p.stem}" for p in found)


def _file(folder: Path, name: str) -> Path:
    for p in (folder / f"{name}.yaml", folder / f"{name}.yml"):
        if p.exists():
            return p
    have = sorted(p.stem for p in folder.glob("*.y*ml"))
    raise ConfigError(f"no {name!r} in {folder}; there are: {', '.join(have) or 'none'}")


def resolve(root: str | Path, table_fqn: str, env: str) -> Resolved:
    root, parts = Path(root), table_fqn.split(".")
    if len(parts) != 2 or not all(parts):
        raise ConfigError(f"a table is domain.name: {table_fqn!r}")
    domain, name = parts
    files = [_file(root, "defaults"), _file(root / "tables" / domain, name), _file(root / "environments", env)]
    defaults, table, environment = map(load, files)
    if environment.get("env") != env:
        raise ConfigError(f"{files[2]} says env: {environment.get('env')!r}")
    if table.get("table", {}).get("domain", domain) != domain:
        raise ConfigError(f"{files[1]} says another domain than its folder")
    overrides = environment.pop("overrides", None) or {}
    if not isinstance(overrides, dict):
        raise ConfigError("overrides must be a mapping")
    out: dict = {}
    for layer in (defaults, table, environment, overrides.get(table_fqn) or {}):
        out = merge(out, layer)
    out = merge(out, {"env": env, "table": {"domain": domain, "name": name}})
    own, target = out["table"], out.setdefault("target", {})
    target["table_name"] = target.get("table_name") or str(own.get("source_object") or name).lower()
    target["merge_keys"] = target.get("merge_keys") or list(own.get("business_key") or [])
    if target.get("write_mode") == "merge" and not target.get("partition_by") and not target.get("cluster_by"):
        target["cluster_by"] = list(target["merge_keys"])
    out = interpolate(out, {"table_fqn": table_fqn, "env": env, "domain": domain, "table": name})
    return Resolved(table_fqn, env, out, tuple(map(str, files)))
