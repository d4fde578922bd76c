"""Configuration files, read on the driver."""

from __future__ import annotations

from pathlib import Path

try:
    import yaml
except ImportError:  # an optional package; the reader below knows mappings of scalars
    yaml = None


def _plain(text: str) -> dict:
    """Nested mappings of quoted or bare scalars, and folded texts: what the configurations use."""
    root: dict = {}
    levels: list[tuple[int, dict]] = [(-1, root)]
    lines = text.splitlines()
    i = 0
    while i < len(lines):
        raw = lines[i]
        i += 1
        if not raw.strip() or raw.lstrip().startswith("#"):
            continue
        indent = len(raw) - len(raw.lstrip())
        body = raw.strip()
        if body[0] in "\"'":
            end = body.index(body[0], 1)
            key, rest = body[1:end], body[end + 1 :].lstrip()
            if not rest.startswith(":"):
                raise ValueError(f"expected a mapping: {body}")
            rest = rest[1:].strip()
        else:
            key, colon, rest = body.partition(":")
            if not colon:
                raise ValueError(f"expected a mapping: {body}")
            key, rest = key.strip(), rest.strip()
        while levels[-1][0] >= indent:
            levels.pop()
        if rest in (">", "|"):
            part = []
            while i < len(lines) and (not lines[i].strip() or len(lines[i]) - len(lines[i].lstrip()) > indent):
                part.append(lines[i].strip())
                i += 1
            levels[-1][1][key] = (" " if rest == ">" else "\n").join(part).strip() + "\n"
        elif not rest:
            levels[-1][1][key] = {}
            levels.append((indent, levels[-1][1][key]))
        else:
            levels[-1][1][key] = _scalar(rest)
    return root


def _scalar(s: str):
    if s[0] in "\"'" and s[-1] == s[0] and len(s) > 1:
        return s[1:-1]
    s = s.split(" #", 1)[0].strip()
    if s in ("null", "~", ""):
        return None
    return {"true": True, "false": False}.get(s, int(s) if s.lstrip("-").isdigit() else s)


def load(path: str | Path) -> dict:
    text = Path(path).read_text(encoding="utf-8")
    value = yaml.safe_load(text) if yaml else _plain(text)
    if value is None:
        return {}
    if not isinstance(value, dict):
        raise ValueError(f"expected a mapping in {path}")
    return value


def section(path: str | Path, name: str) -> dict:
    """The mapping `name` of a configuration (book, tts), or an empty one."""
    return load(path).get(name) or {}


def pronunciation(path: str | Path) -> dict[str, str]:
    table = load(path).get("replacements") or {}
    if not isinstance(table, dict):
        raise ValueError("replacements must be a mapping")
    return {str(k): str(v) for k, v in table.items()}
