"""Writing packages and JSON documents. Driver-side, one book at a time.

Each package is a version of its own beside the target, which is a link to the version
that counts. Moving the link is one step, so whoever reads the target finds the old
package or the new one, whenever the process ends.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame

from quire.operators.checks import assert_none


#: Files that are written with a line for each element.
INDENTED = (".xml", ".opf", ".ncx", ".smil")


def indented(xml: str) -> str:
    """XML with each element on a line of its own, two spaces deeper than the one around it; elements with text stay on one line."""
    out, depth, last = [], 0, ""
    for token in filter(None, (t if t.startswith("<") else t * bool(t.strip()) for t in re.split(r"(<[^>]*>)", xml))):
        kind = "text" if token[0] != "<" else "head" if token[1] in "?!" else "end" if token[1] == "/" else "empty" if token.endswith("/>") else "start"
        depth -= kind == "end"
        # an end tag closes its line if its element has only text or nothing
        if out and kind != "text" and last != "text" and not (kind == "end" and last == "start"):
            out.append("\n" + "  " * depth)
        out.append(token)
        depth += kind == "start"
        last = kind
    return "".join(out) + "\n"


def versions_of(target: Path) -> Path:
    return target.with_name(f"{target.name}.versions")


def _point(target: Path, version: Path) -> None:
    link = target.with_name(f"{target.name}.link-{uuid.uuid4().hex}")
    link.symlink_to(os.path.relpath(version, target.parent), target_is_directory=True)
    link.replace(target)


def _settle(target: Path) -> None:
    """Make the target a link, or nothing: a folder from elsewhere becomes a version, a lost link comes back."""
    versions = versions_of(target)
    if target.is_dir() and not target.is_symlink():
        versions.mkdir(parents=True, exist_ok=True)
        target.rename(versions / f"taken-{uuid.uuid4().hex}")
    elif os.path.lexists(target) and not target.is_symlink():
        raise ValueError(f"not a directory: {target}")
    if not target.exists() and versions.is_dir():
        whole = sorted((p for p in versions.iterdir() if not p.name.startswith("new-")), key=lambda p: p.stat().st_mtime)
        if whole:
            _point(target, whole[-1])


def publish(files: DataFrame, target: str | Path, validate: Callable[[Path], DataFrame], extra: Mapping[str, Path] | None = None) -> Path:
    """Write (path, content) rows and `extra` files as a new version, and point the target to it if `validate` finds nothing.

    On any failure the target stays as it was and the new version is removed. Other versions go once the target has moved.
    """
    target = Path(os.path.abspath(target))
    _settle(target)
    versions = versions_of(target)
    name = uuid.uuid4().hex
    new = versions / f"new-{name}"
    new.mkdir(parents=True)
    try:
        for r in files.select("path", "content").toLocalIterator():  # one book's files, one at a time
            (new / r.path).write_text(indented(r["content"]) if r.path.endswith(INDENTED) else r["content"], encoding="utf-8")
        for path, source in (extra or {}).items():
            shutil.copyfile(source, new / path)
        assert_none(validate(new))
    except BaseException:
        shutil.rmtree(new, ignore_errors=True)
        if not any(versions.iterdir()):
            versions.rmdir()
        raise
    whole = new.rename(versions / f"version-{name}")
    _point(target, whole)
    for other in versions.iterdir():
        if other != whole:
            shutil.rmtree(other, ignore_errors=True)
    return target


def zipped(folder: str | Path, target: str | Path, violations: DataFrame) -> tuple[Path, Path]:
    """A zip of a valid package, members by path, and a file with its SHA-256 and name."""
    assert_none(violations)
    folder, target = Path(folder).resolve(), Path(target)
    target.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(x for x in folder.rglob("*") if x.is_file()):
            z.write(p, p.relative_to(folder))
    sums = target.with_name(f"{target.stem}_sha256sums.txt")
    sums.write_text(f"{file_sha256(target)}  {target.name}\n", encoding="utf-8")
    return target, sums


def verified(archive: str | Path, sums: str | Path) -> list[str]:
    """What is wrong with a zipped package and its checksum file; nothing for a good one."""
    archive, wrong = Path(archive), []
    if not archive.is_file():
        return [f"no archive: {archive}"]
    want = dict(reversed(line.split("  ", 1)) for line in Path(sums).read_text(encoding="utf-8").splitlines())
    if want.get(archive.name) != file_sha256(archive):
        wrong.append(f"checksum of {archive.name}")
    try:
        with zipfile.ZipFile(archive) as z:
            if bad := z.testzip():
                wrong.append(f"damaged member {bad}")
            if z.namelist() != sorted(z.namelist()):
                wrong.append("members out of order")
    except zipfile.BadZipFile as e:
        wrong.append(str(e))
    return wrong


def file_sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_json(rows: DataFrame, path: str | Path, *drop: str) -> dict:
    """One nested row as a JSON document, indented by two, null fields left out, non-ASCII characters as they are."""
    value = rows.drop(*drop).toJSON().first()
    value = json.loads(value) if value else {}
    write_value(value, path)
    return value


def write_values(rows: DataFrame, path: str | Path) -> list[dict]:
    """The rows of a small report as a JSON array, in their order."""
    values = [json.loads(v) for v in rows.toJSON().toLocalIterator()]
    write_value(values, path)
    return values


def write_value(value, path: str | Path) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f"{path.name}.{uuid.uuid4().hex}")
    part.write_text(json.dumps(value, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    part.replace(path)
