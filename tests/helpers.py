"""Documents for the tests."""

from __future__ import annotations

import io
import zipfile

OBJECT = {
    "class_id": "1",
    "name": "SEN",
    "category_id": "2",
    "index": "3",
    "object_id": "4",
    "show": "true",
    "GUID": "98246b27-0c91-4b26-8f8b-5537c56b6dc0",
}
VALUES = (1, "SEN", 2, 3, 4, True, "98246b27-0c91-4b26-8f8b-5537c56b6dc0")
COLUMNS = ("class_id", "name", "category_id", "index", "object_id", "show", "guid")


def row(tag: str = "t_object", extra: str = "", attributes: str = "", **changes) -> str:
    """A row element; a child set to None is left out."""
    children = {**OBJECT, **changes}
    inner = "".join(f"\n    <{k}>{v}</{k}>" for k, v in children.items() if v is not None)
    return f"  <{tag}{attributes}>{inner}{extra}\n  </{tag}>\n"


def document(*rows: str, head: str = '<?xml version="1.0" encoding="utf-8"?>\n') -> str:
    inner = "".join(rows)
    return f'{head}<SolutionDataset xmlns="urn:example:solution">\n{inner}</SolutionDataset>\n'


def values(**changes) -> tuple:
    return tuple({**dict(zip(COLUMNS, VALUES)), **changes}[c] for c in COLUMNS)


def zipped(**members: str | bytes) -> bytes:
    """A ZIP file; members are named without the .xml ending."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(f"{name}.xml", text)
    return out.getvalue()
