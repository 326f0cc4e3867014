"""Hand-made rows, given to both engines: as a DataFrame, and as VALUES in SQL."""

from __future__ import annotations


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(literal, v)) + "]"
    return "'" + str(v).replace("'", "''") + "'"


def values(rows: list[tuple], names: str) -> str:
    """SELECT of the rows as a table with these columns."""
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({names})"
