"""Small helpers to compose SQL text from named steps (``WITH`` chains)."""

from __future__ import annotations


def with_steps(steps: list[tuple[str, str]], final: str) -> str:
    """``WITH a AS (...), b AS (...) <final>``."""
    if not steps:
        return final
    body = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in steps)
    return f"WITH {body}\n{final}"


def values_relation(rows: list[tuple], columns: list[str]) -> str:
    """A ``VALUES`` relation with typed-by-value literals."""

    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS t({', '.join(columns)})"
