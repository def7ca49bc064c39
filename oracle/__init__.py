"""Plain SQL for every registered query, to check the Spark results against.

Written from the specification, on its own: the SQL shares only the fixed values with the
package. ``sql(name)`` assembles the text with just the parts a query needs.
"""

from oracle.inputs import INPUTS
from oracle.operators import OPERATORS
from oracle.stages import STAGES

_PARTS = {**INPUTS, **STAGES, **OPERATORS}


def _needed(name: str, seen: list[str]) -> None:
    text = _PARTS[name]
    for other in _PARTS:
        if other != name and other not in seen and f"{{{other}}}" in text:
            _needed(other, seen)
    if name not in seen:
        seen.append(name)


def sql(name: str, text_of: str | None = None) -> str:
    """The SQL of a query; ``text_of`` names a timestamp column to show as text."""
    columns = "*"
    if text_of:
        columns += f" REPLACE (strftime({text_of}, '%Y-%m-%d %H:%M:%S.%g') AS {text_of})"
    parts: list[str] = []
    _needed(name, parts)
    names = {p: p for p in _PARTS}
    ctes = [f"{p} AS (\n{_PARTS[p].format(**names).strip()}\n)" for p in parts]
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {columns} FROM {name}"
