"""Column names as they come from files: dots, spaces, repeats."""

from __future__ import annotations

from collections.abc import Iterable


def quoted(names: Iterable[str]) -> list[str]:
    """Names in backticks, so that a dot in one is no field access."""
    return [f"`{n.replace('`', '``')}`" for n in names]


def told_apart(names: list[str]) -> list[str]:
    """Header names made usable as column names: an empty one becomes
    ``Unnamed: <position>``, a repeated one gets ``.1``, ``.2`` and so on, the
    next number that no name of the header has.  Letter case does not tell
    columns apart in Spark, so it does not here either."""
    names = [n or f"Unnamed: {k}" for k, n in enumerate(names)]
    taken, out = {n.lower() for n in names}, []
    given: set[str] = set()
    for n in names:
        number, name = 0, n
        while name.lower() in given or (number and name.lower() in taken):
            number += 1
            name = f"{n}.{number}"
        given.add(name.lower())
        out.append(name)
    return out
