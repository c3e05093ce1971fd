"""The columnDependencies option: src=dest:transform, separated by commas."""

from __future__ import annotations

from pyspark.sql import types as T

from tidemark.functions.transforms import Transform

from .predicates import Dependency


def find(schema: T.StructType, name: str, case_sensitive: bool = False) -> T.StructField | None:
    return next((f for f in schema.fields if f.name == name or not case_sensitive and f.name.lower() == name.lower()), None)


def parse(text: str | None, schema: T.StructType, case_sensitive: bool = False) -> tuple[list[Dependency], list[str]]:
    """The dependencies, and what is wrong with the rest. Each transform must give its destination's type."""
    out, errors = [], []
    for item in filter(None, (x.strip() for x in (text or "").split(","))):
        sides = item.split("=")
        rest = sides[1].split(":") if len(sides) == 2 else []
        if len(rest) != 2:
            errors.append(f"column dependency {item!r} is not of the form source=destination:transform")
            continue
        src, dest = (find(schema, x.strip(), case_sensitive) for x in (sides[0], rest[0]))
        if src is None or dest is None:
            errors.append(f"column dependency {item!r} names a column that does not exist")
            continue
        try:
            transform = Transform(rest[1], src.dataType)
        except ValueError as e:
            errors.append(str(e))
            continue
        whole = isinstance(transform.result, T.IntegralType) and isinstance(dest.dataType, T.IntegralType)
        if transform.result != dest.dataType and not whole:
            errors.append(f"column dependency {item!r} gives {transform.result.simpleString()}, not {dest.dataType.simpleString()}")
            continue
        out.append(Dependency(src.name, dest.name, transform))
    return out, errors
