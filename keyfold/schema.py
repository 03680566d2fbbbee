"""Column names and types of a delimited source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql.types import DataType, StructType

STATION = "station"
TEMP = "temp"
MEASUREMENT_NAMES = (STATION, TEMP)
MEASUREMENT_TYPES = {TEMP: "DOUBLE"}


def build_schema(
    names: Sequence[str] = MEASUREMENT_NAMES,
    types: Mapping[str | int, str | DataType] | Sequence[str | DataType] | None = None,
) -> StructType:
    """Schema from column names and types.

    ``types`` maps a name, or a position counted from 1 as in SQL, to a type;
    columns it leaves out are ``STRING``. It may also be one type per column.
    """
    if types is None:
        chosen = {}
    elif isinstance(types, Mapping):
        chosen = {}
        for which, kind in types.items():
            if isinstance(which, int):
                if not 1 <= which <= len(names):
                    raise ValueError(f"no column at position {which} among {list(names)}")
                which = names[which - 1]
            if which not in names:
                raise ValueError(f"no column {which!r} among {list(names)}")
            chosen[which] = kind
    else:
        if len(types) != len(names):
            raise ValueError(f"{len(names)} columns but {len(types)} types")
        chosen = dict(zip(names, types))
    schema = StructType()
    for name in names:
        kind = chosen.get(name, "STRING")
        schema = schema.add(name, DataType.fromDDL(kind) if isinstance(kind, str) else kind)
    return schema
