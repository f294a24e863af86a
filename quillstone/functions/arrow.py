"""Arrow arrays of what a pass over texts finds."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate, batched

import pyarrow as pa


def lists(rows: Iterable[list[tuple]], kinds: dict[str, pa.DataType], at_once: int = 500) -> pa.Array:
    """The tuples of each row as list<struct>, its fields by kinds; so many rows' tuples are held at once."""
    made = [pa.array([], pa.list_(pa.struct(list(kinds.items()))))]
    for some in batched(rows, at_once):
        columns = [pa.array([t[i] for own in some for t in own], kind) for i, kind in enumerate(kinds.values())]
        ends = pa.array(accumulate(map(len, some), initial=0), pa.int32())
        made.append(pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, list(kinds))))
    return pa.concat_arrays(made)
