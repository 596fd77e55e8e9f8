"""Helpers that the corpus operators share: column idioms, appended columns, the held-out fold."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.columns import let
from waymark.plans.durable import components, forget, free_name, small_side
from waymark.plans.durable import written as materialise

__all__ = ["append_columns", "ascii_lower", "components", "forget", "free_name", "held_out", "let", "materialise", "portions", "renamed", "sliding", "small_side"]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII strings take the fast path of lower()."""
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(mapped)


def sliding(array: Column, width: int, combine: Callable[[Column, Column], Column], exact: bool) -> Column:
    """Combine each run of `width` neighbours by pairing the array with itself shifted, doubling the reach.

    exact: runs are cut into adjacent parts (for hashes); otherwise the last two may overlap (for minima).
    array must be cheap to name again (a column or a bound variable). The last width - 1 entries cover less.
    """

    def pair(reached: Column, other: Column | None, shift: int) -> Column:
        def body(a: Column) -> Column:
            return F.zip_with(a, F.slice(a if other is None else other, 1 + shift, F.size(array)), combine)

        return let(reached, body)

    whole, reach = array, 1
    if exact:
        for bit in bin(width)[3:]:
            whole, reach = pair(whole, None, reach), reach * 2
            if bit == "1":
                whole, reach = pair(whole, array, reach), reach + 1
    while reach < width:
        step = min(reach, width - reach)
        whole, reach = pair(whole, None, step), reach + step
    return whole


def portions(batch, column: str, size: int):
    """The batch in slices of consecutive rows whose texts or lists hold about size bytes or elements together."""
    import numpy as np
    import pyarrow.compute as pc

    array = batch.column(column)
    lengths = pc.list_value_length(array) if array.type.num_fields else pc.binary_length(array)
    group = np.cumsum(np.asarray(pc.fill_null(lengths, 0), np.int64)) // size
    ends = [*(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip([0, *ends], ends, strict=False):
        yield batch.slice(start, end - start)


def append_columns(df: DataFrame, fields: str, make: Callable, by: str | None = None, size: int = 1 << 21, without: str | None = None) -> DataFrame:
    """All columns of df and new ones: make gets an Arrow record batch and returns one array per field of the DDL.

    A column of df that has the name of a new one is replaced by it. by: make gets slices of a batch that hold
    about size bytes (or elements) of this column, so that what it needs does not grow with the rows of a batch.
    without: a column that make reads and the result leaves out.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    added = T.StructType.fromDDL(fields)
    df = df.drop(*added.names)
    passed = [f for f in df.schema.fields if f.name != without]
    names = [f.name for f in passed]

    def run(batches):
        for whole in batches:
            for batch in portions(whole, by, size) if by else [whole]:
                columns = [*(c for c, name in zip(batch.columns, batch.schema.names, strict=True) if name != without), *make(batch)]
                yield pa.RecordBatch.from_arrays(columns, [*names, *added.names])

    return df.mapInArrow(run, T.StructType([*passed, *added.fields]))


def held_out(key: str) -> Column:
    """The fold that no model may learn from: CRC-32 of the id as text leaves 0 by 5. A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def renamed(df: DataFrame, *names: str) -> list[str]:
    """For each wanted name of a helper column, one that df does not have."""
    return [free_name(df, name) for name in names]
