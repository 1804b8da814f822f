"""Arrow batches in tasks: append columns to rows, walk texts in bounded slices."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

#: Characters of text that a task holds as Python objects at a time.
SLICE_CHARS = 1 << 19


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores put before them until no column (in any case) has them."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


#: Rows of an Arrow batch (a few MB of text).
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session sends tasks' Python code at most BATCH_ROWS rows at a time."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def append(df: DataFrame, fields: list[tuple[str, str]], make: Callable[..., list],
           inputs: list[str], keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with new columns ``fields`` (name, DDL type) computed from ``inputs``.

    ``make(values...)`` gets the input columns of a slice of rows as lists, text as bytes (the
    first input must be text or binary; slices are cut by its size), and returns one list or
    array per field.  The rows themselves pass through as Arrow data, without a
    shuffle.  A column of the same name as a new one is replaced.
    """
    new = {n.lower() for n, _ in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    sent = kept + [c for c in inputs if c not in kept]
    places = [sent.index(c) for c in inputs]
    out = T.StructType([df.schema[c] for c in kept]
                       + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())      # gives freed memory back
        for batch in batches:
            for part in slices(batch, places[0]):
                values = make(*[_list(part.column(i)) for i in places])
                arrays = [part.column(i) for i in range(len(kept))]
                arrays += [pa.array(v, type=_ARROW[t]) for v, (_, t) in zip(values, fields)]
                yield pa.RecordBatch.from_arrays(arrays, names=out.fieldNames())

    # Sent under plain names: mapInArrow would read a dot in a name as a field of a struct.
    return small_batches(df).select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(sent)]).mapInArrow(run, out)


def _list(column: pa.Array) -> list:
    return (column.cast(pa.binary()) if pa.types.is_string(column.type) else column).to_pylist()


def text(raw: bytes | None) -> str:
    """Null is the empty text; ill-formed bytes become replacement characters."""
    return raw.decode("utf-8", "replace") if raw else ""


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
          "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def slices(batch: pa.RecordBatch, by: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts (column ``by``) have about SLICE_CHARS bytes."""
    column = batch.column(by)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        total += n + 16
        if total >= SLICE_CHARS:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


class Numbers(dict):
    """Keys numbered in order of first use; ``new`` lists those not seen before."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n

    def of(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class Remembered:
    """Rows of numbers per key, computed once by ``make(keys)``; emptied when over ``limit`` keys."""

    def __init__(self, make: Callable[[list[str]], np.ndarray], width: int, dtype, limit: int):
        self.make, self.limit = make, limit
        self.ids, self.rows = Numbers(), np.zeros((0, width), dtype=dtype)

    def of(self, keys: list[str]) -> np.ndarray:
        if len(self.ids) > self.limit:
            self.ids = Numbers()
        at, new = self.ids.of(keys), self.ids.new
        if new:
            n = len(self.ids) - len(new)
            if len(self.ids) > len(self.rows):
                grown = np.zeros((2 * len(self.ids), self.rows.shape[1]), dtype=self.rows.dtype)
                grown[:n] = self.rows[:n]
                self.rows = grown
            self.rows[n:n + len(new)] = self.make(new)
            self.ids.new = []
        return self.rows[at]
