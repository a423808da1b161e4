"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def id_remainder(c: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def id_mix(*columns: Column) -> Column:
    """A reproducible 64-bit mix of columns, for bounded samples."""
    return F.xxhash64(*columns)


def map_rows(
    df: DataFrame, schema: str, row: Callable[..., Iterable[tuple]], flush_rows: int = 4096
) -> DataFrame:
    """``row(*values)`` yields output tuples for each input row; batches go through Arrow."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                out.extend(row(*(c[i].as_py() for c in columns)))
                if len(out) >= flush_rows:
                    yield as_batch(out, target)
                    out = []
        if out:
            yield as_batch(out, target)

    return df.mapInArrow(run, schema)


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)
