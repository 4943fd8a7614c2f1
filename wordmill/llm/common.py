"""What the corpus operators share: reading rows in small slices, spans, and their digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Span = tuple[str, int, int]

# Rows of one slice of an Arrow batch, and the bytes of text after which a slice ends earlier.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``rows`` rows, fewer where texts are long."""
    n = batch.num_rows
    if n == 0:
        return
    step = max(1, min(rows, int(n * SLICE_BYTES / max(1, batch.nbytes))))
    for start in range(0, n, step):
        yield batch.slice(start, step)


def map_rows(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, object]]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` for a generator that takes slices and gives columns by name.

    Rows stay in their partition; nothing is held but a slice and what ``function`` keeps.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    names = schema.names
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(part for batch in batches for part in slices(batch)):
            arrays = [
                c if isinstance(c := columns[name], pa.Array) else pa.array(c, type=arrow.field(name).type) for name in names
            ]
            # Lists made from flat arrays name their element in another way.
            arrays = [c if c.type == arrow.field(n).type else c.cast(arrow.field(n).type) for n, c in zip(names, arrays, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet, in any case of its letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The text column of a slice; null is empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def raw_texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The text column of a slice as UTF-8; null is empty."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    return [t or b"" for t in column.to_pylist()]


def span_list(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(spans: Iterable[Span], kinds: list[str], by_start: bool) -> list[Span]:
    """Spans by start and then kind as listed, or by kind as listed and then start."""
    rank = {k: i for i, k in enumerate(kinds)}
    if by_start:
        return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))
    return sorted(spans, key=lambda s: (rank[s[0]], s[1], s[2]))
