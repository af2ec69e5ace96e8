"""Helpers that the operators share: column-wise Python over Arrow batches, words, tables."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Words of the search operators: ASCII letters are lower-cased, every other ASCII character that is
# not a digit separates, all characters beyond ASCII belong to words.
FOLDED = bytes(
    b + 32
    if 65 <= b <= 90
    else b
    if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122
    else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; any other column it has is left out."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def folded_words(text: bytes | None) -> list[bytes]:
    """Folded words of a UTF-8 text; a null text has none."""
    return text.translate(FOLDED).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Runs of characters other than the six ASCII white spaces."""
    return text.split() if text else []


def byte_texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def append_columns(
    df: DataFrame,
    make: Callable[[], Callable[..., dict]],
    inputs: list[str],
    outputs: T.StructType,
    keep: list[str] | None = None,
) -> DataFrame:
    """Add columns that a function computes from whole Arrow columns, a batch at a time.

    make() is called once in every task and gives a function from the input columns to a dict of
    output columns (lists or Arrow arrays). keep names the columns of df to return, by default all.
    An output replaces a column of df that has its name in any case of letters.
    """
    made = {field.name.lower() for field in outputs}
    fields = {field.name: field for field in df.schema}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in made]
    read = df.select(*dict.fromkeys([*inputs, *kept]))
    schema = T.StructType([fields[c] for c in kept] + list(outputs))
    names = schema.names
    kinds = {field.name: to_arrow_type(field.dataType) for field in outputs}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            got = compute(*(batch.column(c) for c in inputs))
            arrays = [batch.column(c) for c in kept]
            for name, kind in kinds.items():
                value = got[name]
                arrays.append(
                    value if isinstance(value, (pa.Array, pa.ChunkedArray)) else pa.array(value, kind)
                )
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return read.mapInArrow(run, schema)


def unused_names(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column has, in any case of letters."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def by_crc(column, divisor: int):
    """Remainder of the CRC-32 of an id as text, the rule that holds rows out; null ids give null."""
    return F.crc32(column.cast("string").cast("binary")) % divisor
