"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Code points of text that Python code takes up together.
BATCH_CHARS = 2_000_000


#: What a Python worker keeps between tasks: the state of one operator at a time.
_kept: dict[tuple, Any] = {}


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """The state named `key`, made once a worker. Another operator's state (another first part of the key) is dropped
    first and its memory given back, as Spark uses a worker again for whatever task comes next."""
    if key not in _kept:
        if _kept and next(iter(_kept))[0] != key[0]:
            _kept.clear()
            give_back()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Freed memory goes back to the system, where its library can do that."""
    gc.collect()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


class Numbered(dict):
    """What is asked for gets the next number when it is first seen."""

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        return number


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def crc32_mod(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def by_characters(frames: Iterator[pd.DataFrame], text: str, limit: int = BATCH_CHARS) -> Iterator[pd.DataFrame]:
    """The same rows in frames of at most about `limit` characters, so a run of long texts does not meet in memory."""
    for frame in frames:
        start, held = 0, 0
        sizes = frame[text].str.len().to_numpy()
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield frame.iloc[start:i]
                start, held = i, 0
            held += n
        if start < len(frame):
            yield frame.iloc[start:]


def frames_of(df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, text: str = "text") -> DataFrame:
    """What `work` makes out of pandas frames of bounded text, any number of rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_characters(frames, text):
            yield work(frame)

    return df.mapInPandas(run, schema)


def by_bytes(batches: Iterator[pa.RecordBatch], text: str, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about `limit` bytes of text, so a run of long texts does not meet in memory."""
    for batch in batches:
        start, held = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def map_texts(df: DataFrame, keep: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], added: str, text: str = "text") -> DataFrame:
    """The columns `keep` and those that `work` makes out of the others, row by row, over pandas frames of bounded text.

    What is kept stays in Arrow: pandas would make a whole number beside a null a float, and round it. The rows keep their
    partition, so nothing is shuffled."""
    made = StructType.fromDDL(added)
    arrow, seen = to_arrow_schema(made), [c for c in df.columns if c not in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text):
            new = pa.RecordBatch.from_pandas(work(batch.select(seen).to_pandas()), schema=arrow, preserve_index=False)
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *new.columns], names=[*keep, *arrow.names])

    return df.mapInArrow(run, StructType([*(df.schema[c] for c in keep), *made.fields]))
