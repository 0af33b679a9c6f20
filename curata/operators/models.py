"""Models and checks of a caller's own as table functions over binary columns: loaded once per task, errors as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Segmenter(Protocol):
    """What a model must do: give the instances of one image as dictionaries."""

    def segment(self, content: bytes) -> Sequence[dict[str, Any]]: ...


def segmented(images: DataFrame, key: str, content: str, load: Callable[[], Segmenter], instance: str | T.StructType) -> DataFrame:
    """``key, source_index, error`` and the instance's fields: a row per instance, and one row for an image that fails or has none.

    ``load`` runs once in each task, before its first image.
    """
    own = T._parse_datatype_string(instance) if isinstance(instance, str) else instance
    schema = T.StructType([T.StructField(key, images.schema[key].dataType), T.StructField("source_index", T.IntegerType()), T.StructField("error", T.StringType()), *own.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, model = to_arrow_schema(schema), None
        for b in batches:
            rows = []
            for k, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    model = model or load()
                    found = [{key: k, "source_index": i, **one} for i, one in enumerate(model.segment(data))]
                    rows += found or [{key: k}]
                except Exception as e:  # the caller's code: one bad image is a row
                    rows.append({key: k, "error": f"{type(e).__name__}: {e}"})
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return images.select(key, content).mapInArrow(run, schema)


def checked(files: DataFrame, key: str, content: str, check: Callable[[bytes], str | None]) -> DataFrame:
    """``key, problem`` of what a check says about each file; null where it is content."""
    schema = T.StructType([T.StructField(key, files.schema[key].dataType), T.StructField("problem", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = []
            for data in b.column(1).to_pylist():
                try:
                    said.append(check(data))
                except Exception as e:  # the caller's code
                    said.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(said, pa.string())], [key, "problem"])

    return files.select(key, content).mapInArrow(run, schema)


def instances(rows: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """A row per element of parallel arrays, with ``source_index``; arrays of different lengths are an error."""
    n = F.size(arrays[0])
    same = F.lit(True)
    for a in arrays[1:]:
        same = same & (F.size(a) == n)
    zipped = F.when(same, F.arrays_zip(*arrays)).otherwise(F.raise_error(F.lit(f"{', '.join(arrays)} differ in length")).cast("void"))
    out = rows.select(*[c for c in rows.columns if c not in arrays], F.posexplode(zipped).alias("source_index", "__i"))
    return out.select(*[c for c in out.columns if c != "__i"], *[F.col(f"__i.{a}").alias(a) for a in arrays])


def mended_jpeg(content: Column) -> Column:
    """``method, content``: a JPEG as it is, with the end marker it lacks, or for a decoder to write anew."""
    begins, ends = F.hex(F.substring(content, 1, 2)) == "FFD8", F.hex(F.substring(content, -2, 2)) == "FFD9"
    method = F.when(~begins, "re_encode").when(ends, "copy").otherwise("append_end")
    whole = F.when(begins & ~ends, F.concat(content, F.unhex(F.lit("FFD9")))).when(begins, content)
    return F.struct(method.alias("method"), whole.alias("content"))
