"""Sinks: CSV, JSON, checksum lists, partitioned tables, and publishing of several at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, exclusive: bool = False) -> None:
    """Columns in a fixed order with a header even if there are no rows; nulls are empty cells."""
    df.select(*(columns or df.columns)).write.mode("errorifexists" if exclusive else "overwrite").csv(path, header=True, nullValue="", emptyValue="")


def write_csv_union(frames: Sequence[DataFrame], path: str) -> None:
    """Rows of tables with different columns under the union of those, in the order they come up."""
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f, allowMissingColumns=True)
    write_csv(both, path)


def sorted_fields(column: Column, kind: T.DataType) -> Column:
    """A value whose structs have their fields in order, at every depth."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[sorted_fields(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)])
        return F.when(column.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: sorted_fields(x, kind.elementType))
    return column


def write_json(df: DataFrame, path: str, exclusive: bool = False) -> None:
    """One object a row with its keys in sorted order, nested ones too; nulls are written."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    rows = df.select(*[sorted_fields(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    rows.write.mode("errorifexists" if exclusive else "overwrite").option("ignoreNullFields", "false").json(path)


def write_split(df: DataFrame, path: str, split: str = "split") -> None:
    """A folder per split; rewriting one split leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(split).parquet(path)


def write_checksums(files: DataFrame, path: str, root: str = "") -> None:
    """Lines of digest, two blanks and path, in the order of the paths."""
    below = F.regexp_replace("path", "^(file:)?/*" + root.strip("/") + "/", "") if root else F.col("path")
    files.select(F.concat_ws("  ", "sha256", below).alias("value"), "path").orderBy("path").select("value").write.mode("overwrite").text(path)


def rewritten_paths(text: Column, old: str, new: str) -> Column:
    """A text with one root for another."""
    return F.replace(text, F.lit(old), F.lit(new))


def markdown(df: DataFrame, title: str, rows: int = 100) -> str:
    """A report's table of the first rows (a summary has few)."""
    cell = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "/")
    lines = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in df.limit(rows).collect()]
    return "\n".join(lines) + "\n"


def dataset_yaml(root: str, splits: Mapping[str, str], names: Sequence[str]) -> str:
    """The description of a data set that trainers read."""
    lines = [f"path: {root}", *(f"{k}: {v}" for k, v in splits.items()), "names:", *(f"  {i}: {n}" for i, n in enumerate(names))]
    return "\n".join(lines) + "\n"


def publish(spark: SparkSession, targets: Mapping[str, Callable[[str], None]]) -> None:
    """Write every target beside its place and move all there, or leave all as they were.

    ``targets`` maps a path to a function that writes to the path it is given.
    Nothing is moved before everything is written; if a move fails, those made
    before it are taken back.
    """
    tag = uuid.uuid4().hex
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    places = {t: (path(t), path(f"{t}.new-{tag}"), path(f"{t}.old-{tag}")) for t in targets}
    fs = {t: p[0].getFileSystem(conf) for t, p in places.items()}
    moved: list[str] = []
    try:
        for t, write in targets.items():
            write(f"{t}.new-{tag}")
        for t, (here, new, old) in places.items():
            if fs[t].exists(here) and not fs[t].rename(here, old):
                raise OSError(f"cannot move {t} aside")
            moved.append(t)
            if not fs[t].rename(new, here):
                raise OSError(f"cannot move {t} to its place")
    except BaseException:
        for t in reversed(moved):
            here, _, old = places[t]
            if fs[t].exists(old):
                fs[t].delete(here, True)
                fs[t].rename(old, here)
        raise
    finally:
        for t, (_, new, old) in places.items():
            fs[t].delete(new, True)
            if t in moved and fs[t].exists(places[t][0]):
                fs[t].delete(old, True)
