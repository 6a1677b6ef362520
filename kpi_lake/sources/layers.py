"""Layered table storage: bronze / silver / gold folders of one lake.

A table is a directory ``<root>/<layer>/<name>`` in one file format. Writes are full refreshes
(overwrite), optionally replacing or merging the stored schema. Delta is used when the format is
``delta`` and the package is on the cluster; parquet otherwise, with the schema rules re-expressed
on top of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

LAYERS = ("bronze", "silver", "gold")


# Name parts of folders that a write leaves behind if it is cut off.
STAGING, REPLACED = ".__staging-", ".__replaced-"
# A hidden file in each table folder that names its last full refresh (see ``refresh_id``).
REFRESH_FILE = "_refresh_id"
# In the folder of a versioned table: names of its versions, and of the file that names the current.
VERSION, POINTER = "v-", "_current"


class SchemaConflictError(ValueError):
    """A write that isn't to replace the schema would change a stored column's type or drop it."""


@dataclass(frozen=True)
class Lake:
    """Where the layers live and in which format tables are stored.

    ``pattern`` builds a table path from root, layer and name; the default is
    ``{root}/{layer}/{name}``. The shared test tables use ``{root}/{name}.parquet`` (one folder,
    no layer).
    """

    root: str
    fmt: str = "parquet"
    pattern: str = "{root}/{layer}/{name}"
    #: File tables as versions: a full refresh writes a folder of its own inside the table's, and a
    #: small file that names the current one is replaced in one step. Readers never find the table
    #: missing; the version before stays for those that have begun to read it.
    versioned: bool = False

    def path(self, layer: str, name: str) -> str:
        return self.pattern.format(root=self.root.rstrip("/"), layer=layer, name=name)


def source_lake(sf_dir: str) -> Lake:
    """The folder of shared parquet tables, seen as a lake with a single layer."""
    return Lake(root=sf_dir, fmt="parquet", pattern="{root}/{name}.parquet")


def read_table(spark: SparkSession, lake: Lake, layer: str, name: str) -> DataFrame:
    """Lazy scan of one table; projections and filters applied later reach the file scan."""
    if lake.fmt != "delta" and not lake.versioned:
        _recover(spark, lake.path(layer, name))
    return spark.read.format(lake.fmt).load(table_path(spark, lake, layer, name))


def table_path(spark: SparkSession, lake: Lake, layer: str, name: str) -> str:
    """The folder that holds the table's files now."""
    path = lake.path(layer, name)
    versions = _pointer(spark, path) if lake.versioned else []
    return f"{path}/{versions[0]}" if versions else path


def _pointer(spark: SparkSession, path: str) -> list[str]:
    """The current version's folder and the one before, as far as there are any."""
    text = _read_mark(spark, f"{path}/{POINTER}")
    return text.split("\n") if text else []


def _point_to(spark: SparkSession, path: str, versions: list[str]) -> None:
    """Replace the pointer file in one step: a rename that overwrites, or, on a store without one
    (where creating a small object is one step), creating it."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway  # noqa: SLF001
    new = f"{path}/{POINTER}.{uuid.uuid4().hex[:12]}"
    write_mark(spark, new, "\n".join(versions))
    src, fs = _fs_path(spark, new)
    dst, _ = _fs_path(spark, f"{path}/{POINTER}")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())  # noqa: SLF001
    except Exception as e:  # a store without that interface
        if "UnsupportedFileSystemException" not in str(e):
            raise
        write_mark(spark, f"{path}/{POINTER}", "\n".join(versions))
        fs.delete(src, False)
        return
    context.rename(src, dst, overwrite)


def _write_version(spark: SparkSession, writer, path: str) -> None:
    """A full refresh: write a new version, point to it, and let go of the one before the last."""
    version = f"{VERSION}{uuid.uuid4().hex[:12]}"
    try:
        writer.save(f"{path}/{version}")
    except Exception:
        _delete(spark, f"{path}/{version}")
        raise
    before = _pointer(spark, path)
    _point_to(spark, path, [version, *before[:1]])
    for old in before[1:]:
        _delete(spark, f"{path}/{old}")


def remove_unreferenced(spark: SparkSession, lake: Lake, layer: str, name: str) -> list[str]:
    """Delete the versions and pointer files that refreshes which were cut off left in a table's
    folder; not while one is running. Returns their names."""
    path = lake.path(layer, name)
    folder, fs = _fs_path(spark, path)
    keep = {POINTER, *_pointer(spark, path)}
    found = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    gone = [n for n in found if n not in keep and (n.startswith(VERSION) or n.startswith(POINTER))]
    for n in gone:
        _delete(spark, f"{path}/{n}")
    return sorted(gone)


def _delete(spark: SparkSession, path: str) -> None:
    hpath, fs = _fs_path(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def _existing_schema(spark: SparkSession, lake: Lake, layer: str, name: str) -> StructType | None:
    """Schema of the stored table; None where there is no folder or no file in it. Any other
    failure to read it is raised: a table that can't be read must not be taken for none."""
    path = table_path(spark, lake, layer, name)
    hpath, fs = _fs_path(spark, path)
    if not fs.exists(hpath):
        return None
    try:
        return spark.read.format(lake.fmt).load(path).schema
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def table_exists(spark: SparkSession, lake: Lake, layer: str, name: str) -> bool:
    """Whether the table is there, with a file that gives its schema."""
    if lake.fmt != "delta" and not lake.versioned:
        _recover(spark, lake.path(layer, name))
    return _existing_schema(spark, lake, layer, name) is not None


def _fs_path(spark: SparkSession, path: str):
    jvm = spark._jvm  # noqa: SLF001 - Hadoop FileSystem API for the swap, no data moves
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def _recover(spark: SparkSession, path: str) -> None:
    """Put back a table that a crash between the two renames of a swap left under its retired name."""
    dst, fs = _fs_path(spark, path)
    parent = dst.getParent()
    if parent is None or fs.exists(dst) or not fs.exists(parent):
        return
    retired = [f.getPath() for f in fs.listStatus(parent) if f.getPath().getName().startswith(dst.getName() + REPLACED)]
    if len(retired) == 1 and not fs.rename(retired[0], dst):
        raise OSError(f"could not put {retired[0]} back to {path}")
    if len(retired) > 1:
        raise OSError(f"{path} is missing and there are several retired versions of it: {sorted(map(str, retired))}")


def refresh_id(spark: SparkSession, lake: Lake, layer: str, name: str) -> str | None:
    """Names the last full refresh of a table by this library; appends keep it. None for folders
    that others wrote."""
    if lake.versioned:
        return next(iter(_pointer(spark, lake.path(layer, name))), None)
    return _read_mark(spark, f"{lake.path(layer, name)}/{REFRESH_FILE}")


def _read_mark(spark: SparkSession, path: str) -> str | None:
    hpath, fs = _fs_path(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def write_mark(spark: SparkSession, path: str, text: str) -> None:
    hpath, fs = _fs_path(spark, path)
    stream = fs.create(hpath, True)
    stream.writeUTF(text)
    stream.close()


def _swap_into_place(spark: SparkSession, staged: str, path: str) -> None:
    """Replace ``path`` by the fully written ``staged`` folder (two renames, then cleanup).

    Between the renames the table is missing for a moment; after a crash there the next read or
    write puts the old version back. Only Delta replaces a table in one step, and on an object
    store, where a rename copies, Delta is the format to use."""
    dst, fs = _fs_path(spark, path)
    src, _ = _fs_path(spark, staged)
    retired, _ = _fs_path(spark, f"{path}{REPLACED}{uuid.uuid4().hex[:12]}")
    had_old = fs.exists(dst)
    if had_old and not fs.rename(dst, retired):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(src, dst):
        if had_old:
            fs.rename(retired, dst)
        raise OSError(f"could not move {staged} to {path}")
    if had_old:
        fs.delete(retired, True)


def _merge_frame(df: DataFrame, old: StructType) -> DataFrame:
    """New rows carrying every old column: columns the new frame lacks are filled with null."""
    stored = {f.name: f.dataType for f in old.fields}
    shared = [_conform(F.col(f"`{f.name}`"), f.dataType, _merged_type(stored.get(f.name, f.dataType), f.dataType, f.name)).alias(f.name) for f in df.schema.fields]
    extra = [f for f in old.fields if f.name not in df.columns]
    return df.select(*shared, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])


def _merged_type(old: DataType, new: DataType, name: str) -> DataType:
    """The type that holds both: structs, also inside arrays and map values, have the stored fields
    and then the new ones. Anything else has to be equal."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        own = {f.name: f.dataType for f in new.fields}
        kept = [StructField(f.name, _merged_type(f.dataType, own.get(f.name, f.dataType), f"{name}.{f.name}")) for f in old.fields]
        return StructType(kept + [StructField(f.name, f.dataType) for f in new.fields if f.name not in {k.name for k in old.fields}])
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(_merged_type(old.elementType, new.elementType, f"{name}.element"))
    if isinstance(old, MapType) and isinstance(new, MapType) and old.keyType.simpleString() == new.keyType.simpleString():
        return MapType(old.keyType, _merged_type(old.valueType, new.valueType, f"{name}.value"))
    if old.simpleString() != new.simpleString():
        raise SchemaConflictError(f"column {name} is {old.simpleString()} in the stored table, {new.simpleString()} in the new data; write with schema_mode='replace'")
    return new


def _conform(value: Column, have: DataType, want: DataType) -> Column:
    """A value with the fields of a merged type; those that it lacks are null, a null stays null."""
    if have.simpleString() == want.simpleString():
        return value
    if isinstance(have, StructType) and isinstance(want, StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [_conform(value.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(fields, want.fields, strict=True)]))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(value, lambda x: _conform(x, have.elementType, want.elementType))
    return F.transform_values(value, lambda _, v: _conform(v, have.valueType, want.valueType))  # type: ignore[attr-defined]


def _check_columns(df: DataFrame, old: StructType, path: str) -> None:
    dropped = [f.name for f in old.fields if f.name not in df.columns]
    if dropped:
        raise SchemaConflictError(f"{path}: the new data lacks the stored columns {dropped}; write with schema_mode='replace' or 'merge'")


def _check_compatible(df: DataFrame, old: StructType, path: str) -> None:
    old_types = {f.name: f.dataType for f in old.fields}
    for f in df.schema.fields:
        if f.name in old_types and old_types[f.name] != f.dataType:
            raise SchemaConflictError(
                f"{path}: column {f.name} is {old_types[f.name].simpleString()} in the stored table, "
                f"{f.dataType.simpleString()} in the new data; write with schema_mode='replace'"
            )


def write_table(
    df: DataFrame,
    lake: Lake,
    layer: str,
    name: str,
    mode: str = "overwrite",
    schema_mode: str = "keep",
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    atomic: bool = True,
) -> str:
    """Full-refresh write of one table; returns its path.

    With ``atomic`` (file formats, overwrite), the job writes into a staging folder next to the
    table and the staging folder replaces the table, by two renames, only after the job has
    committed: a failed job leaves the previous table intact, a crash between the renames is put
    right by the next read or write, and a frame may overwrite the table it reads from.

    ``sort_within`` sorts each task's rows before writing (no shuffle): row groups then cover
    narrow key ranges, so a later filter on that key skips most of them from parquet statistics.

    schema_mode:
      ``keep``    overwrite; stored columns must not be dropped nor change their type.
      ``replace`` overwrite and take the new schema as it is.
      ``merge``   overwrite; columns of the stored table that the new data lacks survive as null,
                  so do fields of structs, at any depth; shared ones must not change their type.
    """
    if schema_mode not in ("keep", "replace", "merge"):
        raise ValueError(f"schema_mode must be keep, replace or merge, not {schema_mode!r}")
    spark = df.sparkSession
    path = lake.path(layer, name)
    writer_df = df
    if lake.fmt != "delta" and not lake.versioned:
        _recover(spark, path)
    if lake.fmt != "delta" and schema_mode != "replace" and mode in ("overwrite", "append"):
        old = _existing_schema(spark, lake, layer, name)
        if old is not None:
            if mode == "overwrite" and schema_mode == "merge":
                writer_df = _merge_frame(df, old)
            else:  # appended files must not disagree with the stored ones on a column's type either
                _check_compatible(df, old, path)
            if mode == "overwrite" and schema_mode == "keep":
                _check_columns(df, old, path)
    if sort_within:
        writer_df = writer_df.sortWithinPartitions(*sort_within)
    writer = writer_df.write.mode(mode).format(lake.fmt)
    if lake.fmt == "delta":
        if schema_mode == "replace":
            writer = writer.option("overwriteSchema", "true")
        elif schema_mode == "merge":
            writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if lake.versioned and lake.fmt != "delta":
        if mode == "append" and _pointer(spark, path):
            writer.save(table_path(spark, lake, layer, name))
        else:
            _write_version(spark, writer, path)
    elif atomic and mode == "overwrite" and lake.fmt != "delta":
        staged = f"{path}{STAGING}{uuid.uuid4().hex[:12]}"
        try:
            writer.save(staged)
        except Exception:
            staged_path, fs = _fs_path(spark, staged)
            if fs.exists(staged_path):
                fs.delete(staged_path, True)
            raise
        write_mark(spark, f"{staged}/{REFRESH_FILE}", uuid.uuid4().hex)
        _swap_into_place(spark, staged, path)
    else:
        writer.save(path)
    return path


def write_many(df: DataFrame, targets: Sequence[tuple[Lake, str, str]], **kwargs) -> list[str]:
    """Write one frame to several (lake, layer, name) targets.

    The plan runs once: the first target is written from the plan, the others are copies read
    back from the first written table (files, so a lost executor costs a re-read, not a rerun).
    """
    if not targets:
        return []
    first_lake, first_layer, first_name = targets[0]
    paths = [write_table(df, first_lake, first_layer, first_name, **kwargs)]
    written = read_table(df.sparkSession, first_lake, first_layer, first_name)
    for lake, layer, name in targets[1:]:
        paths.append(write_table(written, lake, layer, name, **kwargs))
    return paths


def copy_table(
    spark: SparkSession,
    src: Lake,
    src_layer: str,
    name: str,
    dst: Lake,
    dst_layer: str,
    columns: Sequence[str] | None = None,
    dst_name: str | None = None,
) -> str:
    """Pass a table through to another layer, optionally keeping only ``columns``."""
    df = read_table(spark, src, src_layer, name)
    if columns:
        df = df.select(*columns)
    return write_table(df, dst, dst_layer, dst_name or name)


__all__ = [
    "LAYERS",
    "Lake",
    "SchemaConflictError",
    "copy_table",
    "read_table",
    "refresh_id",
    "remove_unreferenced",
    "source_lake",
    "table_exists",
    "table_path",
    "write_many",
    "write_table",
]
