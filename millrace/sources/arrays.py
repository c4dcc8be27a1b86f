"""Numpy files, written and read by tasks without loss of digits.

``.npy`` files hold either one matrix, its rows stacked, or typed records with a field per column.
``.npz`` archives hold an array per column. Whatever a file's type cannot hold exactly is refused.

A file's type and shape stand in front of its rows and depend on all of them: the writer keeps the
batches of a file on local disk until they are known, then writes the rows block by block.

The reader parses only the headers when it plans; a task then reads a range of rows, so one large
file gives many tasks and nothing has to fit in memory as a whole. Members of compressed archives
can only be read from their start, one task each, block by block.
"""

from __future__ import annotations

import contextlib
import io
import struct
import zipfile
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.session import qualified
from millrace.sources.file_writer import FileWriter, file_system, local_file, slices

_FILE_BYTES = 128 << 20  # a task starts a new file beyond this size
_TASK_BYTES = 64 << 20  # rows of one file that a task reads
_BLOCK_BYTES = 4 << 20
_BLOCK_ROWS = 1 << 16  # so that what is said of each row, like its path, stays small too
_EXACT = 1 << 53  # integers up to this are exact as doubles
#: Field that tells which integers or booleans of a typed record are missing.
_MISSING = "__missing"


# Writing ----------------------------------------------------------------------------------------

def _is_list(kind: pa.DataType) -> bool:
    return pa.types.is_list(kind) or pa.types.is_large_list(kind)


def _shape(column: pa.Array, name: str) -> tuple[np.dtype, int | None]:
    """Type of a column's numbers, doubles if some are missing, and the length of its lists if it has any."""
    if _is_list(column.type):
        widths = pc.unique(pc.list_value_length(column).drop_null()).to_pylist()
        inner, _ = _shape(column.flatten(), name)
        return np.dtype(np.float64) if column.null_count else inner, _one_width(set(widths), name)
    if column.null_count and not pa.types.is_floating(column.type):
        return np.dtype(np.float64), None
    return np.dtype(column.type.to_pandas_dtype()), None


def _one_width(widths: set[int], name: str) -> int | None:
    if len(widths) > 1:
        raise ValueError(f"lists of column {name} differ in length: {sorted(widths)[:5]}")
    return next(iter(widths), None)


def _common(dtypes: Iterable[np.dtype]) -> np.dtype:
    """The narrowest type of all; next to reals the others are doubles."""
    dtypes = set(dtypes)
    kinds = {d.kind for d in dtypes}
    return np.dtype(np.float64) if "f" in kinds and kinds != {"f"} else np.result_type(*dtypes)


def _cells(column: pa.Array, name: str, dtype: np.dtype, width: int | None) -> np.ndarray:
    """A column as one array of that type, with NaN for missing numbers and lists."""
    present = column.is_valid().to_numpy(zero_copy_only=False) if column.null_count else None
    if _is_list(column.type):
        inner = _cells(column.flatten(), name, dtype, None).reshape(len(column) - column.null_count, width)
    elif column.null_count and not pa.types.is_floating(column.type):
        inner = _exactly(column.drop_null().to_numpy(zero_copy_only=False), name, dtype)
    else:
        return _exactly(column.to_numpy(zero_copy_only=False), name, dtype)
    if present is None:
        return inner
    cells = np.full((len(column), *inner.shape[1:]), np.nan, dtype)
    cells[present] = inner
    return cells


def _exactly(cells: np.ndarray, name: str, dtype: np.dtype) -> np.ndarray:
    if dtype.kind == "f" and cells.dtype.kind in "iu" and cells.size and max(int(cells.max()), -int(cells.min())) > _EXACT:
        raise ValueError(f"integers of column {name} do not fit a matrix of doubles; write layout='records'")
    return cells.astype(dtype, copy=False)


class _Held:
    """Batches of one file, on local disk, and the type and width that all of them give each column."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, 0, 0
        self._dtypes: list[set[np.dtype]] = [set() for _ in schema]
        self._widths: list[set[int]] = [set() for _ in schema]
        self._file = local_file()
        self._out = pa.ipc.new_file(self._file, schema)

    def add(self, batch: pa.RecordBatch) -> None:
        self._out.write_batch(batch)
        self.rows += batch.num_rows
        self.bytes += batch.nbytes
        for column, name, dtypes, widths in zip(batch.columns, self.schema.names, self._dtypes, self._widths):
            dtype, width = _shape(column, name)
            dtypes.add(dtype)
            if width is not None:
                widths.add(width)
                _one_width(widths, name)

    def shapes(self) -> list[tuple[np.dtype, int | None]]:
        """Of each column, after the last batch."""
        self._out.close()
        for field, widths in zip(self.schema, self._widths):
            if _is_list(field.type) and not any(widths):
                raise ValueError(f"lists of column {field.name} are all missing or empty")
        return [(_common(d), next(iter(w), None)) for d, w in zip(self._dtypes, self._widths)]

    def batches(self, columns: list[int] | None = None) -> Iterator[pa.RecordBatch]:
        reader = pa.ipc.open_file(self._file, options=pa.ipc.IpcReadOptions(included_fields=columns))
        for i in range(reader.num_record_batches):
            yield reader.get_batch(i)

    def close(self) -> None:
        self._file.close()


def _head(dtype: np.dtype, shape: tuple[int, ...]) -> bytes:
    """What stands in front of the rows of an array: of one without rows, with their number put in.

    The format pads its header so that the number of rows can grow.
    """
    buffer = io.BytesIO()
    np.save(buffer, np.empty((0, *shape[1:]), dtype))
    head, rows = buffer.getvalue(), b"(%d," % shape[0]
    at = head.rindex(b"(0,")
    return (head[:at] + rows + head[at + 3:-1])[:len(head) - 1] + b"\n"


class NpyWriter(FileWriter):
    """``.npy`` with one array of rows, or ``.npz`` with one array per column, under its name."""

    def __init__(self, options, schema, overwrite=False):
        super().__init__(options, schema, overwrite)
        self.layout = options.get("layout", "matrix")
        self.compressed = options.get("compressed", "false").lower() == "true"
        self.suffix = ".npz" if self.layout == "archive" else ".npy"

    def _matrix(self, held: _Held) -> Iterator[bytes]:
        """Columns side by side, in the narrowest common type that holds all of them exactly."""
        shapes = held.shapes()
        dtype = _common(d for d, _ in shapes)
        yield _head(dtype, (held.rows, sum(w or 1 for _, w in shapes)))
        for batch in held.batches():
            blocks = [_cells(c, n, dtype, w) for c, n, (_, w) in zip(batch.columns, held.schema.names, shapes)]
            yield np.hstack([c if c.ndim > 1 else c[:, None] for c in blocks]).tobytes()

    def _records(self, held: _Held) -> Iterator[bytes]:
        """Typed records; an integer or boolean that can be missing has a second field that says so."""
        fields, columns = [], []
        for field, asked, (dtype, width) in zip(held.schema, self.schema, held.shapes()):
            real = _is_list(field.type) or pa.types.is_floating(field.type)
            dtype = dtype if real else np.dtype(field.type.to_pandas_dtype())
            flag = None if real or not asked.nullable else field.name + _MISSING
            if flag:
                fields.append((flag, np.dtype(bool)))
            fields.append((field.name, dtype) if width is None else (field.name, dtype, (width,)))
            columns.append((field.name, dtype, width, real, flag))
        dtype = np.dtype(fields)
        yield _head(dtype, (held.rows,))
        for batch in held.batches():
            out = np.empty(batch.num_rows, dtype)
            for column, (name, kind, width, real, flag) in zip(batch.columns, columns):
                if flag:
                    out[flag] = column.is_null().to_numpy(zero_copy_only=False)
                if not real:
                    column = column.fill_null(False if pa.types.is_boolean(column.type) else 0)
                out[name] = _cells(column, name, kind, width)
            yield out.tobytes()

    def _archive(self, held: _Held) -> Iterator[bytes]:
        kind = zipfile.ZIP_DEFLATED if self.compressed else zipfile.ZIP_STORED
        shapes = held.shapes()
        with local_file() as whole:
            with zipfile.ZipFile(whole, "w", kind) as archive:
                for i, (name, (dtype, width)) in enumerate(zip(held.schema.names, shapes)):
                    with archive.open(f"{name}.npy", "w", force_zip64=True) as member:
                        member.write(_head(dtype, (held.rows,) if width is None else (held.rows, width)))
                        for batch in held.batches([i]):
                            member.write(_cells(batch.column(0), name, dtype, width).tobytes())
            whole.seek(0)
            while block := whole.read(_BLOCK_BYTES):
                yield block

    def contents(self, batches):
        write = {"records": self._records, "archive": self._archive}.get(self.layout, self._matrix)
        left = (some for batch in batches for some in slices(batch, _BLOCK_BYTES))
        for first in left:
            with contextlib.closing(_Held(first.schema)) as held:
                held.add(first)
                while held.bytes < _FILE_BYTES and (some := next(left, None)) is not None:
                    held.add(some)
                yield write(held)


def _check_numeric(df: DataFrame) -> None:
    for field in df.schema:
        inner = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
        if not isinstance(inner, (T.NumericType, T.BooleanType)) or isinstance(inner, T.DecimalType):
            raise ValueError(f"column {field.name} of type {field.dataType.simpleString()} is no array of numbers")


def write_npy(df: DataFrame, path: str, layout: str = "matrix") -> None:
    """One or more ``.npy`` files per partition; files already in the folder go.

    ``layout="matrix"`` stacks rows to one 2-D array: integers stay integers if all columns are, and
    otherwise numbers are doubles, with NaN for null. An integer that a double cannot hold fails the
    job. ``layout="records"`` has typed fields under the columns' names, and holds any integer and
    any null. Lists of a column must be equally long; a null list is one of NaN.
    """
    if layout not in ("matrix", "records"):
        raise ValueError(f"layout must be matrix or records, not {layout!r}")
    _check_numeric(df)
    df.sparkSession.dataSource.register(NpySource)
    df.write.format("millrace_npy").option("layout", layout).mode("overwrite").save(qualified(df.sparkSession, path))


def write_npz(df: DataFrame, path: str, names: list[str] | None = None, compressed: bool = False) -> None:
    """One or more ``.npz`` files per partition.

    ``names`` lists the columns that keep their names; the others count as positional and become
    ``arr_0``, ``arr_1``, ... in column order. By default all names are kept.
    """
    _check_numeric(df)
    named = df.columns if names is None else names
    positional = [c for c in df.columns if c not in named]
    renamed = df.withColumnsRenamed({c: f"arr_{i}" for i, c in enumerate(positional)})
    df.sparkSession.dataSource.register(NpySource)
    renamed.write.format("millrace_npy").option("layout", "archive").option(
        "compressed", str(compressed).lower()
    ).mode("overwrite").save(qualified(df.sparkSession, path))


# Reading ----------------------------------------------------------------------------------------

@dataclass
class ArrayRows(InputPartition):
    """Rows ``start`` to ``stop`` of an array in a file; ``offset`` is where its data begin, None if compressed."""

    path: str
    name: str | None
    offset: int | None
    dtype: np.dtype
    shape: tuple[int, ...]
    columns_first: bool
    start: int
    stop: int

    @property
    def row_bytes(self) -> int:
        return self.dtype.itemsize * int(np.prod(self.shape[1:], dtype=np.int64))


def _header(stream) -> tuple[tuple[int, ...], bool, np.dtype]:
    version = np.lib.format.read_magic(stream)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, columns_first, dtype = read(stream)
    if dtype.hasobject:
        raise ValueError("arrays of Python objects are not read")
    return shape, columns_first, dtype


def _member_offset(stream, member: zipfile.ZipInfo) -> int:
    """Where the data of an uncompressed member begin: after its local header, name and extra field."""
    stream.seek(member.header_offset + 26)
    name, extra = struct.unpack("<HH", stream.read(4))
    return member.header_offset + 30 + name + extra


def _arrays(path: str) -> list[ArrayRows]:
    """The arrays of a file, from their headers."""
    system, plain = file_system(path)
    with system.open_input_file(plain) as stream:
        if not plain.endswith(".npz"):
            shape, columns_first, dtype = _header(stream)
            return [ArrayRows(path, None, stream.tell(), dtype, shape, columns_first, 0, shape[0] if shape else 1)]
        found = []
        with zipfile.ZipFile(stream) as archive:
            for member in archive.infolist():
                name = member.filename.removesuffix(".npy")
                with archive.open(member) as inner:
                    shape, columns_first, dtype = _header(inner)
                    head = inner.tell()
                stored = member.compress_type == zipfile.ZIP_STORED
                offset = _member_offset(stream, member) + head if stored else None
                found.append(ArrayRows(path, name, offset, dtype, shape, columns_first, 0, shape[0] if shape else 1))
        return found


def find_arrays(path: str) -> list[ArrayRows]:
    """All arrays of a ``.npy`` or ``.npz`` file, or of those in a folder. Only headers are read."""
    from pyarrow import fs

    system, root = file_system(path)
    info = system.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        files = [path]
    else:
        listed = system.get_file_info(fs.FileSelector(root))
        files = sorted(
            f"{path.rstrip('/')}/{f.base_name}" for f in listed
            if f.is_file and f.extension in ("npy", "npz") and f.base_name[0] not in "._"
        )
    with ThreadPoolExecutor(16) as pool:
        return [array for some in pool.map(_arrays, files) for array in some]


def _blocks(rows: ArrayRows) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x values) of the range, in blocks of bounded size."""
    shape, width = rows.shape, int(np.prod(rows.shape[1:], dtype=np.int64))
    step = max(1, min(_BLOCK_ROWS, _BLOCK_BYTES // max(1, rows.row_bytes)))
    system, plain = file_system(rows.path)
    with system.open_input_file(plain) as stream:
        if rows.offset is None:
            with zipfile.ZipFile(stream) as archive, archive.open(f"{rows.name}.npy") as inner:
                if rows.columns_first and len(shape) > 1:
                    # Its columns follow each other: a block of rows needs all of them.
                    yield 0, np.lib.format.read_array(io.BytesIO(inner.read())).reshape(shape[0], width)
                    return
                _header(inner)
                for start in range(0, rows.stop, step):
                    size = min(step, rows.stop - start)
                    yield start, np.frombuffer(inner.read(size * rows.row_bytes), rows.dtype).reshape(size, width)
            return
        for start in range(rows.start, rows.stop, step):
            size = min(step, rows.stop - start)
            if rows.columns_first and len(shape) > 1:
                block = np.empty((size, width), rows.dtype)
                strides = np.cumprod([1, *shape[:-1]])
                for place, index in enumerate(np.ndindex(*shape[1:])):
                    stream.seek(rows.offset + rows.dtype.itemsize * int(start + np.dot(index, strides[1:])))
                    block[:, place] = np.frombuffer(stream.read(size * rows.dtype.itemsize), rows.dtype)
            else:
                stream.seek(rows.offset + start * rows.row_bytes)
                block = np.frombuffer(stream.read(size * rows.row_bytes), rows.dtype).reshape(size, width)
            yield start, block


def _native(values: np.ndarray) -> np.ndarray:
    return values.astype(values.dtype.newbyteorder("="), copy=False)


def _column(cells: np.ndarray, kind: pa.DataType, missing: np.ndarray | None = None) -> pa.Array:
    """Values as the asked-for type; what it cannot hold fails, and NaN is null where there is no NaN."""
    cells = np.ascontiguousarray(_native(cells))
    if cells.dtype.kind == "f" and not pa.types.is_floating(kind):
        missing = np.isnan(cells)
        cells = np.where(missing, 0, cells)
    values = pa.array(cells, mask=missing)
    if pa.types.is_boolean(kind) and not pa.types.is_boolean(values.type):
        return pc.not_equal(values, pa.scalar(0, values.type))
    if pa.types.is_boolean(values.type) and not pa.types.is_boolean(kind):
        values = values.cast(pa.int8())
    narrower = pa.types.is_floating(values.type) and pa.types.is_floating(kind)
    return values.cast(kind, safe=not narrower)


def _lists(cells: np.ndarray, kind: pa.DataType) -> pa.Array:
    size, width = cells.shape
    offsets = pa.array(np.arange(size + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, _column(cells.ravel(), kind.value_type)).cast(kind)


class NpyReader(DataSourceReader):
    """Rows of arrays: (path, array_name, row_idx, values), or under a table's schema."""

    def __init__(self, options, schema):
        self.path = options["path"]
        self.table = options.get("rows", "arrays") == "table"
        self.schema = schema

    def partitions(self):
        out = []
        for array in find_arrays(self.path):
            if array.offset is None:
                out.append(array)
                continue
            step = max(1, _TASK_BYTES // max(1, array.row_bytes))
            for start in range(0, array.stop, step):
                part = (array.path, array.name, array.offset, array.dtype, array.shape, array.columns_first)
                out.append(ArrayRows(*part, start, min(array.stop, start + step)))
        return out or [InputPartition(None)]

    def read(self, partition):
        if not isinstance(partition, ArrayRows):
            return
        target = to_arrow_schema(self.schema)
        for start, block in _blocks(partition):
            if self.table:
                columns = self._fields(block, target)
            else:
                if block.dtype.names:
                    raise ValueError(f"{partition.path} holds typed records: read it as a table")
                size = len(block)
                columns = [
                    pa.array([partition.path] * size, pa.string()), pa.array([partition.name] * size, pa.string()),
                    pa.array(np.arange(start, start + size)), _lists(block, target.field("values").type),
                ]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    def _fields(self, block: np.ndarray, target: pa.Schema) -> list[pa.Array]:
        out = []
        if block.dtype.names:
            record = block.reshape(-1)
            for field in target:
                if field.name not in record.dtype.names:
                    raise ValueError(f"no field {field.name} among {record.dtype.names}")
                cells, flag = record[field.name], field.name + _MISSING
                if pa.types.is_list(field.type):
                    out.append(_lists(cells.reshape(len(cells), -1), field.type))
                else:
                    missing = np.ascontiguousarray(record[flag]) if flag in record.dtype.names else None
                    out.append(_column(cells, field.type, missing))
            return out
        for i, field in enumerate(target):
            if pa.types.is_list(field.type):
                out.append(_lists(np.ascontiguousarray(block[:, i:]), field.type))
            else:
                out.append(_column(block[:, i], field.type))
        return out


class NpySource(DataSource):
    @classmethod
    def name(cls):
        return "millrace_npy"

    def reader(self, schema):
        return NpyReader(self.options, schema)

    def writer(self, schema, overwrite):
        return NpyWriter(self.options, schema, overwrite)


def _load(spark: SparkSession, path: str, schema, rows: str) -> DataFrame:
    spark.dataSource.register(NpySource)
    return spark.read.format("millrace_npy").schema(schema).option("rows", rows).load(qualified(spark, path))


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """Arrays of ``.npy`` and ``.npz`` files as (path, array_name, row_idx, values).

    Each row of a file's array is one output row; ``array_name`` is null for ``.npy``. ``values`` are
    longs if all arrays are of integers or booleans, otherwise doubles, and a number that these do
    not hold exactly fails the job.
    """
    whole = all(a.dtype.kind in "biu" for a in find_arrays(qualified(spark, path)))
    values = "array<long>" if whole else "array<double>"
    return _load(spark, path, f"path string, array_name string, row_idx long, values {values}", "arrays")


def read_npy_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of ``.npy`` files under the given schema: records by name, a matrix by place, arrays last."""
    arrays = [i for i, f in enumerate(schema) if isinstance(f.dataType, T.ArrayType)]
    found = find_arrays(qualified(spark, path))
    if arrays and arrays != [len(schema) - 1] and not all(a.dtype.names for a in found):
        raise ValueError("only the last column of a stacked array can itself be an array")
    return _load(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in schema]), "table")
