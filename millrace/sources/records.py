"""Record files (TFRecord of Example messages), read and written by tasks.

The writer is a Python data source that makes files of bounded size. The reader lists files with
``binaryFile``; tasks open them, a file is read by one task, and decode them in Arrow batches. Both
hold a block of a file, not the whole. Only where pyarrow has no file system for the path, Spark
hands the tasks whole files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from millrace.functions.types import RECORD_FLOAT, RECORD_INT, record_type
from millrace.session import qualified
from millrace.sources.file_writer import FileWriter, file_system, slices

# --- fixed values of the file formats -----------------------------------------------------------
CRC32C_POLYNOMIAL = 0x82F63B78
CRC_MASK_DELTA = 0xA282EAD8
# Field numbers of the value lists in a Feature message.
BYTES_LIST, FLOAT_LIST, INT_LIST = 1, 2, 3
# ------------------------------------------------------------------------------------------------

_FILE_BYTES = 128 << 20  # a task starts a new file beyond this size
_BLOCK_BYTES = 4 << 20
_BATCH_ROWS = 4096


# Record files -----------------------------------------------------------------------------------

def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(CRC32C_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _crc_of_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of many slices of a buffer: one step per byte position over all that reach it."""
    order = np.argsort(-lengths, kind="stable")
    starts, ordered = starts[order], lengths[order]
    state = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    active, position = len(starts), 0
    while active:
        while active and ordered[active - 1] <= position:
            active -= 1
        if active < 16:
            break
        step = (state[:active] ^ data[starts[:active] + position]) & 0xFF
        state[:active] = _CRC[step] ^ (state[:active] >> 8)
        position += 1
    table = _CRC.tolist() if active else ()
    for i in range(active):  # a few long slices are left
        value = int(state[i])
        for byte in data[starts[i] + position:starts[i] + ordered[i]].tobytes():
            value = table[(value ^ byte) & 0xFF] ^ (value >> 8)
        state[i] = value
    result = np.empty(len(starts), dtype=np.uint32)
    result[order] = state ^ np.uint32(0xFFFFFFFF)
    return result


def crc32c(payloads: list[bytes]) -> np.ndarray:
    lengths = np.array([len(p) for p in payloads], dtype=np.int64)
    return _crc_of_slices(np.frombuffer(b"".join(payloads), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths)


def _masked(crc: np.ndarray) -> np.ndarray:
    rotated = (crc >> np.uint32(15)) | (crc << np.uint32(17))
    return (rotated.astype(np.uint64) + CRC_MASK_DELTA).astype(np.uint32)


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append((value & 0x7F) | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _feature(kind: str, values: list) -> bytes:
    if kind == RECORD_FLOAT:
        return _field(FLOAT_LIST, _field(1, struct.pack(f"<{len(values)}f", *values)))
    if kind == RECORD_INT:
        return _field(INT_LIST, _field(1, b"".join(map(_varint, values))))
    texts = (v.encode() if isinstance(v, str) else bytes(v) for v in values)
    return _field(BYTES_LIST, b"".join(_field(1, t) for t in texts))


def _payloads(column: pa.Array, kind: str, is_array: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes that follow the last length of each row's entry: (buffer, starts, sizes); null has size -1."""
    n = len(column)
    if is_array or kind not in (RECORD_FLOAT, RECORD_INT):
        if is_array:
            packed = {RECORD_FLOAT: lambda v: struct.pack(f"<{len(v)}f", *v),
                      RECORD_INT: lambda v: b"".join(map(_varint, v))}.get(
                kind, lambda v: b"".join(_field(1, t.encode() if isinstance(t, str) else t) for t in v))
            rows = [None if v is None else packed(v) for v in column.to_pylist()]
        else:
            rows = [v.encode() if isinstance(v, str) else v for v in column.to_pylist()]
        sizes = np.array([-1 if r is None else len(r) for r in rows], dtype=np.int64)
        buffer = np.frombuffer(b"".join(r for r in rows if r), dtype=np.uint8)
        used = np.maximum(sizes, 0)
        return buffer, np.cumsum(used) - used, sizes
    if kind == RECORD_FLOAT:
        values = column.fill_null(0).to_numpy(zero_copy_only=False).astype("<f4")
        buffer, starts, sizes = values.view(np.uint8), np.arange(n) * 4, np.full(n, 4)
    else:
        values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        shifts = np.arange(10, dtype=np.uint64) * np.uint64(7)
        groups = values[:, None] >> shifts
        sizes = np.maximum((groups > 0).sum(axis=1), 1)
        more = np.arange(10) < (sizes - 1)[:, None]
        buffer = ((groups & np.uint64(0x7F)).astype(np.uint8) | np.where(more, 0x80, 0).astype(np.uint8)).ravel()
        starts = np.arange(n) * 10
    return buffer, starts, np.where(column.is_valid().to_numpy(zero_copy_only=False), sizes, -1)


def _around(name: bytes, kind: str, is_array: bool, size: int) -> bytes:
    """Tags and lengths in front of a payload of that size."""
    if kind == RECORD_FLOAT:
        feature = _field(FLOAT_LIST, _field(1, bytes(size)))
    elif kind == RECORD_INT:
        feature = _field(INT_LIST, _field(1, bytes(size)))
    else:
        feature = _field(BYTES_LIST, bytes(size) if is_array else _field(1, bytes(size)))
    entry = _field(1, _field(1, name) + _field(2, feature))
    return entry[:len(entry) - size]


def encode_records(batch: pa.RecordBatch, kinds: list[tuple[str, str, bool]]) -> bytes:
    """A batch as framed Example messages. A null leaves its feature out.

    Rows whose values have the same sizes share all tags and lengths: the bytes around the values
    are built once per such group and the values are copied in as arrays.
    """
    n = batch.num_rows
    if n == 0:
        return b""
    columns = [_payloads(c, kind, is_array) for c, (_, kind, is_array) in zip(batch.columns, kinds)]
    shapes, group_of = np.unique(np.column_stack([sizes for _, _, sizes in columns]), axis=0, return_inverse=True)
    group_of = group_of.ravel()
    layouts = []
    for shape in shapes.tolist():
        body, spots = b"", []
        for k, (size, (name, kind, is_array)) in enumerate(zip(shape, kinds)):
            if size >= 0:
                body += _around(name.encode(), kind, is_array, size)
                spots.append((k, len(body), size))
                body += bytes(size)
        head = _field(1, body)
        shift = len(head) - len(body)
        layouts.append((np.frombuffer(head, dtype=np.uint8), [(k, at + shift, size) for k, at, size in spots]))
    lengths = np.array([len(body) for body, _ in layouts], dtype=np.int64)[group_of]
    starts = np.cumsum(lengths + 16) - (lengths + 16)
    out = np.zeros(int(starts[-1] + lengths[-1] + 16), dtype=np.uint8)
    order = np.argsort(group_of, kind="stable")
    edges = np.searchsorted(group_of[order], np.arange(len(layouts) + 1))
    for g, (body, spots) in enumerate(layouts):
        rows = order[edges[g]:edges[g + 1]]
        block = np.tile(body, (len(rows), 1))
        for k, at, size in spots:
            buffer, begin, _ = columns[k]
            if size:
                block[:, at:at + size] = buffer[begin[rows][:, None] + np.arange(size)]
        out[(starts[rows] + 12)[:, None] + np.arange(len(body))] = block

    def put(offset, values):
        raw = np.ascontiguousarray(values).view(np.uint8).reshape(n, -1)
        out[(starts + offset)[:, None] + np.arange(raw.shape[1])] = raw

    put(0, lengths.astype("<u8"))
    put(8, _masked(_crc_of_slices(out, starts, np.full(n, 8))).astype("<u4"))
    put(lengths + 12, _masked(_crc_of_slices(out, starts + 12, lengths)).astype("<u4"))
    return out.tobytes()


def _one_file(first: bytes, others: Iterator[bytes]) -> Iterator[bytes]:
    size = 0
    for framed in chain([first], others):
        yield framed
        size += len(framed)
        if size >= _FILE_BYTES:
            return


class RecordWriter(FileWriter):
    suffix = ".tfrecord"

    def contents(self, batches):
        kinds = [(f.name, *record_type(f.dataType)) for f in self.schema]
        framed = (
            encode_records(some, kinds) for batch in batches for some in slices(batch, _BLOCK_BYTES, _BATCH_ROWS)
        )
        for first in framed:
            yield _one_file(first, framed)


class RecordSource(DataSource):
    @classmethod
    def name(cls):
        return "millrace_tfrecord"

    def writer(self, schema, overwrite):
        return RecordWriter(self.options, schema, overwrite)


def write_tfrecord(df: DataFrame, path: str) -> None:
    for field in df.schema:
        record_type(field.dataType)
    # The format has one float width; decimals travel as doubles and are narrowed by the encoder.
    plain = df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ])
    df.sparkSession.dataSource.register(RecordSource)
    plain.write.format("millrace_tfrecord").mode("overwrite").save(qualified(df.sparkSession, path))


def _read_varint(data, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data):
    at = 0
    while at < len(data):
        tag, at = _read_varint(data, at)
        if tag & 7 == 2:
            length, at = _read_varint(data, at)
            yield tag >> 3, data[at:at + length]
            at += length
        elif tag & 7 == 5:
            yield tag >> 3, data[at:at + 4]
            at += 4
        elif tag & 7 == 0:
            value, at = _read_varint(data, at)
            yield tag >> 3, value
        else:
            raise ValueError(f"unexpected wire type {tag & 7} in a record")


def _values(feature) -> list:
    values: list = []
    for kind, payload in _fields(feature):
        for _, item in _fields(payload):
            if kind == BYTES_LIST:
                values.append(bytes(item))
            elif kind == FLOAT_LIST:
                values.extend(struct.unpack(f"<{len(item) // 4}f", item))
            elif isinstance(item, int):
                values.append(item - (1 << 64) if item >> 63 else item)
            else:
                at = 0
                while at < len(item):
                    value, at = _read_varint(item, at)
                    values.append(value - (1 << 64) if value >> 63 else value)
    return values


def _decode_any(message) -> dict[str, list]:
    """Features of a message in any field order."""
    row = {}
    for _, features in _fields(message):
        for _, entry in _fields(features):
            parts = dict(_fields(entry))
            row[bytes(parts[1]).decode()] = _values(parts.get(2, b""))
    return row


def decode_example(message: bytes) -> dict[str, list]:
    """Features of a message. The common layout, key before value and packed numbers, is read directly."""
    def sized(at):
        size = message[at + 1]
        return (size, at + 2) if size < 0x80 else _read_varint(message, at + 1)

    row, at = {}, 0
    if not message:
        return row
    if message[0] != 0x0A:
        return _decode_any(message)
    size, at = sized(0)
    end = at + size
    while at < end:
        size, at = sized(at)
        stop = at + size
        if message[at] != 0x0A:
            return _decode_any(message)
        size, at = sized(at)
        name = message[at:at + size].decode()
        at += size
        if at == stop or message[at] != 0x12:
            return _decode_any(message)
        size, at = sized(at)
        if size == 0:
            row[name] = []
            continue
        kind = message[at] >> 3
        size, at = sized(at)
        if kind == FLOAT_LIST and size and message[at] == 0x0A:
            size, at = sized(at)
            if at + size != stop:
                return _decode_any(message)
            row[name] = list(struct.unpack_from(f"<{size // 4}f", message, at))
        elif kind == INT_LIST and size and message[at] == 0x0A:
            size, at = sized(at)
            if at + size != stop:
                return _decode_any(message)
            values = []
            while at < stop:
                value, at = _read_varint(message, at)
                values.append(value - (1 << 64) if value >> 63 else value)
            row[name] = values
        elif kind == BYTES_LIST:
            values = []
            while at < stop:
                size, at = sized(at)
                values.append(message[at:at + size])
                at += size
            row[name] = values
        else:
            return _decode_any(message)
        at = stop
    return row


def _bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Starts and lengths of the payloads of whole records, and where the last of them ends."""
    at, starts, lengths = 0, [], []
    while at + 12 <= len(raw):
        length = int.from_bytes(raw[at:at + 8], "little")
        if at + 16 + length > len(raw):
            break
        starts.append(at + 12)
        lengths.append(length)
        at += 16 + length
    return np.array(starts, dtype=np.int64), np.array(lengths, dtype=np.int64), at


def _damaged() -> ValueError:
    return ValueError("a record file is damaged: a checksum does not match")


def _verify(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
    def stored(offsets):
        return data[offsets[:, None] + np.arange(4)].view("<u4").ravel()

    for first in range(0, len(begin), _BATCH_ROWS):
        b, s = begin[first:first + _BATCH_ROWS], size[first:first + _BATCH_ROWS]
        heads = _masked(_crc_of_slices(data, b - 12, np.full(len(b), 8)))
        if (heads != stored(b - 4)).any() or (_masked(_crc_of_slices(data, b, s)) != stored(b + s)).any():
            raise _damaged()


def record_slices(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the payloads of a record file, checksums verified."""
    begin, size, end = _bounds(data.tobytes())
    if end != len(data):
        raise _damaged()
    _verify(data, begin, size)
    return begin, size


def record_blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A record file block by block: the bytes, and starts and lengths of the payloads, checksums verified.

    A block ends where a record does; one longer than a block is read at once.
    """
    left, rest, wanted = b"", stream.size(), 0
    while rest:
        fresh = stream.read(min(rest, max(_BLOCK_BYTES, wanted - len(left))))
        if not fresh:
            break
        rest -= len(fresh)
        left += fresh
        begin, size, end = _bounds(left)
        if end:
            data = np.frombuffer(left, dtype=np.uint8)
            _verify(data, begin, size)
            yield data, begin, size
            left, data = left[end:], None
        wanted = 16 + int.from_bytes(left[:8], "little") if len(left) >= 12 else 0
        if wanted > len(left) + rest:
            break
    if left or rest:
        raise _damaged()


def _layout(message: bytes, kinds) -> list[tuple[int, int]] | None:
    """(start, size) of the payload of each wanted scalar in a message, when all of them are plain.

    Found by decoding the message twice: once as it is, and by locating each value's only possible
    place, the end of its entry. Messages with other features or shapes give None.
    """
    found, at = {}, 0
    try:
        _, at = _read_varint(message, 1)
        while at < len(message):
            size, at = _read_varint(message, at + 1)
            stop = at + size
            key_size, at = _read_varint(message, at + 1)
            name = message[at:at + key_size].decode()
            at += key_size
            for _ in range(3):  # feature, list, packed values or text
                size, at = _read_varint(message, at + 1)
            if at + size != stop:
                return None
            found[name] = (at, size)
            at = stop
        places = [found.get(name) for name, _, _ in kinds]
        rebuilt = b""
        for name in found:
            kind = next(k for n, k, _ in kinds if n == name)
            start, size = found[name]
            rebuilt += _around(name.encode(), kind, False, size) + message[start:start + size]
        return places if _field(1, rebuilt) == message else None
    except (IndexError, StopIteration, UnicodeDecodeError):
        return None


def decode_records(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, kinds, types) -> list[pa.Array]:
    """Columns of a batch of messages.

    Messages that agree in all bytes but those of the values are decoded together as arrays; the
    few that agree with no other, and all messages with array features, one by one.
    """
    n = len(starts)
    columns: list[list] = [[None] * n for _ in kinds]
    left = np.arange(n)
    tries = 0 if any(is_array for _, _, is_array in kinds) else 64
    while len(left) and tries:
        tries -= 1
        start, length = starts[left[0]], lengths[left[0]]
        message = data[start:start + length].tobytes()
        places = _layout(message, kinds)
        if places is None:
            break
        same = left[lengths[left] == length]
        block = data[starts[same][:, None] + np.arange(length)]
        fixed = np.ones(length, dtype=np.uint8) * 0xFF
        for place, (_, kind, _) in zip(places, kinds):
            if place:
                # Of integers the continuation bits belong to the layout.
                fixed[place[0]:place[0] + place[1]] = 0x80 if kind == RECORD_INT else 0
        alike = ((block ^ np.frombuffer(message, dtype=np.uint8)) & fixed == 0).all(axis=1)
        rows, block = same[alike].tolist(), block[alike]
        for column, place, (_, kind, _) in zip(columns, places, kinds):
            if place is None:
                continue
            part = np.ascontiguousarray(block[:, place[0]:place[0] + place[1]])
            if kind == RECORD_FLOAT:
                values = part.view("<f4")[:, 0].tolist() if place[1] else [None] * len(rows)
            elif kind == RECORD_INT:
                shifts = np.arange(place[1], dtype=np.uint64) * np.uint64(7)
                whole = ((part & 0x7F).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64)
                values = whole.view(np.int64).tolist()
            else:
                raw, size = part.tobytes(), place[1]
                values = [raw[i * size:(i + 1) * size] for i in range(len(rows))]
            for row, value in zip(rows, values):
                column[row] = value
        left = np.setdiff1d(left, same[alike], assume_unique=True)
    for row in left.tolist():
        features = decode_example(data[starts[row]:starts[row] + lengths[row]].tobytes())
        for column, (name, _, is_array) in zip(columns, kinds):
            values = features.get(name)
            column[row] = values if is_array else (values[0] if values else None)
    return [pa.array(c, type=t) for c, t in zip(columns, types)]


def read_tfrecord(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of Example records under the given schema; a missing feature is null."""
    kinds = [(f.name, *record_type(f.dataType)) for f in schema]
    wire = {RECORD_INT: T.LongType(), RECORD_FLOAT: T.FloatType()}
    flat = T.StructType([
        T.StructField(name, T.ArrayType(wire.get(kind, T.BinaryType())) if is_array else wire.get(kind, T.BinaryType()))
        for name, kind, is_array in kinds
    ])
    arrow = {RECORD_INT: pa.int64(), RECORD_FLOAT: pa.float32()}
    target = pa.schema([
        (name, pa.list_(arrow.get(kind, pa.binary())) if is_array else arrow.get(kind, pa.binary()))
        for name, kind, is_array in kinds
    ])

    def decode(batches):
        for batch in batches:
            for file in batch.column(0):
                with _stream(file) as stream:
                    for data, starts, lengths in record_blocks(stream):
                        for first in range(0, len(starts), _BATCH_ROWS):
                            part = slice(first, first + _BATCH_ROWS)
                            arrays = decode_records(data, starts[part], lengths[part], kinds, target.types)
                            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tfrecord*").load(path)
    decoded = files.select("path" if _reachable(qualified(spark, path)) else "content").mapInArrow(decode, flat)
    return decoded.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def _reachable(path: str) -> bool:
    """Whether tasks can open files there without Spark."""
    try:
        system, plain = file_system(path)
        system.get_file_info(plain)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def _stream(file: pa.Scalar):
    """A file by its path or from its content."""
    if pa.types.is_binary(file.type) or pa.types.is_large_binary(file.type):
        return pa.BufferReader(file.as_buffer())
    system, plain = file_system(file.as_py())
    return system.open_input_file(plain)
