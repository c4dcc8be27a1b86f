"""Readers, writers, listings, record files and connector options."""

import json
import os
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of
from millrace.operators.upsert import latest_by_key, upsert
from millrace.session import qualified
from millrace.sources import connectors as C
from millrace.sources import files as L
from millrace.sources import arrays, csv_records, records, tables, text


def write(folder, name, content, mode="w"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", mode) as out:
        out.write(content)
    return f"{folder}/{name}"


def test_csv(spark, folder):
    path = write(folder, "a.csv", "x;y;z\n# note\n1;NA;3\n4;5;6\n")
    df = tables.read_csv(spark, path, sep=";", comment="#", na_values="NA", usecols=["x", "y"])
    assert [tuple(r) for r in df.collect()] == [(1, None), (4, 5)]
    assert tables.read_csv(spark, path, sep=";", comment="#", names=["p", "q", "r"]).columns == ["p", "q", "r"]
    tables.write_csv(df, f"{folder}/out")
    tables.write_csv(df, f"{folder}/out")
    assert tables.read_csv(spark, f"{folder}/out").count() == 2


def test_json_layouts(spark, folder):
    lines = write(folder, "l.json", '{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n')
    array = write(folder, "r.json", '[\n{"a": 1, "b": "x"},\n{"a": 2, "b": "y"}]')
    columns = write(folder, "c.json", json.dumps({"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": "y"}}, indent=1))
    for path, orient in ((lines, "lines"), (array, "records"), (columns, "columns")):
        df = tables.read_json(spark, path, orient, "a int, b string").select("a", "b")
        assert sorted(map(tuple, df.collect())) == [(1, "x"), (2, "y")]
    assert tables.read_json(spark, columns, "columns").columns == ["index", "a", "b"]
    with pytest.raises(ValueError):
        tables.read_json(spark, lines, "table")


def test_parquet_text_and_whole_files(spark, folder):
    df = spark.range(3).select("id", F.col("id").cast("string").alias("value"))
    tables.write_parquet(df, f"{folder}/p")
    assert tables.read_parquet(spark, f"{folder}/p", ["value"]).columns == ["value"]
    tables.write_text(df.coalesce(1), f"{folder}/t")
    whole = tables.read_whole(spark, f"{folder}/t").first()
    assert whole.content == "0\n1\n2\n"
    assert bytes(tables.read_whole(spark, f"{folder}/t/*.txt", binary=True).first().content) == b"0\n1\n2\n"


def test_excel_is_gated(spark, folder):
    try:
        import openpyxl  # noqa: F401
    except ImportError:
        with pytest.raises(RuntimeError, match="openpyxl"):
            tables.read_excel(spark, folder, "a int")


def test_images(spark, folder):
    import struct
    import zlib

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    pixels = zlib.compress(b"\x00" + b"\xff\x00\x00" * 3 + b"\x00" + b"\x00\xff\x00" * 3)
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 3, 2, 8, 2, 0, 0, 0)) + chunk(
        b"IDAT", pixels) + chunk(b"IEND", b"")
    write(folder, "a.png", png, "wb")
    row = tables.read_images(spark, folder).first()
    assert (row.width, row.height, row.nChannels) == (3, 2, 3)


def test_tables_of_the_catalog(spark, store):
    store.create_featuregroup(spark.sql("SELECT 1 AS a"), "g", descriptive_statistics=False, feature_correlation=False,
                              feature_histograms=False, cluster_analysis=False)
    assert tables.read_table(spark, "g_1", store.database).count() == 1


def test_matrix(spark, folder):
    path = write(folder, "m.txt", "# head\n1 2.5 -3e1\n\n4 nan 6 # tail\n")
    rows = [r["values"] for r in text.read_matrix(spark, path).collect()]
    assert rows[0] == [1.0, 2.5, -30.0] and rows[1][0] == 4.0 and np.isnan(rows[1][1])
    with pytest.raises(ValueError, match="from 2 to 3"):
        text.read_matrix(spark, write(folder, "bad.txt", "1 2 3\n1 2\n"))
    with pytest.raises(Exception, match="could not convert"):
        text.read_matrix(spark, write(folder, "bad2.txt", "1 x\n")).collect()


def test_matrix_with_gaps(spark, folder):
    path = write(folder, "g.csv", "h1\nh2\n1,,x,4\n5,6,7,8\n")
    rows = [r["values"] for r in text.read_matrix_with_gaps(spark, path, ",", skip_header=2, filling=-1.0).collect()]
    assert rows == [[1.0, -1.0, -1.0, 4.0], [5.0, 6.0, 7.0, 8.0]]


def test_headers_of_split_files(spark, folder):
    """Files cut into many splits and several files in one task lose exactly their first lines."""
    for k in range(3):
        write(folder, f"{k}.txt", "".join(f"{k} {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        frame = spark.read.text(folder)
        assert frame.rdd.getNumPartitions() > 3
        rows = [tuple(map(int, r["values"])) for r in text.read_matrix(spark, folder, skip_header=7).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(rows) == [(k, i) for k in range(3) for i in range(7, 5000)]
    again = [tuple(map(int, r["values"])) for r in text.read_matrix(spark, folder, skip_header=7).collect()]
    assert sorted(again) == sorted(rows)


def test_regex_records(spark, folder):
    path = write(folder, "r.txt", "a=1 b=x a=2 b=y\nnothing\na=3\nb=z\n")
    rows = text.read_regex(spark, path, r"a=(\d+)\s+b=(\w)", "a int, b string").collect()
    assert sorted(map(tuple, rows)) == [(1, "x"), (2, "y")]
    spanning = text.read_regex(spark, path, r"a=(\d+)\s+b=(\w)", "a int, b string", whole_files=True).collect()
    assert sorted(map(tuple, spanning)) == [(1, "x"), (2, "y"), (3, "z")]


def test_binary_records(spark, folder):
    os.makedirs(folder)
    layout = [("a", "<i4"), ("b", ">f8"), ("c", "S2"), ("d", "i1"), ("e", "V3")]
    values = [(i, i / 2, b"ab", i % 5, b"xyz") for i in range(1000)]
    np.array(values, dtype=layout).tofile(f"{folder}/x.bin")
    df = text.read_binary_records(spark, f"{folder}/x.bin", layout)
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "string"), ("d", "tinyint"), ("e", "binary")]
    rows = sorted((r.a, r.b, r.c, r.d, bytes(r.e)) for r in df.collect())
    assert rows == [(a, b, c.decode(), d, e) for a, b, c, d, e in values]


@pytest.mark.parametrize("size", ["40", "97", "100000"])
def test_csv_records_over_splits(spark, folder, size):
    import random

    random.seed(51)
    piece = ["a", "bc", '"', '""', ",", "\n", "\n\n", " ", "\r\n", "\\", "é", "x" * 60, ""]
    texts = [None, "", "plain"] + ["".join(random.choices(piece, k=random.randint(0, 12))) for _ in range(150)]
    rows = [(i, t, i / 4) for i, t in enumerate(texts)] + [(None, "\n" * 300 + '"', None)]
    df = spark.createDataFrame(rows, "i long, t string, r double").repartition(2)
    options = {"header": "true", "escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**options).csv(folder)
    whole = spark.read.schema(df.schema).options(**options, multiLine="true").csv(folder).collect()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, size)
        read = csv_records.read_csv_records(spark, folder, df.schema, options, ".csv")
        found = read.collect()
        lines = csv_records._lines(spark, folder, ".csv")
        assert size == "100000" or lines.rdd.getNumPartitions() > 10
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(map(str, found)) == sorted(map(str, whole)) and len(found) == len(rows)
    assert sorted(map(str, found)) == sorted(map(str, df.collect()))


@pytest.mark.parametrize("size", ["16", "1000000"])
def test_heading_lines_over_splits(spark, folder, size):
    import os

    os.makedirs(folder)
    for n in range(3):
        lines = [f"heading {i}" for i in range(5)] + [str(100 * n + i) for i in range(40)]
        with open(f"{folder}/{n}.txt", "w") as file:
            file.write("\n".join(lines) + "\n")
    with open(f"{folder}/short.txt", "w") as file:
        file.write("heading\nheading\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, size)
        found = text.skip_first_lines(spark.read.text(folder), 5).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(int(r.value) for r in found) == sorted(100 * n + i for n in range(3) for i in range(40))


def test_provenance_of_rows_read(spark, folder):
    spark.range(10).coalesce(1).write.parquet(f"{folder}/a b")
    spark.range(10, 30).coalesce(1).write.parquet(f"{folder}/c")
    a, c = spark.read.parquet(f"{folder}/a b"), spark.read.parquet(f"{folder}/c")
    found = L.provenance(a.filter("id >= 4"), c.filter("id > 100"), a).collect()
    assert [(r.rows, r.path.split("/")[-2]) for r in found] == [(16, "a b")]
    path = found[0].path.removeprefix("file:")
    assert found[0].length == os.path.getsize(path) and L.provenance(c.filter("id < 0")).count() == 0


def test_npy_and_npz(spark, folder):
    df = spark.range(0, 500, 1, 3).select("id", (F.col("id") / 2).alias("half"))
    arrays.write_npy(df, f"{folder}/npy")
    rows = arrays.read_npy(spark, f"{folder}/npy").collect()
    assert sorted(tuple(r["values"]) for r in rows) == [(i, i / 2) for i in range(500)]
    assert {r.array_name for r in rows} == {None}
    arrays.write_npz(df, f"{folder}/npz", names=["half"])
    named = arrays.read_npy(spark, f"{folder}/npz").groupBy("array_name").agg(F.sum(F.col("values")[0]).alias("s"))
    assert {tuple(r) for r in named.collect()} == {("arr_0", 124750.0), ("half", 62375.0)}
    os.makedirs(f"{folder}/own")
    np.save(f"{folder}/own/a.npy", np.arange(12).reshape(2, 3, 2))
    np.savez(f"{folder}/own/b.npz", np.array(5), named=np.arange(3))
    own = {(r.array_name, r.row_idx): r["values"] for r in arrays.read_npy(spark, f"{folder}/own").collect()}
    assert own[(None, 1)] == [6, 7, 8, 9, 10, 11] and own[("arr_0", 0)] == [5] and own[("named", 2)] == [2]
    with pytest.raises(ValueError, match="no array of numbers"):
        arrays.write_npy(spark.sql("SELECT 'x' AS t"), f"{folder}/text")


def test_npy_keeps_every_digit(spark, folder):
    schema = "k long, b boolean, s short, f float, v array<long>"
    rows = [(2**53 + 1, True, None, 0.5, [1, 2**62]), (-(2**63), None, 3, None, [-1, 0]), (None, False, -4, 1.5, [7, 8])]
    df = spark.createDataFrame(rows, schema).repartition(2)
    arrays.write_npy(df, f"{folder}/records", layout="records")
    read = arrays.read_npy_table(spark, f"{folder}/records", df.schema)
    # A missing float comes back as NaN's counterpart in the format.
    assert {(r.k, r.b, r.s, r.f if r.f == r.f else None, tuple(r.v)) for r in read.collect()} == {(*r[:4], tuple(r[4])) for r in rows}
    whole = df.select("k").na.drop()
    arrays.write_npy(whole, f"{folder}/whole")
    found = arrays.read_npy(spark, f"{folder}/whole")
    assert found.schema["values"].dataType.elementType.simpleString() == "bigint"
    assert {r["values"][0] for r in found.collect()} == {2**53 + 1, -(2**63)}
    booleans = spark.createDataFrame([(True, 1), (None, 2)], "b boolean, i int")
    arrays.write_npz(booleans, f"{folder}/nulls")
    values = {(r.array_name, r["values"][0]) for r in arrays.read_npy(spark, f"{folder}/nulls").collect()}
    assert {v for v in values if v[1] == v[1]} == {("b", 1.0), ("i", 1.0), ("i", 2.0)} and len(values) == 4


def test_npy_refuses_what_does_not_fit(spark, folder):
    for bad in (
        spark.createDataFrame([(2**53 + 1, 0.5)], "k long, d double"),
        spark.createDataFrame([(2**53 + 1,), (None,)], "k long").coalesce(1),
        spark.createDataFrame([([1],), ([1, 2],)], "v array<int>").coalesce(1),
    ):
        with pytest.raises(Exception, match="do not fit|differ in length"):
            arrays.write_npy(bad, f"{folder}/bad")
        assert not os.path.exists(f"{folder}/bad")
    arrays.write_npy(spark.createDataFrame([(1.5,)], "d double"), f"{folder}/half")
    with pytest.raises(Exception, match="truncated"):
        arrays.read_npy_table(spark, f"{folder}/half", T.StructType().add("d", T.IntegerType())).collect()


def test_npy_is_read_by_ranges_of_rows(spark, folder):
    os.makedirs(folder)
    large = np.arange(17_000_000, dtype="<i8").reshape(17_000, 1000)
    np.save(f"{folder}/large.npy", large)
    read = arrays.read_npy(spark, f"{folder}/large.npy")
    assert read.rdd.getNumPartitions() == 3
    sums = read.select("row_idx", F.aggregate("values", F.lit(0).cast("long"), lambda a, x: a + x).alias("s"))
    assert sums.where(F.col("s") != F.col("row_idx") * 1_000_000 + 499_500).count() == 0 and sums.count() == 17_000
    odd = np.arange(24, dtype=">f4").reshape(4, 3, 2)
    for name, array in {"c": odd, "f": np.asfortranarray(odd), "flat": odd[:, 0, 0], "none": odd[:0]}.items():
        np.save(f"{folder}/{name}.npy", array)
        np.savez(f"{folder}/{name}.npz", one=array, two=array[:, ::-1] if array.ndim > 1 else array)
        np.savez_compressed(f"{folder}/{name}-small.npz", one=array)
        for file, of in ((".npy", array), (".npz", array), ("-small.npz", array)):
            rows = arrays.read_npy(spark, f"{folder}/{name}{file}").where("array_name IS NULL OR array_name = 'one'").collect()
            assert [r["values"] for r in sorted(rows, key=lambda r: r.row_idx)] == [row.ravel().tolist() for row in of]


def _most_memory(work) -> int:
    """Most bytes that Python and numpy held at once during the work, above those held before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _batches(n, rows=10_000):
    for i in range(n):
        k = np.arange(i * rows, (i + 1) * rows)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(k / 4), pa.array(k / 8)], ["k", "x", "y"])


@pytest.mark.parametrize("layout", ["matrix", "records", "archive"])
def test_npy_writer_holds_blocks_not_files(tmp_path, layout):
    schema = T.StructType().add("k", "long").add("x", "double").add("y", "double")
    writer = arrays.NpyWriter({"path": str(tmp_path / "out"), "layout": layout}, schema, True)
    names = []
    most = _most_memory(lambda: names.extend(writer.write(_batches(200)).names))  # 48 MB in one file
    assert most < 24 << 20 and len(names) == 1
    read = np.load(next(tmp_path.glob(f"out.staging-*/{names[0]}")))
    x = read[:, 1] if layout == "matrix" else read["x"]
    assert x.tolist() == (np.arange(2_000_000) / 4).tolist()


def test_npy_file_takes_its_type_from_all_batches(tmp_path):
    """Missing numbers and lists that only a later batch has."""
    kind = pa.schema([("k", pa.int32()), ("b", pa.bool_()), ("v", pa.list_(pa.float32()))])
    batches = [
        pa.RecordBatch.from_pydict({"k": [1, 2], "b": [True, False], "v": [None, None]}, kind),
        pa.RecordBatch.from_pydict({"k": [], "b": [], "v": []}, kind),
        pa.RecordBatch.from_pydict({"k": [None, 4], "b": [True, None], "v": [[1, 2], [None, 4]]}, kind),
    ]
    schema = T.StructType().add("k", T.IntegerType()).add("b", "boolean", False).add("v", T.ArrayType(T.FloatType()))
    nan = np.nan
    for layout in ("matrix", "archive", "records"):
        writer = arrays.NpyWriter({"path": str(tmp_path / layout), "layout": layout}, schema, True)
        name, = writer.write(iter(batches)).names
        read = np.load(next(tmp_path.glob(f"{layout}.staging-*/{name}")))
        if layout == "matrix":
            rows = [[1, 1, nan, nan], [2, 0, nan, nan], [nan, 1, 1, 2], [4, nan, nan, 4]]
            np.testing.assert_array_equal(read, np.array(rows))
            assert read.dtype == np.float64
            continue
        v = np.array([[nan, nan], [nan, nan], [1, 2], [nan, 4]])
        np.testing.assert_array_equal(read["v"], v)
        if layout == "archive":
            np.testing.assert_array_equal(read["k"], np.array([1, 2, nan, 4]))
            assert (read["v"].dtype, read["b"].dtype) == (np.float64, np.float64)
        else:
            assert read["k"].tolist() == [1, 2, 0, 4] and read["k__missing"].tolist() == [False, False, True, False]
            assert read.dtype["k"] == np.int32 and read.dtype.names == ("k__missing", "k", "b", "v")
    with pytest.raises(ValueError, match="differ in length"):
        more = pa.RecordBatch.from_pydict({"k": [1], "b": [True], "v": [[1.0]]}, kind)
        arrays.NpyWriter({"path": str(tmp_path / "bad")}, schema, True).write(iter([*batches, more]))
    with pytest.raises(ValueError, match="do not fit"):
        longs = [pa.RecordBatch.from_pydict({"k": [2**53 + 1]}), pa.RecordBatch.from_pydict({"k": pa.array([None], pa.int64())})]
        arrays.NpyWriter({"path": str(tmp_path / "bad")}, T.StructType().add("k", "long"), True).write(iter(longs))


def test_npz_is_read_in_batches_of_few_rows(tmp_path):
    """What each row carries besides its number, like the path, stays in bounds."""
    np.savez_compressed(tmp_path / "a.npz", x=np.arange(300_000.0))
    schema = T.StructType().add("path", "string").add("array_name", "string").add("row_idx", "long")
    schema = schema.add("values", T.ArrayType(T.DoubleType()))
    reader = arrays.NpyReader({"path": str(tmp_path)}, schema)
    found = [b for part in reader.partitions() for b in reader.read(part)]
    assert max(b.num_rows for b in found) <= 1 << 16
    assert [v for b in found for v in b.column(2).to_pylist()] == list(range(300_000))


def test_failed_overwrite_keeps_the_old_files(spark, folder):
    arrays.write_npy(spark.range(10), f"{folder}/kept")
    bad = spark.range(100, 110).select(F.when(F.col("id") < 105, F.col("id")).otherwise(F.raise_error(F.lit("no"))))
    with pytest.raises(Exception, match="no"):
        arrays.write_npy(bad.repartition(3).toDF("id"), f"{folder}/kept")
    assert arrays.read_npy(spark, f"{folder}/kept").count() == 10 and os.listdir(folder) == ["kept"]
    arrays.write_npy(spark.range(3), f"{folder}/kept")
    assert arrays.read_npy(spark, f"{folder}/kept").count() == 3 and os.listdir(folder) == ["kept"]


def test_crc32c():
    known = {b"": 0, b"123456789": 0xE3069283, bytes(32): 0x8A9136AA, b"\xff" * 32: 0x62A8AB43}
    many = list(known) * 9 + [b"123456789" * 50]
    found = records.crc32c(many).tolist()
    assert found[:-1] == list(known.values()) * 9
    assert records.crc32c([many[-1]]).tolist() == [found[-1]]


def test_record_files(spark, folder):
    df = spark.createDataFrame(
        [(1, -2, 0.5, "é", [1, -1], [0.25], ["p", ""], b"\x00\xff"), (None, 1 << 40, None, None, [], None, None, None)],
        "a int, b long, c double, d string, e array<long>, f array<float>, g array<string>, h binary",
    )
    records.write_tfrecord(df, folder)
    rows = records.read_tfrecord(spark, folder, df.schema).orderBy("b").collect()
    assert rows == df.orderBy("b").collect()
    assert os.path.exists(f"{folder}/_SUCCESS") and not os.path.exists(f"{folder}/_temporary")
    name = next(n for n in os.listdir(folder) if n.endswith(".tfrecord"))
    with open(f"{folder}/{name}", "r+b") as f:
        f.seek(14)
        f.write(b"\x00")
    with pytest.raises(Exception, match="damaged"):
        records.read_tfrecord(spark, folder, df.schema).collect()


def test_record_files_are_written_and_read_by_blocks(tmp_path):
    texts = pa.array([b"t" * 500] * 1000)
    writer = records.RecordWriter({"path": str(tmp_path / "out")}, T.StructType().add("t", "binary"), True)
    names = []
    batches = (pa.RecordBatch.from_arrays([texts], ["t"]) for _ in range(100))
    assert _most_memory(lambda: names.extend(writer.write(batches).names)) < 24 << 20 and len(names) == 1
    path = next(tmp_path.glob(f"out.staging-*/{names[0]}"))
    assert path.stat().st_size > 50 << 20
    counts = []

    def read():
        with pa.OSFile(str(path)) as stream:
            counts.extend(len(starts) for _, starts, _ in records.record_blocks(stream))

    assert _most_memory(read) < 24 << 20 and sum(counts) == 100_000


def test_record_blocks_of_any_size(monkeypatch):
    texts = [b"", b"a", b"b" * 500, b"c" * 30, b"d" * 4000, b"", b"e" * 7]
    kinds = [("t", "string", False)]
    whole = records.encode_records(pa.RecordBatch.from_pydict({"t": texts}), kinds)

    def payloads(raw):
        found = []
        for data, starts, lengths in records.record_blocks(pa.BufferReader(raw)):
            found += [records.decode_example(data[s:s + n].tobytes())["t"][0] for s, n in zip(starts, lengths)]
        return found

    for size in (1, 5, 13, 100, 1 << 20):
        monkeypatch.setattr(records, "_BLOCK_BYTES", size)
        assert payloads(whole) == texts and payloads(b"") == []
        for bad in (whole[:-1], whole[:5], whole + b"x", whole[:700] + b"!" + whole[701:], b"\xff" * 40):
            with pytest.raises(ValueError, match="damaged"):
                payloads(bad)


def test_record_files_that_only_spark_opens(spark, folder, monkeypatch):
    df = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("t"))
    records.write_tfrecord(df.repartition(3), folder)
    assert "content" not in plan_of(records.read_tfrecord(spark, folder, df.schema))
    monkeypatch.setattr(records, "_reachable", lambda path: False)
    read = records.read_tfrecord(spark, folder, df.schema)
    assert "content" in plan_of(read) and sorted(read.collect()) == sorted(df.collect())


def test_records_in_any_field_order():
    feature = records._field(records.FLOAT_LIST, records._varint(1 << 3 | 5) + b"\x00\x00\x80\x3f")  # unpacked
    entry = records._field(2, feature) + records._field(1, b"x")  # value before key
    message = records._field(1, records._field(1, entry))
    assert records.decode_example(message) == {"x": [1.0]}


def test_records_decode_alike_in_groups_and_one_by_one():
    rng = np.random.default_rng(1)
    n = 3000
    rows = {
        "x": [None if i % 7 == 0 else float(i) / 8 for i in range(n)],
        "y": [int(v) for v in rng.integers(-5, 1 << 40, n)],
        "s": [None if i % 11 == 0 else "t" * (i % 5) + "é" for i in range(n)],
        "b": [bytes([i % 256]) * (i % 90) for i in range(n)],
    }
    batch = pa.RecordBatch.from_pydict(rows)
    kinds = [("x", "float32", False), ("y", "int64", False), ("s", "string", False), ("b", "string", False)]
    data = np.frombuffer(records.encode_records(batch, kinds), dtype=np.uint8)
    starts, lengths = records.record_slices(data)
    assert len(starts) == n
    types = [pa.float32(), pa.int64(), pa.binary(), pa.binary()]
    together = [a.to_pylist() for a in records.decode_records(data, starts, lengths, kinds, types)]
    assert together[:2] == [rows["x"], rows["y"]] and together[3] == rows["b"]
    assert [None if v is None else v.decode() for v in together[2]] == rows["s"]
    for i in (0, 1, 7, 11, 2999):
        alone = records.decode_example(data[starts[i]:starts[i] + lengths[i]].tobytes())
        assert alone.get("y") == [rows["y"][i]] and alone.get("x") == (None if rows["x"][i] is None else [rows["x"][i]])
    assert records.encode_records(batch.slice(0, 0), kinds) == b""


def test_listings(spark, folder):
    write(f"{folder}/a", "x.txt", "12345")
    write(f"{folder}/a/sub", "y.csv", "1")
    write(f"{folder}/b", "x.txt", "123")
    write(f"{folder}/b", "z.txt", "")
    listing = lambda p, **k: L.relative_to(L.list_files(spark, f"{folder}/{p}", **k), f"{folder}/{p}")
    assert [r.name for r in listing("a").collect()] == ["x.txt"]
    both = listing("a", recursive=True)
    assert {r.relative for r in both.collect()} == {"x.txt", "sub/y.csv"}
    assert listing("a", recursive=True, pattern="*.csv").count() == 1
    diff = {r.file: r.status for r in L.compare_listings(both, listing("b", recursive=True)).collect()}
    assert diff == {"x.txt": "resized", "sub/y.csv": "only_left", "z.txt": "only_right"}
    assert not L.same_tree(both, listing("b")) and L.same_tree(both, both)
    assert tuple(L.total_size(both).first()) == (2, 6)
    source = spark.read.text(f"{folder}/a")
    assert [r.length for r in L.provenance(source).collect()] == [5]


def test_path_attributes(spark):
    empty = spark.createDataFrame([], "path string, name string, value string")
    attributes = L.set_attribute(L.set_attribute(L.set_attribute(empty, "/a", "x", 1), "/a", "y", "2"), "/a", "x", 3)
    assert L.get_attributes(attributes, "/a") == {"x": "3", "y": "2"}
    assert L.get_attributes(L.remove_attribute(attributes, "/a", "x"), "/a") == {"y": "2"}
    assert L.get_attributes(attributes, "/a", "y") == {"y": "2"}


def test_upsert_with_a_hot_key(spark):
    base = spark.range(50).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    changes = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), F.col("id").cast("int").alias("v"),
        F.col("id").alias("seq"),
    )
    wanted = {k: 0 for k in range(50)}
    for i in range(3000):
        wanted[7 if i % 3 == 0 else i % 100] = i
    assert {r.k: r.v for r in upsert(base, changes, ["k"], "seq").collect()} == wanted
    assert latest_by_key(changes, ["k"], "seq").count() == len({7 if i % 3 == 0 else i % 100 for i in range(3000)})


def test_upsert_keeps_newer_rows_and_refuses_bad_keys(spark):
    base = spark.createDataFrame([(1, 30.0, 9), (2, 1.0, 1), (3, 5.0, None)], "k int, v double, seq int")
    changes = spark.createDataFrame(
        [(1, 20.0, 4), (2, 2.0, 2), (2, 3.0, 1), (3, 6.0, 1), (4, 7.0, 0)], "k int, v double, seq int"
    )
    found = {r.k: (r.v, r.seq) for r in upsert(base, changes, ["k"], "seq").collect()}
    assert found == {1: (30.0, 9), 2: (2.0, 2), 3: (6.0, 1), 4: (7.0, 0)}
    one = upsert(base, changes.filter("k IN (1, 4)"), ["k"])
    assert {r.k: r.v for r in one.collect()} == {1: 20.0, 2: 1.0, 3: 5.0, 4: 7.0}
    with pytest.raises(Exception, match="several changes of one key"):
        upsert(base, changes, ["k"]).collect()
    for order in (None, "seq"):
        with pytest.raises(Exception, match="null in the key"):
            upsert(base, spark.createDataFrame([(None, 1.0, 1)], base.schema), ["k"], order).collect()


def test_connector_options(spark):
    assert C.broker_list("INTERNAL://10.0.0.1:9091,INTERNAL://b:2") == ["10.0.0.1:9091", "b:2"]
    options = C.kafka_options("a:1", "t", truststore="ts", truststore_password="x", max_offsets_per_trigger=5)
    assert options["startingOffsets"] == "earliest" and options["kafka.security.protocol"] == "SSL"
    assert C.elasticsearch_options("n", "Demo", "Idx", "k", "kp", "t", "tp", "Bearer x")["es.resource"] == "demo_idx"
    jdbc = C.jdbc_options("jdbc:x://h/db", "user=me;password=a=b,ssl=1", dbtable="t")
    assert jdbc == {"url": "jdbc:x://h/db", "user": "me", "password": "a=b", "ssl": "1", "dbtable": "t"}
    assert C.redshift_url_parts("jdbc:redshift://c.x.eu-1.e.com:5439/dev?user=me") == ("eu-1", "c", "dev", "me")
    for bad in ("jdbc:mysql://h/db?user=u", "jdbc:redshift://c.x.r.com/dev"):
        with pytest.raises(ValueError):
            C.redshift_url_parts(bad)
    assert C.s3_settings("a", "s", "t")["spark.hadoop.fs.s3a.session.token"] == "t"
    assert C.s3_training_path("s3a://bucket/", "td", 2) == "s3a://bucket/TRAINING_DATASETS/td_2"
    schema = spark.sql("SELECT 1L AS a, 1 AS b, 'x' AS c, CAST(1 AS DECIMAL(9,2)) AS d").schema
    assert C.row_store_columns(schema) == "a BIGINT(20), b INT(11), c VARCHAR(1000), d DECIMAL(9,2)"
    schema = spark.sql("SELECT 1L AS a, 1 AS b, 'x' AS c, X'00' AS d, 'y' AS `e f`").schema
    parsed = T.StructType.fromDDL(C.row_store_texts(schema))
    assert [f.name for f in parsed] == ["c", "e f"]


def test_missing_packages_are_named(spark):
    for call in (lambda: C.read_kafka(spark, {}), lambda: C.read_elasticsearch(spark, {}),
                 lambda: C.write_kafka(spark.sql("SELECT 'k' AS key, 'v' AS value"), "a:1", "t")):
        with pytest.raises(RuntimeError, match="class path"):
            call()


def test_paths_are_resolved_as_spark_does(spark, folder):
    assert qualified(spark, "/a b/c") == "file:/a b/c"
    assert qualified(spark, "file:///a/c") == "file:/a/c"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://127.0.0.1:1")
    try:
        assert qualified(spark, "/a/c") == "hdfs://127.0.0.1:1/a/c"
    finally:
        conf.set("fs.defaultFS", before)
    path = f"{folder}/with space"
    arrays.write_npy(spark.range(5), path)
    assert sorted(row["values"][0] for row in arrays.read_npy(spark, path).collect()) == [0, 1, 2, 3, 4]
