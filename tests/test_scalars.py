import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions import types as K


def one(spark, column, ddl=None, value=None):
    df = spark.createDataFrame([(value,)], ddl) if ddl else spark.range(1)
    return df.select(column.alias("v")).first().v


def test_metrics(spark):
    texts = ["1", " 2.5 ", "-3e2", ".5", "abc", "", None, "nan", "1.0d", "1_0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.v for r in df.select(S.to_metric("t").alias("v")).collect()] == [
        1.0, 2.5, -300.0, 0.5, None, None, None, None, None, None]
    with pytest.raises(Exception, match="Metric is not a number"):
        df.select(S.require_metric("t")).collect()


def test_trial_key(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, CAST(NULL AS INT) AS c")
    assert df.select(S.trial_key(["b", "a", "c"]).alias("k")).first().k == "b=x&a=1&c=null"


def test_durations(spark):
    millis = S.duration_ms(F.lit(90061.5))
    assert one(spark, millis) == 90061500
    assert one(spark, S.duration_text(millis)) == "1 hours, 1 minutes, 1 seconds"


def test_paths(spark):
    assert one(spark, S.strip_scheme(F.lit("hdfs://10.0.2.15:8020/Projects/demo/"))) == "/Projects/demo/"
    assert one(spark, S.strip_scheme(F.lit("/Projects/demo"))) == "/Projects/demo"
    expand = lambda p: S.expand_path(F.lit(p), "hdfs://h:1", "/Projects/demo/")
    assert one(spark, expand("Resources/a.csv")) == "hdfs://h:1/Projects/demo/Resources/a.csv"
    assert one(spark, expand("/Projects/x")) == "hdfs://h:1/Projects/x"
    assert one(spark, expand("hdfs://h:1/y")) == "hdfs://h:1/y"
    with pytest.raises(Exception, match="not a path of this file system"):
        one(spark, expand("s3://bucket/z"))


def test_names(spark):
    assert one(spark, S.project_of(F.lit("demo__user__x"))) == "demo"
    assert one(spark, S.index_name(F.lit("Demo"), F.lit("IDX"))) == "demo_idx"
    assert one(spark, S.is_valid_name(F.lit("abc9"))) is True
    assert one(spark, S.is_valid_name(F.lit("a_b"))) is False
    assert one(spark, S.is_valid_name(F.lit("a" * 257))) is False


def test_arguments(spark):
    parsed = one(spark, S.parse_arguments(F.lit("password=a=b, user=u,flag,user=w")))
    assert parsed == {"password": "a=b", "user": "w"}
    assert one(spark, S.parse_arguments(F.lit("a=1;b=2"), ";")) == {"a": "1", "b": "2"}


def test_redshift(spark):
    url = "jdbc:redshift://cluster1.abc123.eu-west-1.redshift.example.com:5439/dev?user=me&ssl=true"
    row = one(spark, S.redshift_parts(F.lit(url)))
    assert (row.region, row.cluster, row.database, row.user) == ("eu-west-1", "cluster1", "dev", "me")
    assert one(spark, S.redshift_parts(F.lit("jdbc:mysql://h/db"))) is None


def test_draws_do_not_depend_on_partitions(spark):
    a = spark.range(0, 100, 1, 3).select("id", S.draw(5, "id").alias("u"))
    b = spark.range(0, 100, 1, 8).select("id", S.draw(5, "id").alias("u"))
    assert sorted(a.collect()) == sorted(b.collect())
    values = [r.u for r in a.collect()]
    assert all(0 <= v < 1 for v in values) and 0.3 < sum(values) / 100 < 0.7


def test_uniform(spark):
    ints = spark.range(200).select(S.uniform_between(-1, 1, S.draw(1, "id")).alias("v"))
    assert {r.v for r in ints.collect()} == {-1, 0, 1}
    reals = spark.range(200).select(S.uniform_between(-1, 1.5, S.draw(1, "id")).alias("v"))
    assert all(-1 <= r.v < 1.5 for r in reals.collect())
    with pytest.raises(ValueError):
        S.uniform_between("a", "b", F.lit(0.5))
    with pytest.raises(AssertionError):
        S.uniform_between(2, 1, F.lit(0.5))


def test_rounding_is_half_even(spark):
    assert [one(spark, S.clamp_whole(F.lit(v), 0, 10)) for v in (0.5, 1.5, 2.5, 99.0, -4.0)] == [0, 2, 2, 10, 0]


def test_outputs(spark):
    assert one(spark, S.decode_outputs(F.lit("12"))) == {"metric": "12"}
    assert one(spark, S.decode_outputs(F.lit('{"a": 1}'))) == {"a": "1"}
    outputs = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    assert one(spark, S.run_metric(outputs)) is None
    assert one(spark, S.run_metric(outputs, "b")) == "2"
    with pytest.raises(Exception, match="not in the returned"):
        one(spark, S.run_metric(outputs, "c"))


def test_model_metrics():
    assert S.check_metrics({"accuracy": "21.5"}) == {"accuracy": 21.5}
    for bad in ({"accuracy": "not number"}, {1337: "0.5"}, [1]):
        with pytest.raises(AssertionError):
            S.check_metrics(bad)


def test_online_schema():
    schema = K.online_schema([{"name": "id", "type": "int", "primary": True}, {"name": "v", "type": "string"}])
    assert schema["v"].metadata == {"comment": "-", "primary": False, "partition": False}
    for bad in ([], [{"name": "a", "type": "int"}], [{"name": "a"}], [{"name": "a", "type": "int", "primary": False}]):
        with pytest.raises(ValueError):
            K.online_schema(bad)


def test_key_violations(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert sorted((r.k is None, r.rows) for r in K.primary_key_violations(df, ["k"]).collect()) == [(False, 2), (True, 1)]
