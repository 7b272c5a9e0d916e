import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardledger.functions.text import filled, nested_to_json, timestamps_to_text
from wardledger.operators.clean import clean_text, current_state, interval_slice, latest_per_key, lost_winners, merge_latest, typed_projection
from wardledger.sources import derived
from wardledger.sources.schemas import (
    bronze_fields,
    bronze_schema,
    bronze_tables,
    code_list_key,
    code_list_schema,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_schema_sizes():
    sizes = {t: len(bronze_fields(t)) for t in bronze_tables()}
    assert len(sizes) == 20
    assert (sizes["tabPatient"], sizes["tabItem"], sizes["tabPatientEncounter"]) == (53, 83, 40)
    assert sizes["tabHealthcarePractitioner"] == 45
    assert sizes["tabEncounter_SatuSehat"] == 25 and sizes["tabMedicationDispense_SatuSehat"] == 19
    assert code_list_schema("icd_o").names == ["CODE", "STR", "SAB"]
    assert code_list_key("icd_o") == ("CODE", "SAB") and code_list_key("icd_10") == ("CODE", "VERSION")


def test_blank_to_null_trims_spaces_only(spark):
    df = spark.createDataFrame([(" a ", 1), ("", 2), ("   ", 3), (None, 4), ("\ta", 5)], "c string, n int")
    got = {r["n"]: r["c"] for r in clean_text(df).collect()}
    assert got == {1: "a", 2: None, 3: None, 4: None, 5: "\ta"}


def test_clean_text_drop_and_keep(spark):
    df = spark.createDataFrame([(" a ", " b ", " c ")], "a string, b string, c string")
    assert rows(clean_text(df, drop=("a",), keep_raw=("c",))) == [("b", " c ")]


def test_typed_projection_is_strict(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DecimalType(21, 9))])
    good = spark.createDataFrame([("1", "2.5", "x")], "n string, d string, extra string")
    assert typed_projection(good, schema).schema.names == ["n", "d"]
    bad = spark.createDataFrame([("one", "2.5")], "n string, d string")
    with pytest.raises(PySparkException):
        typed_projection(bad, schema).collect()


def test_bronze_schema_types():
    schema = bronze_schema("tabPatient")
    assert schema["modified"].dataType == T.TimestampNTZType()
    assert schema["dob"].dataType == T.DateType()
    assert schema["uid"].dataType == T.StringType()


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("A", 1, "old"), ("A", 2, "new"), ("B", 1, "b1"), ("B", 3, "b3"), ("B", 2, "b2"), ("A ", 9, "pad"), ("C", 1, "c")],
        "name string, modified int, v string",
    )
    assert rows(latest_per_key(df)) == [("A ", 9, "pad"), ("A", 2, "new"), ("B", 3, "b3"), ("C", 1, "c")]
    # the raw name is the key, so padded names stay two rows after cleaning
    assert [r[0] for r in rows(current_state(df))] == ["A", "A", "B", "C"]


def test_latest_per_key_ties_are_stable(spark):
    data = [("A", 1, f"v{i}") for i in range(20)]
    first = rows(latest_per_key(spark.createDataFrame(data, "name string, modified int, v string")))
    again = rows(latest_per_key(spark.createDataFrame(data[::-1], "name string, modified int, v string").repartition(3)))
    assert first == again and len(first) == 1


def test_latest_per_key_hot_key(spark):
    hot = spark.range(0, 5000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 700)) AS name", "id AS modified")
    got = {r["name"]: r["modified"] for r in latest_per_key(hot).collect()}
    expected = {r["name"]: r["m"] for r in hot.groupBy("name").agg(F.max("modified").alias("m")).collect()}
    assert got == expected


def history(spark, rows_):
    return spark.createDataFrame(rows_, "name string, m string, v int").selectExpr("name", "cast(m AS timestamp_ntz) AS modified", "v")


def test_merged_state_equals_the_full_ranking(spark):
    """Intervals are loaded in order, again, late and emptied; the state follows from the former one."""
    days = {
        1: [("a", "2026-07-01 01:00:00", 1), ("b", "2026-07-01 02:00:00", 2), (None, "2026-07-01 03:00:00", 3), ("e", "2026-07-01", 9)],
        2: [("a", "2026-07-02 01:00:00", 4), ("c", "2026-07-02 02:00:00", 5), ("e", "2026-07-02", 8)],
        3: [("a", "2026-07-03 01:00:00", 6), (None, "2026-07-03 00:00:00", 7)],
    }
    empty = history(spark, [("x", "2026-07-01", 0)]).where("false")
    state, held = empty, {}
    steps = [(1, days[1]), (3, days[3]), (2, days[2]), (3, []), (2, [("a", "2026-07-02 00:00:00", 40)]), (1, days[1][:1]), (3, days[3])]
    for day, fresh_rows in steps:
        held[day] = fresh_rows
        fresh = history(spark, fresh_rows) if fresh_rows else empty
        stored = [r for rows_ in held.values() for r in rows_]
        every = history(spark, stored)
        span = (f"2026-07-0{day}", f"2026-07-0{day + 1}")
        lost = lost_winners(state, fresh, *span)
        state = spark.createDataFrame(merge_latest(state, fresh, *span, lost, every).collect(), state.schema)
        assert sorted(map(str, state.collect())) == sorted(map(str, latest_per_key(every).collect())), (day, fresh_rows)
        if lost.isEmpty():
            again = merge_latest(state, fresh, *span)
            assert sorted(map(str, again.collect())) == sorted(map(str, state.collect()))


def test_interval_is_half_open(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, timestamp_ntz'2026-07-02 00:00:00'), (2, timestamp_ntz'2026-07-02 23:59:59.999'), "
        "(3, timestamp_ntz'2026-07-03 00:00:00') AS t(id, modified)"
    )
    got = interval_slice(df, "2026-07-02", "2026-07-03")
    assert [r["id"] for r in got.orderBy("id").collect()] == [1, 2]


def test_nested_and_timestamps_to_text(spark):
    df = spark.sql(
        "SELECT named_struct('a', 1) AS s, array(1, 2) AS l, map('k', 'v') AS m, 'x' AS t, "
        "timestamp_ntz'2026-07-02 03:04:05.678' AS at"
    )
    assert rows(nested_to_json(df).select("s", "l", "m", "t")) == [('{"a":1}', "[1,2]", '{"k":"v"}', "x")]
    assert timestamps_to_text(df).select("at").first()["at"] == "2026-07-02 03:04:05"


def test_filled_template(spark):
    df = spark.createDataFrame([("it's", None)], "a string, b string")
    got = df.selectExpr(f"{filled(chr(39) + '{a}' + chr(39) + ' \\ ok')} AS x", f"{filled('{a}-{b}')} AS y").first()
    assert got["x"] == "'it's' \\ ok" and got["y"] is None


def test_sorted_raw_rows_are_spread_by_size(spark, tmp_path, monkeypatch):
    """A task that sorts whole raw rows gets no more of them when the table grows."""
    spark.range(0, 4000, 1, 1).selectExpr("id AS o_orderkey", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    stored = sum(f.stat().st_size for f in (tmp_path / "orders.parquet").glob("*.parquet"))
    monkeypatch.setattr(derived, "SORTED_BYTES", stored // 20)
    spread = spark.sql(f"SELECT * FROM {derived.parquet_relation(spark, str(tmp_path), sorted_rows=True)('orders')}")
    assert spread.rdd.getNumPartitions() >= 20 and spread.distinct().count() == spread.count() == 4000
