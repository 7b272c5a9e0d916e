import json

import pytest

from wardledger.functions.fhirpath import Shape, coerce, steps_of, value_at
from wardledger.operators.flatten import flatten, flatten_children, flatten_rejects, flatten_resource
from wardledger.sources.resources import CHILD_VIEWS, RESOURCES
from wardledger.sources.schemas import bronze_fields
from wardledger.sources.views import VIEWS, View


def at(spark, document, path):
    df = spark.createDataFrame([(json.dumps(document),)], "p string").selectExpr("try_parse_json(p) AS n")
    return df.selectExpr(f"{value_at('n', path)} AS v").first()["v"]


@pytest.mark.parametrize(
    "document, path, expected",
    [
        ({"a": {"b": {"c": "x"}}}, "a.b.c", "x"),
        ({"a": {}}, "a.b.c", None),
        ({}, "a.b.c", None),
        ({"a": None}, "a.b", None),
        ({"a": {"b": None}}, "a.b", None),
        ({"c": {"coding": [{"code": "1"}, {"code": "2"}]}}, "c.coding.first().code", "1"),
        ({"c": {"coding": []}}, "c.coding.first().code", None),
        ({"c": {"coding": [{"display": "d"}, {"code": "2"}]}}, "c.coding.first().code", None),
        ({"c": {"coding": [None, {"code": "2"}]}}, "c.coding.first().code", "2"),
        # one object where a list is usual, and the reverse
        ({"c": {"coding": {"code": "1"}}}, "c.coding.first().code", "1"),
        ({"c": [{"coding": [{"code": "1"}]}]}, "c.coding.first().code", "1"),
        ({"s": [{"r": "x"}]}, "s.r", "x"),
        ({"s": [{"d": 1}, {"r": "y"}]}, "s.r", "y"),
        ({"s": [[{"r": "z"}]]}, "s.r", None),
        ({"k": ["p", "q"]}, "k.first()", "p"),
        ({"k": "p"}, "k.first()", "p"),
        ({"k": ["p", "q"]}, "k", "p"),
        ({"k": []}, "k", None),
        ({"k": "[draft]"}, "k", "[draft]"),
        ({"k": {"v": 5}}, "k.v", "5"),
        ({"k": True}, "k", "true"),
        ({"i": [{"use": "temp", "value": "t"}, {"use": "official", "value": "o"}]}, "i.where(use='official').value.first()", "o"),
        ({"i": [{"use": "official"}, {"use": "official", "value": "o"}]}, "i.where(use='official').value.first()", "o"),
        ({"i": [{"use": "official"}]}, "i.where(use='official').value.first()", None),
        ({"i": {"use": "official", "value": "o"}}, "i.where(use='official').value.first()", "o"),
        ({}, "i.where(use='official').value.first()", None),
    ],
)
def test_paths(spark, document, path, expected):
    assert at(spark, document, path) == expected


    assert read_at(spark, document, path) == expected


def read_at(spark, document, path, *more):
    shape = Shape([path, *more])
    df = spark.createDataFrame([(json.dumps(document),)], "p string").selectExpr("try_parse_json(p) AS n")
    if not shape.empty:
        df = df.selectExpr("n", f"{shape.column('n')} AS r")
    return df.selectExpr(f"{shape.value('n', 'r', path)} AS v").first()["v"]


def test_paths_that_contradict(spark):
    """A member that is a list for one path and none for another, or text and parent at once."""
    both = {"k": ["p", "q"], "c": {"text": "t"}}
    assert [read_at(spark, both, "k.first()", "k"), read_at(spark, both, "k", "k.first()")] == ["p", "p"]
    assert [read_at(spark, both, "c", "c.text"), read_at(spark, both, "c.text", "c")] == ['{"text":"t"}', "t"]
    assert Shape(["c.text", "c", "k.first()", "k"]).type_text() == "struct<c: struct<text: string>, k: array<string>>"


def test_one_lookup_reads_a_payload(spark):
    view = VIEWS["encounter"]
    shape = Shape(path for _, path in view.columns)
    outside = [path for _, path in view.columns if "where(" in path]
    assert set(path for _, path in view.columns) - shape._inside == set(outside)


@pytest.mark.parametrize("path", ["", "a..b", "a.where(x>1)", "first()", "a.last()", "a.b-c"])
def test_other_forms_are_refused(path):
    with pytest.raises(ValueError):
        steps_of(path)


def test_all_view_paths_compile():
    for view in VIEWS.values():
        for _, path in (*view.columns, *view.nested):
            assert steps_of(path)


@pytest.mark.parametrize(
    "text, kind, expected",
    [
        ("1.5", "DOUBLE", "1.5"), ("x", "DOUBLE", None), ("7", "INT", "7"), ("7.5", "INT", None),
        ("true", "BOOLEAN", "true"), ("maybe", "BOOLEAN", None), ("2026-07-02", "DATE", "2026-07-02"),
        ("soon", "DATE", None), ("2026-07-02T10:00:00+00:00", "TIMESTAMP", "2026-07-02 10:00:00"),
        ("2026-07-02", "TIMESTAMP", "2026-07-02 00:00:00"), ("2026-13-45", "TIMESTAMP", None),
    ],
)
def test_coerce(spark, text, kind, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.selectExpr(f"cast({coerce('t', kind)} AS string) AS v").first()["v"] == expected


PASS = {"doc": "name"}
VIEW = View("Thing", (("id", "id"), ("name", "label")))


def frame(spark, *payloads):
    return spark.createDataFrame([(f"d{i}", p) for i, p in enumerate(payloads)], "name string, payload_json string")


def test_guard_missing_and_unreadable(spark):
    df = frame(
        spark, '{"resourceType":"Thing","id":"1"}', None, "not json", '{"resourceType":"Other","id":"2"}', "[]", "{}",
    )
    assert [tuple(r) for r in flatten(df, VIEW, PASS).collect()] == [("d0", "1", None)]
    assert flatten_rejects(df, RESOURCES["encounter"]).first().asDict() == {"missing": 1, "unreadable": 1, "foreign": 4}


def test_array_positions_keep_gaps(spark):
    thing = '{"resourceType":"Thing","id":"%s"}'
    df = frame(spark, f'[{{"resourceType":"Other"}},{thing % "a"},null,{thing % "b"}]', "[]", thing % "c", "{bad")
    got = flatten(df, VIEW, PASS, is_array=True, index_column="idx").select("doc", "id", "idx")
    assert sorted(map(tuple, got.collect())) == [("d0", "a", 1), ("d0", "b", 3)]


def test_view_column_wins_over_passthrough(spark):
    df = frame(spark, '{"resourceType":"Thing","id":"1","label":"from view"}')
    got = flatten(df, VIEW, {"name": "name"})
    assert got.columns == ["name", "id"] and got.first()["name"] == "from view"


def test_for_each(spark):
    view = View("Thing", (("id", "id"),), "part", (("size", "n.first()"),))
    parts = ["[]", "[{\"n\":[1]}]", "[{\"n\":1},{},{\"n\":3}]", "{\"n\":9}", "null"]
    df = frame(spark, *[f'{{"resourceType":"Thing","id":"{i}","part":{p}}}' for i, p in enumerate(parts)])
    got = flatten(df, view, PASS, index_column="i")
    assert sorted(map(tuple, got.select("id", "size", "i").collect()), key=str) == sorted(
        [("1", "1", 0), ("2", "1", 0), ("2", None, 1), ("2", "3", 2), ("3", "9", 0)], key=str
    )


def test_empty_input_keeps_schema(spark):
    for name, spec in RESOURCES.items():
        fields = bronze_fields(spec.table)
        empty = spark.createDataFrame([], ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in fields))
        flat = flatten_resource(empty, name)
        assert flat.columns[: len(spec.passthrough)] == list(spec.passthrough)
        assert "fhir_id" in flat.columns and flat.count() == 0


def test_column_counts():
    counts = {
        "allergy_intolerance": (10, 11), "careplan": (9, 9), "composition": (9, 9), "condition": (12, 8),
        "diagnostic_report": (11, 12), "encounter": (14, 11), "episode_of_care": (7, 7), "imaging_study": (9, 10),
        "immunization": (9, 12), "medication_dispense": (9, 9), "medication_statement": (9, 10),
        "observation": (12, 11), "procedure": (10, 8), "questionnaire_response": (11, 8),
        "service_request": (9, 12), "specimen": (9, 8),
    }
    assert {n: (len(r.passthrough), len(r.view.columns)) for n, r in RESOURCES.items()} == counts


def test_view_from_json(spark, tmp_path):
    text = json.dumps(
        {"resource": "Thing", "select": [{"column": [{"name": "id", "path": "id"}]},
                                         {"forEach": "part", "column": [{"name": "n", "path": "n"}]}]}
    )
    (tmp_path / "v.json").write_text(text)
    view = View.load(str(tmp_path / "v.json"))
    assert view == View("Thing", (("id", "id"),), "part", (("n", "n"),))


def test_children(spark):
    for name in CHILD_VIEWS:
        table = RESOURCES[CHILD_VIEWS[name]].table
        fields = bronze_fields(table)
        empty = spark.createDataFrame([], ", ".join(f"{f.name} {f.spark_type.simpleString()}" for f in fields))
        assert flatten_children(empty, name).columns[-1] == "element_idx"


def test_repeated_keys_are_kept_and_trailing_text_is_not(spark):
    rows = [
        ("last", '{"resourceType":"Encounter","id":"a","id":"b"}'),
        ("tail", '{"resourceType":"Encounter","id":"a"} x'),
        ("comma", '{"resourceType":"Encounter"},{"resourceType":"Encounter"}'),
        ("bracket", '{"resourceType":"Encounter"}] x'),
        ("blank", " "),
        ("mark", '{"resourceType":"Encounter"},"~end of text~"] junk'),
        ("held", '{"resourceType":"Encounter","id":"~end of text~"}'),
    ]
    df = spark.createDataFrame(rows, "name string, payload_json string").selectExpr("*", "timestamp_ntz'2026-07-01' AS modified")
    view = View("Encounter", (("id", "id"),))
    found = flatten(df, view, {"name": "name"}).collect()
    assert [(r["name"], r["id"]) for r in found] == [("last", "b"), ("held", "~end of text~")]
    assert flatten_rejects(df, RESOURCES["encounter"]).first()["unreadable"] == 5


def test_whole_numbers_are_long(spark):
    number = coerce("'3000000000'", "INT")
    assert spark.sql(f"SELECT {number} AS n").first()["n"] == 3_000_000_000


@pytest.mark.parametrize("name", ["encounter", "observation"])
def test_tagged_rows_are_the_flat_rows_and_the_rest(spark, folder, name):
    from wardledger.plans.derived_clinic import DerivedClinic

    bronze = DerivedClinic(spark, folder).bronze(RESOURCES[name].table)
    tagged = flatten_resource(bronze, name, tagged=True)
    flat = flatten_resource(bronze, name)
    good = tagged.where("_reject = 'none'").drop("_reject")
    assert good.dtypes == flat.dtypes
    assert sorted(map(str, good.collect())) == sorted(map(str, flat.collect()))
    left_out = tagged.where("_reject <> 'none'")
    missing = bronze.where("payload_json IS NULL").count()
    assert left_out.where("_reject = 'missing'").count() == missing > 0
    assert left_out.count() == bronze.count() - flat.select("frappe_doc_name").distinct().count()
    assert tagged._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


@pytest.mark.parametrize("name", ["encounter", "observation"])
@pytest.mark.parametrize("tagged", [False, True])
def test_a_payload_is_not_searched_and_its_parse_is_generated(spark, folder, name, tagged):
    """The guard against trailing text costs a hash: no search of the text, no function over a list around the parse."""
    from wardledger.plans.derived_clinic import DerivedClinic

    bronze = DerivedClinic(spark, folder).bronze(RESOURCES[name].table)
    plan = flatten_resource(bronze, name, tagged)._jdf.queryExecution().optimizedPlan().toString()
    parse = next(line for line in plan.splitlines() if "parseJson" in line)
    assert "lambda" not in parse and "contains(" not in plan.lower() and plan.count("md5(") == 1


def test_null_and_foreign_documents_are_told_apart(spark):
    payloads = [
        None, "null", " null ", "7", '"Encounter"', '[{"resourceType":"Encounter"}]', '{"resourceType":["Encounter"]}',
        '{"resourceType":"Encounter"},7', "{", "", '{"resourceType":"Encounter","id":"a"} ',
    ]
    rows = [(f"d{i}", text) for i, text in enumerate(payloads)]
    df = spark.createDataFrame(rows, "name string, payload_json string")
    view = View("Encounter", (("id", "id"),))
    tagged = flatten(df, view, {"name": "name"}, index_column="place", tagged=True).collect()
    expected = ["missing", *["foreign"] * 6, "unreadable", "unreadable", "unreadable", "none"]
    assert [r["_reject"] for r in sorted(tagged, key=lambda r: int(r["name"][1:]))] == expected
    assert [(r["name"], r["id"], r["place"]) for r in tagged if r["place"] is not None] == [("d10", "a", 0)]
