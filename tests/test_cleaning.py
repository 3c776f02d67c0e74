import json
from decimal import Decimal

import pytest

from auditflow.operators.cleaning import (
    cleaned_records,
    enrich,
    explode_items,
    parse_messages,
    rejected_records,
)

SCORED = "struct<type string, score double, level string>"

GOOD = (
    '{"dt":"2031-05-06 07:08:09","countryCode":"ZQ","data":'
    '[{"type":"pear","score":4.25,"level":"low"},{"type":"plum","score":9.5,"level":"top"}]}'
)


@pytest.fixture
def codes(spark):
    return spark.createDataFrame([("ZQ", "NORTH")], "countryCode string, area string")


def run(df, codes, **options):
    rows = cleaned_records(df, codes, **options).collect()
    return sorted((r.kind, r.value) for r in rows)


def records(df, codes, **options):
    rows = run(df, codes, **options)
    assert {kind for kind, _ in rows} <= {"clean"}
    return [json.loads(value, parse_float=Decimal) for _, value in rows]


@pytest.mark.parametrize("item_type", [None, SCORED])
def test_area_and_time_are_put_into_each_item(values, codes, item_type):
    got = records(values(GOOD), codes, item_type=item_type)
    common = {"area": "NORTH", "dt": "2031-05-06 07:08:09"}
    assert got == [
        {"type": "pear", "score": Decimal("4.25"), "level": "low", **common},
        {"type": "plum", "score": Decimal("9.5"), "level": "top", **common},
    ]


@pytest.mark.parametrize("code", ['"XX"', "null", None])
def test_unknown_country_has_no_area(values, codes, code):
    header = "" if code is None else f'"countryCode":{code},'
    got = records(values(f'{{"dt":"t",{header}"data":[{{"type":"pear"}}]}}'), codes)
    assert got == [{"type": "pear", "dt": "t"}]


def test_unknown_country_fails_when_strict(values, codes):
    strict = cleaned_records(values(GOOD.replace("ZQ", "XX")), codes, on_missing="fail")
    with pytest.raises(Exception, match="no area for country code XX"):
        strict.collect()


def test_strict_passes_known_countries_and_sets_bad_messages_aside(values, codes):
    kinds = [k for k, _ in run(values(GOOD, "{bad"), codes, on_missing="fail")]
    assert kinds == ["clean", "clean", "malformed"]


def test_unknown_option_is_refused(values, codes):
    with pytest.raises(ValueError):
        enrich(parse_messages(values(GOOD)), codes, on_missing="drop")


def test_unknown_keys_and_exact_numbers_survive(values, codes):
    item = '{"n":12345678901234567890.123456789,"o":{"k":[1,"}{"]},"q":"say \\"hi\\"","e":{}}'
    got = records(values(f'{{"dt":"t","countryCode":"ZQ","data":[{item}]}}'), codes)
    expected = json.loads(item, parse_float=Decimal)
    assert got == [{**expected, "area": "NORTH", "dt": "t"}]


def test_old_keys_are_replaced_and_nulls_left_out(values, codes):
    item = '{"area":"old","dt":"old","x":null,"y":1}'
    text = '{{"dt":"t","countryCode":"{}","data":[{}]}}'
    assert records(values(text.format("ZQ", item)), codes) == [
        {"y": 1, "area": "NORTH", "dt": "t"}
    ]
    # An unknown area replaces the old one with nothing.
    assert records(values(text.format("XX", item)), codes) == [{"y": 1, "dt": "t"}]


def test_empty_item_and_missing_time(values, codes):
    assert records(values('{"data":[{}]}'), codes) == [{}]


def test_a_repeated_key_keeps_its_last_value(values, codes):
    assert records(values('{"dt":"t","data":[{"a":1,"a":2}]}'), codes) == [{"a": 2, "dt": "t"}]


def test_loose_json_is_read(values, codes):
    assert records(values("{'dt':'t',data:[{a:'x'}]}"), codes) == [{"a": "x", "dt": "t"}]


@pytest.mark.parametrize("item_type", [None, SCORED])
def test_empty_data_gives_nothing(values, codes, item_type):
    assert run(values('{"dt":"t","countryCode":"ZQ","data":[]}'), codes, item_type=item_type) == []


@pytest.mark.parametrize("item_type", [None, SCORED])
@pytest.mark.parametrize(
    "kind, text",
    [
        ("malformed", "{bad"),
        ("malformed", "[1]"),
        ("malformed", '"text"'),
        ("malformed", '{"dt":"t","data":[]}{"dt":"u","data":[]}'),
        ("malformed", '{"dt":"t","data":[]},{"dt":"u","data":[]}'),
        ("malformed", '{"dt":"t","data":[]} garbage'),
        ("malformed", '{"dt":"t","data":[{"type":"pear"}]}],[{"dt":"u","data":[]}'),
        ("malformed", '{"dt":"t","data":[]}]'),
        ("malformed", '{"dt":"t","data":[]}] , {}'),
        ("malformed", '{"dt":"t","data":[]}},{"x":[{}'),
        ("malformed", '{"dt":"t","data":[]},'),
        ("no_data", '{"dt":"t","data":"none"}'),
        ("malformed", '{"dt":"t","data":[{"type":"pear"}]'),
        ("no_data", '{"dt":"t"}'),
        ("no_data", '{"dt":"t","data":null}'),
    ],
)
def test_unusable_messages_are_set_aside_whole(values, codes, kind, text, item_type):
    assert run(values(text), codes, item_type=item_type) == [(kind, text)]


def test_elements_that_are_no_objects_are_set_aside(values, codes):
    text = '{"dt":"t","data":[{"a":1},null,3,"s",[1]]}'
    got = run(values(text), codes)
    assert [v for k, v in got if k == "bad_item"] == ['"s"', "3", "[1]", "null"]
    assert [json.loads(v) for k, v in got if k == "clean"] == [{"a": 1, "dt": "t"}]


def test_a_null_element_of_a_declared_type_is_set_aside(values, codes):
    text = '{"dt":"t","data":[null,{"type":"pear"}]}'
    assert [k for k, _ in run(values(text), codes, item_type=SCORED)] == ["bad_item", "clean"]


def test_null_and_empty_texts_are_malformed(values, codes):
    assert [k for k, _ in run(values(None, ""), codes)] == ["malformed", "malformed"]


def test_other_columns_are_kept(spark, codes):
    df = spark.createDataFrame([(7, GOOD)], "batch_id bigint, value string")
    rows = explode_items(enrich(parse_messages(df, SCORED), codes)).collect()
    assert [(r.batch_id, r.item.type, r.area) for r in rows] == [
        (7, "pear", "NORTH"), (7, "plum", "NORTH")
    ]


NUMBERS = [
    "1234567890123456789012345678901234567890.5", "9" * 60, "1e400", "-1.5E-4000", "1.23456789012345678901e2", "1.10", "1e5",
    "-0", "-0.0", "0", "7", "12345678901234567890.123456789012345678", "1234567890123456789",
]


@pytest.mark.parametrize("number", NUMBERS)
def test_numbers_are_kept_as_written(values, codes, number):
    text = f'{{"dt":"t","data":[{{"n":{number},"o":{{"l":[{number}, {number}]}}}}]}}'
    assert run(values(text), codes) == [("clean", f'{{"dt":"t","n":{number},"o":{{"l":[{number},{number}]}}}}')]
    quoted = f'{{"dt":"t","data":[{{"n":"{number}"}}]}}'
    assert records(values(quoted), codes) == [{"n": number, "dt": "t"}]


def test_numbers_outside_items_are_kept_too(values, codes):
    assert records(values('{"dt":1.50,"countryCode":1e400,"data":[{"a":1}]}'), codes) == [{"a": 1, "dt": "1.50"}]
    assert run(values('{"dt":{"a":1.50,"b":null},"data":[{"a":1},1.50]}'), codes) == [
        ("bad_item", "1.50"), ("clean", '{"dt":"{\\"a\\":1.50,\\"b\\":null}","a":1}')
    ]
    assert records(values('{"dt":null,"countryCode":null,"data":[{"a":1.0}]}'), codes) == [{"a": Decimal("1.0")}]


@pytest.mark.parametrize("number", ["01", "1.", ".5", "+1", "1e", "--1", "1.2.3", "0x1", "1_0"])
def test_what_is_no_number_is_malformed(values, codes, number):
    text = f'{{"dt":"t","data":[{{"n":{number},"m":1.5}}]}}'
    assert run(values(text), codes) == [("malformed", text)]


MARK = "\ue000"


@pytest.mark.parametrize("string", [MARK, MARK * 2, f"{MARK}null", f"{MARK}1.5", f"{MARK * 3}1.5", f'x"{MARK}1.5"', f"'{MARK}null"])
def test_strings_that_look_like_marked_literals_stay(values, codes, string):
    item = {"a": string, string: "b", "c": [string, None, 1.5], "d": {"e": string, "f": None}}
    left = {"a": string, string: "b", "c": [string, None, Decimal("1.5")], "d": {"e": string}, "dt": "t"}
    for ascii_ in (True, False):
        text = json.dumps({"dt": "t", "data": [item]}, ensure_ascii=ascii_)
        assert records(values(text), codes) == [left]
        upper = text.replace("\\ue000", "\\uE000")
        assert records(values(upper), codes) == [left]


def test_loose_json_with_fractions_is_read(values, codes):
    text = "{'dt':'it\\'s 1.5',data:[{a1:1.50, $b:null, null_:2.0, 'c\"d':'\"1.5'}]}"
    assert records(values(text), codes) == [
        {"a1": Decimal("1.50"), "null_": Decimal("2.0"), 'c"d': '"1.5', "dt": "it's 1.5"}
    ]


def test_long_texts_with_many_literals(values, codes):
    item = {"s": 'x\\"' * 20_000, "l": [1.5, None] * 20_000, "o": {f"k{i}": None for i in range(2_000)}}
    got = records(values(json.dumps({"data": [item]})), codes)
    assert got == [{"s": item["s"], "l": [Decimal("1.5"), None] * 20_000, "o": {}}]


@pytest.mark.parametrize("item_type", [None, "struct<o struct<x int, y int, z struct<k int>>, l array<int>>"])
def test_null_members_are_left_out_at_every_depth(values, codes, item_type):
    item = '{"l":[null,1],"o":{"x":null,"y":1,"z":{"k":null}}}'
    got = records(values(f'{{"dt":"t","data":[{item}]}}'), codes, item_type=item_type)
    assert got == [{"l": [None, 1], "o": {"y": 1, "z": {}}, "dt": "t"}]


@pytest.mark.parametrize(
    "item",
    ['{"a":":null,","b":":null}","c":"null"}', '{"a,":"b\\\\","c":",\\"k\\":null"}', '{"a":"x,\\"k\\":null}"}', '{"a":"b,","c":":null,"}', '{"a":{"b":"{","c":{"d":2}}}', '{"a":[",",":null,"],"b":"n"}'],
)
def test_text_that_looks_like_a_null_member_stays(values, codes, item):
    assert records(values(f'{{"dt":"t","data":[{item}]}}'), codes) == [{**json.loads(item), "dt": "t"}]


def test_rejected_records_are_those_that_are_not_clean(values, codes):
    texts = [GOOD, "{bad", '{"dt":"t"}', '{"dt":"t","data":[1,null,{"a":1}]}', '{"dt":"t","data":[{"a":1e400},1e400]}', '{"data":[]}],[{}', None]
    for item_type in (None, SCORED):
        every = cleaned_records(values(*texts), codes, item_type=item_type).where("kind <> 'clean'")
        found = rejected_records(values(*texts), item_type)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, every.collect()))


@pytest.mark.parametrize("string", ["~", "~~", "~null", "~1.5", "~~~1.5", 'x"~1.5"', "'~null", 'x"~~', "'~~", '\\u0022~~', '\\"~~1'])
def test_strings_that_look_marked_by_a_byte_stay(values, codes, string):
    item = {"a": string, string: "b", "c": [string, None, 1.5], "d": {"e": string, "f": None}}
    left = {"a": string, string: "b", "c": [string, None, Decimal("1.5")], "d": {"e": string}, "dt": string}
    text = json.dumps({"dt": string, "data": [item]})
    escaped = text.replace('\\"', "\\u0022") if "\\\\" not in text else text
    for written in (text, text.replace("~", "\\u007e"), text.replace("~", "\\u007E"), escaped, text.replace("'", "\\u0027")):
        assert records(values(written), codes) == [left]


def test_integers_are_kept_whether_marked_or_not(values, codes):
    numbers = ["0", "-0", "10", "-10", "9" * 17, "-" + "9" * 17, "9" * 18, "1" + "0" * 18, "1E2", "10.0"]
    listed = ",".join(numbers)
    text = f'{{"dt":{numbers[4]},"data":[{{"l":[{listed}],"n":null}},{numbers[5]},1.50]}}'
    assert run(values(text), codes) == [
        ("bad_item", numbers[5]), ("bad_item", "1.50"), ("clean", f'{{"dt":"{numbers[4]}","l":[{listed}]}}')
    ]
    for wrong in ("-", "00", "-01", "1a", "1 2"):
        bad = f'{{"dt":"t","data":[{{"n":{wrong},"m":1.5}}]}}'
        assert run(values(bad), codes) == [("malformed", bad)]


def test_area_and_time_are_written_once_a_message(values, codes):
    plan = cleaned_records(values(GOOD), codes)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("struct(area") == 1
    assert plan.index("posexplode(") < plan.index("struct(area")
