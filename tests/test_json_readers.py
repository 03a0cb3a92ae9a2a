"""Shapes of the JSON columns, on literal values."""

import datetime

import pytest
from pyspark.sql import functions as F

from wagerlens.functions import json_readers as R


@pytest.fixture
def read(spark):
    def run(way, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
        return [r[0] for r in df.orderBy("i").select(way(F.col("v"))).collect()]

    return run


def plain(rows):
    return [None if r is None else [tuple(x) for x in r] for r in rows]


def test_transaction_entries_in_every_shape(read):
    one = [("t1", "p"), ("t2", None)]
    inner = '[{"Transaction_ID": "t1", "Player_Profile_ID": "p"}, {"TxId": "t2"}, 5, {"Player_ID": "x"}]'
    got = read(
        R.transaction_entries,
        inner,
        '{"Game_Transactions": {"Transactions": %s}}' % inner,
        '{"Game_Transaction": %s}' % inner,
        '{"Transactions": %s}' % inner,
        inner.replace('"', "'"),
        inner.replace('"', '""'),
        '{"TransactionId": 7, "PlayerId": 8}',
        "not json",
        None,
        "[]",
        "{}",
    )
    assert plain(got) == [one] * 6 + [[("7", "8")], [], [], [], []]
    assert plain(read(R.strict_transaction_entries, '{"Game_Transaction": %s}' % inner, inner, "{'Game_Transaction': []}")) == [one, [], []]


def test_accounts_and_risk(read):
    got = read(R.bank_accounts, '[{"Bank_Account_ID": "1a"}, {"Bank_Account_ID": ""}, {"x": 1}]', '{"Bank_Account_ID": 5}', "null", "", None)
    assert got == [["1a"], ["5"], [], [], []]
    got = read(R.risk_class, '"{""RG_Class_Value"": ""NO_RISK"", ""RG_Class_Datetime"": ""2017""}"', '{"RG_Class_Value": ""}', "[]", None)
    assert got == ["NO_RISK", None, None, None]


def test_limits(read):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5)
    got = read(
        lambda c: R.limit_values(c, "deposit"),
        '[{"Deposit_Request_Datetime": "2024-01-02T03:04:05", "Deposit_Amount": "12,5", "Deposit_Time_Window": " DAY "}]',
        '{"Deposit_Request_Datetime": "", "Deposit_Start_Datetime": "2024-01-02 03:04:05", "Deposit_Amount": 3}',
        '[{"Deposit_Amount": "none"}, {"Deposit_Amount": "much"}]',
    )
    assert plain(got) == [[(at, 12.5, None, "DAY")], [(at, 3.0, None, None)], [(None, None, None, None), (None, None, "much", None)]]
    got = read(lambda c: R.limit_values(c, "game_type"), '[{"Game_Type_Type": " slots "}]')
    assert plain(got) == [[(None, None, "slots", None)]]
    got = read(lambda c: R.limit_values(R.limit_object(c, "balance"), "balance"), "12,5", '{"Balance_Amount": "1"}')
    assert plain(got) == [[(None, 12.5, None, None)], [(None, 1.0, None, None)]]


def test_legs(read):
    got = read(R.live_flags, '{"Part": [{"Part_Live": true}, {"Part_Live": "No"}, {"Part_Live": "?"}, {}]}', '{"Part": {"Part_Live": 2}}', '[{"Part_Live": "t"}]', '{"Part_Live": 0}', "x")
    assert got == [[True, False], [True], [True], [False], []]
    assert read(R.part_ids, '{"Part": [{"Part_ID": 1}, {"Part_ID": "b"}, {}]}', None) == [["1", "b"], []]
    flat = read(R.flattened_parts, '{"Parts": [{"Part": [{"Part_ID": 1}]}, {"Part": {"Part_ID": 2}}]}')
    assert read(R.part_ids, *flat) == [["1", "2"]]


def test_responses(read):
    got = read(
        R.response_ids, '[{"Response": [{"Response_ID": "a"}, {"Response_ID": "b"}]}, {"Response": [{"Response_ID": "c"}]}]', '[{"Response": null}]', '[{""Response"": null}]', "[{'Response': null}]", None, "broken"
    )
    assert got == [["a", "b", "c"], None, None, None, None, None]
    with pytest.raises(Exception, match="no object"):
        read(R.response_ids, "[5]")


def test_parents_from_flat_columns(spark):
    df = spark.createDataFrame([(None, "1", "nan"), ('{"a": 9}', "1", "2"), ("null", None, ""), (None, "1", "2")], "p string, x string, y string")
    some = df.select(R.json_parent(F.col("p"), {"x": F.col("x"), "y": F.col("y")}).alias("j"), R.json_parent(F.col("p"), {"x": F.col("x"), "y": F.col("y")}, need_all=True).alias("k"))
    assert [tuple(r) for r in some.collect()] == [('{"x":"1"}', None), ('{"a": 9}', '{"a": 9}'), (None, None), ('{"x":"1","y":"2"}', '{"x":"1","y":"2"}')]


def test_repairs(read):
    assert read(R.wrapped_in_list, '{"a": 1}', "[1]") == ['[{"a": 1}]', "[1]"]
    assert read(lambda c: R.renamed_keys(c, {"a": "b"}), '{"a" : {"a": 1}}') == ['{"b": {"b": 1}}']
