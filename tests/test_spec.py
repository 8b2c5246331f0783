"""Every rule of the load description, one invalid variant each."""

import pytest

from tablekeel import LoadSpec

DAY = dict(
    table="t", schema="s", partition_column="d", partition_type="day", processing_strategy="single_day",
    partition_query="SELECT * FROM x WHERE d IN ({target_date_list})",
)
MONTH = {**DAY, "partition_type": "month", "processing_strategy": "single_month"}
FULL = dict(
    table="t", schema="s", partition_column="", partition_type="full", processing_strategy="full",
    partition_query="SELECT * FROM x",
)
VIEW = {**FULL, "processing_strategy": "view"}


@pytest.mark.parametrize("config", [DAY, MONTH, FULL, VIEW, {**DAY, "processing_strategy": "last_and_current_month"}, {**DAY, "layout": "clustered"}, {**MONTH, "layout": "partitioned"}])
def test_valid(config):
    LoadSpec.from_mapping(config)


@pytest.mark.parametrize("config", [None, {}, [], "text"])
def test_needs_a_mapping(config):
    with pytest.raises(ValueError, match="mapping"):
        LoadSpec.from_mapping(config)


@pytest.mark.parametrize("field", ["table", "schema", "partition_type", "partition_query", "processing_strategy"])
@pytest.mark.parametrize("value", [None, "absent", "", "  ", 7])
def test_required_fields(field, value):
    config = dict(DAY)
    if value == "absent":
        del config[field]
    else:
        config[field] = value
    with pytest.raises(ValueError, match=field):
        LoadSpec.from_mapping(config)


@pytest.mark.parametrize(
    "base, change, message",
    [
        (DAY, {"partition_type": "week"}, "day, month, full"),
        (VIEW, {"partition_type": "day"}, "view"),
        (VIEW, {"partition_column": "d"}, "partition_column"),
        (VIEW, {"partition_query": DAY["partition_query"]}, "target_date_list"),
        (FULL, {"partition_column": "d"}, "partition_column"),
        (FULL, {"partition_query": DAY["partition_query"]}, "target_date_list"),
        (FULL, {"processing_strategy": "single_day"}, "processing_strategy"),
        (DAY, {"partition_column": ""}, "partition_column"),
        (DAY, {"partition_column": None}, "partition_column"),
        (MONTH, {"partition_column": " "}, "partition_column"),
        (DAY, {"partition_column": 5}, "partition_column"),
        (DAY, {"processing_strategy": "single_month"}, "processing_strategy"),
        (DAY, {"processing_strategy": "full"}, "processing_strategy"),
        (MONTH, {"processing_strategy": "single_day"}, "processing_strategy"),
        (MONTH, {"processing_strategy": "last_and_current_month"}, "processing_strategy"),
        (DAY, {"partition_query": "SELECT 1"}, "target_date_list"),
        (MONTH, {"partition_query": "SELECT 1"}, "target_date_list"),
        (DAY, {"layout": "sorted"}, "layout"),
        (FULL, {"layout": "clustered"}, "layout"),
        (VIEW, {"layout": "partitioned"}, "layout"),
        (DAY, {"table": "s.t"}, "dots"),
        (DAY, {"schema": "c.s"}, "dots"),
        (DAY, {"catalog": "c.d"}, "dots"),
    ],
)
def test_invalid(base, change, message):
    with pytest.raises(ValueError, match=message):
        LoadSpec.from_mapping({**base, **change})


@pytest.mark.parametrize("config", [FULL, VIEW])
def test_whole_table_takes_no_target_date(config):
    spec = LoadSpec.from_mapping(config)
    spec.check_target_date(None)
    spec.check_target_date("")
    with pytest.raises(ValueError, match="target_date"):
        spec.check_target_date("2024-01-01")


def test_values_are_kept_trimmed():
    spec = LoadSpec.from_mapping({**DAY, "partition_type": " day ", "table": "\tt ", "partition_column": " d"})
    assert (spec.partition_type, spec.table, spec.partition_column) == ("day", "t", "d")


def test_partition_column_may_be_left_out_for_full():
    assert LoadSpec.from_mapping({k: v for k, v in FULL.items() if k != "partition_column"}).partition_column == ""


def test_unknown_fields_are_ignored():
    assert LoadSpec.from_mapping({**FULL, "owner": "me"}).table == "t"


def test_target_name():
    assert LoadSpec.from_mapping(FULL).target == "`s`.`t`"
    assert LoadSpec.from_mapping({**FULL, "catalog": "c"}).target == "`c`.`s`.`t`"
