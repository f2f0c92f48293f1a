import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from mirrorwell.config import RefreshConfig
from mirrorwell.functions.names import job_name, new_job_id, remap_schema, split_table_list, table_list


def test_table_list():
    assert table_list([" orders", "", "Part ", "ORDERS"]) == ["ORDERS", "PART"]


def test_columns_of_names(spark):
    row = (
        spark.createDataFrame([(" a,, b ,A", "S.T", "SX.T")], "l string, q string, o string")
        .select(split_table_list(F.col("l")), remap_schema(F.col("q"), "S", "U"), remap_schema(F.col("o"), "S", "U"))
        .first()
    )
    assert tuple(row) == (["A", "B"], "U.T", "SX.T")


def test_job_id(spark):
    found = new_job_id(spark)
    assert re.fullmatch(r"j_\d{8}_\d{6}_[0-9a-f]{16}", found) and new_job_id(spark) != found
    begun = datetime.strptime(found[2:17], "%Y%m%d_%H%M%S").replace(tzinfo=timezone.utc)
    assert abs((datetime.now(timezone.utc) - begun).total_seconds()) < 120
    at = spark.sql("select timestamp'2026-05-22 12:00:00' as at").select(job_name(F.col("at"), F.lit("0f")))
    assert at.first()[0] == "j_20260522_120000_0f"


def test_config_is_normalized():
    config = RefreshConfig("src", " tgt", "orders, part,")
    assert (config.source_schema, config.target_schema) == ("SRC", "TGT")
    assert config.tables == ("ORDERS", "PART")
    assert RefreshConfig.from_json(config.to_json()) == config


def test_old_commit_mode_name():
    with pytest.warns(DeprecationWarning):
        config = RefreshConfig("s", "t", ["a"], commit_mode="all_or_nothing")
    assert config.commit_mode == "defer_insert_commits"


@pytest.mark.parametrize(
    "bad",
    [
        {"tables": []},
        {"commit_mode": "sometimes"},
        {"strategy": "magic"},
        {"max_parallel": 0},
        {"max_chunks_per_table": 0},
        {"verify": "eyes"},
        {"consistent_read": "maybe"},
    ],
)
def test_config_refuses(bad):
    with pytest.raises(ValueError):
        RefreshConfig(**{"source_schema": "s", "target_schema": "t", "tables": ["a"], **bad})
