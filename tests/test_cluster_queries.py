"""Queries that stage tables, on a cluster that names no folder for them, against their SQL."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry

#: Before the staged tables went below the warehouse there, each ended with a ValueError.
STAGING = [
    "category_stats",
    "baseline_features",
    "bottom_categories",
    "category_avg_price_full",
    "category_avg_price_train",
    "category_avg_review_csv",
    "category_median_sales_csv",
    "category_insert_if_absent",
    "category_seed_file",
    "category_ranges",
    "category_seed_rows",
    "clean_row_count",
    "fit_gbt",
    "fit_gbt_tuned",
    "fit_linear",
    "fit_tree",
    "fit_forest",
]

TABLES = {
    "nation": "SELECT i AS n_nationkey, 'NATION_' || i AS n_name, 0 AS n_regionkey FROM range(5) t(i)",
    "customer": "SELECT i AS c_custkey, (i % 5)::INT AS c_nationkey FROM range(20) t(i)",
    "supplier": "SELECT i AS s_suppkey, (i % 5)::INT AS s_nationkey FROM range(8) t(i)",
    "part": """
        SELECT i AS p_partkey, 'part number ' || i AS p_name, 'Brand#' || (1 + i % 4) AS p_brand,
            ['PROMO', 'ECONOMY', 'SMALL', 'LARGE'][1 + i % 3] AS p_type, (1 + i * 7 % 50)::INT AS p_size
        FROM range(60) t(i)""",
    "orders": """
        SELECT i AS o_orderkey, i % 20 AS o_custkey,
            TIMESTAMP '1997-01-01' + to_days((i * 11 % 700)::INT) AS o_orderdate
        FROM range(150) t(i)""",
    "lineitem": """
        SELECT i // 4 AS l_orderkey, i * 13 % 60 AS l_partkey, i * 5 % 8 AS l_suppkey,
            (1 + i % 4)::INT AS l_linenumber, (1 + i * 17 % 50)::DOUBLE AS l_quantity,
            (50.25 + i * 7919 % 9973)::DOUBLE AS l_extendedprice, (i % 9) / 100 AS l_tax,
            ['A', 'N', 'R'][1 + i % 3] AS l_returnflag, ['O', 'F'][1 + i % 2] AS l_linestatus
        FROM range(600) t(i)""",
    "events": """
        SELECT i AS event_id, TIMESTAMP '2024-01-01' + to_minutes((i * 37 % 9000)::INT) AS ts,
            (i * 31 % 400)::DOUBLE AS value
        FROM range(240) t(i)""",
}

_RUN = """
import json, sys
from pyspark.sql import SparkSession
folder, names = sys.argv[1], sys.argv[2:]
spark = SparkSession.builder.config(map={
    "spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "1g",
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": folder + "/warehouse",
}).getOrCreate()
import check
tables, outcomes = check.connect(folder + "/tables"), {}
for name in names:
    try:
        outcomes[name] = check.compare(spark, tables, name, folder + "/tables")
    except Exception as error:
        outcomes[name] = f"{type(error).__name__}: {error}"[:500]
    with open(folder + "/outcomes", "w") as file:
        json.dump(outcomes, file)
spark.stop()
"""


@pytest.fixture(scope="module")
def outcomes(tmp_path_factory):
    folder = tmp_path_factory.mktemp("cluster")
    for name in ("conf", "tables"):
        (folder / name).mkdir()
    for name, rows in TABLES.items():
        duckdb.execute(f"COPY ({rows}) TO '{folder}/tables/{name}.parquet' (FORMAT parquet)")
    environment = os.environ | {"PYTHONPATH": entry.HERE, "SPARK_CONF_DIR": str(folder / "conf")}
    done = subprocess.run(
        [sys.executable, "-c", _RUN, str(folder), *STAGING],
        env=environment, cwd=folder, capture_output=True, text=True, timeout=600,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return json.loads((folder / "outcomes").read_text())


@pytest.mark.parametrize("name", STAGING)
def test_a_staging_query_on_a_cluster_that_names_no_folder(outcomes, name):
    assert outcomes[name].startswith("match (")
