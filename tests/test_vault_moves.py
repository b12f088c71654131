"""How much vault loads move and write: short rows, once."""

import datetime as dt
import os

import pytest
from frames import rows
from fixed_rows import STAGED_ORDERS
from pyspark.sql import functions as F
from scans import _nodes
from test_vault import T1, T2, keyed_orders, staged

from loomhouse.operators import vault as operators
from loomhouse.plans import driver_views, vault
from loomhouse.session import set_within
from loomhouse.sources.staging import stage
from loomhouse.sources.vault_store import VaultStore

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def moved(df):
    """(rows, columns) of each shuffle of a frame that was run; broadcasts are none."""
    found = []
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            output = node.output()
            found.append((node.metrics().apply("shuffleRecordsWritten").value(),
                          [output.apply(i).name() for i in range(output.size())]))
    return found


def test_customers_move_once_an_order(spark, tmp_path):
    day = dt.datetime(1996, 1, 2)
    tables = {
        "nation": ([(0, "N")], "n_nationkey int, n_name string"),
        "customer": ([(i, f"C{i}", 0) for i in range(5)],
                     "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(i, f"P{i}", "T") for i in range(5)],
                 "p_partkey long, p_name string, p_type string"),
        "orders": ([(i, i % 6, "O", 10.5, day, "2-HIGH" if i % 2 else None) for i in range(10)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                   "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(i % 11, i % 6, float(i), 1.25) for i in range(400)],
                     "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    with set_within(spark, NO_BROADCAST):
        for partitions in (None, 6):
            found = driver_views.staged_orders(spark, str(tmp_path), partitions=partitions)
            got = rows(found, "order_id", "customer_name", "product_name", "qty", "source_system")
            assert sorted(got) == sorted(
                (i % 11, f"C{i % 11 % 6}", f"P{i % 6}", i, "CRM" if i % 11 % 2 else "WEB")
                for i in range(400) if i % 11 < 10 and i % 11 % 6 < 5 and i % 6 < 5)
            found.collect()
            named = [n for n, columns in moved(found) if "c_name" in columns]
            assert named and max(named) <= 10


@pytest.mark.parametrize("compare", ["any", "latest"])
def test_digests_are_not_shuffled(spark, tmp_path, monkeypatch, compare):
    store = VaultStore(spark, str(tmp_path / "vault"), 1000)
    vault.load_vault(keyed_orders(spark, 0, 60), store, T1)
    written = []
    real = operators.stage_sized
    monkeypatch.setattr(operators, "SMALL_BATCH_BYTES", 0)
    monkeypatch.setattr(operators, "stage_sized",
                        lambda df, name: written.append(name) or real(df, name))
    batch = stage(keyed_orders(spark, 30, 90).withColumn(
        "qty", F.when(F.col("order_id") < 40, 77).otherwise(F.col("qty"))))
    with set_within(spark, NO_BROADCAST):
        added = vault.run_vault(batch, T2, {t: store.stored(t) for t in vault.TABLES}, compare,
                                zone_width=store.zone_width)
        for table, n in {"link_order_product": 30, "sat_order_product": 40, "hub_order": 30}.items():
            assert len(added[table].collect()) == n
            digests = {"hash_diff", "hk_order", "hk_order_product", "hk_order_product_link"}
            shuffles = [set(columns) for _, columns in moved(added[table])]
            # Stored rows come as one digest; the newest ones by key are found by both.
            assert {"_known"} in shuffles
            assert sum(bool(c & digests) for c in shuffles) == (
                compare == "latest" and table.startswith("sat"))
    assert not written


def test_pairs_move_once(spark, monkeypatch):
    lines = stage(staged(spark).unionByName(staged(spark)).unionByName(
        staged(spark, [r[:9] + (9,) + r[10:] for r in STAGED_ORDERS])))
    found = {}
    for most in (0, 1 << 20):
        monkeypatch.setattr(operators, "ROWS_TOGETHER", most)
        new = vault.run_vault(lines, T1, zone_width=2, tables=["link_order_product",
                                                               "sat_order_product"])
        found[most] = {t: rows(df) for t, df in new.items()}
        for df in new.values():
            df.collect()
            assert len(moved(df)) == (1 if most else 2)
    assert found[0] == found[1 << 20]
    plain = vault.run_vault(lines, T1, tables=list(found[0]))
    assert {t: [r[:-1] for r in found[0][t]] for t in plain} == {
        t: rows(df) for t, df in plain.items()}


def test_small_files_have_small_bloom_filters(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path / "vault"), 1 << 20)
    store.append("hub_order", vault.hub(keyed_orders(spark, 0, 50), "hub_order", T1,
                                        zone_width=store.zone_width), gathered=True)
    sizes = [os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(store.root)
             for f in names if f.endswith(".parquet")]
    assert sizes and max(sizes) < 20_000


def test_settings_hold_until_the_last_load_ends(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    outer, inner = set_within(spark, {key: "1000"}), set_within(spark, {key: "1000"})
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(key) == "1000"
    inner.__exit__(None, None, None)
    assert spark.conf.get(key) == before
