import datetime as dt
from decimal import Decimal

import pytest
from frames import by_key, rows
from scans import rows_read
from fixed_rows import DIGESTS, STAGED_ORDERS, VAULT_ROWS
from pyspark.sql import functions as F

from loomhouse.functions import hash_key
from loomhouse.operators import vault as operators
from loomhouse.operators.vault import Zones, key_rejects, latest_satellite, satellite_rejects
from loomhouse.plans import catalog, vault
from loomhouse.sources.contracts import STAGING, VAULT, violations
from loomhouse.sources.files import child_names, literal_rows
from loomhouse.sources.staging import stage, staged_folder
from loomhouse.sources.vault_store import VaultStore
from loomhouse.streaming.vault_stream import STATE_SETTINGS, vault_stream

T1, T2, T3 = "2026-06-01 10:00:00", "2026-06-02 10:00:00", "2026-06-03 10:00:00"


def staged(spark, data=STAGED_ORDERS):
    return literal_rows(spark, data, STAGING["stg_orders"].schema())


def customer_in(spark, city):
    return staged(spark).withColumn(
        "customer_city", F.when(F.col("customer_id") == 1, city).otherwise(
            F.col("customer_city")))


@pytest.fixture(scope="module")
def first(spark):
    return {t: df.cache() for t, df in vault.run_vault(staged(spark), T1).items()}


def test_first_load(first):
    assert {t: df.count() for t, df in first.items()} == VAULT_ROWS
    for name, df in first.items():
        assert df.columns == VAULT[name].names()
        for rule, bad in violations(first, name).items():
            assert bad.count() == 0, (name, rule)


def test_digests(first):
    assert by_key(first["hub_customer"], "customer_id", "hk_customer")["1"] == DIGESTS["1"]
    assert by_key(first["hub_order"], "order_id", "hk_order")["100"] == DIGESTS["100"]
    assert by_key(first["hub_product"], "product_id", "hk_product")["10"] == DIGESTS["10"]
    links = by_key(first["link_order_product"], "hk_order_product", "hk_order", "hk_product")
    assert links[DIGESTS["100|10"]] == (DIGESTS["100"], DIGESTS["10"])
    assert DIGESTS["100|11"] in links
    assert DIGESTS["1|100"] in by_key(first["link_customer_order"], "hk_customer_order",
                                      "hk_order")
    assert by_key(first["sat_customer"], "hk_customer", "hash_diff")[DIGESTS["1"]] == \
        DIGESTS["Ivan|Moscow"]
    assert by_key(first["sat_order"], "hk_order", "hash_diff")[DIGESTS["100"]] == \
        DIGESTS["1100.00|NEW"]
    assert by_key(first["sat_product"], "hk_product", "hash_diff")[DIGESTS["10"]] == \
        DIGESTS["Phone|Electronics"]
    assert by_key(first["sat_order_product"], "hk_order_product_link", "hash_diff")[
        DIGESTS["100|10"]] == DIGESTS["2|500.00"]
    end = first["sat_customer"].first().end_date
    assert end == dt.datetime(9999, 12, 31)


def test_replay_adds_nothing(spark, first):
    for compare in ("any", "latest"):
        again = vault.run_vault(staged(spark), T2, first, compare)
        assert {t: df.count() for t, df in again.items()} == dict.fromkeys(VAULT_ROWS, 0)


def test_changed_and_new_rows(spark, first):
    extra = (6, "Zoe", "Oslo", 105, Decimal("1.00"), "NEW", 10, "Phone", "Electronics", 1,
             Decimal("1.00"), "CRM", dt.datetime(2026, 6, 2))
    batch = customer_in(spark, "Kyiv").unionByName(staged(spark, [extra])).withColumn(
        "order_status", F.when(F.col("order_id") == 100, "PAID").otherwise(
            F.col("order_status")))
    added = {t: df.count() for t, df in vault.run_vault(batch, T2, first).items()}
    assert added == {"hub_customer": 1, "hub_order": 1, "hub_product": 0,
                     "link_customer_order": 1, "link_order_product": 1, "sat_customer": 2,
                     "sat_order": 2, "sat_product": 0, "sat_order_product": 1}


def test_return_to_former_values(spark, first):
    moved = first["sat_customer"].unionByName(vault.satellite(
        customer_in(spark, "Kyiv"), "sat_customer", T2, first["sat_customer"]))
    assert moved.count() == 6
    assert vault.satellite(staged(spark), "sat_customer", T3, moved).count() == 0
    back = vault.satellite(staged(spark), "sat_customer", T3, moved, compare="latest")
    assert rows(back, "name", "city") == [("Ivan", "Moscow")]
    newest = latest_satellite(moved.unionByName(back), "hk_customer")
    assert newest.count() == 5
    assert by_key(newest, "name", "city")["Ivan"] == "Moscow"
    assert by_key(latest_satellite(moved, "hk_customer"), "name", "city")["Ivan"] == "Kyiv"


def test_second_source_and_two_attribute_sets(spark, first):
    other = staged(spark).withColumn("source_system", F.lit("A WEB"))
    assert vault.hub(other, "hub_customer", T2, first["hub_customer"]).count() == 0
    both = staged(spark).unionByName(other).unionByName(customer_in(spark, "Aachen"))
    assert {r.record_source for r in vault.hub(both, "hub_customer", T1).collect()} == {"A WEB"}
    assert by_key(vault.satellite(both, "sat_customer", T1), "name", "city")["Ivan"] == "Moscow"


def test_links_and_satellites_need_their_parents(spark, first):
    hubs = {"hub_customer": first["hub_customer"].filter("customer_id <> '1'"),
            "hub_order": first["hub_order"]}
    assert vault.link(staged(spark), "link_customer_order", T1, hubs=hubs).count() == 4
    assert vault.satellite(staged(spark), "sat_customer", T1,
                           parent=hubs["hub_customer"]).count() == 4
    links = first["link_order_product"].filter(F.col("hk_order_product") != DIGESTS["100|10"])
    assert vault.link_satellite(staged(spark), "sat_order_product", T1, parent=links).count() == 5


def test_nulls_are_rejected_or_encoded(spark):
    batch = customer_in(spark, F.lit(None))
    assert vault.satellite(batch, "sat_customer", T1).count() == 4
    rejects = satellite_rejects(batch, ["customer_id"], vault.SATELLITES["sat_customer"][1])
    assert rows(rejects) == [(1, "Ivan", None)]
    assert vault.satellite(batch, "sat_customer", T1, null_safe=True).count() == 5
    texts = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "-"), ("-", None),
                                   ("", None), (None, "")], "x string, y string")
    plain = texts.select(hash_key(F.col("x"), F.col("y")).alias("h"))
    assert plain.filter("h is null").count() == 4
    assert plain.filter("h is not null").distinct().count() == 1
    safe = texts.select(hash_key(F.col("x"), F.col("y"), null_safe=True).alias("h"))
    assert safe.filter("h is not null").distinct().count() == 6


def test_store_survives_a_partial_batch(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path / "vault"))
    store.append("hub_customer", vault.hub(staged(spark), "hub_customer", T1,
                                           zone_width=store.zone_width))
    other = stage(staged(spark), "another_load")
    before = child_names(spark, staged_folder(spark))
    for _ in range(2):
        vault.load_vault(staged(spark), store, T1)
    assert child_names(spark, staged_folder(spark)) == before
    assert other.count() == len(STAGED_ORDERS)
    assert {t: store.read(t).count() for t in VAULT_ROWS} == VAULT_ROWS


def test_stream_loads_new_files_only(spark, tmp_path):
    incoming, store = str(tmp_path / "in"), VaultStore(spark, str(tmp_path / "vault"))
    schema = STAGING["stg_orders"].schema()

    def run():
        stream = spark.readStream.schema(schema).parquet(incoming)
        query = vault_stream(stream, store, str(tmp_path / "progress"),
                             lambda n: f"2026-06-0{n + 1} 10:00:00")
        query.awaitTermination()

    staged(spark, STAGED_ORDERS[:3]).coalesce(1).write.parquet(incoming)
    run()
    assert store.read("hub_order").count() == 2
    staged(spark).coalesce(1).write.mode("append").parquet(incoming)
    run()
    run()
    assert {t: store.read(t).count() for t in VAULT_ROWS} == VAULT_ROWS
    assert {str(r.load_dts) for r in store.read("hub_order").select("load_dts").collect()} == {
        "2026-06-01 10:00:00", "2026-06-02 10:00:00"}


def keyed_orders(spark, low, high, step=1):
    """One line an order, each order of its own customer among a thousand."""
    one = staged(spark, STAGED_ORDERS[:1]).drop("order_id", "customer_id")
    ids = spark.range(low, high, step).select(
        F.col("id").cast("int").alias("order_id"), (F.col("id") % 1000).cast("int").alias("customer_id"))
    return ids.crossJoin(F.broadcast(one)).select(*STAGING["stg_orders"].names())


ORDER_TABLES = ["hub_order", "link_customer_order", "link_order_product", "sat_order",
                "sat_order_product"]


def read_for(batch, store, tables=ORDER_TABLES):
    """Stored rows that each table's load reads for a batch, and the rows it adds."""
    old = {t: store.stored(t) for t in vault.TABLES}
    added = vault.run_vault(batch, T2, old, zone_width=store.zone_width)
    new = {t: len(added[t].collect()) for t in tables}
    return {t: rows_read(added[t], store.path(t))[0] for t in tables}, new


def test_a_batch_reads_its_zones_only(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path / "vault"), 500)
    vault.load_vault(keyed_orders(spark, 0, 20_000), store, T1)
    late = stage(keyed_orders(spark, 19_900, 20_100))           # 1 % of the orders
    read, new = read_for(late, store)
    assert read == dict.fromkeys(ORDER_TABLES, 500) and new == dict.fromkeys(ORDER_TABLES, 100)
    few = stage(keyed_orders(spark, 77, 30_000, 10_000))        # by value, in three zones
    read, new = read_for(few, store)
    assert max(read.values()) <= 1000 and new == dict.fromkeys(ORDER_TABLES, 1)
    spread = stage(keyed_orders(spark, 0, 40_000, 200))         # keys of every zone
    assert read_for(spread, store)[1] == dict.fromkeys(ORDER_TABLES, 100)


def test_later_batches_read_no_more(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path / "vault"), 100)
    read = []
    for n in range(4):
        batch = stage(keyed_orders(spark, 100 * n - (50 if n else 0), 100 * n + 100))
        read.append(read_for(batch, store)[0] if n else None)
        vault.load_vault(batch, store, T1)
    assert read[1] == read[2] == read[3] == dict.fromkeys(ORDER_TABLES, 100)


def test_zones_follow_the_text_of_a_key(spark):
    keys = ["0", "7", "99", "100", "-1", "-100", "-101", "7.5", "A", "", "9" * 18, "9" * 30]
    texts = spark.createDataFrame([(k,) for k in keys], "k string")
    found = by_key(texts.select("k", Zones("k", 100).column()), "k", "_zone")
    assert [found[k] for k in keys[:7]] == [0, 0, 0, 1, -1, -1, -2]
    assert all(-(1 << 62) < found[k] < -(1 << 59) for k in ("7.5", "A", "", "9" * 30))
    numbers = spark.createDataFrame([(int(k),) for k in keys[:7]], "k int")
    assert [r[0] for r in numbers.select(Zones("k", 100).column()).collect()] == [
        found[k] for k in keys[:7]]


def test_a_store_keeps_its_zone_width(spark, tmp_path):
    root = str(tmp_path / "vault")
    store = VaultStore(spark, root, 300)
    vault.load_vault(keyed_orders(spark, 0, 1000), store, T1)
    again = VaultStore(spark, root)
    assert again.zone_width == 300
    vault.load_vault(keyed_orders(spark, 0, 1000), again, T2)
    assert again.read("hub_order").count() == 1000
    with pytest.raises(ValueError, match="zone"):
        again.append("hub_order", again.read("hub_order"))


def test_rows_without_keys_are_listed(spark):
    batch = staged(spark).withColumn(
        "customer_id", F.when(F.col("order_id") > 101, F.col("customer_id")))
    lost = rows(key_rejects(batch, ["customer_id", "order_id"]))
    ids = [r[3] for r in STAGED_ORDERS if r[3] <= 101]
    assert sum(r[-1] for r in lost) == len(ids)
    assert {(r[0], r[1], r[3]) for r in lost} == {(None, i, "customer_id") for i in ids}


def test_a_stream_does_not_read_the_keys_it_has_stored(spark, tmp_path, monkeypatch):
    incoming, store = str(tmp_path / "in"), VaultStore(spark, str(tmp_path / "vault"), 1000)
    schema = STAGING["stg_orders"].schema()
    vault.load_vault(keyed_orders(spark, 0, 50), store, T1)          # by another load, before
    read, whole = [], VaultStore.stored

    def stored(self, table, without=None):
        found = whole(self, table, without)
        if table in ("hub_order", "hub_customer", "link_customer_order"):
            read.append((table, 0 if found is None else found.count()))
        return found

    for n in range(4):
        keyed_orders(spark, 40 * n, 40 * n + 60).coalesce(1).write.mode("append").parquet(incoming)
        with monkeypatch.context() as patched:
            patched.setattr(VaultStore, "stored", stored)
            stream = spark.readStream.schema(schema).parquet(incoming)
            vault_stream(stream, store, str(tmp_path / "progress"), lambda n: T2
                         ).awaitTermination()
    assert len(read) == 12 and {n for _, n in read} == {50}
    plain = vault.run_vault(keyed_orders(spark, 0, 180), T1)
    for table, df in plain.items():
        assert rows(store.read(table).drop("load_dts")) == rows(df.drop("load_dts")), table


def test_a_repeated_load_replaces_its_first_attempt(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path / "vault"), 1000)
    for high in (10, 20):
        store.append("hub_order", vault.hub(keyed_orders(spark, 0, high), "hub_order", T1,
                                            zone_width=1000), "a-1.")
    store.append("hub_order", vault.hub(keyed_orders(spark, 20, 25), "hub_order", T1,
                                        zone_width=1000), "a-10.")
    assert store.read("hub_order").count() == 25
    assert store.stored("hub_order", "a-1.").count() == 5
    assert store.stored("hub_order", "a-") is None


def test_a_stream_keeps_its_state_on_disk(spark, tmp_path):
    incoming, store = str(tmp_path / "in"), VaultStore(spark, str(tmp_path / "vault"), 1000)
    keyed_orders(spark, 0, 20).coalesce(1).write.parquet(incoming)
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    stream = spark.readStream.schema(STAGING["stg_orders"].schema()).parquet(incoming)
    found = vault_stream(stream, store, str(tmp_path / "progress"), lambda n: T1)
    found.awaitTermination()
    kept = [s for p in found.queries[0].recentProgress for s in p["stateOperators"]]
    assert kept and all(any(m.startswith("rocksdb") for m in s["customMetrics"]) for s in kept)
    assert {key: spark.conf.get(key, None) for key in STATE_SETTINGS} == before
    assert store.read("hub_order").count() == 20


def test_written_rows_are_not_written_again(spark, tmp_path, monkeypatch):
    store = VaultStore(spark, str(tmp_path / "vault"), 1000)
    stg = stage(staged(spark), "orders")
    monkeypatch.setattr(vault, "stage", None)
    vault.load_vault(stg, store, T1, written=True)
    assert {t: store.read(t).count() for t in VAULT_ROWS} == VAULT_ROWS


def test_digests_meet_as_bytes(spark, monkeypatch):
    written = []
    monkeypatch.setattr(operators, "stage_sized", lambda rows, name: (
        written.append(dict(rows.dtypes)) or (rows, 1 << 30)))
    old = vault.link_satellite(staged(spark, STAGED_ORDERS[:3]), "sat_order_product", T1)
    new = vault.link_satellite(staged(spark), "sat_order_product", T1, old)
    whole = vault.link_satellite(staged(spark), "sat_order_product", T1)
    assert rows(new) == rows(whole.subtract(old))
    assert [d["hash_diff"] for d in written] == ["binary"]


def test_a_link_satellite_stages_the_key_of_its_link_only(spark, tmp_path, monkeypatch):
    staged_columns = {}

    def noted(df, name="table", session=None):
        staged_columns[name] = df.columns
        return df

    monkeypatch.setattr(catalog, "stage", noted)
    monkeypatch.setattr(catalog, "_staged", lambda s, folder, *c: staged(s).select(*c))
    found = catalog.sat_order_product(spark, str(tmp_path))
    assert staged_columns == {"links": ["hk_order_product"]}
    assert rows(found, "hash_diff") == rows(vault.link_satellite(
        staged(spark), "sat_order_product", T1), "hash_diff")
