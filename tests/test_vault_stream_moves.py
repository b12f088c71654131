"""What a vault stream keeps and writes."""

from frames import rows
from pyspark.sql import functions as F
from test_vault import T1, keyed_orders, staged

from loomhouse.plans import vault
from loomhouse.sources.contracts import STAGING
from loomhouse.sources.vault_store import LOAD_SETTINGS, VaultStore
from loomhouse.streaming import vault_stream as streaming
from loomhouse.streaming.vault_stream import first_seen, vault_stream


def test_keys_of_a_stream_are_numbers_if_all_are(spark):
    numbers = staged(spark)
    texts = numbers.withColumn("product_id", F.col("product_id").cast("string"))
    found = [rows(first_seen(df)) for df in (numbers, texts)]
    assert found[0] == found[1] and len(found[0]) > 0
    for df, kind in ((numbers, "bigint"), (texts, "string")):
        plan = first_seen(df)._jdf.queryExecution().analyzed().toString()
        assert f"as {kind}" in plan


def test_files_of_a_stream_are_not_written_again(spark, tmp_path, monkeypatch):
    incoming = str(tmp_path / "in")
    keyed_orders(spark, 0, 40).coalesce(1).write.parquet(incoming)
    keyed_orders(spark, 20, 70).coalesce(1).write.mode("append").parquet(incoming)
    names, real = [], streaming.stage
    monkeypatch.setattr(streaming, "stage", lambda df, name, *rest: names.append(name) or real(
        df, name, *rest))
    before = {key: spark.conf.get(key, None) for key in LOAD_SETTINGS}
    found = {}
    for written in (False, True):
        names.clear()
        store = VaultStore(spark, str(tmp_path / f"vault-{written}"), 1000)
        stream = (spark.readStream.schema(STAGING["stg_orders"].schema())
                  .option("maxFilesPerTrigger", 1).parquet(incoming))
        vault_stream(stream, store, str(tmp_path / f"progress-{written}"), lambda n: T1,
                     written=written).awaitTermination()
        found[written] = {t: rows(store.read(t)) for t in vault.TABLES}
        assert names.count("stg_orders") == (0 if written else 2)
        assert names.count("new_keys") == 2
    assert found[True] == found[False] and len(found[True]["sat_order_product"]) == 70
    assert {key: spark.conf.get(key, None) for key in LOAD_SETTINGS} == before
