"""Token ids of documents in files of wavelet matrices.

Documents are range-partitioned by doc_id and written in that order, one file a partition.
A row of a file is a shard: the documents it holds, their numbers of ids and one wavelet
matrix over all their ids. A document ends with `end_id` and lies in one shard.

Rows: a missing text is empty (its end id alone); a missing doc_id sorts first; rows with one
doc_id are in the order of their texts' hashes. An empty table gives an empty store.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import SLICE, slice_offsets
from ..sources.staging import stage, staged_path
from .common import (bucket_count, byte_rows, column, doc_key, groups, numbers, own_id, ship,
                     whole_text)
from .tokens import byte_encoder, with_end
from .wavelet import WaveletMatrix

VOCABULARY = "byte_bpe_50k.json"
#: Ids after which a shard is closed.
SHARD_IDS = 1 << 20
#: Stored bytes of text for each file.
FILE_BYTES = 16 << 20
#: Positions of an id in a batch of results.
FOUND = 1 << 16
#: Up to so many files are named to the scan when positions are looked up.
NAMED_FILES = 1000
_SHARD = ("part int, shard int, before long, n_ids long, docs binary, lengths binary, "
          "matrix binary")


def _shards(vocabulary, end_id, shard_ids):
    def write(batches):
        encoder = byte_encoder(vocabulary)
        planes = max(1, max(encoder.size() - 1, end_id).bit_length())
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        docs, ids, lengths, size = [], [], [], 0

        def closed():
            whole = np.concatenate(ids)
            return pa.RecordBatch.from_pydict(
                {"part": [part], "shard": [shard], "before": [before], "n_ids": [len(whole)],
                 "docs": [np.concatenate(docs).tobytes()],
                 "lengths": [np.concatenate(lengths).tobytes()],
                 "matrix": [WaveletMatrix.build(whole, planes).tobytes()]},
                pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()),
                           ("n_ids", pa.int64()), ("docs", pa.binary()),
                           ("lengths", pa.binary()), ("matrix", pa.binary())]))

        for batch in batches:
            doc = numbers(batch, "doc")
            data, offsets = byte_rows(column(batch, "text"))
            for low, high in groups(offsets):
                found, at = with_end(*encoder.encode(data[offsets[low]:offsets[high]],
                                                     offsets[low:high + 1] - offsets[low]),
                                     end_id)
                docs.append(doc[low:high].astype(np.int64))
                ids.append(found)
                lengths.append(np.diff(at))
                size += len(found)
                if size >= shard_ids:
                    yield closed()
                    shard, before = shard + 1, before + size
                    docs, ids, lengths, size = [], [], [], 0
        if docs:
            yield closed()
    return write


def write_store(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = 0,
                shard_ids: int = SHARD_IDS, file_bytes: int = FILE_BYTES) -> None:
    """Encode `docs` (doc_id, text) into a store at `folder`."""
    ship(docs)
    rows = docs.select(doc_key().alias("doc"), whole_text().alias("text"))
    # Never fewer than two: a single one would not be put in order of place.
    files = max(2, bucket_count(rows, file_bytes))
    ordered = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(files, "doc", "tie")
               .sortWithinPartitions("doc", "tie").select("doc", "text"))
    ordered.mapInArrow(_shards(vocabulary, end_id, shard_ids), _SHARD).write.parquet(folder)


def _read(batches):
    for batch in batches:
        for shard in batch.to_pylist():
            ids = WaveletMatrix.frombytes(shard["matrix"]).all().astype("<u4")
            docs = np.frombuffer(shard["docs"], np.int64)
            lengths = np.frombuffer(shard["lengths"], np.int64)
            starts = np.cumsum(lengths) - lengths
            raw = memoryview(ids.tobytes())
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([shard["part"]] * len(docs), pa.int32()),
                 "doc": docs, "before": starts + shard["before"], "n_tokens": lengths,
                 "ids_crc32": np.array([zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in
                                        zip(starts.tolist(), lengths.tolist())], np.int64)})


def _offsets(store: DataFrame) -> DataFrame:
    """Ids before each part: the totals of the parts, summed up a tree."""
    totals = store.groupBy(F.col("part").alias(SLICE)).agg(F.sum("n_ids").alias("n_ids"))
    return slice_offsets(totals, ["n_ids"]).select(F.col(SLICE).alias("part"),
                                                   F.col("n_ids").alias("offset"))


def _matrices(spark: SparkSession, folder: str) -> DataFrame:
    """Shards with the place of their first id in the store."""
    store = spark.read.parquet(folder)
    ship(store)
    return store.join(_offsets(store), "part").select(
        "part", "shard", "n_ids", (F.col("offset") + F.col("before")).alias("first"), "matrix")


def _access(batches):
    for batch in batches:
        for shard in batch.to_pylist():
            matrix, places = WaveletMatrix.frombytes(shard["matrix"]), shard["places"]
            yield pa.RecordBatch.from_pydict(
                {"position": pa.array(places, pa.int64()),
                 "token": pa.array([matrix.access(at - shard["first"]) for at in places],
                                   pa.int64())})


def tokens_at(spark: SparkSession, folder: str, positions: DataFrame) -> DataFrame:
    """`token` at each distinct `position` of the store; missing where the store has none."""
    asked = positions.select(F.col("position").cast("long").alias("position")).distinct()
    shards = _matrices(spark, folder)
    # Shards and positions meet by ranges of places, so that no two whole tables are compared.
    ranges = shards.select("part", "shard", "first", "n_ids", F.explode(F.sequence(
        F.expr(f"first div {SHARD_IDS}"), F.expr(f"(first + n_ids - 1) div {SHARD_IDS}")))
        .alias("range"))
    held = stage(asked.withColumn("range", F.expr(f"position div {SHARD_IDS}"))
                 .join(ranges, "range").filter("position >= first AND position < first + n_ids")
                 .groupBy("part", "shard").agg(F.collect_list("position").alias("places")),
                 "places")
    # Matrices are read from the files asked for only: a file holds one part.
    files = [r[0] for r in held.select("part").distinct().limit(NAMED_FILES + 1).collect()]
    if len(files) <= NAMED_FILES:
        shards = shards.filter(F.col("part").isin(files))
    found = (shards.join(held, ["part", "shard"]).select("first", "places", "matrix")
             .mapInArrow(_access, "position long, token long"))
    return asked.join(found, "position", "left")


def token_counts(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """How often each of `tokens` is in the store, as `n`, summed over the shards."""
    wanted = sorted(set(tokens))

    def count(batches):
        for batch in batches:
            for raw in column(batch, "matrix"):
                matrix = WaveletMatrix.frombytes(raw.as_py())
                yield pa.RecordBatch.from_pydict(
                    {"token": pa.array(wanted, pa.int64()),
                     "n": pa.array([matrix.count(t) for t in wanted], pa.int64())})

    store = spark.read.parquet(folder)
    ship(store)
    none = spark.createDataFrame([(t, 0) for t in wanted], "token long, n long")
    return (store.select("matrix").mapInArrow(count, "token long, n long").unionByName(none)
            .groupBy("token").agg(F.sum("n").alias("n")))


def token_positions(spark: SparkSession, folder: str, tokens: list[int]) -> DataFrame:
    """Every `position` in the store of each of `tokens`."""
    wanted = sorted(set(tokens))

    def occurrences(batches):
        for batch in batches:
            for shard in batch.to_pylist():
                matrix = WaveletMatrix.frombytes(shard["matrix"])
                for token in wanted:
                    places = shard["first"] + matrix.positions(token)
                    for low in range(0, len(places), FOUND):
                        found = places[low:low + FOUND]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(found), token)), pa.array(found)],
                            ["token", "position"])

    return (_matrices(spark, folder).select("first", "matrix")
            .mapInArrow(occurrences, "token long, position long"))


def stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files.

    Starts within a part are in the files.
    """
    store = spark.read.parquet(folder)
    offsets = _offsets(store)
    read = store.mapInArrow(_read, "part int, doc long, before long, n_tokens long, "
                                   "ids_crc32 long")
    return (read.join(offsets, "part")
            .select(own_id("doc").alias("doc_id"),
                    (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))


def store_folder(spark: SparkSession) -> str:
    """A new folder for a store among the staged tables."""
    return staged_path(spark, "tokens")
