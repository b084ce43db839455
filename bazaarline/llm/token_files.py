"""Token ids in binary shards with a minimal perfect hash index.

``write`` encodes texts in ascending key order and stores shards of bounded size. A shard
is one row of a Parquet container, which every Hadoop file system can hold: the raw id
payload (little-endian, 16 bits where the vocabulary allows it), the documents' offsets in
it, and an index. The index is a minimal perfect hash over the shard's keys (hash and
displace): slot -> first document of the key, with a stored fingerprint that rejects keys
the shard doesn't have. A directory of key ranges and id counts says which shard to ask.
``read`` gives the documents back through the index; ``lookup`` finds stated keys.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.staging import new_path
from .bpe import packed, ranked

#: Keys in a bucket of the displacement table, on average.
LOAD = 4
#: Seed of fingerprints; the displacement of a bucket is the seed of its slots.
MARK = 0xF1


def key_bytes(key: object) -> bytes:
    """A name of a key, equal for equal keys only (of one column): a null's is no text's
    UTF-8, both zeros are one, and so is every NaN."""
    if key is None:
        return b"\xff"
    if isinstance(key, float) and key == 0:
        key = 0.0
    return key.encode() if isinstance(key, str) else b"#" + str(key).encode()


class PerfectHash:
    """n keys to n slots: ``seeds`` by bucket (a negative one is a slot itself)."""

    def __init__(self, n: int, seeds: Sequence[int]):
        self.n, self.seeds = n, seeds

    def slot(self, key: bytes) -> int:
        seed = self.seeds[xxhash.xxh64_intdigest(key) % len(self.seeds)]
        return -seed - 1 if seed < 0 else xxhash.xxh64_intdigest(key, seed) % self.n

    @classmethod
    def build(cls, keys: list[bytes]) -> PerfectHash:
        """Buckets, largest first, try seeds until their keys fall on free slots; buckets
        of one key take the free slots that remain. Equal keys can't be told apart: an error."""
        n = len(keys)
        if len(set(keys)) < n:
            raise ValueError("a perfect hash needs distinct keys")
        buckets: list[list[bytes]] = [[] for _ in range(n // LOAD + 1)]
        for key in keys:
            buckets[xxhash.xxh64_intdigest(key) % len(buckets)].append(key)
        seeds, free = [0] * len(buckets), [True] * n
        order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
        for b in order:
            own = buckets[b]
            if len(own) < 2:
                break
            for seed in range(1, 1 << 31):
                slots = {xxhash.xxh64_intdigest(key, seed) % n for key in own}
                if len(slots) == len(own) and all(free[s] for s in slots):
                    break
            else:
                raise ValueError("no seed separates the keys of a bucket")
            seeds[b] = seed
            for s in slots:
                free[s] = False
        rest = iter([s for s in range(n) if free[s]])
        for b in order:
            if len(buckets[b]) == 1:
                seeds[b] = -next(rest) - 1
        return cls(n, seeds)


def fingerprint(key: bytes) -> int:
    return xxhash.xxh64_intdigest(key, MARK) & 0xFFFFFFFF


def index_of(keys: list[object]) -> dict[str, bytes]:
    """Displacements, fingerprints and document runs of a shard whose equal keys adjoin."""
    every = [key_bytes(k) for k in keys]
    firsts = [i for i, name in enumerate(every) if i == 0 or name != every[i - 1]]
    runs = [b - a for a, b in zip(firsts, [*firsts[1:], len(keys)])]
    names = [every[i] for i in firsts]
    hashed = PerfectHash.build(names)
    marks, first, count = (np.zeros(len(names), "<u4") for _ in range(3))
    for name, i, n in zip(names, firsts, runs):
        slot = hashed.slot(name)
        marks[slot], first[slot], count[slot] = fingerprint(name), i, n
    return {
        "seeds": np.array(hashed.seeds, "<i4").tobytes(),
        "marks": marks.tobytes(),
        "first": first.tobytes(),
        "count": count.tobytes(),
    }


class Shard:
    """One stored row, opened for keyed access."""

    def __init__(self, row: dict):
        self.payload, self.width = row["payload"], row["width"]
        self.offsets = np.frombuffer(row["offsets"], "<i8").tolist()
        seeds = np.frombuffer(row["seeds"], "<i4").tolist()
        self.marks = np.frombuffer(row["marks"], "<u4").tolist()
        self.first = np.frombuffer(row["first"], "<u4").tolist()
        self.count = np.frombuffer(row["count"], "<u4").tolist()
        self.hashed = PerfectHash(len(self.marks), seeds)

    def find(self, key: object) -> range:
        """Documents of a key, in constant time; empty if the shard lacks it."""
        name = key_bytes(key)
        slot = self.hashed.slot(name)
        if self.marks[slot] != fingerprint(name):
            return range(0)
        return range(self.first[slot], self.first[slot] + self.count[slot])

    def ids(self, at: int) -> bytes:
        """Ids of a document as little-endian unsigned 32-bit integers."""
        raw = self.payload[self.offsets[at] * self.width : self.offsets[at + 1] * self.width]
        return raw if self.width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def write(
    df: DataFrame,
    path: str,
    vocabulary: str,
    ranks: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    shard_ids: int = 1 << 18,
    shard_docs: int = 1 << 13,
) -> None:
    """Encode ``text`` (null: empty), end each document by ``end_id`` and write the shards.

    Order: ascending key, nulls first; rows of one key by their text's hash. A shard closes
    at ``shard_ids`` ids or ``shard_docs`` documents; a longer document is never cut. The texts are
    shuffled once, by key range and hash, so a key that repeats doesn't fill a task.
    """
    spark = df.sparkSession
    wide = spark.conf.get("spark.sql.shuffle.partitions")
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(int(wide), F.col("key"), tie).sortWithinPartitions("key", tie)
    fields = [
        T.StructField("part", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("keys", T.ArrayType(df.schema[key].dataType)),
        T.StructField("before", T.LongType()),
        T.StructField("n_ids", T.LongType()),
        T.StructField("width", T.IntegerType()),
        *(T.StructField(c, T.BinaryType()) for c in ("offsets", "seeds", "marks", "first", "count", "payload")),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end, part = ranked(vocabulary, ranks), packed([end_id]), TaskContext.get().partitionId()
        width = 2 if max(coder.strings) < 1 << 16 else 4
        keys, ids, sizes, held, before, shard, kind = [], [], [], 0, 0, 0, None

        def close() -> pa.RecordBatch:
            payload = np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes()
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8").tobytes()
            index = index_of(keys)
            values = (part, shard, keys, before, held, width, offsets, *index.values(), payload)
            types = [pa.int32(), pa.int32(), pa.list_(kind), pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 6
            columns = [pa.array([v], t) for v, t in zip(values, types)]
            return pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

        for batch in batches:
            kind = batch.column(0).type
            for k, value in zip(batch.column(0), batch.column(1)):
                made = coder.encode(value.as_py()) + end
                keys.append(k.as_py())
                ids.append(made)
                sizes.append(len(made) // 4)
                held += sizes[-1]
                if held >= shard_ids or len(keys) >= shard_docs:
                    yield close()
                    before, shard, held = before + held, shard + 1, 0
                    keys, ids, sizes = [], [], []
        if keys:
            yield close()

    out = ordered.mapInArrow(run, T.StructType(fields))
    # small row groups: a reader holds one at a time
    out.write.option("parquet.block.size", 16 << 20).parquet(path)


def directory(spark: SparkSession, path: str) -> DataFrame:
    """``part, start``: ids before each written partition. One row per write task, so the
    window over all of them stays small."""
    parts = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def documents_of(shards: DataFrame, key: str, wanted: frozenset | None = None) -> DataFrame:
    """Documents of shard rows: ``part, key, start (in the part), n_tokens, ids_crc32, ids``."""
    kind = shards.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField(key, kind),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            *([T.StructField("ids", T.BinaryType())] if wanted is not None else []),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                shard, out = Shard(row), [[] for _ in schema]
                for k in dict.fromkeys(row["keys"]) if wanted is None else wanted:
                    for doc in shard.find(k):
                        if wanted is not None and row["keys"][doc] != k:
                            continue  # another key of the same fingerprint
                        ids = shard.ids(doc)
                        values = (row["part"], k, row["before"] + shard.offsets[doc], len(ids) // 4, zlib.crc32(ids), ids)
                        for column, value in zip(out, values):
                            column.append(value)
                types = [pa.int32(), batch.schema.field("keys").type.value_type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], [f.name for f in schema])

    return shards.mapInArrow(run, schema)


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """All documents from the files: ``key, start, n_tokens, ids_crc32``."""
    made = documents_of(spark.read.parquet(path), key).join(directory(spark, path), "part")
    return made.select(key, (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, keys: Sequence, key: str = "doc_id", most: int = 10_000) -> DataFrame:
    """Documents of at most ``most`` stated keys with their ids; unknown keys give no row."""
    wanted = frozenset(keys)
    if len(wanted) > most:
        raise ValueError(f"more than {most} keys: join with read() instead")
    near = F.exists("keys", lambda k: k.isin(*wanted)) if wanted else F.lit(False)
    made = documents_of(spark.read.parquet(path).where(near), key, wanted).join(directory(spark, path), "part")
    return made.select(key, (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", "ids")


def round_trip(df: DataFrame, vocabulary: str, ranks: str, **options) -> DataFrame:
    """Write to a new path in the shared folder and read everything back."""
    path = new_path(df.sparkSession, "token-ids")
    write(df, path, vocabulary, ranks, **options)
    return read(df.sparkSession, path, options.get("key", "doc_id"))
