"""Token-id shards with a minimal perfect hash index (operator 4).

Layout of a store (one folder):

``shard-NNNNNN.bin``   raw little-endian ids (uint16 if the vocabulary allows,
                       else uint32) of the shard's documents, one after another
``shard-NNNNNN.off``   int64 little-endian: end offset in ids of each document
``index-NNNNN.mph``    one bucket of the key index
``manifest/``          Parquet, one row a document: key, shard, row, start, n

Documents stand in ascending key order over the shards in shard order. A key
(a long, or null) is hashed to a bucket; the bucket's minimal perfect hash
gives a slot, the slot holds a 32-bit fingerprint, shard, first row and number
of rows. A lookup reads one slot, so its cost doesn't depend on the size of
the store. A key that was never stored is told by its fingerprint (a false
match has odds 2**-32).

The perfect hash is built in levels: at each level the keys that land alone in
a bit array are placed, the others go on; a slot is the rank of the key's bit.

Defined results: a null text is empty; each document ends with ``end_id``;
rows with equal keys stay side by side, ordered by text, and the index entry
covers all of them; an empty table gives a store without shards; other columns
of the input are ignored.
"""

from __future__ import annotations

import functools
import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .files import make_folder, open_fs, read_file, write_file
from .gpt_split import pretoken_starts
from .segments import SegmentTable
from .textbytes import U64, blocks, code_points, mix

SHARD_BYTES = 32 << 20       # text a shard, about
KEYS_A_BUCKET = 1 << 16
NULL_KEY = U64(0xD1B54A32D192ED03)
GAMMA = 2.0                  # bits a key and level
MAX_LEVELS = 60


# ------------------------------------------------------------------ encoder

class ByteBpe:
    """Exact ids of a byte-level BPE tokenizer file, a block of texts at once.

    Pre-tokens are found with array operations and each distinct one is encoded
    by the tokenizers library. Texts that hold a special token's string, and
    tokenizers of another kind, are encoded whole by the library."""

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.plain = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                      and pre.get("use_regex", True) and spec.get("normalizer") is None
                      and spec["model"]["type"] == "BPE")
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.dtype = np.dtype("<u2" if self.lib.get_vocab_size() <= 1 << 16 else "<u4")
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in set(kept)]
        self._chars = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(moved)}
        self.table = SegmentTable(self._encode, [self.dtype])

    def _encode(self, segments: list[str]) -> list[list]:
        run, chars = self.lib.model.tokenize, self._chars
        return [[[t.id for t in run(s.encode().decode("latin-1").translate(chars))] for s in segments]]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.dtype)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block, and the number of each text."""
        raw = data.tobytes()
        if not self.plain:
            ids = [self.whole(raw[a:b].decode()) for a, b in zip(off[:-1], off[1:])]
            return np.concatenate([np.zeros(0, self.dtype), *ids]), np.array([len(x) for x in ids], np.int64)
        cps, coff = code_points(data, off)
        starts = pretoken_starts(cps, coff)
        slots = self.table.slots(cps, starts)  # may empty the table and replace its pools
        ids, lens = self.table.pools[0].gather(slots)
        total = np.concatenate([[0], np.cumsum(lens)])
        ends = total[np.searchsorted(starts, coff)]
        counts = np.diff(ends)
        if any(s in raw for s in self.special):
            parts, begin = [], ends[:-1]
            for i in range(len(counts)):
                text = raw[off[i]: off[i + 1]]
                parts.append(self.whole(text.decode()) if any(s in text for s in self.special)
                             else ids[begin[i]: begin[i] + counts[i]])
            ids, counts = np.concatenate(parts), np.array([len(x) for x in parts], np.int64)
        return ids, counts


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    return ByteBpe(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


# ------------------------------------------------------------ perfect hash

def key_hash(keys: pa.Array) -> np.ndarray:
    null = np.asarray(keys.is_null())
    h = mix(np.asarray(keys.fill_null(0)).astype(np.int64).view(U64) + U64(0x632BE59BD9B4E019))
    return np.where(null, NULL_KEY, h)


def _level(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h ^ U64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % U64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit hashes: slots 0 .. n-1."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        self.rank = np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(h):
            if len(sizes) == MAX_LEVELS:
                raise ValueError("keys of a perfect hash are not distinct")
            size = max(2, int(GAMMA * len(h)))
            at = _level(h, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            h = h[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, bool), *bits]))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each hash; -1 if no level holds it."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for i, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = self.base[i] + _level(h[left], i, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return out


def fingerprint(h: np.ndarray) -> np.ndarray:
    return (mix(h ^ U64(0xA0761D6478BD642F)) >> U64(32)).astype(np.uint32)


def pack_bucket(h: np.ndarray, shard: np.ndarray, row: np.ndarray, rows: np.ndarray) -> bytes:
    p = PerfectHash.build(h)
    put = np.argsort(p.slots(h))
    out = io.BytesIO()
    np.savez(out, sizes=p.sizes, bits=np.packbits(p.bits), n_bits=len(p.bits), mark=fingerprint(h)[put],
             shard=shard[put], row=row[put], rows=rows[put])
    return out.getvalue()


class Bucket:
    """A bucket of the index as read from its file."""

    def __init__(self, payload: bytes) -> None:
        z = np.load(io.BytesIO(payload))
        self.hash = PerfectHash(z["sizes"], np.unpackbits(z["bits"], count=int(z["n_bits"])).astype(bool))
        self.mark, self.shard, self.row, self.rows = z["mark"], z["shard"], z["row"], z["rows"]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(found, shard, row, rows) of each key hash."""
        s = self.hash.slots(h)
        ok = s >= 0
        ok[ok] = self.mark[s[ok]] == fingerprint(h[ok])
        s = np.where(ok, s, 0)
        return ok, self.shard[s], self.row[s], self.rows[s]


# -------------------------------------------------------------------- store

MANIFEST = "key long, shard int, row long, start long, n long"


def write_store(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
                end_id: int = 0, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``docs`` and write the store's shards, manifest and index."""
    make_folder(path)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    total = docs.select(F.sum(F.octet_length(F.col(text))).alias("b")).first()["b"] or 0
    n = max(1, -(-total // shard_bytes))
    ordered = (rows.repartitionByRange(n, F.col("key").asc_nulls_first())
               .sortWithinPartitions(F.col("key").asc_nulls_first(), F.col("text").asc_nulls_first()))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        payload, ends, row, at = [], [], 0, 0
        for batch in batches:
            col = batch.column("text")
            for lo, hi, data, off in blocks(col):
                ids, counts = with_end(*enc.encode(data, off), end_id)
                payload.append(ids.astype(enc.dtype).tobytes())
                end = at + np.cumsum(counts)
                ends.append(end)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(lo, hi - lo), pa.array(np.full(hi - lo, no, np.int32)),
                     pa.array(np.arange(row, row + hi - lo)), pa.array(end - counts), pa.array(counts)],
                    names=["key", "shard", "row", "start", "n"])
                row, at = row + hi - lo, int(end[-1])
        if ends:
            write_file(path, f"shard-{no:06d}.bin", b"".join(payload))
            write_file(path, f"shard-{no:06d}.off", np.concatenate(ends).astype("<i8").tobytes())

    ordered.mapInArrow(shard, MANIFEST).write.parquet(f"{path}/manifest")
    spark = docs.sparkSession
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    keys = manifest.groupBy("key").agg(F.min(F.struct("shard", "row")).alias("at"), F.count("*").alias("rows"))
    n_buckets = max(1, -(-manifest.count() // KEYS_A_BUCKET))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if t is None or t.num_rows == 0:
            return
        t = t.combine_chunks()
        bucket = t.column("bucket").to_numpy()
        h = key_hash(t.column("key").combine_chunks())
        shard_no, row_no, many = (t.column(c).to_numpy() for c in ("shard", "row", "rows"))
        for b in np.unique(bucket):
            m = bucket == b
            write_file(path, f"index-{b:05d}.mph", pack_bucket(h[m], shard_no[m], row_no[m], many[m]))
            yield pa.RecordBatch.from_arrays([pa.array([int(b)]), pa.array([int(m.sum())])], names=["bucket", "n"])

    (keys.select("key", bucket_of("key", n_buckets).alias("bucket"), "at.shard", "at.row", "rows")
     .repartition(n_buckets, "bucket").mapInArrow(index, "bucket long, n long")
     .write.parquet(f"{path}/buckets"))


def bucket_of(key: str, n_buckets: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n_buckets))


def lookup(keys: DataFrame, path: str, key: str = "key") -> DataFrame:
    """(key, shard, row, rows) of the keys that the store holds; one row a
    distinct key, found through the perfect hash."""
    spark = keys.sparkSession
    n_buckets = max(1, -(-spark.read.schema(MANIFEST).parquet(f"{path}/manifest").count() // KEYS_A_BUCKET))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, Bucket | None] = (-1, None)
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            for b in np.unique(bucket).tolist():
                if held[0] != b:
                    try:
                        held = (b, Bucket(read_file(path, f"index-{b:05d}.mph")))
                    except FileNotFoundError:  # no stored key has this bucket
                        held = (b, None)
                if held[1] is None:
                    continue
                part = batch.filter(pa.array(bucket == b)).column("key")
                ok, shard, row, rows = held[1].find(key_hash(part))
                yield pa.RecordBatch.from_arrays([part, pa.array(shard), pa.array(row), pa.array(rows)],
                                                 names=["key", "shard", "row", "rows"]).filter(pa.array(ok))

    asked = keys.select(F.col(key).cast("long").alias("key")).distinct()
    return (asked.withColumn("bucket", bucket_of("key", n_buckets)).repartition(n_buckets, "bucket")
            .sortWithinPartitions("bucket").mapInArrow(find, "key long, shard int, row long, rows long"))


def read_documents(found: DataFrame, path: str, dtype: str, with_ids: bool = False) -> DataFrame:
    """Read the looked-up documents' ids from the shards: key, shard, start (in
    the shard), n_tokens, ids_crc32 (of the ids as little-endian uint32), and
    the ids themselves on request. One row a stored row of the key."""
    n_shards = found.sparkSession.read.schema(MANIFEST).parquet(f"{path}/manifest").select("shard").distinct().count()
    schema = "key long, shard int, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    width = np.dtype(dtype).itemsize

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(path)
        held, ends, payload = -1, None, None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            for s in np.unique(shard).tolist():
                if s != held:
                    ends = np.frombuffer(read_file(path, f"shard-{s:06d}.off"), "<i8")
                    held, payload = s, fs.open_input_file(f"{root}/shard-{s:06d}.bin")
                part = batch.filter(pa.array(shard == s))
                rows = part.column("rows").to_numpy()
                pick = np.repeat(np.arange(part.num_rows), rows)
                inner = np.arange(len(pick)) - np.repeat(np.cumsum(rows) - rows, rows)
                row = part.column("row").to_numpy()[pick] + inner
                start = np.where(row > 0, ends[row - 1], 0)
                crc, ids = [], []
                for a, b in zip(start.tolist(), ends[row].tolist()):
                    x = np.frombuffer(payload.read_at((b - a) * width, a * width), dtype)
                    crc.append(zlib.crc32(x.astype("<u4").tobytes()))
                    if with_ids:
                        ids.append(x.astype(np.int64))
                cols = [part.column("key").take(pa.array(pick)), pa.array(np.full(len(pick), s, np.int32)),
                        pa.array(start.astype(np.int64)), pa.array(ends[row] - start), pa.array(np.array(crc, np.int64))]
                names = ["key", "shard", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return (found.repartition(max(1, n_shards), "shard").sortWithinPartitions("shard", "row").mapInArrow(read, schema))


def shard_bases(spark: SparkSession, path: str) -> DataFrame:
    """(shard, base): ids in all shards before; one row a shard."""
    per = (spark.read.schema(MANIFEST).parquet(f"{path}/manifest").groupBy("shard").agg(F.sum("n").alias("n")))
    return per.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("base"))


def store_digest(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the store, then read every document of ``docs`` back by key."""
    spark = docs.sparkSession
    write_store(docs, path, tokenizer, end_id=end_id)
    dtype = encoder(tokenizer).dtype.str
    found = lookup(docs.select(F.col("doc_id").alias("key")), path)
    got = read_documents(found, path, dtype)
    return (got.join(shard_bases(spark, path), "shard")
            .select(F.col("key").alias("doc_id"), (F.col("base") + F.col("start")).alias("start"),
                    "n_tokens", "ids_crc32"))
