"""Near-duplicate embeddings by random-hyperplane hashing (operator 5).

Equal vectors are one class. Each class gets, in each of several tables, a
bucket: the signs of its products with random hyperplanes. Classes that share
a bucket are compared by exact cosine in double precision. A pair is counted in
the first table where it meets, so no list of pairs is made or shuffled: a
bucket gives each member's number of links, and a spanning forest of its links
as edges for the connected components.

The number of hyperplanes follows the number of classes (about one class a
bucket), the number of tables then makes a pair at the threshold missed with
odds of ``MISS`` at most, a closer pair far less often. A bucket of more than
``BLOCK`` classes is cut into blocks, and pairs of blocks are compared by
different tasks.

Signs are exact integers' (vectors and hyperplanes are rounded to integers
first), so a vector has the same bucket in any batch.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing; vectors of different lengths never
link; repeated rows are vectors of their own, linked with each other; a null
id is no smaller than others and its own component if it has no links; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .files import stored
from .textbytes import ragged

THRESHOLD = 0.95
MISS = 1e-6
MIN_BITS = 12
BLOCK = 4096
DENSE = 256      # larger groups are compared by matrix products
PORTION = 8192   # rows that a task compares at a time, if groups allow
SEED = 5


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    """Integer hyperplanes: dim x (tables * bits). The first tables are the
    same for any number of tables."""
    rng = np.random.default_rng([SEED, dim])
    return np.rint(rng.normal(0, 200, (tables * bits, dim))).T


def shape(classes: int, threshold: float) -> tuple[int, int]:
    """(bits, tables) for so many classes."""
    bits = max(MIN_BITS, math.ceil(math.log2(max(2, classes))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-meet))


def buckets(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Bucket of each row of ``x`` in each table."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit = np.rint(unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True)) * (1 << 20))
    h = planes(x.shape[1], bits, tables)
    weights = 1 << np.arange(bits, dtype=np.int64)
    out = np.empty((len(x), tables), np.int64)
    for a in range(0, len(x), 1024):
        signs = (unit[a: a + 1024] @ h >= 0).reshape(-1, tables, bits)
        out[a: a + 1024] = signs @ weights
    return out


def vector_classes(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): every row with its vector's bytes (null if it can't
    link), and the distinct vectors with cid, least id, and number of rows."""
    spark = vectors.sparkSession
    v = F.col(column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fit = F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("v")
            out = [None if not rows[i].is_valid else (rows[i].values.to_numpy(zero_copy_only=False) + 0.0).tobytes()
                   for i in range(len(rows))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "v"])

    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("id"), F.when(fit, F.col(column)).alias("v"))
    rows = stored(spark, rows.mapInArrow(pack, f"id {kind}, v binary"), "vectors")
    classes = (rows.where(F.col("v").isNotNull()).groupBy("v").agg(F.min("id").alias("least"), F.count("*").alias("m"))
               .withColumn("cid", F.monotonically_increasing_id()))
    return rows, stored(spark, classes, "classes")


def _cosines(x: np.ndarray, norm: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    ok = np.zeros(len(a), bool)
    for c in range(0, len(a), 1 << 16):
        p, q = a[c: c + (1 << 16)], b[c: c + (1 << 16)]
        ok[c: c + (1 << 16)] = (x[p] * x[q]).sum(axis=1) / (norm[p] * norm[q]) >= threshold
    return ok


def _links(x: np.ndarray, norm: np.ndarray, group_end: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within groups with cosine >= threshold. ``group_end`` holds
    the end of each row's group."""
    here = np.arange(len(x))
    size = group_end - here
    first = np.append(True, group_end[1:] != group_end[:-1])
    large = np.repeat(size[first] > DENSE, np.diff(np.append(np.flatnonzero(first), len(x))))
    out = []
    small = here[~large]
    n = size[small] - 1
    ends = np.cumsum(n)
    lo = 0
    while lo < len(small):  # all pairs of small groups, in portions
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20), "right")))
        a = np.repeat(small[lo:hi], n[lo:hi])
        b = ragged(small[lo:hi] + 1, n[lo:hi])
        ok = _cosines(x, norm, a, b, threshold)
        out.append((a[ok], b[ok]))
        lo = hi
    for begin in here[first & large].tolist():
        end = int(group_end[begin])
        unit = x[begin:end] / norm[begin:end, None]
        for s in range(0, end - begin, 1024):
            i, j = np.nonzero(unit[s: s + 1024] @ unit.T >= threshold - 1e-9)
            a, b = begin + s + i, begin + j
            a, b = a[a < b], b[a < b]
            ok = _cosines(x, norm, a, b, threshold)
            out.append((a[ok], b[ok]))
    cat = lambda k: np.concatenate([np.zeros(0, np.int64), *(o[k] for o in out)])
    return cat(0), cat(1)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Indices of edges that form a spanning forest."""
    parent = list(range(n))
    out = []
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if i != j:
            parent[max(i, j)] = min(i, j)
            out.append(k)
    return np.array(out, np.int64)


def _matrix(raw: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, shorter ones filled up with zeros, and their lengths."""
    size = np.array([len(r) for r in raw], np.int64)
    top = int(size.max())
    if (size < top).any():
        raw = [r.ljust(top, b"\0") for r in raw]
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64), size


def _met_before(x: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, tab: np.ndarray, width: int,
                bits: int, tables: int) -> np.ndarray:
    """Whether each pair shares a bucket in a table before its own."""
    used, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    keys = np.empty((len(used), tables), np.int64)
    for s in np.unique(size[used]):
        pick = size[used] == s
        keys[pick] = buckets(x[used[pick]][:, : s // width], bits, tables)
    left, right, out = where[: len(a)], where[len(a):], np.zeros(len(a), bool)
    earlier = np.arange(tables)[None, :]
    for c in range(0, len(a), 1 << 14):
        sl = slice(c, c + (1 << 14))
        out[sl] = ((keys[left[sl]] == keys[right[sl]]) & (earlier < tab[sl, None])).any(axis=1)
    return out


def compare(groups: DataFrame, dtype: str, bits: int, tables: int, threshold: float) -> DataFrame:
    """(a, b, n): links of class a met first in a group (b null), and forest
    edges a-b. ``groups``: rows sorted by (tab, bucket, i, j) in each task."""
    def some(g: pa.Table) -> pa.RecordBatch:
        cid, m, salt, tab, i, j, bucket = (g.column(c).to_numpy() for c in ("cid", "m", "salt", "tab", "i", "j", "bucket"))
        x, size = _matrix(g.column("v").to_pylist(), dtype)
        norm = np.sqrt((x * x).sum(axis=1))
        cut = np.flatnonzero((tab[1:] != tab[:-1]) | (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
        ends = np.append(cut, len(cid))
        a, b = _links(x, norm, np.repeat(ends, np.diff(np.append(0, ends))), threshold)
        # a block is compared with itself only where it is paired with itself
        keep = (size[a] == size[b]) & ((i[a] == j[a]) | (salt[a] != salt[b]))
        a, b = a[keep], b[keep]
        if len(a):
            fresh = ~_met_before(x, size, a, b, tab[a], np.dtype(dtype).itemsize, bits, tables)
            a, b = a[fresh], b[fresh]
        ids, at = np.unique(cid, return_inverse=True)
        n = (np.bincount(at[a], m[b], len(ids)) + np.bincount(at[b], m[a], len(ids))).astype(np.int64)
        got, f = np.flatnonzero(n), _forest(at[a], at[b], len(ids))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[got], cid[a[f]]])),
             pa.array(np.concatenate([np.zeros(len(got), np.int64), cid[b[f]]]),
                      mask=np.concatenate([np.ones(len(got), bool), np.zeros(len(f), bool)])),
             pa.array(np.concatenate([n[got], np.zeros(len(f), np.int64)]))], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last, rows = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("tab", "bucket", "i", "j")], 1)
            cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            if last is not None and (key[0] != last).any():
                cut = np.append(0, cut)
            last = key[-1]
            if rows + batch.num_rows > PORTION and len(cut):  # whole groups
                k = int(cut[-1])
                ready = pa.Table.from_batches([*held, batch.slice(0, k)]).combine_chunks()
                if ready.num_rows:
                    yield some(ready)
                held, rows = [batch.slice(k)], batch.num_rows - k
            else:
                held.append(batch)
                rows += batch.num_rows
        if rows:
            yield some(pa.Table.from_batches(held).combine_chunks())

    return groups.mapInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """(``key``, n_links, component_id, kept), one row a row of ``vectors``."""
    spark = vectors.sparkSession
    dtype = "<f4" if vectors.schema[column].dataType.elementType.simpleString() == "float" else "<f8"
    rows, classes = vector_classes(vectors.select(key, column), key, column)
    bits, tables = shape(classes.count(), threshold)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, cid = batch.column("v").to_pylist(), batch.column("cid").to_numpy()
            size = np.array([len(r) for r in raw])
            for s in np.unique(size):
                pick = np.flatnonzero(size == s)
                x = np.frombuffer(b"".join(raw[p] for p in pick), dtype).reshape(len(pick), -1).astype(np.float64)
                b = buckets(x, bits, tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(tables, dtype=np.int32), len(pick))), pa.array(b.reshape(-1)),
                     pa.array(np.repeat(cid[pick], tables))], names=["tab", "bucket", "cid"])

    placed = stored(spark, classes.select("v", "cid").mapInArrow(place, "tab int, bucket long, cid long"), "placed")
    sizes = placed.groupBy("tab", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    salted = (placed.join(sizes, ["tab", "bucket"]).withColumn("parts", parts)
              .withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("tab", "bucket", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"),
                      "salt", "cid"))
    groups = (salted.join(classes.select("cid", "m", "v"), "cid").repartition("tab", "bucket", "i", "j")
              .sortWithinPartitions("tab", "bucket", "i", "j"))
    met = stored(spark, compare(groups, dtype, bits, tables, threshold), "met")
    links = met.where(F.col("b").isNull()).groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    comps = connected_components(met.where(F.col("b").isNotNull()).select("a", "b"))
    least = (comps.join(classes.select(F.col("cid").alias("id"), "least"), "id")
             .groupBy("component").agg(F.min("least").alias("component_id")))
    per_class = (classes.join(links, "cid", "left")
                 .join(comps.join(least, "component").select(F.col("id").alias("cid"), "component_id"), "cid", "left")
                 .select("v", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                         F.coalesce("component_id", "least").alias("component_id")))
    out = rows.join(per_class, "v", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
