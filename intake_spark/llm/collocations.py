"""Phrase collocation mining by prefix-free parsing (operator 12).

Texts are lower-cased (A-Z) and cut into pieces at marks and line ends, pieces
into words. A piece's words are parsed into chunks: a pair of neighbouring
words whose hash is a multiple of ``TRIGGER`` ends a chunk and begins the next,
so neighbouring chunks overlap by that pair, and equal passages fall into equal
chunks wherever they stand. The distinct chunks of a language with their parse
frequencies are the dictionary. Words and three-word windows are counted inside
distinct chunks only, weighted by frequency. A window belongs to the chunk that
holds all of it, and what starts in the pair that two chunks share to the later
one, so each occurrence is counted once. The last words of a piece have windows
with empty places; so counts of pairs are sums of windows with the same first
two words, and one shuffle of windows, dealt by their first two words, gives
pairs and triples.

A word's number is a 64-bit hash of language and word. Distinct words are
counted by their text; if two of a corpus have one number, all numbers are made
anew from another seed. So counts are exact but for words of one block that
agree in 128 bits.

Scores: cutting a phrase after its first k words gives
``floor(1000000 * a * a / (l * r))``; the lowest counts (ties: the smallest k).
Products are decimals of 38 digits, quotients are exact integers. A pair is
dropped if a triple that holds it occurs at least ``SHARE`` percent as often.

Defined results: null or empty texts have no words; a null language is
``und``; repeated rows count each; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .files import stored
from .textbytes import BYTE_CODE, LOWER, MIX_A, U64, Prefix, blocks, mix, ragged

LONGEST = 3             # words of a phrase; chunks overlap by one word less
TRIGGER = 12            # one pair of words in so many ends a chunk
MIN_COUNT = 10
SHARE = 50              # percent
TOP = 2000
UND = "und"
HELD_WINDOWS = 1 << 21  # that a task combines before it hands them on
HELD_WORDS = 1 << 19
SALTS = 16              # of a language's candidates, before the last ranking
SEEDS = 4               # for word numbers

_BYTE = np.arange(256)
IS_MARK = np.isin(_BYTE, [ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E)))
IS_BLANK = (_BYTE == 0x20) | (_BYTE == 0x09)


# --------------------------------------------------------------------- parsing

def _words(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of a block's words, and whether a word begins a piece."""
    gap = IS_MARK[low] | IS_BLANK[low]
    n = len(low)
    first = np.zeros(n + 1, bool)
    first[off] = True
    before = np.ones(n, bool)
    before[1:] = gap[:-1]
    a = np.flatnonzero(~gap & (before | first[:n]))
    after = np.ones(n, bool)
    after[:-1] = gap[1:]
    b = np.flatnonzero(~gap & (after | first[1:])) + 1
    marks = np.concatenate([[0], np.cumsum(IS_MARK[low])])
    piece = np.ones(len(a), bool)
    if len(a):
        text = np.searchsorted(off, a, "right")
        piece[1:] = (marks[a[1:]] > marks[b[:-1]]) | (text[1:] != text[:-1])
    return a, b, piece


def _chunks(low: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with one space after each word, chunks' starts, ends, their
    texts, whether a chunk is its piece's last)."""
    a, b, piece = _words(low, off)
    n = len(a)
    if n == 0:
        zero = np.zeros(0, np.int64)
        return np.zeros(0, np.uint8), zero, zero, zero, np.zeros(0, bool)
    h = mix(Prefix(BYTE_CODE[low]).span(a, b) + (b - a).astype(U64))
    pair = np.zeros(n, bool)  # a pair of one piece begins here
    pair[:-1] = ~piece[1:]
    trigger = pair.copy()
    trigger[:-1] &= mix(h[:-1] * MIX_A + h[1:]) % U64(TRIGGER) == 0
    start = np.flatnonzero(piece | trigger)
    follow = np.append(start[1:], n)
    last = np.append(piece[start[1:]], True)
    stop = np.where(last, follow, follow + LONGEST - 1)  # of words: the next chunk's pair comes along
    size = b - a + 1
    joined = np.append(low, np.uint8(32))[ragged(a, size)]
    joined[np.cumsum(size) - 1] = 32
    at = np.concatenate([[0], np.cumsum(size)])
    text = np.searchsorted(off, a[start], "right") - 1
    return joined, at[start], at[stop] - 1, text, last


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, chunk, last, n): the distinct chunks, words joined by spaces, and
    how often the parse has them."""
    rows = docs.where(F.col(f"`{text}`").isNotNull()).select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UND)).alias("lang"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in blocks(batch.column("text")):
                joined, a, b, of, last = _chunks(LOWER[data], off)
                size = b - a
                ends = np.concatenate([[0], np.cumsum(size)])
                chunks = pa.LargeStringArray.from_buffers(
                    len(a), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(joined[ragged(a, size)])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(lo, hi - lo).take(pa.array(of)), chunks, pa.array(last)],
                                                 names=["lang", "chunk", "last"])

    return (rows.mapInArrow(run, "lang string, chunk string, last boolean")
            .groupBy("lang", "chunk", "last").agg(F.count("*").alias("n")))


# -------------------------------------------------------------------- counting

def _seed_of(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{lang}".encode(), digest_size=8).digest(), "little")


def _numbered(batch: pa.RecordBatch, seed: int):
    """For blocks of a dictionary batch: (bytes, word starts, word ends, word
    numbers (never 0), second hashes, chunk of each word, first row)."""
    langs = batch.column("lang").dictionary_encode()
    names = langs.dictionary.to_pylist()
    of_lang = np.array([_seed_of(x, seed) for x in names], U64)
    code = langs.indices.to_numpy()
    for lo, hi, data, off in blocks(batch.column("chunk")):
        space = data == 32
        start = np.zeros(len(data), bool)
        start[off[:-1]] = True  # chunks are never empty
        start[1:] |= space[:-1]
        a = np.flatnonzero(start)
        chunk = np.searchsorted(off, a, "right") - 1
        b = np.append(a[1:] - 1, len(data))
        b[np.append(chunk[1:] != chunk[:-1], True)] = off[chunk[np.append(chunk[1:] != chunk[:-1], True)] + 1]
        size = (b - a).astype(U64)
        codes = BYTE_CODE[data]
        own = of_lang[code[lo:hi]][chunk]
        h = mix(mix(Prefix(mix(codes + U64(seed))).span(a, b) + size) ^ own)
        check = mix(Prefix(mix(codes ^ MIX_A)).span(a, b) ^ size)
        yield lo, data, a, b, np.where(h == 0, U64(1), h), check, chunk


def _counted_once(chunk: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a word's occurrence belongs to its chunk: the last words of a
    chunk that isn't its piece's last are the next chunk's first."""
    left = np.searchsorted(chunk, chunk, "right") - np.arange(len(chunk))
    return last[chunk] | (left > LONGEST - 1)


def _combined_by(keys: list[np.ndarray], values: list[np.ndarray], n: np.ndarray,
                 order: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Neighbours of equal keys, in an order: the first one's values, and the sum."""
    keys, n = [k[order] for k in keys], n[order]
    new = np.ones(len(n), bool)
    new[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [v[order[at]] for v in values], np.add.reduceat(n, at) if len(at) else n


def count_words(chunks: DataFrame, seed: int = 0) -> DataFrame:
    """(lang, number, word, n) of every word. Words are combined by two hashes
    in the task, and by their text in the shuffle; their numbers are put beside
    the distinct words afterwards."""
    def flush(held: list[list]) -> pa.RecordBatch:
        langs = pa.chunked_array([x[0] for x in held]).combine_chunks()
        words = pa.chunked_array([x[1] for x in held]).combine_chunks()
        h, check, n = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4))
        order = np.lexsort((check, h))
        (place,), total = _combined_by([h, check], [np.arange(len(h))], n, order)
        return pa.RecordBatch.from_arrays([langs.take(pa.array(place)), words.take(pa.array(place)), pa.array(total)],
                                          names=["lang", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            last, times = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("last", "n"))
            for lo, data, a, b, h, check, chunk in _numbered(batch, seed):
                at = np.flatnonzero(_counted_once(chunk, last[lo: lo + chunk[-1] + 1]))
                order = np.lexsort((check[at], h[at]))
                (place,), n = _combined_by([h[at], check[at]], [at], times[lo:][chunk[at]], order)
                size = b[place] - a[place]
                words = pa.LargeStringArray.from_buffers(
                    len(place), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)),
                    pa.py_buffer(np.ascontiguousarray(data[ragged(a[place], size)]))).cast(pa.string())
                held.append([batch.column("lang").slice(lo).take(pa.array(chunk[place])), words, h[place], check[place], n])
                rows += len(place)
                if rows >= HELD_WORDS:
                    yield flush(held)
                    held, rows = [], 0
        if held:
            yield flush(held)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chunks = batch.rename_columns(["lang", "chunk", "n"])
                h = np.concatenate([x[4] for x in _numbered(chunks, seed)])
                yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(h.view(np.int64)), batch.column("word"), batch.column("n")],
                                                 names=["lang", "number", "word", "n"])

    return (chunks.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
            .mapInArrow(number, "lang string, number long, word string, n long"))


def count_windows(chunks: DataFrame, seed: int = 0) -> DataFrame:
    """(w1, w2, w3, n): windows of three word numbers, w3 = 0 after a piece's
    end; a piece's last word has none. Dealt by the first two words, so sums of them need no other shuffle."""
    def flush(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        w1, w2, w3, n = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(mix(w1 * MIX_A + w2) * MIX_A + w3)
        cols, n = _combined_by([w1, w2, w3], [w1, w2, w3], n, order)
        return pa.RecordBatch.from_arrays([*(pa.array(c.view(np.int64)) for c in cols), pa.array(n)], names=["w1", "w2", "w3", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            last, times = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("last", "n"))
            for lo, _, _, _, h, _, chunk in _numbered(batch, seed):
                own = _counted_once(chunk, last[lo: lo + chunk[-1] + 1])
                after = []
                for k in (1, 2):
                    same = np.zeros(len(h), bool)
                    same[:-k] = chunk[k:] == chunk[:-k]
                    after.append(np.where(same, np.append(h[k:], np.zeros(k, U64)), U64(0)))
                own &= after[0] != 0  # single words are counted already
                held.append([h[own], after[0][own], after[1][own], times[lo:][chunk[own]]])
                rows += int(own.sum())
                if rows >= HELD_WINDOWS:
                    yield flush(held)
                    held, rows = [], 0
        if held:
            yield flush(held)

    return (chunks.select("lang", "chunk", "last", "n").mapInArrow(run, "w1 long, w2 long, w3 long, n long")
            .repartition("w1", "w2").groupBy("w1", "w2", "w3").agg(F.sum("n").alias("n")))


def count_phrases(windows: DataFrame, min_count: int) -> DataFrame:
    """(w1, w2, w3, a): pairs (w3 = 0) and triples that occur ``min_count``
    times or more. Both read the same shuffle."""
    triples = windows.withColumn("a", F.when(F.col("w3") != 0, F.col("n")).otherwise(F.lit(0)))
    pairs = windows.groupBy("w1", "w2").agg(F.sum("n").alias("a"))
    return (triples.where(F.col("a") >= min_count).select("w1", "w2", "w3", "a")
            .union(pairs.where(F.col("a") >= min_count).select("w1", "w2", F.lit(0).cast("long"), "a")))


# --------------------------------------------------------------------- scoring

def _score(left: Column, right: Column) -> Column:
    def wide(c):
        return c.cast("decimal(15,0)")
    top = (wide(F.col("a")) * wide(F.col("a"))).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, wide(left) * wide(right))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """All phrases that stay (lang, w1, w2, w3, a, l, r, n, score), and the
    words (lang, number, word, n) that their numbers stand for."""
    spark = docs.sparkSession
    chunks = stored(spark, dictionary(docs, text, lang), "chunks")
    for seed in range(SEEDS):
        words = stored(spark, count_words(chunks, seed), "words")
        if words.groupBy("number").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("no seed gives different words different numbers")
    counted = stored(spark, count_phrases(count_windows(chunks, seed), min_count), "phrases")
    pairs, triples = counted.where("w3 = 0").drop("w3"), counted.where("w3 != 0")

    def word(name: str, n: str) -> DataFrame:
        return words.where(F.col("n") >= min_count).select(F.col("number").alias(name), F.col("n").alias(n))

    def pair(x: str, y: str, n: str) -> DataFrame:
        return pairs.select(F.col("w1").alias(x), F.col("w2").alias(y), F.col("a").alias(n))

    inside = (triples.select("w1", "w2", "a").union(triples.select("w2", "w3", "a"))
              .groupBy("w1", "w2").agg(F.max("a").alias("longer")))
    twos = (pairs.join(inside, ["w1", "w2"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")
            .join(word("w1", "l"), "w1").join(word("w2", "r"), "w2")
            .select("w1", "w2", F.lit(0).cast("long").alias("w3"), "a", "l", "r", _score(F.col("l"), F.col("r")).alias("score")))
    cuts = (triples.join(pair("w1", "w2", "l2"), ["w1", "w2"]).join(pair("w2", "w3", "r1"), ["w2", "w3"])
            .join(word("w1", "l1"), "w1").join(word("w3", "r2"), "w3")
            .withColumn("s1", _score(F.col("l1"), F.col("r1"))).withColumn("s2", _score(F.col("l2"), F.col("r2"))))
    early = F.col("s1") <= F.col("s2")
    threes = cuts.select("w1", "w2", "w3", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    # a language's words in all: one row a language, in map tasks first
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    lang_of = words.where(F.col("n") >= min_count).select(F.col("number").alias("w1"), "lang")
    found = twos.union(threes).join(lang_of, "w1").join(totals, "lang")
    return (found.select("lang", "w1", "w2", "w3", "a", "l", "r", "n", "score"),
            words.where(F.col("n") >= min_count).select("number", "word"))


def best(found: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase."""
    order = [F.desc("score"), F.desc("a")]
    # those that can't be among the first are left out in parts, ties kept; only the others get their text
    salted = found.withColumn("salt", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        salted = salted.withColumn("at", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("at") <= top)
    named = stored(found.sparkSession, salted.drop("salt", "at"), "first")
    for k in (1, 2, 3):
        text = words.select(F.col("number").alias(f"w{k}"), F.col("word").alias(f"t{k}"))
        named = named.join(text, f"w{k}", "left" if k == 3 else "inner")
    phrase = F.concat_ws(" ", "t1", "t2", "t3").alias("phrase")
    ranked = named.select("lang", phrase, "a", "l", "r", "n", "score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.asc("phrase"))).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, share: int = SHARE,
         top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
    found, words = collocations(docs, text, lang, min_count, share)
    return best(found, words, top)
