"""Removes repeated runs of sentences (operator 1).

From each sentence of a text, forwards and backwards, the shortest run of at
least ``MIN_SENTENCES`` sentences with ``MIN_WORDS`` words or more is hashed.
Runs of equal content are joined over all documents; sentences that any run
covers which isn't the first of its content (smallest document, then position)
are removed.

A sentence ends after ``. ! ?`` followed by white space, after the wide forms
of these marks, and at a line end; it takes the white space that follows.
Content is the sequence of lower-cased words with the sentence ends, so
punctuation and spacing don't matter. Pieces without words belong to the
sentence before (or the first one).

With ``long_words`` (``digest`` and ``clean`` give ``LONG_WORDS``) a sentence of
at least so many words is also a run of its own, and one of more is cut before
the least word (by its first eight bytes in lower case; the last of equal ones)
of each ``CUT_WINDOW`` words in a row: the pieces count as sentences. The places
depend on the words around them alone, so a passage inside text without sentence
marks is cut alike wherever it stands, but for its first and last
``CUT_WINDOW - 1`` words; any 51 words in a row of one sentence hold a run.

Defined results: a null text stays null, an empty one empty; a text of fewer
sentences or words than a run has none; a text may become empty, its row stays;
rows with equal ids are documents of their own, in order of their text; null
ids come first; an empty table gives no rows; all other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import stored
from .held import begin
from .rows import ROW, numbered
from .spans import by_content, first_in_block, merge_ranges, ranges_by_row
from .textbytes import IS_WORD, LOWER, MIX_A, SMALL_BLOCK, U64, Prefix, blocks, mix, words

MIN_SENTENCES = 2
MIN_WORDS = 12
LONG_WORDS = 25
CUT_WINDOW = 8

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
# UTF-8 of the wide full stop, exclamation and question mark.
WIDE_ENDS = (b"\xe3\x80\x82", b"\xef\xbc\x81", b"\xef\xbc\x9f")


def _heads(data: np.ndarray, off: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """The first eight bytes of words in lower case, in the order of bytes."""
    end = off[np.searchsorted(off, word_at, "right")]
    inside, out = np.ones(len(word_at), bool), np.zeros(len(word_at), U64)
    for k in range(8):
        low = LOWER[data[np.minimum(word_at + k, len(data) - 1)]]
        inside &= (word_at + k < end) & IS_WORD[low]
        out = out << U64(8) | np.where(inside, low, 0).astype(U64)
    return out


def sentences(data: np.ndarray, off: np.ndarray,
              long_words: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(byte starts, offsets by text, content hash, words) of the sentences of
    a block, those over ``long_words`` words in pieces. A text without words
    has none."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n:
        white = _SPACE[data]
        stop = data == 10
        ends = np.flatnonzero(_END[data[:-1]] & white[1:]) + 1
        for mark in WIDE_ENDS:
            hit = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])) if n > 2 else []
            cut[np.asarray(hit, np.int64) + 3] = True
        stop[ends] = True  # the white space after an end mark
        filled = np.append(np.flatnonzero(~white), n)
        after = np.flatnonzero(stop) + 1
        cut[filled[np.searchsorted(filled, after)]] = True
    cut[off] = True
    starts = np.flatnonzero(cut[:n])
    # pieces without words join the piece before, within the text
    wh, word_at, piece_off = words(data, np.append(starts, n))
    if long_words is not None:
        per = np.diff(piece_off)
        inner = np.zeros(len(wh), bool)
        at = np.flatnonzero(np.repeat(per > long_words, per))  # windows start here
        head = np.zeros(len(wh), U64)
        head[at] = _heads(data, off, word_at[at])
        at = at[at + CUT_WINDOW <= np.repeat(piece_off[1:], per)[at]]
        least = at
        for k in range(1, CUT_WINDOW):
            least = np.where(head[at + k] <= head[least], at + k, least)
        inner[least] = True
        inner[piece_off[:-1][per > 0]] = False
        starts = np.sort(np.concatenate([starts, word_at[inner]]))
        piece_off = np.searchsorted(word_at, np.append(starts, n))
    piece_first, count = piece_off[:-1], np.diff(piece_off)
    text = np.searchsorted(off, starts, "right") - 1
    have = count > 0
    keep = np.flatnonzero(have)
    starts, piece_first, count, text = starts[keep], piece_first[keep], count[keep], text[keep]
    soff = np.searchsorted(text, np.arange(len(off)))
    starts = starts.copy()
    first = soff[:-1][np.diff(soff) > 0]
    starts[first] = off[:-1][np.diff(soff) > 0]  # what stands before the first words
    return starts, soff, mix(Prefix(wh).span(piece_first, piece_first + count)), count


def runs(soff: np.ndarray, content: np.ndarray, count: np.ndarray, min_sentences: int,
         min_words: int, long_words: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first sentence, end, hash) of the shortest runs from each sentence
    forwards and backwards, and of each of ``long_words`` words; each once."""
    n = len(content)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, U64)
    total = np.concatenate([[0], np.cumsum(count)])
    text = np.repeat(np.arange(len(soff) - 1), np.diff(soff))
    i = np.arange(n)
    end = np.maximum(np.searchsorted(total, total[i] + min_words), i + min_sentences)
    fwd = end <= soff[text + 1]
    begin = np.minimum(np.searchsorted(total, total[i + 1] - min_words, "right") - 1, i + 1 - min_sentences)
    back = (begin >= soff[text]) & (total[i + 1] >= min_words)
    alone = i[count >= long_words] if long_words is not None else i[:0]
    a = np.concatenate([i[fwd], begin[back], alone])
    b = np.concatenate([end[fwd], i[back] + 1, alone + 1])
    u = np.unique(a << 32 | b)
    a, b = u >> 32, u & 0xFFFFFFFF
    h = mix(Prefix(content * MIX_A + U64(1)).span(a, b) + (b - a).astype(U64))
    return a, b, h


def repeated_runs(rows: DataFrame, min_sentences: int, min_words: int, long_words: int | None = None) -> DataFrame:
    """(row, a, b): sentence ranges that repeat an earlier run."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("substring_dedup")
        for batch in batches:
            number = batch.column("row").to_numpy()
            for lo, hi, data, off in blocks(batch.column("text"), SMALL_BLOCK):
                _, soff, content, count = sentences(data, off, long_words)
                a, b, h = runs(soff, content, count, min_sentences, min_words, long_words)
                text = np.searchsorted(soff, a, "right") - 1
                row = number[lo:hi][text]
                a, b = a - soff[text], b - soff[text]
                order = np.lexsort((a, row))
                a, b, h, row = a[order], b[order], h[order], row[order]
                first = first_in_block(h)
                r, x, y = merge_ranges(row[~first], a[~first], b[~first])
                cat = np.concatenate
                route = cat([h[first], mix(r.astype(np.int64).view(U64))]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route), pa.array(cat([np.zeros(int(first.sum()), np.int8), np.ones(len(r), np.int8)])),
                     pa.array(cat([row[first], r])), pa.array(cat([a[first], x]).astype(np.int32)),
                     pa.array(cat([b[first], y]).astype(np.int32))], names=["route", "known", "row", "a", "b"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, known = batch.column("route").to_numpy(), batch.column("known").to_numpy()
            repeat = np.zeros(len(h), bool)
            repeat[1:] = (h[1:] == h[:-1]) & (known[1:] == known[:-1])
            repeat[0] = last == (h[0], known[0])
            last = (h[-1], known[-1])
            pick = repeat | (known == 1)
            r, a, b = merge_ranges(*(batch.column(c).to_numpy()[pick] for c in ("row", "a", "b")))
            yield pa.RecordBatch.from_arrays([pa.array(r), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                             names=["row", "a", "b"])

    found = rows.mapInArrow(find, "route long, known byte, row long, a int, b int")
    return (by_content(found, "known", "route", "row", "a").mapInArrow(settle, "row long, a int, b int"))


def dedup(docs: DataFrame, key: str = "doc_id", min_sentences: int = MIN_SENTENCES,
          min_words: int = MIN_WORDS, long_words: int | None = None) -> DataFrame:
    """``kept`` (the columns of ``docs``), new_text, n_sentences, n_removed."""
    rows = numbered(docs, key)
    texts = rows.select(F.col(ROW).alias("row"), F.col("kept.text").alias("text"))
    ranges = stored(docs.sparkSession, repeated_runs(texts, min_sentences, min_words, long_words), "ranges")
    joined = (rows.withColumnRenamed(ROW, "row").join(ranges_by_row(ranges), "row", "left")
              .select("kept", F.col("kept.text").alias("text"), "ranges"))
    kind = rows.schema["kept"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("ranges")
            for lo, hi, data, off in blocks(batch.column("text"), SMALL_BLOCK):
                starts, soff, _, _ = sentences(data, off, long_words)
                part = spans.slice(lo, hi - lo)
                per = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = part.flatten()
                base = np.repeat(soff[:-1], per)
                step = np.zeros(len(starts) + 1, np.int64)
                np.add.at(step, base + flat.field("a").to_numpy(), 1)
                np.add.at(step, base + flat.field("b").to_numpy(), -1)
                gone = np.cumsum(step[:-1]) > 0
                ends = np.append(starts[1:], len(data))
                last = soff[1:][np.diff(soff) > 0] - 1
                ends[last] = off[1:][np.diff(soff) > 0]
                mask = np.zeros(len(data) + 1, np.int64)
                np.add.at(mask, starts[gone], 1)
                np.add.at(mask, ends[gone], -1)
                keep = np.cumsum(mask[:-1]) == 0
                out = data[keep].tobytes()
                ooff = np.concatenate([[0], np.cumsum(keep)])[off].astype(np.int32)
                text = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(ooff.tobytes()), pa.py_buffer(out))
                null = batch.column("text").slice(lo, hi - lo).is_null()
                text = pa.compute.if_else(null, pa.scalar(None, pa.string()), text)
                removed = np.concatenate([[0], np.cumsum(gone)])[soff]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("kept").slice(lo, hi - lo), text, pa.array(np.diff(soff)), pa.array(np.diff(removed))],
                    names=["kept", "new_text", "n_sentences", "n_removed"])

    return joined.mapInArrow(cut, f"kept {kind}, new_text string, n_sentences long, n_removed long")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed and the text left of every document."""
    return dedup(docs, long_words=LONG_WORDS).select("kept.doc_id", "n_sentences", "n_removed", F.col("new_text").alias("text"))


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated sentences, and pieces of long ones, removed
    from ``text``; ``n_chars`` follows the text."""
    fresh = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return dedup(docs, long_words=LONG_WORDS).select(*[fresh[c].alias(c) if c in fresh else F.col(f"kept.`{c}`") for c in docs.columns])
