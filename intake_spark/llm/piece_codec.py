"""SentencePiece (merge-type) encoding and decoding (operator 2).

Encoding is exact and uses no merge queue over the text. A sequence of pieces
is the merge result if and only if each adjacent pair is compatible, that is,
merging the pair's own text gives back the pair. So a text is encoded by
backtracking: take the longest piece at a position (all longest matches come
from one Aho-Corasick pass over the reversed text), accept it if it is
compatible with the piece before it and its end isn't known to fail, else try
its next shorter prefix piece, else give up the position (marked in a bitfield)
and go back. Compatibility is checked by re-merging the two pieces' text, once
a pair.

The rule needs distinct merge priorities. Pieces of equal score exist for runs
of the space symbol; segments with such pieces are merged directly.

A text is cut where no piece spans the cut (between code points that stand
side by side in no piece), and each distinct segment is encoded once a worker.

Defined results: a null or empty text has no pieces and decodes to the empty
text; characters outside the vocabulary become their UTF-8 bytes' pieces;
repeated rows give repeated results; other columns are not read. Models of
another kind (unigram, own normaliser, no byte pieces) are refused.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .held import begin, keeps
from .segments import SegmentTable
from .textbytes import SMALL_BLOCK, blocks, code_points

SPACE = "▁"
DENSE = 512            # code points whose pairs are looked up when cutting
MAX_PAIRS = 400_000    # remembered compatibility checks
HELD_SEGMENTS = 500_000


class PieceBpe:
    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, kinds = proto.normalizer_spec, pb.ModelProto.SentencePiece
        if (proto.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap
                or not norm.escape_whitespaces or norm.remove_extra_whitespaces
                or not proto.trainer_spec.byte_fallback or proto.trainer_spec.treat_whitespace_as_suffix
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces)):
            raise ValueError("a merge-type model with identity normaliser and byte pieces is needed")
        self.prefix = norm.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.kind = [p.type for p in proto.pieces]
        self.unknown_text = proto.trainer_spec.unk_surface
        self.normal, self.byte, self.unknown, self.control = kinds.NORMAL, kinds.BYTE, kinds.UNKNOWN, kinds.CONTROL
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.score = {p.piece: p.score for p in proto.pieces if p.type == kinds.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        seen: set[float] = set()
        tied: set[float] = set()
        for p, s in self.score.items():
            if len(p) > 1:
                (tied if s in seen else seen).add(s)
        self.tied = [p for p, s in self.score.items() if len(p) > 1 and s in tied]
        self.has_tied = re.compile("|".join(map(re.escape, self.tied)) or r"(?!)").search
        self.chars = {p for p in self.ids if len(p) == 1}
        self.plain = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        self.size = {i: len(p) for p, i in self.ids.items()}
        self.longest = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.longest.add_word(p[::-1], (len(p), i))
        self.longest.make_automaton()
        self.shorter = {}
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1)
        self._pairs: dict[int, bool] = {}
        # pairs of code points inside pieces: no cut between them
        self.joined = np.zeros((DENSE, DENSE), bool)
        space_inside = False
        for p in self.ids:
            for a, b in zip(p, p[1:]):
                space_inside |= b == SPACE != a
                if ord(a) < DENSE and ord(b) < DENSE:
                    self.joined[ord(a), ord(b)] = True
        self.cut_at_space = not space_inside
        self.table = SegmentTable(self._segments, [np.uint32, np.uint8], HELD_SEGMENTS)

    # -- merging (for pairs of pieces and tied runs)

    def merge(self, text: str) -> list[str]:
        """Merge result of ``text``: the best-scored adjacent pair first, the
        leftmost among equals."""
        parts, right = list(text), list(range(1, len(text) + 1))
        left = list(range(-1, len(text) - 1))
        n, score, heap = len(parts), self.score, []

        def offer(i: int, j: int) -> None:
            s = score.get(parts[i] + parts[j])
            if s is not None:
                heapq.heappush(heap, (-s, i, j, len(parts[i]), len(parts[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if len(parts[i]) != a or len(parts[j]) != b:
                continue
            parts[i], parts[j] = parts[i] + parts[j], ""
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [p for p in parts if p]

    def compatible(self, a: int, b: int) -> bool:
        """Whether piece ``b`` may follow piece ``a`` (-1: the start)."""
        key = (a + 1) << 32 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            pair = [self.pieces[b]] if a < 0 else [self.pieces[a], self.pieces[b]]
            known = self._pairs[key] = self.merge("".join(pair)) == pair
        return known

    # -- encoding

    def _backtrack(self, s: str) -> list[int]:
        """Ids of a text whose every character is a piece."""
        n = len(s)
        best = [(0, -1)] * n
        for end, hit in self.longest.iter(s[::-1]):
            if hit[0] > best[n - 1 - end][0]:
                best[n - 1 - end] = hit
        size, pairs, shorter = self.size, self._pairs, self.shorter
        failed = bytearray(n // 8 + 1)  # a bit a position
        out: list[int] = []
        pos, cand = 0, best[0][1]
        while True:
            last = out[-1] if out else -1
            while cand >= 0:
                k = size[cand]
                end = pos + k
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = pairs.get((last + 1) << 32 | cand)
                    if self.compatible(last, cand) if fits is None else fits:
                        break
                cand = shorter[cand]
            if cand >= 0:
                out.append(cand)
                pos += k
                if pos == n:
                    return out
                cand = best[pos][1]
            else:
                failed[pos >> 3] |= 1 << (pos & 7)
                cand = out.pop()
                pos -= size[cand]

    def encode_segment(self, s: str) -> list[int]:
        ids = self.ids
        if not self.chars.issuperset(s):
            out, run = [], ""
            for c in s:
                if c in ids:
                    run += c
                else:
                    out += self.encode_segment(run) if run else []
                    out += [self.byte_ids[b] for b in c.encode()]
                    run = ""
            return out + (self.encode_segment(run) if run else [])
        if self.has_tied(s):
            return [ids[p] for p in self.merge(s)]
        return self._backtrack(s)

    def _segments(self, segments: list[str]) -> list[list]:
        ids = [self.encode_segment(s) for s in segments]
        return [ids, [self.surface(x) for x in ids]]

    # -- decoding

    def surface(self, ids: Sequence[int]) -> bytes:
        """Text of ids before the leading space is taken off."""
        try:
            return b"".join([self.plain[i] for i in ids])
        except KeyError:
            out, run = [], bytearray()
        for i in ids:
            k = self.kind[i]
            if k == self.byte:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_valid(bytes(run)))
                run = bytearray()
            if k == self.normal:
                out.append(self.plain[i])
            elif k == self.unknown:
                out.append(self.unknown_text.encode())
        if run:
            out.append(_valid(bytes(run)))
        return b"".join(out)

    def decode(self, ids: Sequence[int]) -> str:
        """Text of ids; the space that encoding put in front is taken off."""
        ids = [i for i in ids if self.kind[i] != self.control]
        text = self.surface(ids).decode()
        first = ids and self.kind[ids[0]] == self.normal and self.pieces[ids[0]].startswith(SPACE)
        return text[1:] if first and self.prefix else text

    # -- blocks

    def encode_block(self, data: np.ndarray, off: np.ndarray):
        """(ids, ids' offsets by text, decoded bytes, their offsets by text)."""
        cps, coff = code_points(data, off)
        cps = np.where(cps == 32, np.uint32(ord(SPACE)), cps)
        if self.prefix:
            filled = np.diff(coff) > 0
            cps = np.insert(cps, coff[:-1][filled], ord(SPACE))
            coff = coff + np.concatenate([[0], np.cumsum(filled)])
        n = len(cps)
        if n == 0:
            zero = np.zeros(len(off), np.int64)
            return np.zeros(0, np.uint32), zero, np.zeros(0, np.uint8), zero
        cut = np.ones(n, bool)
        a, b = cps[:-1], cps[1:]
        dense = (a < DENSE) & (b < DENSE)
        cut[1:] = dense & ~self.joined[np.where(dense, a, 0), np.where(dense, b, 0)]
        if self.cut_at_space:
            cut[1:] |= (b == ord(SPACE)) & (a != ord(SPACE))
        cut[coff[:-1][np.diff(coff) > 0]] = True
        starts = np.flatnonzero(cut)
        slots = self.table.slots(cps, starts)
        first = np.searchsorted(starts, coff)
        out = []
        for pool in self.table.pools:
            flat, lens = pool.gather(slots)
            total = np.concatenate([[0], np.cumsum(lens)])
            out += [flat, total[first]]
        if self.prefix:  # the decoded text loses the space put in front
            flat, ends = out[2], out[3]
            filled = np.diff(ends) > 0
            keep = np.ones(len(flat), bool)
            keep[ends[:-1][filled]] = False
            out[2], out[3] = flat[keep], ends - np.concatenate([[0], np.cumsum(filled)])
        return tuple(out)


def _valid(raw: bytes) -> bytes:
    """Bytes as text: each byte that starts no valid character becomes U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[i: i + k].decode())
                break
            except UnicodeDecodeError:
                k = 0
        if k == 0:
            out.append("�")
            k = 1
        i += k
    return "".join(out).encode()


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PieceBpe:
    return PieceBpe(path)


keeps("piece_codec", codec.cache_clear)


def _decimals(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``id,`` for each id, and the running number of bytes."""
    digits = np.full(len(ids), 1, np.int64)
    for p in range(1, 7):
        digits += ids >= 10 ** p
    ends = np.concatenate([[0], np.cumsum(digits + 1)])
    out = np.full(int(ends[-1]), ord(","), np.uint8)
    for p in range(7):
        have = digits > p
        if not have.any():
            break
        out[ends[1:][have] - 2 - p] = ids[have] // 10 ** p % 10 + 48
    return out, ends


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
                     with_ids: bool = False, with_text: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row a document: ``key`` and the columns ``keep``, n_tokens,
    ids_sha256 (of the decimal ids joined by commas), decoded_sha256; ids
    (array<int>) and decoded (string) on request."""
    kept = F.struct(*[F.col(f"`{c}`") for c in (key, *keep)]).alias("kept")
    kind = docs.select(kept).schema["kept"].dataType.simpleString()
    schema = f"kept {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("piece_codec")
        enc = codec(model)
        for batch in batches:
            for lo, hi, data, off in blocks(batch.column("text"), SMALL_BLOCK):
                ids, ioff, dec, doff = enc.encode_block(data, off)
                digits, ends = _decimals(ids)
                digits, dec = digits.data, np.ascontiguousarray(dec).data
                at = ends[ioff].tolist()
                of_ids = [hashlib.sha256(digits[a: max(a, b - 1)]).hexdigest() for a, b in zip(at, at[1:])]
                at = doff.tolist()
                of_text = [hashlib.sha256(dec[a:b]).hexdigest() for a, b in zip(at, at[1:])]
                cols = [batch.column("kept").slice(lo, hi - lo), pa.array(np.diff(ioff)), pa.array(of_ids), pa.array(of_text)]
                names = ["kept", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(ioff, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                if with_text:
                    cols.append(pa.array([bytes(dec[a:b]).decode() for a, b in zip(at, at[1:])]))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    out = docs.select(kept, F.col(text).alias("text")).mapInArrow(run, schema)
    return out.select("kept.*", *out.columns[1:])
