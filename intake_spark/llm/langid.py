"""Language identification with character language models (operator 3).

Per language an interpolated Kneser-Ney model of character n-grams (order
``ORDER``, at any size). ``train`` counts the n-grams of all training rows with
Spark; the lower orders' continuation counts, discounts, probabilities and
back-off weights follow from the highest order's table by aggregates and joins.
The model lies in the shared folder as parts of ``PART_ROWS`` entries: sorted
packed n-grams with the log-probabilities of the languages that have them. Only
the parts' first n-grams (one number a part) go through the driver. A task looks
up a block's distinct n-grams, part by part, and keeps at most ``CACHE_BYTES``
of parts; what a language doesn't have comes from its lower orders.

The language with the lowest cross-entropy per character wins (ties: the first
by name). ``score`` is the posterior under equal priors with the evidence of at
most ``EVIDENCE`` characters. A text is rejected if its cross-entropy is above
a limit of its language: half way from the usual value of that language's texts
to what the next best model gives them, plus a deviation that 99.9 % of its
rows stay under, by text length (``spread / sqrt(characters)``).
Every labelled row is counted, and every one calibrates: it is scored by a model
that counts the rows of the other of ``FOLDS`` parts only (a hash of the text
deals them, so copies stay together). Deviations are rounded up to whole
``1 / SPREAD_BINS`` and counted by value before their percentile is taken.

Text form: letters in lower case, with the marks that follow them; everything
else one space between words, three spaces in front.

Defined results: null texts and texts without a letter get ``und`` and score
0; rows with null language or text don't train; a language is any label seen;
without training rows every text is ``und``; repeated rows count each; other
columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .files import make_folder, read_file, stored, write_file
from .held import begin, keeps
from .textbytes import SMALL_BLOCK, U64, blocks, code_points, ragged

ORDER = 4
PART_ROWS = 1 << 18
CACHE_BYTES = 64 << 20
EVIDENCE = 32
FOLDS = 2                   # parts of the labelled rows that calibrate each other
SPREAD_BINS = 1024
SCORE_BYTES = 1 << 18       # of texts scored at once
SCORE_CELLS = 1 << 19       # n-grams times languages looked up at once
UND = "und"
BLANK = 32

_FOLD: np.ndarray | None = None
_MARKS: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """16-bit code of each letter and mark; BLANK for other code points."""
    global _FOLD, _MARKS
    if _FOLD is None:
        t, marks = np.full(0x110000, BLANK, np.uint16), np.zeros(0x110000, bool)
        for i in range(0x20000):
            c = chr(i)
            kind = unicodedata.category(c)[0]
            if kind in "LM":
                low = c.lower()
                k = ord(low) if len(low) == 1 else i
                t[i] = k if k < 0x10000 else 0xE000 + k % 0x1900
                marks[i] = kind == "M"
        t[0x20000:0x32000] = 0xE000 + np.arange(0x20000, 0x32000) % 0x1900
        _FOLD, _MARKS = t, marks
    return _FOLD


def coded(cps: np.ndarray, coff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a block's code points, and which are letters. A mark counts
    where it follows a letter, or marks after a letter, of its text."""
    code = fold_table()[cps]
    mark = _MARKS[cps]
    letter = (code != BLANK) & ~mark
    if mark.any():
        at = np.arange(len(cps))
        base = np.maximum.accumulate(np.where(mark, -1, at))
        first = np.repeat(coff[:-1], np.diff(coff))
        stay = (base >= first) & letter[np.maximum(base, 0)]
        code = np.where(mark & ~stay, np.uint16(BLANK), code)
    return code, letter


def grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed n-grams, offsets by text, letters by text) of a block."""
    cps, coff = code_points(data, off)
    code, letter = coded(cps, coff)
    blank = code == BLANK
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    first = coff[:-1][np.diff(coff) > 0]
    keep[first] = ~blank[first]  # the spaces in front stand for these
    cum = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(letter)])
    code, coff, n_letters = code[keep], cum[coff], np.diff(letters[coff])
    pad = ORDER - 1
    padded = np.insert(code, np.repeat(coff[:-1], pad), BLANK).astype(U64)
    m = len(padded) - pad
    if m <= 0:
        return np.zeros(0, U64), np.zeros(len(off), np.int64), n_letters
    g = np.zeros(m, U64)
    for j in range(ORDER):
        g |= padded[j: j + m] << U64(16 * (pad - j))
    inner = np.ones(m, bool)  # n-grams that end in the padding of a text
    starts = coff[:-1] + pad * np.arange(len(coff) - 1)
    for j in range(pad):
        at = starts + j - pad
        inner[at[(at >= 0) & (at < m)]] = False
    return g[inner], coff, n_letters


# ------------------------------------------------------------------ training

def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([n for _, n in parts]).astype(float), len(keys)).astype(np.int64)


def count_grams(rows: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows with a text and a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("langid")
        held: dict[str, list] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
            for lo, hi, data, off in blocks(batch.column("text"), SMALL_BLOCK):
                g, goff, _ = grams(data, off)
                by = np.repeat(code[lo:hi], np.diff(goff))
                for i in np.unique(by).tolist():
                    keys, n = np.unique(g[by == i], return_counts=True)
                    parts = held.setdefault(names[i], [])
                    parts.append((keys, n))
                    if len(parts) == 16:
                        parts[:] = [_merge(parts)]
        for name, parts in held.items():
            keys, n = _merge(parts)
            for a in range(0, len(keys), 100_000):
                k = keys[a: a + 100_000].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(k)), pa.array(k), pa.array(n[a: a + 100_000])],
                                                 names=["lang", "gram", "n"])

    return (rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
            .select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
            .mapInArrow(run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


@dataclass
class Model:
    """All tables in memory: the plain form that the stored one is tested against."""
    langs: list[str]
    order: int
    keys: list[np.ndarray] = field(default_factory=list)      # by order 1..n: sorted packed n-grams
    logs: list[np.ndarray] = field(default_factory=list)      # log-probability, a column a language
    contexts: list[np.ndarray] = field(default_factory=list)  # by order: sorted contexts
    backoff: list[np.ndarray] = field(default_factory=list)   # log of the weight left to the lower order
    floor: np.ndarray | None = None                           # log-probability of an unseen character

    def log_probs(self, g: np.ndarray) -> np.ndarray:
        """Log-probability of each n-gram's last character by language."""
        if len(g) == 0:
            return np.zeros((0, len(self.langs)), np.float32)
        return self._level(g, self.order)

    def _level(self, g: np.ndarray, n: int) -> np.ndarray:
        if n == 0:
            return np.broadcast_to(self.floor, (len(g), len(self.langs)))
        keys, g = self.keys[n - 1], _suffix(g, n)
        at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
        out = self.logs[n - 1][at]
        miss = np.flatnonzero(keys[at] != g)
        if len(miss):
            u, inverse = np.unique(g[miss], return_inverse=True)
            low = self._level(u, n - 1)
            ctx, c = u >> U64(16), self.contexts[n - 1]
            at = np.minimum(np.searchsorted(c, ctx), len(c) - 1)
            weight = np.where((c[at] == ctx)[:, None], self.backoff[n - 1][at], np.float32(0))
            out[miss] = (low + weight)[inverse]
        return out


def _suffix(g: np.ndarray, n: int) -> np.ndarray:
    return g if n == 4 else g & U64((1 << 16 * n) - 1)


def build_model(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> Model:
    """Interpolated Kneser-Ney tables from the highest order's counts."""
    langs = sorted(counts)
    model = Model(langs, order)
    tables = []  # by language, by order: (keys, counts)
    for lang in langs:
        keys, n = counts[lang]
        by_order = {order: (keys, n)}
        for k in range(order - 1, 0, -1):
            by_order[k] = np.unique(_suffix(by_order[k + 1][0], k), return_counts=True)
        tables.append(by_order)
    alphabet = len(np.unique(np.concatenate([t[1][0] for t in tables]))) + 1
    lower_keys, lower = None, np.full((1, len(langs)), 1.0 / alphabet)
    for k in range(1, order + 1):
        keys = np.unique(np.concatenate([t[k][0] for t in tables]))
        ctx = keys >> U64(16)
        contexts, of = np.unique(ctx, return_inverse=True)
        p, left = np.zeros((len(keys), len(langs))), np.ones((len(contexts), len(langs)))
        for i, t in enumerate(tables):
            own, n = t[k]
            one, two = (n == 1).sum(), (n == 2).sum()
            d = one / (one + 2 * two) if one and two else 0.5
            at = np.searchsorted(keys, own)
            total = np.bincount(of[at], n, len(contexts))
            kinds = np.bincount(of[at], minlength=len(contexts))
            seen = total > 0
            left[seen, i] = d * kinds[seen] / total[seen]
            p[at, i] = np.maximum(n - d, 0) / total[of[at]]
        base = lower[np.searchsorted(lower_keys, _suffix(keys, k - 1))] if k > 1 else lower
        p += left[of] * base
        lower_keys, lower = keys, p
        model.keys.append(keys)
        model.logs.append(np.log(p).astype(np.float32))
        model.contexts.append(contexts)
        model.backoff.append(np.log(left).astype(np.float32))
    model.floor = np.full(len(langs), -np.log(alphabet), np.float32)
    return model


_PARTS: OrderedDict[tuple[str, str], tuple[np.ndarray, ...]] = OrderedDict()
keeps("langid", _PARTS.clear)


def _part(uri: str, name: str) -> tuple[np.ndarray, ...]:
    """(n-grams, offsets, languages, values) of a part, from this process's
    cache or the shared folder."""
    if (uri, name) in _PARTS:
        _PARTS.move_to_end((uri, name))
        return _PARTS[uri, name]
    raw = read_file(uri, name)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    keys = np.frombuffer(raw, np.int64, n, 16)
    offs = np.frombuffer(raw, np.int64, n + 1, 16 + 8 * n)
    lang = np.frombuffer(raw, np.int32, m, 24 + 16 * n)
    value = np.frombuffer(raw, np.float32, m, 24 + 16 * n + 4 * m)
    _PARTS[uri, name] = keys, offs, lang, value
    held = sum(p[0].nbytes + p[1].nbytes + p[2].nbytes + p[3].nbytes for p in _PARTS.values())
    while held > CACHE_BYTES and len(_PARTS) > 1:
        _, p = _PARTS.popitem(last=False)
        held -= sum(x.nbytes for x in p)
    return keys, offs, lang, value


@dataclass
class StoredModel:
    langs: list[str]
    uri: str
    floor: np.ndarray                                   # log-probability of an unseen character
    index: dict[int, tuple[np.ndarray, list[str]]]      # by table: first n-grams and names of its parts
    number: int = 0                                     # of this model among those in the folder
    limit: np.ndarray | None = None                     # of the cross-entropy, by language
    spread: np.ndarray | None = None                    # added to it, times sqrt(characters)

    def log_probs(self, g: np.ndarray) -> np.ndarray:
        """Log-probability of each n-gram's last character by language."""
        u, inverse = np.unique(g.view(np.int64), return_inverse=True)
        return self._level(u, ORDER)[inverse]

    def text_sums(self, g: np.ndarray, goff: np.ndarray) -> np.ndarray:
        """Sums of the log-probabilities by text and language. Each portion of
        n-grams is looked up once a distinct n-gram, so memory depends neither
        on a text's length nor on the number of languages."""
        out = np.zeros((len(goff) - 1, len(self.langs)))
        step = max(1 << 10, SCORE_CELLS // len(self.langs))
        for lo in range(0, len(g), step):
            part = g[lo: lo + step]
            u, inverse = np.unique(part.view(np.int64), return_inverse=True)
            logs = self._level(u, ORDER)
            text = np.searchsorted(goff, np.arange(lo, lo + len(part)), "right") - 1
            first, n = text[0], text[-1] - text[0] + 1
            text -= first
            for i in range(len(self.langs)):
                out[first: first + n, i] += np.bincount(text, logs[:, i][inverse], n)
        return out

    def _level(self, g: np.ndarray, n: int) -> np.ndarray:
        """Of distinct n-grams of order ``n``, sorted."""
        if n == 0:
            return np.broadcast_to(self.floor, (len(g), len(self.langs)))
        out = self._find(n, g)
        miss = np.flatnonzero(np.isnan(out).any(axis=1))
        if len(miss):
            g = g[miss]
            lower, at = np.unique(g & ((1 << 16 * (n - 1)) - 1), return_inverse=True)
            backed = self._level(lower, n - 1)[at]
            context, of = np.unique((g.view(U64) >> U64(16)).view(np.int64), return_inverse=True)
            backed += np.nan_to_num(self._find(-n, context), nan=0.0)[of]
            have = out[miss]
            out[miss] = np.where(np.isnan(have), backed, have)
        return out

    def _find(self, table: int, keys: np.ndarray) -> np.ndarray:
        """Values of sorted n-grams by language; NaN where there is none."""
        out = np.full((len(keys), len(self.langs)), np.nan, np.float32)
        first, names = self.index[table_of(self.number, table)]
        part = np.searchsorted(first, keys, "right") - 1
        cuts = np.searchsorted(part, np.arange(len(names) + 1))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            have, offs, lang, value = _part(self.uri, names[i])
            asked = keys[cuts[i]: cuts[i + 1]]
            at = np.minimum(np.searchsorted(have, asked), len(have) - 1)
            hit = np.flatnonzero(have[at] == asked)
            count = offs[at[hit] + 1] - offs[at[hit]]
            src = ragged(offs[at[hit]], count)
            out[np.repeat(cuts[i] + hit, count), lang[src]] = value[src]
        return out


def table_of(number: int, table: int) -> int:
    """A model's table among those of all models in a folder."""
    return table + ORDER * number if table > 0 else table - ORDER * number


def model_rows(counts: DataFrame, langs: list[str], models: int) -> tuple[DataFrame, list[int]]:
    """(table, gram, l, v): log-probabilities (table n) of the n-grams that a
    language has, and the log of the weight left after its contexts (table -n),
    with ``table_of`` the model; and the sizes of the models' alphabets.
    ``counts`` are (m, lang, gram, n), m the number of a model."""
    spark = counts.sparkSession
    # k numbers a model's language
    number = (F.col("m") * len(langs) + F.array_position(F.lit(langs), F.col("lang")) - 1).cast("int").alias("k")
    grams_of = {ORDER: counts.select(number, "gram", "n")}
    for n in range(ORDER - 1, 0, -1):
        grams_of[n] = stored(spark, grams_of[n + 1].groupBy("k", F.col("gram").bitwiseAND((1 << 16 * n) - 1).alias("gram"))
                             .agg(F.count("*").alias("n")), f"grams{n}")
    m, lang = F.floor(F.col("k") / len(langs)).cast("int"), (F.col("k") % len(langs)).cast("int").alias("l")
    alphabet = [1] * models
    for x in grams_of[1].select(m.alias("m"), "gram").distinct().groupBy("m").count().collect():
        alphabet[x["m"]] = x["count"] + 1
    kinds = reduce(DataFrame.union, [g.select(F.lit(n).alias("order"), "k", "n") for n, g in grams_of.items()])
    discount = {n: [0.5] * (models * len(langs)) for n in grams_of}
    for x in kinds.groupBy("order", "k").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).collect():
        if x["one"] and x["two"]:
            discount[x["order"]][x["k"]] = x["one"] / (x["one"] + 2 * x["two"])
    lower, out = None, []
    context = F.shiftrightunsigned("gram", 16).alias("context")
    for n in range(1, ORDER + 1):
        d = F.element_at(F.lit(discount[n]), F.col("k") + 1)
        own = grams_of[n].select("k", "gram", "n", context)
        per = own.groupBy("k", "context").agg(F.sum("n").alias("total"), (d * F.count("*") / F.sum("n")).alias("left"))
        found = own.join(per, ["k", "context"])
        if lower is None:
            found = found.withColumn("base", F.element_at(F.lit([1.0 / a for a in alphabet]), m + 1))
        else:
            found = (found.withColumn("suffix", F.col("gram").bitwiseAND((1 << 16 * (n - 1)) - 1))
                     .join(lower.select("k", F.col("gram").alias("suffix"), F.col("p").alias("base")), ["k", "suffix"]))
        lower = stored(spark, found.select("k", "gram", (F.greatest(F.col("n") - d, F.lit(0.0)) / F.col("total")
                                                         + F.col("left") * F.col("base")).alias("p")), f"probabilities{n}")
        out += [lower.select((F.lit(n) + ORDER * m).alias("table"), "gram", lang, F.log("p").cast("float").alias("v")),
                per.select((F.lit(-n) - ORDER * m).alias("table"), F.col("context").alias("gram"), lang,
                           F.log("left").cast("float").alias("v"))]
    return reduce(DataFrame.union, out), alphabet


def write_parts(rows: DataFrame, uri: str, part_rows: int) -> dict[int, tuple[np.ndarray, list[str]]]:
    """Write the model's parts, each in the order of its n-grams; their index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def flush(held: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal made
            table, gram, lang, value = held
            first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
            name = f"{task}-{made}"
            made += 1
            head = np.array([len(first), len(gram)], np.int64)
            write_file(uri, name, b"".join(x.tobytes() for x in (
                head, gram[first], np.append(first, len(gram)).astype(np.int64), lang, value)))
            return pa.RecordBatch.from_arrays([pa.array(table[:1]), pa.array(gram[:1]), pa.array([name])],
                                              names=["table", "first", "name"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in ("table", "gram", "l", "v")]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            while len(held[0]):
                table, gram = held[:2]
                end = int(np.searchsorted(table, table[0], "right"))
                if end > part_rows:  # a part ends where an n-gram does
                    end = int(np.searchsorted(gram[:end], gram[part_rows - 1], "right"))
                if end == len(table):
                    break
                yield flush([x[:end] for x in held])
                held = [x[end:] for x in held]
        if held is not None and len(held[0]):
            yield flush(held)

    make_folder(uri)
    found = (rows.repartitionByRange("table", "gram").sortWithinPartitions("table", "gram", "l")
             .mapInArrow(run, "table int, first long, name string").collect())
    index: dict[int, tuple[np.ndarray, list[str]]] = {}
    for k in sorted({r["table"] for r in found}):
        parts = sorted((r["first"], r["name"]) for r in found if r["table"] == k)
        index[k] = np.array([a for a, _ in parts], np.int64), [b for _, b in parts]
    return index


def fold(text: str) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(FOLDS))


def train(rows: DataFrame, text: str = "text", lang: str = "lang", part_rows: int = PART_ROWS) -> StoredModel | None:
    """Model of all labelled rows, calibrated; None without labelled text."""
    spark = rows.sparkSession
    labelled = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    # model 0 counts all rows, model 1 + i those that aren't in part i
    parts = [stored(spark, count_grams(labelled.where(fold(text) == i), text, lang), f"grams-of-part{i}")
             .withColumn("m", F.explode(F.lit([0] + [1 + j for j in range(FOLDS) if j != i]))) for i in range(FOLDS)]
    counts = stored(spark, reduce(DataFrame.union, parts).groupBy("m", "lang", "gram").agg(F.sum("n").alias("n")), "grams")
    found = counts.select("m", "lang").distinct().collect()
    langs = sorted({r["lang"] for r in found})
    if not langs:
        return None
    entries, alphabet = model_rows(counts, langs, 1 + FOLDS)
    uri = scratch_path(spark, "model")
    index = write_parts(entries, uri, part_rows)
    models = {m: StoredModel(langs, uri, np.full(len(langs), -np.log(alphabet[m]), np.float32), index, m)
              for m in sorted({r["m"] for r in found})}
    calibrate(models[0], labelled, text, lang, {m - 1: x for m, x in models.items() if m})
    return models[0]


def calibrate(model: StoredModel, rows: DataFrame, text: str, lang: str, others: dict[int, StoredModel]) -> None:
    """Rejection limits by language, from all labelled rows: those of part i
    are scored by ``others[i]``, which doesn't count them. A part without such a
    model (there are no other texts) tells nothing."""
    scored = [score_rows(rows.where(fold(text) == i), m, [lang], text) for i, m in others.items()]
    if not scored:
        scored = [score_rows(rows.limit(0), model, [lang], text)]
    got = stored(rows.sparkSession, reduce(DataFrame.union, scored)
                 .where((F.col("best") == F.col("kept")[lang]) & (F.col("n") > 0))
                 .select(F.col("best").alias("l"), "xent", "rival", "n"), "calibration")
    mean = {r["l"]: (r["x"], r["r"]) for r in got.groupBy("l").agg(
        (F.sum(F.col("xent") * F.col("n")) / F.sum("n")).alias("x"),
        (F.sum(F.col("rival") * F.col("n")) / F.sum("n")).alias("r")).toLocalIterator()}
    uniform = -float(model.floor[0])
    model.limit = np.array([sum(mean.get(x, (uniform, uniform))) / 2 for x in model.langs])
    limit = F.lit(None).cast("double")
    for name, x in zip(model.langs, model.limit.tolist()):
        limit = F.when(F.col("l") == name, F.lit(x)).otherwise(limit)
    # above the limit, as the limit leaves room for most of a language's texts:
    # long texts on odd subjects would give short ones a room that fits anything
    off = (F.ceil((F.col("xent") - limit) * F.sqrt("n") * SPREAD_BINS) / SPREAD_BINS).alias("off")
    by_value = got.select("l", off).groupBy("l", "off").agg(F.count("*").alias("n"))
    spread = {r["l"]: r["s"] for r in by_value.groupBy("l").agg(F.percentile("off", 0.999, F.col("n")).alias("s")).toLocalIterator()}
    model.spread = np.array([max(spread.get(x, 0.0), 1.0) for x in model.langs])


# ------------------------------------------------------------------- scoring

def score_rows(rows: DataFrame, model: StoredModel, keep: list[str], text: str = "text") -> DataFrame:
    """``kept`` (a struct of the ``keep`` columns), best (null without a
    letter), score, xent, rival (the next best model's), n (characters). The
    text goes through Python once, also if it is kept."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    inside = text in keep
    fields = ", ".join(f"`{c}`: {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("langid")
        m = held.value
        names = np.array(m.langs, object)
        for batch in batches:
            texts = batch.column("kept").field(keep.index(text)) if inside else batch.column("text")
            for lo, hi, data, off in blocks(texts, SCORE_BYTES):
                g, goff, letters = grams(data, off)
                n = np.diff(goff)
                xent = -m.text_sums(g, goff) / np.maximum(n, 1)[:, None]
                best = xent.argmin(axis=1)
                low = xent[np.arange(len(n)), best]
                rival = np.partition(xent, 1, axis=1)[:, 1] if len(names) > 1 else np.full(len(n), -m.floor[0], float)
                score = 1 / np.exp(-(xent - low[:, None]) * np.minimum(n, EVIDENCE)[:, None]).sum(axis=1)
                ok = letters > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("kept").slice(lo, hi - lo), pa.array(names[best], pa.string(), mask=~ok),
                     pa.array(np.where(ok, score, 0.0)), pa.array(low, mask=~ok),
                     pa.array(rival, mask=~ok), pa.array(n)],
                    names=["kept", "best", "score", "xent", "rival", "n"])

    return (rows.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), *([] if inside else [F.col(text).alias("text")]))
            .mapInArrow(run, f"kept struct<{fields}>, best string, score double, xent double, "
                         "rival double, n long"))


def rejected(model: StoredModel) -> Column:
    """Whether a scored row is in none of the model's languages."""
    most = F.lit(None).cast("double")
    for lang, limit, spread in zip(model.langs, model.limit.tolist(), model.spread.tolist()):
        most = F.when(F.col("best") == lang, F.lit(limit) + F.lit(spread) / F.sqrt("n")).otherwise(most)
    return F.col("best").isNull() | (F.col("xent") > most)


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string")) % 4 == 2


def predict(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Train on the rows that aren't held out, and predict every row."""
    out = F.coalesce(held_out(key), F.lit(False))
    model = train(docs.where(~out), text, lang)
    if model is None:
        return docs.select(F.col(key).alias("doc_id"), out.alias("held_out"), F.lit(UND).alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    return (score_rows(docs.select(key, text), model, [key], text)
            .withColumn("doc_id", F.col("kept")[key])
            .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
                    F.coalesce("best", F.lit(UND)).alias("lang_pred"), "score", rejected(model).alias("rejected")))


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows in a language that the labelled rows teach, unchanged."""
    model = train(docs, text, lang)
    if model is None:
        return docs.limit(0)
    return score_rows(docs, model, docs.columns, text).where(~rejected(model)).select("kept.*")
