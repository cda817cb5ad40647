"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document's measures go into a sketch per (language, source): counts in
buckets of geometrically growing width (relative error GAMMA - 1 on every
quantile). Two sketches merge by adding counts, so they are exact under any
partitioning, are summed before the shuffle, and roll up to languages and to
the whole corpus.

A threshold is where a group's own distribution says that a document no longer
belongs to it. Values are compared on a logarithmic scale; for a rate it counts
the events of a document of the group's median length, log(1 + rate * length),
so that none and one are neighbours. Where the quartiles differ, the threshold
lies FENCE times their distance beyond the outer one. Where they coincide, as
those of rare events do, it lies in the middle of the first gap above them: two
neighbouring values of the sketch of which one is GAP times the other. Without
such a gap it lies GAP times beyond the largest value. So no threshold is a
cutoff in the measure's units.

Every source counts: its threshold is the weighted mean (of logarithms) of its
own and its language's, with as much weight on the source as it has documents
against POOLED; a language's is drawn to the corpus' in the same way.
Thresholds are then joined back to the documents.

Defined results: null text: no words, so the base rule rejects it; null
language or source: a group of its own; repeated rows count repeatedly; empty
table: no rows; columns of the input with clashing names are only overwritten
in the stats columns' prefix ``qr_``.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release_memory, small_batches, stored

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_shouts")
GAMMA = 1.02
#: Documents whose weight a group's parent has beside the group's own.
POOLED = 300
#: Characters of texts whose statistics are taken together.
GROUP_CHARS = 1 << 19
#: Quartile distances beyond the outer quartile, and the ratio of neighbouring values that is a gap.
FENCE = 5.0
GAP = 8.0
#: Bucket of values that are (nearly) nothing.
NOTHING = -(1 << 20)
#: Measures, the side of the threshold, and the length whose median makes a rate's events (none: the value itself counts).
MEASURES: dict[str, tuple[str, str, str | None]] = {
    "symbol_rate": ("n_symbols / n_words", "high", "n_words"),
    "long_words": ("word_chars / n_words", "high", None),
    "short_words": ("word_chars / n_words", "low", None),
    "dup_line_rate": ("n_dup_lines / n_lines", "high", "n_lines"),
    "repeat_rate": ("n_repeat_words / n_words", "high", "n_words"),
    "capital_rate": ("n_capitals / word_chars", "high", "word_chars"),
    "shout_rate": ("n_shouts / n_words", "high", "n_words"),
}
LENGTHS = ("n_words", "n_lines", "word_chars")


def _marks(characters: str) -> np.ndarray:
    """Table of bytes: which stand for one of some ASCII characters."""
    out = np.zeros(256, bool)
    out[[*characters.encode()]] = True
    return out


IS_SPACE, IS_SYMBOL, IS_CAPITAL, IS_SHOUT = map(_marks, (SPACES, SYMBOLS, string.ascii_uppercase, "!"))


def _numbered(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Equal numbers for equal slices of a byte array that begin at starts, each up to the next."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    slices = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return slices.dictionary_encode().indices.to_numpy()


def _repeated(words: np.ndarray, doc: np.ndarray, size: int = 3) -> np.ndarray:
    """Which words lie in a window of ``size`` words found twice or more in their document."""
    n = len(words) - size + 1
    cover = np.zeros(len(words), bool)
    if n < 2:
        return cover
    key = words[:n].astype(np.int64)
    for i in range(1, size):
        wide = int(words.max()) + 1
        if int(key.max()) >= (1 << 62) // wide:  # numbers that would overflow are dealt anew
            key = np.unique(key, return_inverse=True)[1]
        key = key * wide + words[i : n + i]
    if int(key.max()) >= (1 << 62) // (int(doc[-1]) + 1):
        key = np.unique(key, return_inverse=True)[1]
    key = key * (int(doc[-1]) + 1) + doc[:n]
    inside = np.flatnonzero(doc[:n] == doc[size - 1 :])
    order = inside[np.argsort(key[inside])]
    same = key[order[1:]] == key[order[:-1]]
    twice = np.concatenate((order[1:][same], order[:-1][same]))
    for i in range(size):
        cover[twice + i] = True
    return cover


def _group_stats(texts: list[str]) -> np.ndarray:
    raw = np.frombuffer("\n".join([*texts, ""]).encode(), np.uint8)
    until = np.flatnonzero(raw == 10)  # line ends; the documents' ends are among them
    size = np.fromiter((len(t.encode()) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(size)

    def total(flags: np.ndarray) -> np.ndarray:
        """Bytes of each document that are flagged; every document has its line end at least."""
        return np.add.reduceat(flags, ends - size, dtype=np.int64)

    space = IS_SPACE[raw]
    begins = ~space
    begins[1:] &= space[:-1]
    word_at = np.flatnonzero(begins)
    letters = np.flatnonzero(~space)
    words = _numbered(raw[letters], np.flatnonzero(begins[letters]))
    doc = np.searchsorted(ends, word_at, "right")
    line_at = np.concatenate(([0], until[:-1] + 1))
    full = np.diff(np.searchsorted(word_at, until), prepend=0) > 0
    line_doc = np.searchsorted(ends, line_at, "right")[full]
    distinct = np.unique(line_doc * len(until) + _numbered(raw, line_at)[full]) // len(until)
    n_lines = np.bincount(line_doc, minlength=len(texts))
    return np.column_stack([
        np.bincount(doc, minlength=len(texts)), total(~space & ((raw & 0xC0) != 0x80)), total(IS_SYMBOL[raw]), n_lines - np.bincount(distinct, minlength=len(texts)),
        np.bincount(doc[_repeated(words, doc)], minlength=len(texts)), n_lines, total(IS_CAPITAL[raw]), total(IS_SHOUT[raw]),
    ])


def batch_stats(texts: Iterable[str | None]) -> np.ndarray:
    """The STATS of each whole text, texts taken together in groups of GROUP_CHARS."""
    out, group, size = [np.zeros((0, len(STATS)), np.int64)], [], 0
    for text in texts:
        text = text if isinstance(text, str) else ""
        if group and size + len(text) > GROUP_CHARS:
            out.append(_group_stats(group))
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        out.append(_group_stats(group))
    return np.concatenate(out)


def text_stats(text: str | None) -> tuple[int, ...]:
    """The STATS of one whole text."""
    return tuple(batch_stats([text])[0].tolist())


@F.pandas_udf(T.StructType([T.StructField(s, T.LongType()) for s in STATS]))
def _stats(texts: pd.Series) -> pd.DataFrame:
    found = pd.DataFrame(batch_stats(texts), columns=[*STATS])
    release_memory()
    return found


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the struct column qr_stats and the boolean qr_base_failed."""
    small_batches(docs.sparkSession)
    s = F.col("qr_stats")
    failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
    return docs.withColumn("qr_stats", _stats(F.col(text).cast("string"))).withColumn("qr_base_failed", failed)


def _measure(name: str) -> Column:
    top, bottom = MEASURES[name][0].split(" / ")
    s = F.col("qr_stats")
    return F.when(s[bottom] > 0, s[top] / s[bottom]).otherwise(F.lit(0.0))


def sketch(stats: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, measure, bucket, n) of the documents that pass the base rule: the measures, and their lengths."""
    x = F.col("cell.value")
    bucket = F.when(x <= 1e-6, F.lit(NOTHING)).otherwise(F.ceil(F.log(x) / float(np.log(GAMMA)))).cast("int")
    values = {m: _measure(m) for m in MEASURES} | {n: F.col("qr_stats")[n].cast("double") for n in LENGTHS}
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("value")) for m, v in values.items()])).alias("cell")
    rows = stats.where(~F.col("qr_base_failed")).select(F.col(lang).alias("lang"), F.col(source).alias("source"), cells)
    return rows.select("lang", "source", F.col("cell.measure").alias("measure"), bucket.alias("bucket")).groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


def cuts(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """keys, size and the logarithm of each measure's threshold, from sketches merged over keys."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*keys, "measure")
    value = F.when(F.col("bucket") == NOTHING, 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")) * 2 / (1 + GAMMA))
    merged = merged.withColumns({"until": F.sum("n").over(own.orderBy("bucket")), "total": F.sum("n").over(own), "value": value})
    median = lambda name: F.min(F.when((F.col("measure") == name) & (F.col("until") >= 0.5 * F.col("total")), F.col("value"))).over(Window.partitionBy(*keys))
    merged = merged.withColumns({f"typical_{n}": median(n) for n in LENGTHS})
    length = F.coalesce(*[F.when(F.col("measure") == m, F.col(f"typical_{n}")) for m, (_, _, n) in MEASURES.items() if n])
    merged = merged.where(F.col("measure").isin([*MEASURES])).withColumn("length", length)
    merged = merged.withColumn("z", F.when(F.col("length").isNotNull(), F.log1p(F.col("value") * F.col("length"))).otherwise(F.log("value")))
    following = F.lead("z").over(own.orderBy("bucket"))
    gap = F.when((F.col("until") >= 0.75 * F.col("total")) & (following - F.col("z") >= float(np.log(GAP))), (F.col("z") + following) / 2)
    quartile = lambda q: F.min(F.when(F.col("until") >= q * F.col("total"), F.col("z")))
    facts = merged.withColumn("gap", gap).groupBy(*keys, "measure").agg(
        quartile(0.25).alias("z1"), quartile(0.75).alias("z3"), F.min("gap").alias("gap"), F.min("z").alias("least"), F.max("z").alias("most"), F.max("total").alias("total"), F.first("length").alias("length")
    )
    spread, far = F.col("z3") - F.col("z1"), float(np.log(GAP))
    high = F.when(spread > 0, F.col("z3") + FENCE * spread).otherwise(F.coalesce("gap", F.col("most") + far))
    low = F.when(spread > 0, F.col("z1") - FENCE * spread).otherwise(F.col("least") - far)
    limits = []
    for m, (_, side, n) in MEASURES.items():
        z = high if side == "high" else low
        limits.append(F.max(F.when(F.col("measure") == m, F.log(F.expm1(z) / F.col("length")) if n else z)).alias(m))
    return facts.groupBy(*keys).agg(F.max("total").alias("size"), *limits)


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, one threshold for each measure) for every (lang, source) of the sketches."""
    fine = cuts(sketches, ["lang", "source"]).alias("f")
    middle = cuts(sketches, ["lang"]).alias("m")
    coarse = cuts(sketches.withColumn("all", F.lit(1)), ["all"]).alias("c")
    joined = fine.join(middle, F.col("f.lang").eqNullSafe(F.col("m.lang")), "left").crossJoin(F.broadcast(coarse))  # coarse is one row

    def pooled(m: str) -> Column:
        def drawn(level: str, parent: Column) -> Column:
            size = F.col(f"{level}.size")
            return (size * F.col(f"{level}.{m}") + POOLED * parent) / (size + POOLED)

        return F.exp(drawn("f", drawn("m", F.col(f"c.{m}")))).alias(m)

    return joined.select(F.col("f.lang").alias("lang"), F.col("f.source").alias("source"), *map(pooled, MEASURES))


def judged(stats: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """stats with the boolean qr_kept; all its rows and other columns stay.

    The thresholds are a table of their own, one row for each group: small ones
    are broadcast by Spark, large ones joined by a shuffle, in which adaptive
    execution splits a hot source.
    """
    limits = stored(limits)
    cut = limits.select(F.struct(*limits.columns).alias("qr_limit"))
    match = F.col(lang).eqNullSafe(F.col("qr_limit.lang")) & F.col(source).eqNullSafe(F.col("qr_limit.source"))
    good = F.lit(True)
    for m, (_, side, _length) in MEASURES.items():
        limit = F.col(f"qr_limit.{m}")
        good = good & (_measure(m) <= limit if side == "high" else _measure(m) >= limit)
    # a document without a limit belongs to a group that the base rule emptied
    return stats.join(cut, match, "left").withColumn("qr_kept", ~F.col("qr_base_failed") & F.coalesce(good, F.lit(False))).drop("qr_limit")
