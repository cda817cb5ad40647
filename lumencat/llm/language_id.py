"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays.

A text is lower-cased and every letter hashed to one of 127 classes (a-z keep
their own, other letters share the rest; runs of anything else are one
separator). A trigram of classes is a 21-bit key, so a language's model has at
most 2^21 entries however large the corpus: this bounds what is collected and
broadcast. Trigrams are counted over every document of the learning split, in
each task first, then summed per (language, key). Lower orders use Kneser-Ney
continuation counts, derived from the distinct trigrams; discounts come from
the counts of counts.

The model is one sorted key array with a column of log-probabilities for each
language (all interpolation done beforehand) and small tables for keys never
seen. Every whole text is scored by binary search, in slices. The lowest
length-normalised cross-entropy wins. The margin to the runner-up is calibrated
to a probability, and a text whose cross-entropy exceeds what nearly all
learning texts of its language show is marked ``rejected``. Both are calibrated
on one of CALIBRATION learning rows (by a hash of their text, so copies stay
together), whose trigrams are not counted; a language without such a row takes
its limit from the counted ones.

Defined results: text null or without a letter: ``und`` with score 0; a single
language: score 1; nothing to learn from: ``und``; ties: the language that
sorts first; null lang: not learned from; more than MOST_LANGUAGES languages: an
error, as the model would outgrow its broadcast; empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small_batches

CLASSES = 128
KEYS = CLASSES**3
#: Characters scored at once; bounds memory for very long texts.
SLICE = 1 << 19
#: Languages counted at once in a task; with more, counts are passed on early.
OPEN_LANGUAGES = 8
#: Languages of one model: 16 bytes times 2^21 keys at most for each in the broadcast.
MOST_LANGUAGES = 256
#: One of so many learning rows is kept from the counts, to calibrate on.
CALIBRATION = 10
#: Share of learning texts that the rejection threshold accepts.
ACCEPTED = 0.999

_classes: np.ndarray | None = None


def class_table() -> np.ndarray:
    """Class of each code point: 0 for what is no letter."""
    global _classes
    if _classes is None:
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        codes = np.arange(0x110000)
        table = np.where(letters, 27 + codes % 101, 0)
        table[97:123] = np.arange(1, 27)
        _classes = table.astype(np.int32)
    return _classes


def trigrams(text: str | None) -> Iterator[np.ndarray]:
    """Keys of a whole text's trigrams, in slices; none if it has no letter."""
    text = (text or "").lower()
    carry = np.zeros(2, np.int32)  # starts after a separator
    for i in range(0, max(len(text), 1), SLICE):
        last = i + SLICE >= len(text)
        codes = class_table()[np.frombuffer(text[i : i + SLICE].encode("utf-32-le", "surrogatepass"), "<u4")]
        codes = np.concatenate([carry[-1:], codes, np.zeros(1 if last else 0, np.int32)])
        codes = codes[1:][(codes[1:] != 0) | (codes[:-1] != 0)]
        if not len(codes):
            continue
        codes = np.concatenate([carry, codes])
        if len(codes) > 2:
            yield (codes[:-2] << 14) | (codes[1:-1] << 7) | codes[2:]
        carry = codes[-2:]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(lang, key, n) over all rows of docs (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, table in counts.items():
                keys = np.flatnonzero(table)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int32)), pa.array(table[keys])], names=["lang", "key", "n"])
            counts.clear()

        for batch in batches:
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for keys in trigrams(text.as_py()):
                    by.setdefault(lang, []).append(keys)
            for lang, keys in by.items():
                if lang not in counts:
                    if len(counts) >= OPEN_LANGUAGES:
                        yield from passed_on()
                    counts[lang] = np.zeros(KEYS, np.int64)
                every = np.concatenate(keys)
                if len(every) > 50_000:
                    counts[lang] += np.bincount(every, minlength=KEYS)
                else:
                    found, n = np.unique(every, return_counts=True)
                    counts[lang][found] += n
        yield from passed_on()

    rows = docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, key int, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Sorted trigram keys with log-probabilities, and tables for unseen ones; a column for each language."""

    langs: list[str]
    keys: np.ndarray
    logp: np.ndarray
    back: np.ndarray
    bigram: np.ndarray

    def entropies(self, text: str | None) -> np.ndarray | None:
        """Mean negative log-probability of the text's trigrams by language; None without a letter."""
        total, n, letters = np.zeros(len(self.langs)), 0, False
        for keys in trigrams(text):
            letters = letters or bool((keys & 127).any())
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            seen = self.keys[at] == keys
            total += self.logp[at[seen]].sum(axis=0)
            other = keys[~seen]
            total += self.back[other >> 7].sum(axis=0) + self.bigram[other & 0x3FFF].sum(axis=0)
            n += len(keys)
        return -total / n if letters else None


def discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2), between 0.1 and 0.9."""
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.9))


def kneser_ney(langs: list[str], columns: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model from each language's (keys, counts)."""
    union = np.unique(np.concatenate([k for k, _ in columns.values()])).astype(np.int32)
    shape = CLASSES * CLASSES
    logp = np.zeros((len(union), len(langs)), np.float32)
    back, bigram = np.zeros((shape, len(langs)), np.float32), np.zeros((shape, len(langs)), np.float32)
    for j, lang in enumerate(langs):
        keys, n = columns[lang]
        d3 = discount(n)
        # continuation counts: distinct predecessors of a bigram, of a letter
        cont2 = np.bincount(keys & 0x3FFF, minlength=shape).astype(float)
        d2 = discount(cont2[cont2 > 0])
        cont1 = (cont2.reshape(CLASSES, CLASSES) > 0).sum(axis=0).astype(float)
        d1 = 0.5
        p1 = np.maximum(cont1 - d1, 0) / cont1.sum() + d1 * (cont1 > 0).sum() / cont1.sum() / CLASSES
        grid = cont2.reshape(CLASSES, CLASSES)
        total = grid.sum(axis=1, keepdims=True)
        safe = np.maximum(total, 1)
        p2 = np.where(total > 0, np.maximum(grid - d2, 0) / safe + d2 * (grid > 0).sum(axis=1, keepdims=True) / safe * p1, p1).ravel()
        context = np.bincount(keys >> 7, n, minlength=shape)
        followers = np.bincount(keys >> 7, minlength=shape)
        weight = np.where(context > 0, d3 * followers / np.maximum(context, 1), 1.0)
        own = np.zeros(len(union))
        own[np.searchsorted(union, keys)] = n
        p3 = np.maximum(own - d3, 0) / np.maximum(context[union >> 7], 1) + weight[union >> 7] * p2[union & 0x3FFF]
        logp[:, j], back[:, j], bigram[:, j] = np.log(p3), np.log(weight), np.log(p2)
    return Model(langs, union, logp, back, bigram)


def fit(docs: DataFrame) -> Model | None:
    """Model of all rows (lang, text); None if there is nothing to learn from."""
    small_batches(docs.sparkSession)
    if len(docs.where(F.col("lang").isNotNull()).select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    found = trigram_counts(docs).toPandas()  # at most 2^21 rows for each language
    columns = {lang: (g["key"].to_numpy(), g["n"].to_numpy()) for lang, g in found.sort_values("key").groupby("lang")}
    return kneser_ney(sorted(columns), columns) if columns else None


def identified(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, learned, lang_pred, score, cross_entropy, rejected of every row; learn picks the learning rows."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.coalesce(learn, F.lit(False)).alias("learned"))
    rows = rows.withColumn("kept", F.col("learned") & F.coalesce(F.pmod(F.xxhash64("text"), F.lit(CALIBRATION)) == 0, F.lit(False)))
    counted = fit(rows.where("learned AND NOT kept"))
    model = docs.sparkSession.sparkContext.broadcast(counted or fit(rows.where("learned")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            pred, low, margin = [], [], []
            for t in batch.column(1):
                h = m.entropies(t.as_py()) if m else None
                if h is None:
                    pred.append("und"), low.append(None), margin.append(None)
                else:
                    best = int(h.argmin())
                    pred.append(m.langs[best]), low.append(float(h[best]))
                    margin.append(float(np.delete(h, best).min() - h[best]) if len(h) > 1 else None)
            out = [batch.column(0), batch.column(2), batch.column(3), batch.column(4), pa.array(pred, pa.string()), pa.array(low, pa.float64()), pa.array(margin, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "lang", "learned", "kept", "lang_pred", "cross_entropy", "margin"])

    found = checkpointed(rows.mapInArrow(run, "doc_id bigint, lang string, learned boolean, kept boolean, lang_pred string, cross_entropy double, margin double"))
    return calibrated(found)


def calibrated(found: DataFrame) -> DataFrame:
    """Scores and rejections, calibrated on the rows kept for it.

    A language without a kept row takes its limit from all its learning rows.
    """
    known = found.where(F.col("learned") & F.col("lang").isNotNull() & F.col("cross_entropy").isNotNull())
    right = F.col("lang_pred") == F.col("lang")
    steps = [2.0**i for i in range(0, 10)]

    def loss(beta: float) -> Column:
        z = F.when(right, F.lit(-beta)).otherwise(F.lit(beta)) * F.col("margin")
        return F.avg(F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))).alias(f"b{beta:g}")

    losses = known.where("kept").agg(*map(loss, steps)).first()
    beta = min(steps, key=lambda b: losses[f"b{b:g}"] if losses[f"b{b:g}"] is not None else 0.0)
    kept_limit, limit = (F.percentile_approx(c, ACCEPTED, 10_000) for c in (F.when(F.col("kept"), F.col("cross_entropy")), F.col("cross_entropy")))
    limits = known.where(right).groupBy("lang_pred").agg(F.coalesce(kept_limit, limit).alias("limit"))
    score = F.when(F.col("lang_pred") == "und", 0.0).when(F.col("margin").isNull(), 1.0).otherwise(1 / (1 + F.exp(-beta * F.col("margin"))))
    rejected = F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(True))
    # one row for each language of the model
    out = found.join(F.broadcast(limits), "lang_pred", "left").withColumn("rejected", rejected)
    score = F.when(F.col("rejected"), score / 2).otherwise(score)
    return out.select("doc_id", "learned", "lang_pred", score.alias("score"), "cross_entropy", "rejected")
