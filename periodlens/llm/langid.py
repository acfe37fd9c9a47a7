"""Language identification with interpolated Kneser-Ney character models, one per language.

Training takes a bounded sample of labelled rows (``sample_rows`` a language, picked by a hash of
the id), counts its words per language in Spark, and fits one character n-gram model a language.
A model scores the characters of a word and the blank that ends it, each given up to ``order - 1``
characters before it (the blank in front of the word included).  N-grams are kept as 64-bit hashes
in one sorted array an order, with the interpolation weights of every language beside it; a lookup
is a binary search.

A text's score under a language is the sum over its words, divided by its characters: the
length-normalised cross-entropy.  The lowest wins.  Rejection is calibrated on a tenth of the
sample, which the models do not see: per language the quantile ``1 - reject_rate`` of the
cross-entropy of the right model, plus ``reject_margin`` nats.

Prediction is one Arrow-batched map over whole texts without a shuffle.  The models' size depends on
the sample's bound only, not on the table.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; with no
labelled row at all everything is ``und``; ties go to the language that sorts first; null and
repeated ids each keep their row; rows with a null label are never learned from.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 1500            # labelled rows a language that the models are fitted to, about
ORDER = 4
UND = "und"
DISCOUNT = 0.75
CHARSET = 3000                # the uniform distribution below the unigrams
REJECT_RATE, REJECT_MARGIN = 0.001, 0.6
CACHE_WORDS = 500_000
_LETTER = re.compile(r"[^\W\d_]")           # letters, and numbers that are no digits: ``isalpha`` tells
_SPLIT = re.compile(r"[\W\d_]+")
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def words_of(text: str) -> list[str]:
    """Runs of letters (Unicode category L), lower-cased."""
    words = [w for w in _SPLIT.split(text.lower()) if w]
    if all(map(str.isalpha, words)):
        return words
    # fractions, circled and Roman numbers are between the words
    return [x for w in words for x in "".join(c if c.isalpha() else " " for c in w).split()]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m.group().isalpha() for m in _LETTER.finditer(text))


def _grams(words: list[str], order: int):
    """For each scored character: its word, and per order the hash of the n-gram and of its context.

    Where a word has fewer characters before it than the order asks for, ``valid`` is false.
    """
    flat = np.frombuffer((" " + "  ".join(words) + " ").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    out = []
    with np.errstate(over="ignore"):
        code = flat + np.uint64(1)
        # suffix[k]: the hash of the k characters that end here
        suffix = [np.zeros(len(flat), np.uint64)]
        for k in range(1, order + 1):
            shifted = np.concatenate((np.zeros(k - 1, np.uint64), code[:len(flat) - k + 1]))
            suffix.append(suffix[-1] + _mix(shifted * _MULT[k - 1] + np.uint64(k)))
        for k in range(1, order + 1):
            context = np.concatenate((np.zeros(1, np.uint64), suffix[k - 1][:-1]))
            out.append((suffix[k], context, place >= max(k - 1, 1)))
    return word, place >= 1, out


def _mix(x):
    x = (x ^ (x >> np.uint64(29))) * _MULT[0]
    return x ^ (x >> np.uint64(32))


def _sum_by(keys, *weights):
    """Sorted distinct keys and the sum of each weight over them."""
    got, inverse = np.unique(keys, return_inverse=True)
    return got, [np.bincount(inverse, w, len(got)) for w in weights]


def fit(words: list[str], counts, order: int = ORDER) -> list[tuple]:
    """Per order: (n-gram hashes, alpha, context hashes, gamma) of interpolated Kneser-Ney."""
    word, scored, grams = _grams(words, order)
    weight = np.asarray(counts, np.float64)[word]
    model = []
    for k in range(1, order + 1):
        gram, context, valid = grams[k - 1]
        if k == order:
            use = valid & scored
            g, c, w = gram[use], context[use], weight[use]
            keys, (n,) = _sum_by(g, w)
            context_of = c[np.unique(g, return_index=True)[1]]
        else:
            # continuation counts: distinct n-grams one longer that end in this one, and n-grams
            # that start a word, which nothing comes before
            longer, _, lv = grams[k]
            use = lv & scored
            first = np.unique(longer[use], return_index=True)[1]
            start = valid & scored & ~lv
            firsts = np.unique(gram[start], return_index=True)[1]
            g = np.concatenate((gram[use][first], gram[start][firsts]))
            c = np.concatenate((context[use][first], context[start][firsts]))
            keys, (n,) = _sum_by(g, np.ones(len(g)))
            context_of = c[np.unique(g, return_index=True)[1]]
        contexts, (total, kinds) = _sum_by(context_of, n, np.ones(len(n)))
        at = np.searchsorted(contexts, context_of)
        model.append((keys, np.maximum(n - DISCOUNT, 0) / total[at], contexts,
                      np.minimum(DISCOUNT * kinds, total) / total))
    return model


class WordScores(dict):
    """Rows of a matrix by word: the scores of words already seen."""

    rows = np.zeros((0, 1), np.float32)

    def extend(self, words: list[str], scores: np.ndarray) -> None:
        n = len(self)
        if n + len(words) > len(self.rows):
            grown = np.zeros((2 * (n + len(words)), scores.shape[1]), np.float32)
            if n:
                grown[:n] = self.rows[:n]
            self.rows = grown
        self.rows[n:n + len(words)] = scores
        self.update(zip(words, range(n, n + len(words))))


class Models:
    """The models of all languages side by side: sorted hash arrays with one column a language."""

    def __init__(self, by_lang: dict[str, list[tuple]], order: int):
        self.langs, self.order, self.key = sorted(by_lang), order, uuid.uuid4().hex
        self.alpha, self.gamma = [], []
        for k in range(order):
            for at, of, table, absent in ((0, 1, self.alpha, 0.0), (2, 3, self.gamma, 1.0)):
                keys = np.unique(np.concatenate([by_lang[x][k][at] for x in self.langs]))
                values = np.full((len(keys) + 1, len(self.langs)), absent, np.float32)
                for j, x in enumerate(self.langs):
                    values[np.searchsorted(keys, by_lang[x][k][at]), j] = by_lang[x][k][of]
                table.append((keys, values))
        self.reject = np.full(len(self.langs), np.inf)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """log probability (nats) of each word and the blank after it, a column a language."""
        word, scored, grams = _grams(words, self.order)
        p = np.full((len(word), len(self.langs)), 1.0 / CHARSET, np.float32)
        for k in range(self.order):
            gram, context, valid = grams[k]
            a, g = self._find(self.alpha[k], gram), self._find(self.gamma[k], context)
            p = np.where(valid[:, None], a + g * p, p)
        logs = np.where(scored[:, None], np.log(p), 0)
        starts = np.searchsorted(word, np.arange(len(words)))
        return np.add.reduceat(logs, starts, axis=0)

    @staticmethod
    def _find(table, hashes):
        keys, values = table
        at = np.searchsorted(keys, hashes)
        at[at == len(keys)] = 0
        return values[np.where(keys[at] == hashes, at, len(keys))] if len(keys) else values[np.zeros(len(hashes), int)]

    def score(self, texts: list, cache: WordScores) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy (nats a character) of each text under each language, and its characters."""
        split = [words_of(t) if t else [] for t in texts]
        new = list(set().union(*split) - cache.keys())
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear()
            new = list(set().union(*split))
        for i in range(0, len(new), 10_000):
            part = new[i:i + 10_000]
            cache.extend(part, np.column_stack((self.word_scores(part), [len(w) + 1 for w in part])))
        sums = np.zeros((len(texts), len(self.langs) + 1))
        for i, ws in enumerate(split):
            if ws:
                at = np.fromiter(map(cache.__getitem__, ws), np.int64, len(ws))
                sums[i] = cache.rows[at].sum(axis=0, dtype=np.float64)
        chars = sums[:, -1]
        return -sums[:, :-1] / np.maximum(chars, 1)[:, None], chars


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, order: int = ORDER) -> Models | None:
    """Fit the models to a sample of about ``sample_rows`` rows of each language."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    held = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("held")), F.lit(10)) == 0
    totals = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(~held).alias("n_fit")).collect()   # a row a language
    if not totals:
        return None
    # a language with few rows, all of them in the calibration's tenth, is fitted to these
    few = [r["lang"] for r in totals if not r["n_fit"]]
    held = held & ~F.col("lang").isin(few) if few else held
    totals = {r["lang"]: r["n"] for r in totals}
    share = F.lit(0.0)
    for lang, n in sorted(totals.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_rows / n))).otherwise(share)
    pick = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.where(pick < share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.assign(word=b["text"].map(words_of))[["lang", "word"]].explode("word").dropna()
            yield b.groupby(["lang", "word"]).size().rename("n").reset_index()

    words = (rows.where(~held).select("lang", "text").mapInPandas(count, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))

    def fit_lang(key, g: pd.DataFrame) -> pd.DataFrame:
        model = fit(g["word"].tolist(), g["n"].to_numpy(), order)
        parts = [x for k in model for x in k]
        return pd.DataFrame({"lang": [key[0]], "parts": [[np.ascontiguousarray(x).tobytes() for x in parts]]})

    # A language's words are those of its sample, so its group and its model are bounded by it.
    fitted = words.groupBy("lang").applyInPandas(fit_lang, "lang string, parts array<binary>").collect()
    kinds = (np.uint64, np.float64, np.uint64, np.float64)
    by_lang = {}
    for r in fitted:
        parts = [np.frombuffer(x, kinds[i % 4]) for i, x in enumerate(r["parts"])]
        by_lang[r["lang"]] = [tuple(parts[i:i + 4]) for i in range(0, len(parts), 4)]
    if not by_lang:
        return None
    models = Models(by_lang, order)
    _calibrate(models, rows.where(held))
    return models


def _calibrate(models: Models, rows: DataFrame) -> None:
    """Per language the highest cross-entropy that is still accepted."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def entropies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, cache = shared.value, WordScores()
        for b in batches:
            h, chars = m.score(b["text"].tolist(), cache)
            at = {x: j for j, x in enumerate(m.langs)}
            keep = [(x, h[i, at[x]]) for i, x in enumerate(b["lang"]) if x in at and chars[i] > 0]
            yield pd.DataFrame(keep, columns=["lang", "h"])

    quantile = F.percentile_approx("h", F.lit(1 - REJECT_RATE))
    got = (rows.select("lang", "text").mapInPandas(entropies, "lang string, h double")
           .groupBy("lang").agg(quantile.alias("q")).collect())
    for r in got:
        models.reject[models.langs.index(r["lang"])] = r["q"] + REJECT_MARGIN


_CACHE: dict = {}


def _word_cache(models: Models | None) -> WordScores:
    """Scores of words already seen by this worker process under the same models."""
    key = models and models.key
    if key not in _CACHE:
        _CACHE.clear()
        _CACHE[key] = WordScores()
    return _CACHE[key]


def predict(docs: DataFrame, models: Models | None, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score", rejected_col: str = "rejected") -> DataFrame:
    """``docs`` with the predicted language, a score (0 to 1) and whether the text is rejected.

    The score is the posterior of the chosen language when the cross-entropies of a text of 20
    characters are compared, so that it does not saturate with the length.
    """
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
    for c in (pred_col, score_col, rejected_col):
        docs = docs.drop(c)
    schema = StructType([*docs.schema.fields, StructField(pred_col, StringType()), StructField(score_col, DoubleType()),
                         StructField(rejected_col, BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        cache = _word_cache(m)
        for b in batches:
            for s in range(0, b.num_rows, 500):
                part = b.slice(s, 500)
                texts = part.column(at).to_pylist()
                letter = np.array([has_letter(t) for t in texts], bool)
                if m is None:
                    pred, score, bad = [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                else:
                    h, _ = m.score(texts, cache)
                    best = h.argmin(axis=1)
                    low = h[np.arange(len(texts)), best]
                    score = 1.0 / np.exp(-20 * (h - low[:, None])).sum(axis=1)
                    score = np.where(letter, score, 0.0)
                    pred = [m.langs[j] if ok else UND for j, ok in zip(best, letter)]
                    bad = ~letter | (low > m.reject[best])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(bad)],
                    schema=pa.schema([*part.schema, ("_p", pa.string()), ("_s", pa.float64()), ("_r", pa.bool_())])
                ).rename_columns([f.name for f in schema])

    return docs.mapInArrow(run, schema)


def held_out(id_col: Column, folds: int) -> Column:
    """Whether a row is held out: crc32 of its id as text, modulo the folds, is 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))
