"""Language identification of texts that may mix languages.

Training counts hashed character trigrams per language over all training rows; the model
is one table of log-free probabilities. A text is a bag of trigrams from a mixture of the
languages. Expectation-maximisation estimates the proportions; the set of languages is
chosen by penalised likelihood: a language joins only if the fit gains more than the
penalty.

The log-likelihood is concave in the proportions, so its slope at a fit bounds what any
further language can gain. Most texts are settled by that bound without iterating.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fadecast.llm import common

BUCKETS = 1 << 15
ALPHA = 0.05  # added to every count
STEPS = 60  # of expectation-maximisation at most
CLOSE = 1e-6
PENALTY = 3.0  # times the log of the text's trigrams, for each further language
MAX_LANGUAGES = 1000  # the model has BUCKETS numbers a language; more languages fail
UNKNOWN = "und"
PIECE = 1 << 20  # characters of a text that one numpy step looks at

_LETTER = regex.compile(r"\p{L}")


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of a text and how often each occurs. Case is folded, digits
    and white space are one blank each run; every piece of a long text is counted."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), PIECE):
        # A piece begins two characters earlier, so that no trigram is lost between pieces.
        part = text[max(0, at - 2) : at + PIECE].lower()
        c = np.frombuffer((" " * (at == 0) + part + " " * (at + PIECE >= len(text))).encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where(c < 65, 32, c).astype(np.uint64)  # blanks, digits and ASCII signs
        if len(c) >= 3:
            h = common.mix((c[:-2] << np.uint64(42)) ^ (c[1:-1] << np.uint64(21)) ^ c[2:])
            # Runs of blanks say nothing about a language.
            h = h[~((c[:-2] == 32) & (c[1:-1] == 32)) & ~((c[1:-1] == 32) & (c[2:] == 32))]
            if len(text) <= PIECE:
                own, n = np.unique((h & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
                return own, n
            total += np.bincount((h & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    own = np.flatnonzero(total)
    return own, total[own]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language the counts of all buckets; one vector per language is held."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own, n = grams(text)
            held.setdefault(lang, np.zeros(BUCKETS, np.int64))[own] += n
    for lang, n in held.items():
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(own), pa.string()), pa.array(own.astype(np.int32)), pa.array(n[own])],
            names=["lang", "bucket", "n"],
        )


class Model:
    """Languages in alphabetical order and the probability of every bucket in each."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        counts = counts + ALPHA
        self.p = counts / counts.sum(axis=0) if languages else counts
        self.log_p = np.log(self.p)

    def predict(self, text: str | None) -> tuple[str, float, dict[str, float]]:
        """The main language, its proportion, and all proportions."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, {}
        own, n = grams(text)
        if not len(own):
            return UNKNOWN, 0.0, {}
        p, total = self.p[own], int(n.sum())
        penalty = PENALTY * math.log(total + 1)
        fits = n @ self.log_p[own]
        chosen = [int(np.argmax(fits))]
        share, best = np.ones(1), float(fits[chosen[0]])
        while len(chosen) < len(self.languages):
            now = p[:, chosen] @ share
            slope = n @ (p / now[:, None]) - total
            slope[chosen] = -np.inf
            new = int(np.argmax(slope))
            if slope[new] <= penalty:  # no mixture with any further language can gain more
                break
            wider, fit = _fit(p[:, [*chosen, new]], n, np.r_[share * 0.9, 0.1])
            if fit - best <= penalty:
                break
            chosen, share, best = [*chosen, new], wider, fit
        top = int(np.argmax(share))
        found = {self.languages[k]: float(s) for k, s in zip(chosen, share)}
        return self.languages[chosen[top]], float(min(1.0, share[top])), found


def _fit(p: np.ndarray, n: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions by expectation-maximisation and their log-likelihood."""
    total, last = n.sum(), -np.inf
    for _ in range(STEPS):
        mixed = p @ share
        fit = float(n @ np.log(mixed))
        if fit - last < CLOSE * total:
            break
        last = fit
        share = share * ((n / mixed) @ p) / total
    return share, float(n @ np.log(p @ share))


def train(rows: DataFrame) -> Model:
    """A model from all rows of ``rows (text, lang)``; rows with nulls are no evidence."""
    used = rows.select("text", "lang").filter("text is not null and lang is not null")
    counts = used.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = common.written(counts, "trigrams")
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    at = {x: k for k, x in enumerate(languages)}
    found = counts.toPandas()  # at most MAX_LANGUAGES * BUCKETS rows
    table = np.zeros((BUCKETS, len(languages)))
    table[found["bucket"].to_numpy(dtype=np.int64), found["lang"].map(at).to_numpy(dtype=np.int64)] = found["n"].to_numpy()
    return Model(languages, table)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs (doc_id, held_out, text)`` with lang_pred, score and mixture instead of text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model([], np.zeros((0, 0)))
        own.languages, own.p = shared.value
        own.log_p = np.log(own.p)
        for batch in batches:
            found = [own.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([",".join(f"{k}:{round(100 * v)}" for k, v in sorted(x[2].items())) for x in found], pa.string()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "mixture"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, mixture string"
    )


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, mixture`` per row of ``docs (doc_id, text, lang)``.

    Trained on the rows whose crc32(doc_id) modulo 5 is not 0; predictions see the text
    only. ``mixture`` lists languages with their per cents. A null text, one without a
    letter, and any text when nothing could be learned is ``und`` with score 0. A row
    without an id is not held out and not learned from. Repeated rows get equal results;
    an empty table gives an empty table; other columns are ignored.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = train(docs.filter(fold != 0))
    return predict(docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text"), model)


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
