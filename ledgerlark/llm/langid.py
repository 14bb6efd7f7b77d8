"""Language ID by multilingual mixtures: expectation-maximisation over a text's words.

A model of hashed byte trigrams per language gives each word's likelihood in every language. For
each text, EM estimates the proportions of the languages among its words. Sets of languages, the
likeliest first, are then compared by penalised log-likelihood (half a log of the number of words
per language); the prediction is the largest proportion in the chosen set.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import flat, held_out

SLOTS = 1 << 15
#: Languages that a model may have; more raise. Its tables are then 64 MB at most.
LANGUAGES = 512
ROUNDS, SET_ROUNDS = 8, 3
CHUNK = 1 << 20
UND = "und"

#: Letters: A-Z and a-z and every byte of a character beyond ASCII; A-Z are lower-cased, the rest is a gap.
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def grams(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A slot for each letter (it and the two bytes before it), the slots before each word, and the words before each row."""
    buf, at = flat(column)
    # a gap before every row, and one at the end
    size = np.diff(at)
    place = np.arange(len(buf)) + np.repeat(np.arange(1, len(size) + 1), size)
    x = np.zeros(len(buf) + len(size) + 2, np.uint32)
    x[place] = _LETTER[buf]
    latin = (x[:-1] == 0xC3) & (x[1:] >= 0x80) & (x[1:] <= 0x9E) & (x[1:] != 0x97)  # capitals of Latin-1
    x[1:][latin] += 0x20
    # trigrams that end in a letter or just after a word's end
    here = np.flatnonzero(x[:-1] != 0)
    ends = here[x[here + 1] == 0] + 1
    mark = np.zeros(len(x), bool)
    mark[here] = mark[ends] = True
    inside = np.flatnonzero(mark)
    code = (x[inside - 2] << np.uint32(16)) * (x[inside - 1] != 0) | (x[inside - 1] << np.uint32(8)) | x[inside]
    slot = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    starts = np.searchsorted(inside, here[x[here - 1] == 0])
    first = np.searchsorted(here[x[here - 1] == 0], at + np.arange(len(at)))
    return slot, starts, first


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and the log probability of each slot in each; counted over all rows that are not held out.

    A row counts if its lang is not null and its id not held out. The driver gets one number per
    language and slot, however large the table; more than LANGUAGES languages raise ValueError.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                slot, starts, first = grams(part["text"])
                bounds = np.append(starts, len(slot))[first]
                for i, lang in enumerate(part["lang"].to_pylist()):
                    own = total.setdefault(lang, np.zeros(SLOTS, np.int64))
                    own += np.bincount(slot[bounds[i] : bounds[i + 1]], minlength=SLOTS)
        for lang, own in total.items():
            have = np.flatnonzero(own)
            yield pa.record_batch([pa.array([lang] * (len(have) + 1)), pa.array(np.append(have, -1).astype(np.int32)), pa.array(np.append(own[have], 1))], ["lang", "slot", "n"])

    known = docs.filter(F.col("lang").isNotNull() & ~held_out("doc_id")).selectExpr("cast(text as string) text", "cast(lang as string) lang")
    rows = known.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).limit(LANGUAGES * (SLOTS + 1) + 1).toArrow()
    names = sorted(set(rows["lang"].to_pylist()))
    if len(names) > LANGUAGES or rows.num_rows > LANGUAGES * (SLOTS + 1):
        raise ValueError(f"more than {LANGUAGES} languages")
    if not names:
        return [], np.zeros((SLOTS, 0), np.float32)
    which = np.array([names.index(x) for x in rows["lang"].to_pylist()])
    slot, n = np.asarray(rows["slot"]), np.asarray(rows["n"])
    counts = np.zeros((SLOTS, len(names)))
    counts[slot[slot >= 0], which[slot >= 0]] = n[slot >= 0]
    counts += 0.5
    return names, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each row's words; rows without any give 0."""
    out = np.zeros((len(first) - 1, *x.shape[1:]))
    have = np.flatnonzero(first[1:] > first[:-1])
    if len(have):
        out[have] = np.add.reduceat(x, first[:-1][have])
    return out


def mixtures(column, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the predicted language's number (-1: no words) and its proportion."""
    slot, starts, first = grams(column)
    n_lang, n_rows = logp.shape[1], len(first) - 1
    if not len(starts):
        return np.full(n_rows, -1), np.zeros(n_rows)
    ll = np.add.reduceat(logp[slot], starts)
    peak = ll.max(axis=1, keepdims=True)
    like = np.exp(ll - peak)
    row = np.repeat(np.arange(n_rows), np.diff(first))
    words = np.maximum(np.diff(first), 1)[:, None]

    def em(share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        for _ in range(rounds):
            part = like * share[row]
            part /= part.sum(axis=1, keepdims=True) + 1e-30
            share = _sums(part, first) / words
        return share, _sums(np.log((like * share[row]).sum(axis=1) + 1e-30), first)

    total = _sums(ll - peak, first)
    # likeliest first: by proportion, ties by the likelihood of the whole text
    share, _ = em(np.full((n_rows, n_lang), 1.0 / n_lang), ROUNDS)
    best = total.argmax(axis=1)
    best_fit, chosen, size = total.max(axis=1), np.zeros((n_rows, n_lang)), 1
    chosen[np.arange(n_rows), best] = 1.0
    penalty = 0.5 * np.log(words[:, 0] + 1.0)
    best_fit = best_fit - penalty
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1)
    for size in range(2, n_lang + 1):
        own = np.where(rank < size, share + 1e-9, 0)
        own, fit = em(own / own.sum(axis=1, keepdims=True), SET_ROUNDS)
        fit = fit - size * penalty
        better = fit > best_fit
        best_fit[better], chosen[better] = fit[better], own[better]
    lang = chosen.argmax(axis=1)
    score = np.clip(share[np.arange(n_rows), lang], 0, 1)
    return np.where(np.diff(first) > 0, lang, -1), score


def predict(docs: DataFrame, names: list[str], logp: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, from its text alone.

    A null text, one without any letter, and every text where no language was learned, is `und`,
    with score 0. Rows that repeat an id are predicted each by itself; a very long text by all of its
    words. Equal proportions go to the language that comes first. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast((names, logp))  # languages x slots, whatever the table's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logp = model.value
        for batch in batches:
            size = np.cumsum(np.diff(flat(batch["text"])[1]))
            cuts = [0, *(np.flatnonzero(np.diff(size // CHUNK)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(a, b - a)
                lang, score = mixtures(part["text"], logp) if names else (np.full(b - a, -1), np.zeros(b - a))
                buf, at = flat(part["text"])
                plain = (_LETTER[buf] != 0) & (buf < 0x80)
                count = np.concatenate([[0], np.cumsum(plain)])
                none = np.flatnonzero((np.diff(count[at]) == 0) & (lang >= 0))
                for i in none.tolist():  # letters beyond ASCII, or other characters?
                    if not any(map(str.isalpha, part["text"][i].as_py() or "")):
                        lang[i] = -1
                score[lang < 0] = 0
                yield pa.record_batch([part["doc_id"], part["held_out"], pa.array([names[i] if i >= 0 else UND for i in lang.tolist()], pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, *train(docs))
