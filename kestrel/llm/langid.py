"""Operator 8: language identification with language-bitmask n-gram filters.

Training keeps each language's most frequent character n-grams.  They go into a
bit-sliced Bloom filter: slot h holds a bitmask with one bit per language, so k
lookups ANDed together return all languages that contain an n-gram.  A text's
score for a language is the number of its n-grams whose mask has the
language's bit, corrected for the filter's false positives; the largest decides.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.store import columns
from kestrel.llm.text import fmix
from kestrel.plans.topk import top_k

GRAM = 3                  # code points of an n-gram
SAMPLE_DOCS = 2000        # labelled documents per language, at most
LANGUAGES = 256         # label values that are learned, by their documents
SPARE = 2                 # times the sample that the hash cut lets through
CUT_BITS = 40             # of the hash that the cut compares
GRAMS = 20_000            # n-grams kept per language, at most
SLOTS = 1 << 20           # of the filter
HASHES = 2
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> is a letter (Unicode category L)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list[str | None], n: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every n-gram, its text, letters per text).

    Texts are lower-cased and everything but letters is a blank; n-grams run over
    letters and blanks and hold a letter; each text begins and ends with a blank."""
    joined = [" " + (t or "").lower() + " " for t in texts]
    size = np.array([len(t) for t in joined])
    code = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[code]
    start = np.cumsum(size) - size
    counts = np.add.reduceat(letter.astype(np.int64), start) if len(size) else np.empty(0, np.int64)
    code = np.where(letter, code, 32).astype(np.uint64)
    if len(code) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64), counts
    owner = np.repeat(np.arange(len(size)), size)
    end = len(code) - n + 1
    key = np.zeros(end, np.uint64)
    some = np.zeros(end, bool)
    for k in range(n):
        key = (key << np.uint64(21)) | code[k:k + end]
        some |= letter[k:k + end]
    ok = some & (owner[:end] == owner[n - 1:])
    return fmix(key[ok]), owner[:end][ok], counts


def is_held_out() -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


class Filter:
    """Bit-sliced Bloom filter over languages; its size is fixed by ``slots``."""

    def __init__(self, languages: list[str], slots: int = SLOTS, hashes: int = HASHES):
        self.languages = sorted(languages)
        self.slots, self.hashes = slots, hashes
        self.planes = -(-max(1, len(self.languages)) // 64)
        self.bits = np.zeros((self.planes, slots), np.uint64)
        self.false = np.zeros(len(self.languages))

    def _slots(self, h: np.ndarray, k: int) -> np.ndarray:
        return (fmix(h + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.slots)).astype(np.int64)

    def add(self, language: str, h: np.ndarray) -> None:
        i = self.languages.index(language)
        for k in range(self.hashes):
            self.bits[i // 64, self._slots(h, k)] |= np.uint64(1 << (i % 64))
        held = np.count_nonzero(self.bits[i // 64] & np.uint64(1 << (i % 64)))
        self.false[i] = (held / self.slots) ** self.hashes

    def counts(self, h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(n, languages) n-grams found, corrected for false positives, and n-grams per text."""
        total = np.bincount(owner, minlength=n)
        out = np.zeros((n, len(self.languages)))
        for plane in range(self.planes):
            mask = self.bits[plane][self._slots(h, 0)]
            for k in range(1, self.hashes):
                mask = mask & self.bits[plane][self._slots(h, k)]
            for i in range(plane * 64, min(plane * 64 + 64, len(self.languages))):
                hit = ((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(bool)
                out[:, i] = np.bincount(owner[hit], minlength=n)
        return np.maximum(0, (out - total[:, None] * self.false) / np.maximum(1e-9, 1 - self.false)), total


def training_sample(known: DataFrame, sample_docs: int = SAMPLE_DOCS, languages: int = LANGUAGES) -> DataFrame:
    """(lang, text) of at most ``sample_docs`` distinct documents per language, the first in hash order.

    A cut on the hash, set from each language's count of documents, lets about
    ``SPARE`` times the sample into the shuffle, so that a language with a third of
    all rows sends no more than others.  Repeated rows count once.  Of more than
    ``languages`` label values only those with most documents are learned (ties by name), which
    bounds what comes to the driver and the filter, 8 MB per 64 languages."""
    known = known.withColumn("_h", F.xxhash64("doc_id", "text"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("_h", 0.02).alias("n"))
    sizes = sizes.orderBy(F.col("n").desc(), "lang").limit(languages).collect()
    whole = 1 << CUT_BITS
    cut = [F.lit(x) for r in sizes for x in (r["lang"], min(whole, -(-whole * SPARE * sample_docs // max(1, r["n"]))))]
    few = known.where(F.pmod("_h", F.lit(whole)) < (F.create_map(*cut)[F.col("lang")] if cut else F.lit(0)))
    return top_k(few.dropDuplicates(["lang", "_h"]), ["lang"], [F.col("_h")], sample_docs).select("lang", "text")


def train(docs: DataFrame, n: int = GRAM, sample_docs: int = SAMPLE_DOCS, keep: int = GRAMS,
          slots: int = SLOTS, hashes: int = HASHES) -> Filter:
    """Fit the filter on documents that are not held out and have a text and a language.

    It learns from at most ``sample_docs`` distinct documents per language; at most
    ``keep`` n-grams per language come to the driver."""
    known = (docs.select(*columns(docs, "doc_id", "text", "lang"))
             .where(~is_held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull()))
    some = training_sample(known, sample_docs)

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.slice(at, 200)
                h, owner, _ = grams(part["text"].to_pylist(), n)
                langs = part["lang"].to_pylist()
                names = sorted(set(langs))
                of = np.array([names.index(x) for x in langs])
                pairs, count = np.unique(np.stack([of[owner].astype(np.uint64), h], axis=1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[int(i)] for i in pairs[:, 0]], pa.string()),
                     pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64)), pa.array(count)],
                    names=["lang", "gram", "n"])
    counted = (some.mapInArrow(run, "lang string, gram bigint, n bigint")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # N-grams seen once tell little; they only fill up what frequent ones leave of ``keep``.
    best = top_k(counted, ["lang"], [F.col("n").desc(), F.col("gram")], keep).select("lang", "gram").toArrow()
    languages = best["lang"].to_pylist()
    out = Filter(sorted(set(languages)), slots, hashes)
    gram, of = best["gram"].to_numpy().view(np.uint64), np.array(languages, dtype=object)
    for language in out.languages:
        out.add(language, gram[of == language])
    return out


def predict(docs: DataFrame, model: Filter, n: int = GRAM) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, held_out, lang_pred, score.

    ``lang_pred`` is ``und`` with score 0 for null texts, texts without a letter, and
    when nothing was learned; the score is the share of the text's n-grams, after the
    correction, that the language holds.  Ties go to the first language by name.
    Repeated rows give repeated results; extra columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for at in range(0, len(batch), 100):
                part = batch.slice(at, 100)
                h, owner, letters = grams(part["text"].to_pylist(), n)
                count, total = m.counts(h, owner, len(part))
                names = np.array([*m.languages, UNKNOWN], dtype=object)
                known = (letters > 0) & bool(m.languages)
                best = count.argmax(axis=1) if m.languages else np.zeros(len(part), int)
                top = count[np.arange(len(part)), best] if m.languages else np.zeros(len(part))
                score = np.clip(top / np.maximum(1, total), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["held_out"], pa.array(names[np.where(known, best, len(names) - 1)], pa.string()),
                     pa.array(np.where(known, score, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])
    own = docs.select(*columns(docs, "doc_id", "text")).select("doc_id", "text", is_held_out().alias("held_out"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_query(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
