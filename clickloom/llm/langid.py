"""Language identification with a string kernel, Nyström landmarks and one-versus-rest kernel ridge regression.

A text is lower-cased, anything but letters becomes a space, and the kernel of two texts is the number of n-grams
of 1 to `longest` letters that are present in both, over a vocabulary that the languages of a sample use most, divided by the root
of both texts' own numbers. Landmarks, sampled texts of every language, span a feature space (Nyström); ridge regression in it gives
one function per language. Whole texts are scored in batches: a presence matrix times the landmarks' presence, times the coefficients.

Learns from a bounded sample: of each language the `per_language` rows with the smallest hashes among those that are
not held out (crc32 of the doc_id as text, mod 4, is 2) and have at most `most_bytes` bytes. The language, source and doc_id of a text are
never inputs of its prediction.

Results for odd input: null text and text without a letter: `und`, score 0. A text with letters but none of the vocabulary's
n-grams: the language with the largest intercept. Null lang: predicted, not learned from. Null doc_id: held_out null, not learned
from. Repeated rows: one result each. Nothing to learn from: `und`. Ties: the first language by name. Empty table: no rows. Other
columns are ignored.
"""

from __future__ import annotations

import collections
import dataclasses
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import sampled, small_batches

SLOT_BITS = 20
_LETTER = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(sys.maxunicode + 1)), bool)
    return _LETTER


def grams(texts: list[str], longest: int):
    """(slots, rows) of the n-grams of lower-cased texts, one pair per n; and whether each text has a letter."""
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in texts])
    rows = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[:len(points)]
    letter = _letters()[points] if len(points) else np.zeros(0, bool)
    has = np.bincount(rows[letter], minlength=len(texts)) > 0
    code = np.where(letter, points, np.uint32(32)) * np.uint32(2654435769) + np.uint32(977)
    # A space next to a space says nothing: runs of other signs count as one space.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code, rows = code[keep], rows[keep]
    out, rolled = [], np.zeros(len(code), np.uint32)
    for n in range(1, longest + 1):
        if len(code) < n:
            break
        rolled = rolled[:len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1:]
        spread = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(n)
        same = rows[:len(rolled)] == rows[n - 1:]
        out.append(((spread >> np.uint32(32 - SLOT_BITS))[same], rows[:len(rolled)][same]))
    return out, has


@dataclasses.dataclass
class Model:
    languages: list[str]
    longest: int
    places: np.ndarray       # slot -> place in the vocabulary, -1 outside
    size: int
    landmarks: np.ndarray    # presence of the landmarks, divided by the roots of their own numbers
    weights: np.ndarray      # landmark x language
    bias: np.ndarray

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, has = grams(texts, self.longest)
        out = np.zeros((len(texts), self.size), np.float32)
        for slots, rows in found:
            at = self.places[slots]
            hit = at >= 0
            out[rows[hit], at[hit]] = 1
        return out, has

    def kernel(self, present: np.ndarray) -> np.ndarray:
        own = np.sqrt(np.maximum(1, present.sum(axis=1)))
        return (present @ self.landmarks.T) / own[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts))
        present, has = self.presence(texts)
        margin = self.kernel(present).astype(np.float64) @ self.weights + self.bias
        best = margin.argmax(axis=1)
        share = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
        score = 1 / share.sum(axis=1)
        return [self.languages[b] if yes else "und" for b, yes in zip(best, has, strict=True)], np.where(has, score, 0.0)


def learn(rows: list[tuple[str, str]], longest: int, vocabulary: int, landmarks: int, ridge: float) -> Model:
    """A model of (text, language) rows."""
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([], longest, np.zeros(0, np.int32), 0, np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    texts, y = [t.lower() for t, _ in rows], np.array([languages.index(lang) for _, lang in rows])
    used = np.zeros((len(languages), 1 << SLOT_BITS), np.int32)
    for i in range(0, len(texts), 50):
        for slots, own in grams(texts[i:i + 50], longest)[0]:
            pairs = np.unique(own.astype(np.int64) << SLOT_BITS | slots)
            np.add.at(used, (y[i + (pairs >> SLOT_BITS)], pairs & ((1 << SLOT_BITS) - 1)), 1)
    each = max(1, vocabulary // len(languages))
    chosen = np.unique(np.concatenate([np.argsort(-u, kind="stable")[:each] for u in used]))
    chosen = chosen[used[:, chosen].sum(axis=0) > 0]
    places = np.full(1 << SLOT_BITS, -1, np.int16)
    places[chosen] = np.arange(len(chosen))
    model = Model(languages, longest, places, len(chosen), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    present = np.concatenate([model.presence(texts[i:i + 50])[0] for i in range(0, len(texts), 50)])
    order = collections.defaultdict(list)
    for i, c in enumerate(y):
        order[c].append(i)
    per = max(1, landmarks // len(languages))
    marks = [i for own in order.values() for i in own[::max(1, len(own) // per)][:per]]
    model.landmarks = present[marks] / np.sqrt(np.maximum(1, present[marks].sum(axis=1)))[:, None]
    # Nyström: the landmarks' own kernel matrix to the power -1/2 turns kernel values into features.
    among = model.kernel(present[marks]).astype(np.float64)
    values, basis = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6 * values.max()
    root = basis[:, good] / np.sqrt(values[good])
    phi = model.kernel(present).astype(np.float64) @ root
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # Each language weighs alike.
    weight = 1 / np.bincount(y, minlength=len(languages))[y]
    weight = weight / weight.mean()
    x = np.column_stack([phi, np.ones(len(phi))])
    beta = np.linalg.solve((x * weight[:, None]).T @ x + ridge * np.eye(x.shape[1]), (x * weight[:, None]).T @ target)
    model.weights, model.bias = root @ beta[:-1], beta[-1]
    return model


def identify(docs: DataFrame, per_language: int = 250, most_bytes: int = 20_000, longest: int = 4, vocabulary: int = 3000,
             landmarks: int = 96, ridge: float = 0.1) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", "lang").withColumn("held_out", F.expr("crc32(cast(doc_id as string)) % 4 = 2"))
    known = docs.where("not held_out and lang is not null and text is not null").where(F.octet_length("text") <= most_bytes)
    rows = sampled(known, ["doc_id", "text"], per_language, group="lang").select("text", "lang").collect()
    model = docs.sparkSession.sparkContext.broadcast(learn([(r.text, r.lang) for r in rows], longest, vocabulary, landmarks, ridge))

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(column: pa.Array) -> pa.Array:
        texts, langs, scores, begin = [(t or "").lower() for t in column.to_pylist()], [], [], 0
        while begin < len(texts):  # about a million letters, at most 256 texts at a time
            end, size = begin, 0
            while end < len(texts) and end - begin < 256 and size < 1_000_000:
                size += len(texts[end])
                end += 1
            own, score = model.value.predict(texts[begin:end])
            langs += own
            scores.append(score)
            begin = end
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))], ["lang_pred", "score"])

    return docs.select("doc_id", "held_out", predicted("text").alias("_found")).select("doc_id", "held_out", "_found.*")
