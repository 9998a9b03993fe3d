"""Language identification by a blended-spectrum presence kernel with Nystroem landmarks and kernel ridge regression.

The kernel of two texts is the number of character n-grams (n = 1 to 3) present in both, over the root of the
product of their numbers of n-grams. Landmark texts span its feature space; one ridge regression per language
against the rest is fitted on a bounded sample of labelled rows, and texts are scored by batched matrix
products. Results for odd rows: a text that is null or has no letter is ``und`` with score 0, as is every text
when no labelled row exists; repeated rows repeat; equal scores go to the language first in order; an empty
table gives an empty one; a null doc_id counts as the empty text in the fold rule; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import arrow_map, kind_of

UNDETERMINED = "und"
#: Bounds of the fit: labelled rows over all languages, landmarks, and the ridge.
SAMPLE_ROWS, LANDMARKS, RIDGE = 2000, 192, 1e-3
#: Letters whose n-grams have a byte each; number 0 is all that is no letter, the last number all other letters, whose
#: n-grams are kept as codes.
ALPHABET = 62
_POINTS = 0x110000
_UNI, _BI, _TRI = 0, 64, 64 + 64**2
FEATURES = _TRI + 64**3


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


class Spectrum:
    """Presence of n-grams: a byte per n-gram of the letters most common in the sample, a code per other n-gram."""

    def __init__(self, texts: list[str]):
        counts = np.zeros(0x110000, np.int64)
        for text in texts:
            counts += np.bincount(self._points(text), minlength=len(counts))
        letters = [p for p in np.argsort(-counts, kind="stable")[:1000] if counts[p] and chr(p).isalpha()][:ALPHABET]
        self.numbers = np.zeros(0x110000, np.uint8)
        other = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        self.numbers[other] = ALPHABET + 1
        self.numbers[letters] = np.arange(1, len(letters) + 1, dtype=np.uint8)

    @staticmethod
    def _points(text: str) -> np.ndarray:
        return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)

    def grams(self, text: str, flags: np.ndarray) -> np.ndarray:
        """Set ``flags`` to the n-grams that the text has; returns the sorted codes of those with another letter."""
        flags[:] = False
        points = self._points(text)
        c = np.concatenate([[0], self.numbers[points], [0]]).astype(np.int32)
        pair = c[:-1] * 64 + c[1:]
        other = c == ALPHABET + 1
        if not other.any():
            flags[_UNI + c] = True
            flags[_BI + pair] = True
            flags[_TRI + pair[:-1] * 64 + c[2:]] = True
            flags[[_UNI, _BI, _TRI]] = False
            return np.zeros(0, np.int64)
        two = other[:-1] | other[1:]
        three = two[:-1] | other[2:]
        flags[_UNI + c[~other]] = True
        flags[_BI + pair[~two]] = True
        flags[_TRI + (pair[:-1] * 64 + c[2:])[~three]] = True
        flags[[_UNI, _BI, _TRI]] = False
        p = np.where(c > 0, np.concatenate([[0], points, [0]]), 0).astype(np.int64)
        couple = p[:-1] * _POINTS + p[1:]
        triple = couple[:-1] * _POINTS + p[2:]  # below _POINTS**3; the others follow
        return np.unique(np.concatenate([triple[three], _POINTS**3 + couple[two], _POINTS**3 + _POINTS**2 + p[other]]))

    def present(self, text: str, flags: np.ndarray) -> int:
        """Set ``flags`` as ``grams`` does; returns the number of n-grams that the text has."""
        others = self.grams(text, flags)
        return int(np.count_nonzero(flags)) + len(others)


@dataclass
class Classifier:
    spectrum: Spectrum
    languages: list[str]
    columns: np.ndarray  # n-grams that any landmark has
    landmarks: np.ndarray  # columns x landmarks, scaled
    codes: np.ndarray  # other n-grams that any landmark has, sorted
    starts: np.ndarray  # where the landmarks of each code start in owners; one more at the end
    owners: np.ndarray  # landmarks of the codes
    scales: np.ndarray  # of the landmarks
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def kernel(self, texts: list[str]) -> np.ndarray:
        rows = np.zeros((len(texts), len(self.columns)), np.float32)
        flags, norms = np.zeros(FEATURES, bool), np.ones(len(texts), np.float32)
        shared = np.zeros((len(texts), len(self.scales)), np.float32)
        for i, text in enumerate(texts):
            others = self.spectrum.grams(text, flags)
            norms[i] = max(1, int(np.count_nonzero(flags)) + len(others)) ** 0.5
            rows[i] = flags[self.columns]
            if len(others) and len(self.codes):
                shared[i] = self._shared(others) * self.scales
        return (rows @ self.landmarks + shared) / norms[:, None]

    def _shared(self, others: np.ndarray) -> np.ndarray:
        """How many of the sorted codes each landmark has."""
        at = np.searchsorted(self.codes, others)
        at = at[self.codes[np.minimum(at, len(self.codes) - 1)] == others]
        sizes = self.starts[at + 1] - self.starts[at]
        places = np.repeat(self.starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.bincount(self.owners[places], minlength=len(self.scales))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if has_letter(t)]
        for start in range(0, len(at), 256):
            part = at[start:start + 256]
            values = self.kernel([texts[i] for i in part]) @ self.weights + self.bias
            best = values.argmax(axis=1)
            for i, k, v in zip(part, best, np.clip((values.max(axis=1) + 1) / 2, 0, 1)):
                names[i], scores[i] = self.languages[k], float(v)
        return names, scores


def labelled_sample(docs: DataFrame, rows: int) -> list[tuple[str, str]]:
    """At most ``rows`` (text, lang) of the training folds, equally many of each language, by hash of id and text."""
    usable = docs.where((fold(F.col("doc_id")) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    each = max(1, rows // len(counts))
    parts = 1 << 30
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(parts, int(parts * 1.3 * (each + 20) / n)))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))
    found = usable.where(place < share).select("lang", "text", place.alias("place")).collect()
    taken: dict[str, int] = {}
    sample = []
    for r in sorted(found, key=lambda r: (r["place"], r["lang"], r["text"])):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= each and has_letter(r["text"]):
            sample.append((r["text"], r["lang"]))
    return sample


def fit(sample: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Classifier | None:
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return None
    spectrum = Spectrum([t for t, _ in sample])
    queues = [[t for t, lang in sample if lang == one] for one in languages]
    chosen = [q[i] for i in range(max(map(len, queues))) for q in queues if i < len(q)][:landmarks]
    flags, rows, rest = np.zeros(FEATURES, bool), [], []
    for text in chosen:
        rest.append(spectrum.grams(text, flags))
        own = np.flatnonzero(flags)
        rows.append((own, max(1, len(own) + len(rest[-1])) ** -0.5))
    columns = np.unique(np.concatenate([r for r, _ in rows]))
    table = np.zeros((len(columns), len(chosen)), np.float32)
    for j, (r, scale) in enumerate(rows):
        table[np.searchsorted(columns, r), j] = scale
    codes = np.concatenate(rest)
    order = np.argsort(codes, kind="stable")
    owners = np.repeat(np.arange(len(chosen), dtype=np.uint16), list(map(len, rest)))[order]
    codes, starts = np.unique(codes[order], return_index=True)
    scales = np.array([scale for _, scale in rows], np.float32)
    model = Classifier(spectrum, languages, columns, table, codes, np.append(starts, len(owners)), owners, scales, np.zeros((len(chosen), len(languages))), np.zeros(len(languages)))
    between = model.kernel(chosen).astype(float)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    good = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, good] / np.sqrt(values[good])  # Nystroem map: kernel row times this
    seen = np.concatenate([model.kernel([t for t, _ in sample[i:i + 256]]) for i in range(0, len(sample), 256)]) @ root
    target = np.where(np.array([lang for _, lang in sample])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    mean, bias = seen.mean(axis=0), target.mean(axis=0)
    centred = seen - mean
    solved = np.linalg.solve(centred.T @ centred + ridge * len(sample) * np.eye(seen.shape[1]), centred.T @ (target - bias))
    model.weights, model.bias = root @ solved, bias - mean @ solved
    return model


def identify(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and text_hash (of the raw text) per document."""
    model = fit(labelled_sample(docs, sample_rows), landmarks)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the n-grams of the landmarks

    def run(cols: dict[str, list]) -> dict[str, list]:
        one = shared.value
        n = len(cols["text"])
        names, scores = one.predict(cols["text"]) if one else ([UNDETERMINED] * n, [0.0] * n)
        return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": names, "score": scores,
                "text_hash": cols["text_hash"]}

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 1).alias("held_out"), F.xxhash64("text").alias("text_hash"), "text")
    return arrow_map(rows, run, f"doc_id {kind_of(docs, 'doc_id')}, held_out boolean, lang_pred string, score double, text_hash long")
