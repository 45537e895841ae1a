"""Toxicity by compression distance: two trained zstandard dictionaries, compared window by window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard as zstd
from pyspark.sql import DataFrame

from mergewell.llm.common import logistic, probability, training_rows

#: Most labelled documents of either class that the model is fitted on; they are read whole.
PER_CLASS = 1200
#: Words in a window; windows follow one another and cover the whole text.
WINDOW = 6
#: Bytes to which a longer window (words without white space) is cut, and by how many its parts overlap.
LONG_WINDOW, OVERLAP = 1024, 64
#: Sizes of the dictionaries: toxic, ordinary, and ordinary windows that a toxic dictionary shortened by mistake.
TOXIC_BYTES, ORDINARY_BYTES, MISTAKEN_BYTES = 8192, 100_000, 8192
#: Bytes of the segments from which a dictionary is put together, and of the strings that are counted.
SEGMENT, COUNTED, COUNTED_ORDINARY = 16, 8, 6
#: Rounds of training the toxic dictionary on the windows that stand out.
ROUNDS = 4
#: Parts of the sample; each is measured with dictionaries trained on the others to calibrate the thresholds.
FOLDS = 3
#: How much more frequent among toxic windows a saving must be for its windows to train the next round.
STANDS_OUT = 4.0
#: Fewest windows that a round trains on.
FEWEST = 20
#: Bytes saved from which each threshold's evidence is calibrated apart; larger savings count as the last.
LARGEST = 10
#: Stands before each window and at the end of both dictionaries, so that every window compresses and a match of any length shows.
HEADER = b"\n" * 32
#: Stands after each window: zstandard starts no match in the last sixteen bytes where dictionaries are large.
TRAILER = b"\n" * 18


def windows(text: bytes) -> Iterator[bytes]:
    """The whole lower-cased text, WINDOW words at a time; a long window is cut into overlapping parts."""
    words = text.decode("utf-8", "replace").lower().encode().split()
    for i in range(0, len(words), WINDOW):
        part = b" " + b" ".join(words[i : i + WINDOW]) + b" "
        if len(part) <= LONG_WINDOW:
            yield part
        else:
            for j in range(0, len(part), LONG_WINDOW - OVERLAP):
                yield part[j : j + LONG_WINDOW]


def dictionary(size: int, texts: list[bytes], counted: int) -> bytes:
    """A zstandard dictionary trained on all the texts; the texts themselves, in order, where they are too few to train on.

    The trainer stops early where a stretch of its input holds nothing that repeats, as a long document
    of junk does; so it gets the texts in the order of a hash.
    """
    try:
        return zstd.train_dictionary(size, sorted((t for t in texts if t), key=hash_order), k=SEGMENT, d=counted, level=3).as_bytes()
    except (zstd.ZstdError, ValueError):
        return b"".join(sorted(set(texts)))[:size]


def compressor(content: bytes) -> zstd.ZstdCompressor:
    how = zstd.ZstdCompressionParameters(window_log=17, chain_log=16, hash_log=16, search_log=4, min_match=4, target_length=64, strategy=zstd.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstd.ZstdCompressionDict(content + HEADER, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=how)
    return zstd.ZstdCompressor(dict_data=held, compression_params=how)


def savings(ordinary: zstd.ZstdCompressor, toxic: zstd.ZstdCompressor, parts) -> np.ndarray:
    """By how many bytes the toxic dictionary makes each window shorter than the ordinary one does."""
    framed = (HEADER + w + TRAILER for w in parts)
    return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in framed], np.int64)


def trained_pair(toxic_texts: list[bytes], ordinary_texts: list[bytes]) -> tuple[bytes, bytes]:
    """The contents (ordinary, toxic) of the two compressors.

    The ordinary dictionary is trained on all windows of ordinary texts. The toxic one starts from all of
    toxic texts, most of whose windows are ordinary prose; so texts are halved, each half's windows are
    measured with the dictionary of the other half, and those with a saving that is STANDS_OUT times as
    frequent among toxic windows as among ordinary ones train the next dictionary. Ordinary windows
    that a toxic dictionary shortens train one of their own, which both compressors then hold. Copies
    of a text or window count once. The toxic compressor holds the ordinary content behind its own, so
    an ordinary window costs the same with either.
    """
    halves, ordinary_halves, seen = [], [], set()
    for texts, out in ((toxic_texts, halves), (ordinary_texts, ordinary_halves)):
        distinct = sorted(set(texts), key=hash_order)
        for part in (distinct[0::2], distinct[1::2]):
            held = []
            for text in part:
                for w in windows(text):
                    if w not in seen:
                        seen.add(w)
                        held.append(w)
            out.append(held)
    shared = dictionary(ORDINARY_BYTES, ordinary_halves[0] + ordinary_halves[1], COUNTED_ORDINARY)
    chosen = halves
    mistaken: list[list[bytes]] = [[], []]
    for _ in range(ROUNDS):
        following, wrong = [[], []], [[], []]
        for a in (0, 1):
            b = 1 - a
            base = (dictionary(MISTAKEN_BYTES, mistaken[a], COUNTED) if len(mistaken[a]) >= FEWEST else b"") + shared
            ordinary, toxic = compressor(base), compressor(dictionary(TOXIC_BYTES, chosen[a], COUNTED) + base)
            mine, others = savings(ordinary, toxic, halves[b]), savings(ordinary, toxic, ordinary_halves[b])
            least = 1
            for t in range(1, 40):
                if (mine >= t).sum() < FEWEST:
                    break
                least = t
                if (mine >= t).mean() >= STANDS_OUT * ((others >= t).sum() + 1) / (len(others) + 1):
                    break
            following[b] = [w for w, s in zip(halves[b], mine) if s >= least] or chosen[b]
            wrong[b] = mistaken[b] + [w for w, s in zip(ordinary_halves[b], others) if s >= 2]
        chosen, mistaken = following, wrong
    both = mistaken[0] + mistaken[1]
    base = (dictionary(MISTAKEN_BYTES, both, COUNTED) if len(both) >= FEWEST else b"") + shared
    return base, dictionary(TOXIC_BYTES, chosen[0] + chosen[1], COUNTED) + base


def hash_order(text: bytes) -> tuple[int, bytes]:
    from zlib import crc32

    return crc32(text), text


def best_cut(told: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The value from which rows are called toxic with the best balance (F1) of those caught and those called so wrongly, halfway to the next lower one."""
    order = np.argsort(-told, kind="stable")
    caught, called = np.cumsum((weight * toxic)[order]), np.cumsum(weight[order])
    last = np.append(np.diff(told[order]) < 0, True)  # equal values stand or fall together
    quality = np.where(last, 2 * caught / (called + (weight * toxic).sum()), 0)
    at = int(quality.argmax())
    return float((told[order][at] + told[order][min(at + 1, len(order) - 1)]) / 2)


class ToxicityModel:
    """Two dictionaries and the calibrated evidence of each threshold on the bytes that the toxic one saves.

    Each document of the sample is measured with dictionaries trained on other folds. Each number of
    bytes saved gets the log of how much more frequent it is among windows of toxic documents; a text's
    evidence is the sum over its windows. Scores rise with it; 0.5 is where these documents are told apart best. Without both classes the score is the share of toxic labels. An empty
    text has one window without saving.
    """

    def __init__(self, samples: list[tuple[bytes, bool]], counts: dict[bool, int]):
        total = sum(counts.values())
        self.share = counts.get(True, 0) / total if total else 0.0
        toxic = np.array([y for _, y in samples], bool)
        self.ready = len(samples) >= 8 and 3 < toxic.sum() < len(toxic) - 3
        self._pair = None
        if not self.ready:
            return
        fold = np.zeros(len(samples), int)
        order = np.random.RandomState(5)
        for y in (False, True):
            mine = order.permutation(np.flatnonzero(toxic == y))
            fold[mine] = np.arange(len(mine)) % FOLDS
        held = np.zeros((len(samples), LARGEST + 1), np.int64)
        for k in range(FOLDS):
            self._train([s for s, f in zip(samples, fold) if f != k])
            for i in np.flatnonzero(fold == k):
                held[i] = self._bins(samples[i][0])
        self._train(samples)
        seen = np.array([held[~toxic].sum(0), held[toxic].sum(0)]) + 0.5
        self.evidence = np.log((seen[1] / seen[1].sum()) / (seen[0] / seen[0].sum()))
        self.evidence[1:] = np.maximum.accumulate(self.evidence[1:])  # more bytes saved are never less evidence
        weight = np.where(toxic, counts[True] / toxic.sum(), counts[False] / (~toxic).sum())
        features = np.array([self._features(b) for b in held])
        mean, scale, beta = self.calibration = logistic(features, toxic.astype(float), weight)
        told = ((features - mean) / scale) @ beta[:-1] + beta[-1]
        beta[-1] -= best_cut(told, toxic, weight)

    def _train(self, samples: list[tuple[bytes, bool]]) -> None:
        self.ordinary, self.toxic = trained_pair([t for t, y in samples if y], [t for t, y in samples if not y])
        self._pair = None

    def __getstate__(self):
        return self.__dict__ | {"_pair": None}

    def _bins(self, text: bytes) -> np.ndarray:
        if self._pair is None:
            self._pair = compressor(self.ordinary), compressor(self.toxic)
        saved = savings(*self._pair, windows(text))
        return np.bincount(np.clip(saved, 0, LARGEST), minlength=LARGEST + 1) if len(saved) else np.eye(1, LARGEST + 1, dtype=np.int64)[0]

    def _features(self, bins: np.ndarray) -> tuple[float, float, float]:
        told = float(bins @ self.evidence)
        return told, told / float(np.sqrt(bins.sum())), float(np.log(bins.sum()))

    def score(self, texts: Iterator[bytes]) -> np.ndarray:
        if not self.ready:
            return np.full(sum(1 for _ in texts), self.share)
        features = [self._features(self._bins(t)) for t in texts]
        return probability(self.calibration, np.array(features)) if features else np.zeros(0)


def train_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> ToxicityModel:
    """Fits on at most per_class labelled documents of either class, none of them held out. Null, empty and repeated rows: see training_rows."""
    return ToxicityModel(*training_rows(documents, labels, label, per_class))
