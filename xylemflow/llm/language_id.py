"""Language of each word, and of each document, by a linear-chain conditional random field.

Word features are affixes, character n-grams, the word itself and its place in lexicons of the
training sample; label transitions are learned with them. Training maximises the likelihood of
short word sequences from a bounded sample of labelled documents; some are spliced from two
documents of different languages, so that switches are seen. Inference runs forward-backward over
stretches of :data:`STRETCH` words of the whole text, many at a time, and sums the posteriors.

A word is a run of letters; marks and format characters in it are dropped, and everything else ends
it. Runs of more than :data:`PIECE` letters, as in scripts without blanks, are cut into consecutive
words of about equal length, so that all their letters count.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text if
nothing is labelled; ties go to the smaller language; a row with a null ``doc_id`` is predicted, is
not held out and is never learned from. Only ``text`` is an input of a prediction.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections import ChainMap, Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.llm.postings import mapper
from xylemflow.llm.staging import unique_names
from xylemflow.llm.tokens import spans

UNKNOWN = "und"
#: Bounds of the training sample: documents per language, sequences per document, words of each.
TRAIN_DOCUMENTS, TRAIN_SEQUENCES, TRAIN_WORDS = 400, 6, 32
FEATURES = 1 << 17
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.25, 1e-6
STRETCH, SLICE_WORDS, CACHE_WORDS = 64, 200_000, 300_000
#: Letters of the longest word, and of the longest text between blanks whose words are cached.
PIECE, CACHE_LETTERS = 16, 64
#: Stretches that forward-backward takes at a time.
STRETCHES = 4096
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class _Letters(dict):
    """Code points of letters to themselves, of marks and format characters to none, others to a blank."""

    def __missing__(self, code: int) -> int | None:
        kind = unicodedata.category(chr(code))
        self[code] = code if chr(code).isalpha() else None if kind[0] == "M" or kind == "Cf" else 32
        return self[code]


_LETTERS = _Letters()


def words_of(text: str) -> list[str]:
    """Words of a text in lower case, none longer than :data:`PIECE`."""
    out = []
    for run in text.lower().translate(_LETTERS).split():
        if len(run) <= PIECE:
            out.append(run)
        else:
            size = -(-len(run) // -(-len(run) // PIECE))
            out += [run[i : i + size] for i in range(0, len(run), size)]
    return out


def word_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed affixes, n-grams, word and lexicon entry of a lower-case word."""
    edged = f"^{word}$"
    names = {edged, "w" + word}
    names.update(edged[i : i + n] for n in (2, 3, 4) for i in range(len(edged) - n + 1))
    names.update("p" + word[:n] for n in (1, 2, 3))
    names.update("s" + word[-n:] for n in (1, 2, 3))
    if word in lexicon:
        names.add(f"lexicon {lexicon[word]}")
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages
    transitions: np.ndarray  # from x to, log scale
    lexicon: dict[str, int]


def _posteriors(emission: np.ndarray, mask: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over ``sequences x steps x labels`` potentials.

    Masked steps come last in a sequence. Returns label posteriors, the scaled forward messages
    and the scaled backward messages.
    """
    sequences, steps, labels = emission.shape
    forward, backward = np.empty_like(emission), np.empty_like(emission)
    forward[:, 0] = emission[:, 0] / emission[:, 0].sum(1, keepdims=True)
    for t in range(1, steps):
        ahead = (forward[:, t - 1] @ transition) * emission[:, t]
        ahead /= ahead.sum(1, keepdims=True)
        forward[:, t] = np.where(mask[:, t, None], ahead, forward[:, t - 1])
    backward[:, -1] = 1.0 / labels
    for t in range(steps - 2, -1, -1):
        behind = (backward[:, t + 1] * emission[:, t + 1]) @ transition.T
        behind /= behind.sum(1, keepdims=True)
        backward[:, t] = np.where(mask[:, t + 1, None], behind, backward[:, t + 1])
    posterior = forward * backward
    posterior /= posterior.sum(2, keepdims=True)
    return posterior, forward, backward


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, text`` to at most :data:`TRAIN_SEQUENCES` word sequences of each, spread over the text."""
    for batch in batches:
        rows = []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text or "")
            step = max(TRAIN_WORDS, len(words) // TRAIN_SEQUENCES)
            rows += [(lang, " ".join(words[a : a + TRAIN_WORDS])) for a in range(0, len(words), step)][:TRAIN_SEQUENCES]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["lang", "words"])


def training_sample(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """Bounded, reproducible word sequences with their language, from the training folds."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return []
    shares = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1 << 30, math.ceil(TRAIN_DOCUMENTS / n * (1 << 30)))))])
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < shares[F.col("lang")])
    rows = chosen.select("lang", "text").mapInArrow(_training_rows, "lang string, words string").collect()
    return sorted((r["lang"], r["words"].split(" ")) for r in rows)


def _lexicon(sample: list[tuple[str, list[str]]], place: dict[str, int]) -> dict[str, int]:
    """Words that are frequent in one language of the sample and nearly only there."""
    by_language = Counter((w, place[lang]) for lang, words in sample for w in words)
    totals = Counter(w for _, words in sample for w in words)
    return {w: k for (w, k), n in by_language.items() if n >= 5 and n >= 0.9 * totals[w]}


def fit(sample: list[tuple[str, list[str]]], seed: int = 7) -> Model | None:
    """Train on sequences of equal label and on spliced ones, by AdaGrad on the log-likelihood."""
    if not sample:
        return None
    languages = sorted({lang for lang, _ in sample})
    place = {lang: k for k, lang in enumerate(languages)}
    lexicon = _lexicon(sample, place)
    random = np.random.default_rng(seed)
    sequences = [([(w, place[lang]) for w in words]) for lang, words in sample]
    for _ in range(len(sequences) // 4):
        a, b = sequences[random.integers(len(sample))], sequences[random.integers(len(sample))]
        if a[0][1] != b[0][1]:
            sequences.append(a[: TRAIN_WORDS // 2] + b[: TRAIN_WORDS // 2])
    vocabulary = sorted({w for s in sequences for w, _ in s})
    index = {w: i for i, w in enumerate(vocabulary)}
    features = [np.array(word_features(w, lexicon)) for w in vocabulary]
    widths = np.array([len(f) for f in features])
    flat, starts = np.concatenate(features), np.cumsum(widths) - widths
    words = np.zeros((len(sequences), TRAIN_WORDS), np.int64)
    labels = np.full((len(sequences), TRAIN_WORDS), -1)
    for i, s in enumerate(sequences):
        words[i, : len(s)] = [index[w] for w, _ in s]
        labels[i, : len(s)] = [k for _, k in s]
    count = len(languages)
    weights, transitions = np.zeros((FEATURES, count)), np.zeros((count, count))
    weight_square, transition_square = np.full((FEATURES, count), 1e-3), np.full((count, count), 1e-3)
    for _ in range(EPOCHS):
        order = random.permutation(len(sequences))
        for low in range(0, len(order), BATCH):
            at = order[low : low + BATCH]
            w, y = words[at], labels[at]
            mask = y >= 0
            used, inverse = np.unique(w[mask], return_inverse=True)
            ids = np.concatenate([flat[starts[u] : starts[u] + widths[u]] for u in used])
            bounds = np.cumsum(widths[used]) - widths[used]
            score = np.add.reduceat(weights[ids], bounds)
            emission = np.ones((*y.shape, count))
            emission[mask] = np.exp(score - score.max(1, keepdims=True))[inverse]
            transition = np.exp(transitions)
            posterior, forward, backward = _posteriors(emission, mask, transition)
            error = -posterior[mask]
            error[np.arange(len(error)), y[mask]] += 1
            per_word = np.zeros((len(used), count))
            np.add.at(per_word, inverse, error)
            owner = np.repeat(np.arange(len(used)), widths[used])
            gradient = np.stack([np.bincount(ids, per_word[owner, k], FEATURES) for k in range(count)], 1) / len(at)
            step = gradient - DECAY * weights
            weight_square += step**2
            weights += RATE * step / np.sqrt(weight_square)
            pair = np.einsum("nti,ij,ntj->ntij", forward[:, :-1], transition, emission[:, 1:] * backward[:, 1:])
            pair /= pair.sum((2, 3), keepdims=True)
            both = mask[:, 1:]
            expected = pair[both].sum(0)
            seen = np.zeros((count, count))
            np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
            step = (seen - expected) / len(at) - 1e-3 * transitions
            transition_square += step**2
            transitions += RATE * step / np.sqrt(transition_square)
    return Model(languages, weights.astype(np.float32), transitions.astype(np.float32), lexicon)


class Labeller:
    """A model with a bounded cache of word potentials."""

    def __init__(self, model: Model):
        self.model = model
        self.transition = np.exp(model.transitions).astype(np.float32)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {"": -1}
        self.several: list[list[int]] = []
        self.by_letters: dict[str, int] = {}
        self.potentials = np.ones((0, len(self.model.languages)), np.float32)

    def _place(self, raw: str, new: list[str]) -> int:
        """The index of a text of one word, -1 for none, and -2 or less, a place in ``several``, for more.

        Words not seen before are added to ``new``.
        """
        found = words_of(raw)
        for word in found:
            if word not in self.by_letters:
                self.by_letters[word] = len(self.potentials) + len(new)
                new.append(word)
        if len(found) < 2:
            return self.by_letters[found[0]] if found else -1
        self.several.append([self.by_letters[w] for w in found])
        return -1 - len(self.several)

    def look_up(self, texts: list[str]) -> list[np.ndarray]:
        """Indices of the words of each text."""
        if len(self.index) + len(self.by_letters) > 2 * CACHE_WORDS:
            self.clear()
        new: list[str] = []
        found = []
        for text in texts:
            parts = [np.zeros(0, np.int64)]
            for span in spans(text):
                words = span.split(" ")
                fresh = set(words).difference(self.index)
                self.index.update((raw, self._place(raw, new)) for raw in fresh if len(raw) <= CACHE_LETTERS)
                kept = len(self.several)
                long = {raw: self._place(raw, new) for raw in fresh if len(raw) > CACHE_LETTERS}
                index = ChainMap(self.index, long) if long else self.index
                at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                if (at < -1).any():
                    many = [self.several[-2 - k] if k < -1 else (k,) for k in at.tolist()]
                    at = np.fromiter(chain.from_iterable(many), np.int64, sum(map(len, many)))
                del self.several[kept:]
                parts.append(at[at >= 0])
            found.append(np.concatenate(parts))
        if new:
            features = [word_features(w, self.model.lexicon) for w in new]
            ids = np.concatenate([np.array(f) for f in features])
            widths = np.array([len(f) for f in features])
            score = np.add.reduceat(self.model.weights[ids], np.cumsum(widths) - widths)
            self.potentials = np.concatenate([self.potentials, np.exp(np.maximum(score - score.max(1, keepdims=True), -30))])
        return found

    def document_scores(self, texts: list[str]) -> np.ndarray:
        """Mean posterior of each language over the words of each text; zeros without letters."""
        words = self.look_up(texts)
        lengths = np.array([len(x) for x in words])
        out = np.zeros((len(texts), len(self.model.languages)))
        stretches = -(-lengths // STRETCH)
        if not stretches.sum():
            return out
        owner = np.repeat(np.arange(len(texts)), stretches)
        padded = np.full((len(owner), STRETCH), -1)
        row = np.repeat(np.cumsum(stretches) - stretches, lengths) + np.concatenate([np.arange(n) // STRETCH for n in lengths])
        padded[row, np.concatenate([np.arange(n) % STRETCH for n in lengths])] = np.concatenate(words)
        for low in range(0, len(padded), STRETCHES):
            at = padded[low : low + STRETCHES]
            mask = at >= 0
            posterior, _, _ = _posteriors(self.potentials[np.maximum(at, 0)], mask, self.transition)
            np.add.at(out, owner[low : low + STRETCHES], (posterior * mask[:, :, None]).sum(1))
        return out / np.maximum(lengths, 1)[:, None]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about :data:`SLICE_WORDS` words at most, each of one text at least."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        if i > low and size + len(t) > 5 * SLICE_WORDS:
            yield low, i
            low, size = i, 0
        size += len(t)
    if low < len(texts):
        yield low, len(texts)


def _predicted(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    labeller = Labeller(model) if model else None
    for batch in batches:
        texts = [t or "" for t in batch.column(2).to_pylist()]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for low, high in _slices(texts) if labeller else ():
            shares = labeller.document_scores(texts[low:high])
            best = shares.argmax(1)
            for i in np.flatnonzero(shares.any(1)):
                names[low + i], scores[low + i] = labeller.model.languages[best[i]], min(1.0, float(shares[i, best[i]]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)], names=["row_nr", "doc_id", "lang_pred", "score"]
        )


def predict_languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``row_nr, doc_id, lang_pred, score`` of every row of ``docs``; fits a model where none is given."""
    model = model or fit(training_sample(docs))
    source = docs.select(F.monotonically_increasing_id().alias("row_nr"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(mapper(_predicted, model), "row_nr long, doc_id long, lang_pred string, score double")


#: Below this mean posterior a document has no language of its own.
LEAST_SCORE = 0.4


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose language cannot be told; ``docs`` must be a plain scan."""
    known = predict_languages(docs).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    (row,) = unique_names(docs.columns, "_row")
    kept = known.select(F.col("row_nr").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
