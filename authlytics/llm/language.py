"""Language of code-switched text by a linear-chain conditional random field over words.

Each word has features of its own: its byte n-grams with word boundaries marked (those that touch a
boundary are its affixes) and, per language, whether the lexicon learned for it holds the word.
Weights and the transitions between the languages of neighbouring words are trained together, on a
bounded sample of labelled rows of which some are spliced into code-switched ones.  Forward-backward
over all words of a text gives each word's distribution; their mean is the text's.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from authlytics.llm.common import fresh_name, ship, worker_cache

UNDETERMINED = "und"

# Bounds of the training sample.
SAMPLE_ROWS = 300  # a language, about
SAMPLE_CHARS = 3000  # of a sampled row; longer ones are not learned from
LEXICON_WORDS = 200  # a language

SLOTS = 1 << 18  # of hashed n-grams
EPOCHS = 4
RATE = 0.3
PENALTY = 1e-5
_WORD = re.compile(r"[^\W\d_]+")
_STEP_WORDS = 1 << 18  # words, with padding, that go through forward-backward together
_CACHED_WORDS = 1 << 18
_LONG_CHARS = 1 << 20  # of a text from which it is read in pieces
_PIECE_WORDS = 1 << 16


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # (SLOTS, languages)
    lexicon: dict[bytes, list[int]]
    membership: np.ndarray  # (languages of lexica, languages)
    start: np.ndarray
    transitions: np.ndarray


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters; none where there is no letter at all."""
    found = _WORD.findall(text.lower()) if text else []
    if not any(c.isalpha() for word in found for c in word):
        return []
    return [word.encode("utf-8", "replace") for word in found]


def gram_slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word, slot) of every n-gram of 3 and 4 bytes and every affix of 4 bytes."""
    text = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    blank = text == 0x20
    owner = np.cumsum(blank) - 1  # of the bytes after each blank
    padded = text.astype(np.uint64)
    rows, slots = [], []
    for n in (3, 4, 5):
        count = len(text) - n + 1
        if count <= 0:
            continue
        inside = ~np.any([blank[i : i + count] for i in range(1, n - 1)], axis=0)
        if n == 5:
            inside &= blank[:count] | blank[n - 1 :]
        at = np.flatnonzero(inside)
        code = np.full(len(at), np.uint64(n))
        for i in range(n):
            code = code * np.uint64(257) + padded[at + i]
        code = code * np.uint64(0x9E3779B97F4A7C15)
        rows.append(owner[at + 1])
        slots.append((code >> np.uint64(46)).astype(np.int64) & (SLOTS - 1))
    if not rows:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(slots)


def memberships(words: list[bytes], lexicon: dict[bytes, list[int]], n: int) -> np.ndarray:
    holds = np.zeros((len(words), n), dtype=np.float64)
    for i, word in enumerate(words):
        for language in lexicon.get(word, ()):
            holds[i, language] = 1
    return holds


def emissions(model: Model, words: list[bytes]) -> np.ndarray:
    """(words, languages): the scores of each distinct word."""
    rows, slots = gram_slots(words)
    scores = memberships(words, model.lexicon, len(model.languages)) @ model.membership
    for k in range(len(model.languages)):
        scores[:, k] += np.bincount(rows, model.grams[slots, k], minlength=len(words))
    return scores


# -- forward-backward ----------------------------------------------------------------


def marginals(
    scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, transitions: np.ndarray
) -> np.ndarray:
    """(time, sequence, language) probabilities for scores of that shape; zero past an end."""
    steps, n, k = scores.shape
    live = np.arange(steps)[:, None] < lengths[None, :]
    potential = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    first = np.exp(start - start.max())
    ahead = np.empty_like(potential)
    state = potential[0] * first
    ahead[0] = state / state.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        state = (ahead[t - 1] @ move) * potential[t]
        ahead[t] = state / state.sum(axis=1, keepdims=True)
    behind = np.full((n, k), 1 / k)
    for t in range(steps - 1, -1, -1):
        # Past its end a sequence's backward state stays even.
        if t + 1 < steps:
            state = (potential[t + 1] * behind) @ move.T
            state /= state.sum(axis=1, keepdims=True)
            behind = np.where(live[t + 1][:, None], state, behind)
        ahead[t] *= behind
    ahead /= ahead.sum(axis=2, keepdims=True)
    return ahead * live[:, :, None]


def _pairs(model_scores, lengths, start, transitions, probabilities):
    """Expected transitions between neighbours, summed over sequences."""
    steps, _, k = model_scores.shape
    potential = np.exp(model_scores - model_scores.max(axis=2, keepdims=True))
    move = np.exp(transitions - transitions.max())
    ahead = potential[0] * np.exp(start - start.max())
    ahead /= ahead.sum(axis=1, keepdims=True)
    expected = np.zeros((k, k))
    for t in range(1, steps):
        # p(y, z) is proportional to ahead(y) move(y, z) potential(z) behind(z); the last factor
        # follows from the marginal of z.
        into = (ahead @ move) * potential[t]
        ratio = probabilities[t] / np.maximum(into, 1e-300) * potential[t]
        expected += (ahead.T @ (ratio * (lengths > t)[:, None])) * move
        ahead = into / into.sum(axis=1, keepdims=True)
    return expected


def long_mean(model: Model, text: str, piece: int) -> np.ndarray:
    """The mean probabilities of the words of one long text, so many words at a time.

    A first pass carries the forward state over the pieces and keeps it where each begins; a second
    one goes back over them with the backward state.  Only a piece's words are held at a time.
    """
    text = text.lower()
    starts, n = [], 0
    for found in _WORD.finditer(text):
        if n % piece == 0:
            starts.append(found.start())
        n += 1
    pieces = list(zip(starts, [*starts[1:], len(text)]))
    move = np.exp(model.transitions - model.transitions.max())
    first = np.exp(model.start - model.start.max())

    def potentials(start: int, end: int) -> np.ndarray:
        words = [w.encode("utf-8", "replace") for w in _WORD.findall(text, start, end)]
        places: dict[bytes, int] = {}
        at = [places.setdefault(word, len(places)) for word in words]
        scores = emissions(model, list(places))[at]
        return np.exp(scores - scores.max(axis=1, keepdims=True))

    def forward(potential: np.ndarray, before: np.ndarray) -> np.ndarray:
        ahead = np.empty_like(potential)
        for t, own in enumerate(potential):
            state = before * own
            ahead[t] = state / state.sum()
            before = ahead[t] @ move
        return ahead

    befores = [first]
    for start, end in pieces[:-1]:
        befores.append(forward(potentials(start, end), befores[-1])[-1] @ move)
    total, behind = np.zeros(len(model.languages)), np.full(len(model.languages), 1.0)
    for (start, end), before in zip(reversed(pieces), reversed(befores)):
        potential = potentials(start, end)
        ahead = forward(potential, before)
        for t in range(len(potential) - 1, -1, -1):
            state = ahead[t] * behind
            total += state / state.sum()
            behind = move @ (potential[t] * behind)
            behind /= behind.sum()
    return total / max(n, 1)


# -- training ------------------------------------------------------------------------


def held_out(doc_id: str) -> Column:
    """Rows never learned from: crc32 of the id as text is divisible by 5; so is a null id's."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(language, text) of a bounded sample: about SAMPLE_ROWS rows of each language, whole texts
    of at most SAMPLE_CHARS characters."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out("doc_id"))
    chars = F.length("text")
    shortest = {
        lang: least for lang, least in labelled.groupBy("lang").agg(F.min(chars)).collect()
    }
    if not shortest:
        return []
    # A language without a short text is learned from its shortest ones.
    longest = F.create_map(
        *[F.lit(x) for lang, n in shortest.items() for x in (lang, max(n, SAMPLE_CHARS))]
    )
    short = labelled.filter(chars <= longest[F.col("lang")])
    counts = dict(short.groupBy("lang").count().collect())
    share = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, SAMPLE_ROWS / n)]
    )
    # By id and text, so that the choice is the same every time and repeated ids spread out.
    text = F.xxhash64("text")
    draw = F.pmod(F.xxhash64("doc_id", text), F.lit(1 << 30)) / (1 << 30)
    chosen = short.filter(draw < share[F.col("lang")])
    order = [draw, "doc_id", text, "lang"]
    rows = chosen.orderBy(*order).limit(2 * SAMPLE_ROWS * len(counts)).select("lang", "text")
    return sorted((row["lang"], row["text"]) for row in rows.collect())


def train(rows: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """A model of the rows' languages; none where no row has a word."""
    rng = np.random.default_rng(seed)
    texts = [(lang, words_of(text)) for lang, text in rows]
    texts = [(lang, words) for lang, words in texts if words]
    languages = sorted({lang for lang, _ in texts})
    if not languages:
        return None
    index = {lang: k for k, lang in enumerate(languages)}
    k = len(languages)
    lexicon: dict[bytes, list[int]] = {}
    for lang in languages:
        seen = Counter(word for own, words in texts if own == lang for word in words)
        for word, _ in seen.most_common(LEXICON_WORDS):
            lexicon.setdefault(word, []).append(index[lang])
    sequences = []
    for lang, words in texts:
        labels = [index[lang]] * len(words)
        if k > 1 and rng.random() < 0.5:  # splice in a run of another text
            other, more = texts[rng.integers(len(texts))]
            at, size = rng.integers(len(words) + 1), rng.integers(1, 20)
            words = words[:at] + more[:size] + words[at:]
            labels = labels[:at] + [index[other]] * len(more[:size]) + labels[at:]
        sequences.append((words, labels))
    model = Model(
        languages,
        np.zeros((SLOTS, k)),
        lexicon,
        np.zeros((k, k)),
        np.zeros(k),
        np.zeros((k, k)),
    )
    weights = (model.grams, model.membership, model.transitions, model.start)
    squares = [np.full_like(x, 1e-8) for x in weights]
    for _ in range(EPOCHS):
        order = rng.permutation(len(sequences))
        for i in range(0, len(order), 32):
            _step(model, [sequences[j] for j in order[i : i + 32]], squares)
    return model


def _step(model: Model, batch: list, squares: list[np.ndarray]) -> None:
    """One step along the gradient of the log-likelihood, with a rate per weight."""
    words = [word for own, _ in batch for word in own]
    labels = np.array([label for _, own in batch for label in own])
    lengths = np.array([len(own) for own, _ in batch])
    k = len(model.languages)
    rows, slots = gram_slots(words)
    holds = memberships(words, model.lexicon, k)
    flat = holds @ model.membership
    for j in range(k):
        flat[:, j] += np.bincount(rows, model.grams[slots, j], minlength=len(words))
    where = _placement(lengths)
    scores = np.zeros((lengths.max(), len(batch), k))
    scores[where] = flat
    probabilities = marginals(scores, lengths, model.start, model.transitions)
    error = np.eye(k)[labels] - probabilities[where]
    used, back = np.unique(slots, return_inverse=True)
    grams = np.stack(
        [np.bincount(back, error[rows, j], minlength=len(used)) for j in range(k)], axis=1
    )
    starts = np.cumsum(lengths) - lengths
    follows = np.setdiff1d(np.arange(1, len(labels)), starts)
    seen = np.zeros((k, k))
    np.add.at(seen, (labels[follows - 1], labels[follows]), 1)
    moved = seen - _pairs(scores, lengths, model.start, model.transitions, probabilities)
    _ascend(model.grams, squares[0], grams, used)
    _ascend(model.membership, squares[1], holds.T @ error, slice(None))
    _ascend(model.transitions, squares[2], moved, slice(None))
    _ascend(model.start, squares[3], error[starts].sum(axis=0), slice(None))


def _ascend(weights: np.ndarray, squares: np.ndarray, gradient: np.ndarray, at) -> None:
    gradient = gradient - PENALTY * weights[at]
    squares[at] += gradient**2
    weights[at] += RATE * gradient / np.sqrt(squares[at])


def _placement(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, sequence) of the words of consecutive sequences."""
    sequence = np.repeat(np.arange(len(lengths)), lengths)
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths), sequence


# -- prediction ----------------------------------------------------------------------


class Tagger:
    """A model with the scores of the words it has met lately."""

    def __init__(self, model: Model):
        self.model = model
        self.places: dict[bytes, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def _place(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Each text's words as rows of the scores; the words themselves are not kept."""
        if len(self.places) > _CACHED_WORDS:
            self.places, self.scores = {}, self.scores[:0].copy()
        new: list[bytes] = []
        known, result = len(self.places), []
        for text in texts:
            words = words_of(text)
            for word in words:
                if word not in self.places:
                    self.places[word] = known + len(new)
                    new.append(word)
            get = map(self.places.__getitem__, words)
            result.append(np.fromiter(get, dtype=np.int32, count=len(words)))
        scores = [emissions(self.model, new[i : i + 10_000]) for i in range(0, len(new), 10_000)]
        self.scores = np.concatenate([self.scores, *scores])
        return result

    def predict(self, texts: Iterable[str | None]) -> np.ndarray:
        """(texts, languages): the mean of the words' probabilities; zeros without words."""
        texts = list(texts)
        long = {i for i, text in enumerate(texts) if text and len(text) >= _LONG_CHARS}
        places = self._place(None if i in long else text for i, text in enumerate(texts))
        lengths = np.array([len(p) for p in places], dtype=np.int64)
        result = np.zeros((len(places), len(self.model.languages)))
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        start = 0
        while start < len(order):
            # Texts of like length together, so that little is padding.
            end = start + 1
            while (
                end < len(order)
                and end - start < 1024
                and lengths[order[end]] <= max(64, 1.3 * lengths[order[start]])
                and lengths[order[end]] * (end - start + 1) <= _STEP_WORDS
            ):
                end += 1
            group = order[start:end]
            size = lengths[group]
            scores = np.zeros((size.max(), len(group), result.shape[1]))
            scores[_placement(size)] = self.scores[np.concatenate([places[i] for i in group])]
            found = marginals(scores, size, self.model.start, self.model.transitions)
            result[group] = found.sum(axis=0) / size[:, None]
            start = end
        for i in long:
            if any(c.isalpha() for c in texts[i]):
                result[i] = long_mean(self.model, texts[i], _PIECE_WORDS)
        return result


def identify(docs: DataFrame, name: str = "language") -> DataFrame:
    """The documents with a struct (lang_pred, score) more, learned from their own labels.

    lang_pred is a value of lang among the rows learned from, or `und` with score 0 if the text is
    null or has no letter, or if no row is labelled; the score is the mean probability of that
    language over the text's words.  Only text is an input; nulls elsewhere and repeated rows don't
    matter, and an empty table stays empty.
    """
    spark = docs.sparkSession
    ship(spark)
    model, token = spark.sparkContext.broadcast(train(sample(docs))), uuid.uuid4().hex

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        trained = model.value
        tagger = trained and worker_cache(("tagger", token), lambda: Tagger(trained))
        for batch in batches:
            best, score = [UNDETERMINED] * len(batch), np.zeros(len(batch))
            if tagger is not None:
                found = tagger.predict(batch)
                languages = np.array(trained.languages, dtype=object)
                top = found.argmax(axis=1)
                score = np.clip(found.max(axis=1), 0, 1)
                best = np.where(score > 0, languages[top], UNDETERMINED)
            yield pd.DataFrame({"lang_pred": best, "score": score})

    return docs.withColumn(name, predict("text"))


def keep_identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The documents in which one language has at least that score, with all their columns."""
    name = fresh_name(docs, "language")
    found = identify(docs, name)
    clear = (F.col(name)["lang_pred"] != UNDETERMINED) & (F.col(name)["score"] >= least)
    return found.filter(clear).drop(name)
