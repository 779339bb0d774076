"""Exact token counts at every prefix of a text, stored once and asked often.

Within a word of the vocabulary's pattern, dynamic programming over the word's prefixes gives the
last token, and so the count, of each prefix's own encoding; across words counts add up.  Where
cutting a text moves a word boundary (inside white space, a contraction or a special token) the
count at the cut is that of the words that the cut text has.  Counts are stored as one signed byte
per character, the step from the prefix before, so that any truncation or budget is answered by a
running sum, without encoding again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from authlytics.llm.byte_pairs import PATTERN, WHITE, BytePairs
from authlytics.llm.common import row_key, ship, worker_cache

_WORDS = regex.compile(PATTERN)
_WHITE = regex.compile(f"[{WHITE}]")
_WHITE_RUN = regex.compile(f"[{WHITE}]{{2}}")
# Words of the pattern that a cut after two characters splits in two.
_CUT_CONTRACTIONS = ("'re", "'ve", "'ll")
_KEPT_WORDS = 1 << 18
_TOGETHER = 24  # characters of a word up to which words are computed together
_GROUP_CHARS = 1 << 22  # of texts whose words are looked up together


class _Steps(dict):
    """Steps per character of each word, for the words met lately: two generations of a dict."""

    def __init__(self, pairs: BytePairs):
        super().__init__()
        self.pairs, self.older = pairs, {}

    def __missing__(self, word: str) -> bytes:
        steps = self.older.get(word) or self._steps(word)
        self._age()
        self[word] = steps
        return steps

    def _age(self) -> None:
        if len(self) >= _KEPT_WORDS:
            self.older = dict(self)
            self.clear()

    def learn(self, words: set[str]) -> None:
        """Have the steps of the words at hand, computed together where they are new."""
        older, new = self.older, []
        for word in words.difference(self):
            if word in older:
                self[word] = older[word]
            elif len(word) <= _TOGETHER and word not in _CUT_CONTRACTIONS:
                new.append(word)
        self._age()
        if not new:
            return
        steps, lengths = self.pairs.prefix_steps([word.encode() for word in new])
        steps, ends = steps.tobytes(), np.cumsum(lengths)
        for word, start, end in zip(new, (ends - lengths).tolist(), ends.tolist()):
            self[word] = steps[start:end]

    def _steps(self, word: str) -> bytes:
        _, counts = self.pairs.prefixes(word.encode())
        if not word.isascii():
            counts = [counts[i] for i in accumulate((len(c.encode()) for c in word), initial=0)]
        if word in _CUT_CONTRACTIONS:
            counts[2] = self.count(word[0]) + self.count(word[1])
        return bytes([(after - before) & 255 for before, after in pairwise(counts)])

    def count(self, word: str) -> int:
        return len(self.pairs.encode(word.encode()))


class PrefixCounter:
    """Prefix counts under one vocabulary."""

    def __init__(self, vocabulary: str):
        self.pairs = BytePairs(vocabulary)
        self.steps = _Steps(self.pairs)
        self.names = sorted(self.pairs.specials, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, self.names)))

    def _special(self, text: str) -> bool:
        return any(name in text for name in self.names)

    def of(self, text: str) -> np.ndarray:
        """The step of the token count at every character of the text."""
        if not self._special(text):
            return self._plain(text)
        parts, start = [], 0
        for found in self.specials.finditer(text):
            # Up to its last character a special token is ordinary text after what is before it.
            before = text[start : found.start()]
            steps = self._plain(before + found.group()[:-1])
            last = int(self._plain(before).sum()) + 1 - int(steps.sum())
            parts += [steps, np.array([last], dtype=np.int8)]
            start = found.end()
        return np.concatenate([*parts, self._plain(text[start:])])

    def of_many(self, texts: list[str]) -> list[np.ndarray]:
        """`of` each text, with the words of all of them looked up together."""
        words = [None if self._special(text) else _WORDS.findall(text) for text in texts]
        self.steps.learn(set().union(*(own for own in words if own)))
        return [
            self.of(text) if own is None else self._plain(text, own)
            for text, own in zip(texts, words)
        ]

    def _plain(self, text: str, words: list[str] | None = None) -> np.ndarray:
        words = _WORDS.findall(text) if words is None else words
        steps = np.frombuffer(b"".join(map(self.steps.__getitem__, words)), dtype=np.int8)
        if _WHITE_RUN.search(text):
            steps = steps.copy()
            at = 0
            for word, follows in zip(words, words[1:]):
                at += len(word)
                if _WHITE.match(follows) and _WHITE.match(word[-1]):
                    # Cut after the first character of what follows, white space is one word.
                    apart = self.steps.count(word) + int(np.int8(steps[at]))
                    more = self.steps.count(word + follows[0]) - apart
                    steps[at] += more
                    steps[at + 1] -= more
        return steps


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts in order, a bounded number of characters (or one text) at a time."""
    held, chars = [], 0
    for text in column:
        text = text.as_py()
        if held and chars + len(text) > _GROUP_CHARS:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def tokens_at(steps: np.ndarray, chars: int) -> int:
    """The token count of the text's first characters."""
    return int(steps[:chars].sum(dtype=np.int64))


def chars_within(steps: np.ndarray, budget: int) -> int:
    """The length of the longest prefix of at most so many tokens."""
    fits = np.flatnonzero(np.cumsum(steps, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


_ROW = """doc_id long, key struct<doc_id: long, text: long>, n_bytes long, n_tokens long,
    chars_within long, steps binary"""


def prefix_counts(docs: DataFrame, vocabulary: str, budget: int = 512) -> DataFrame:
    """A row per document: doc_id, key (tells rows apart), n_bytes, n_tokens, chars_within, steps.

    `vocabulary` is the JSON text of a byte-level vocabulary.  n_tokens is the count of the whole
    text as the vocabulary's own library gives it, without added special tokens; special tokens
    inside texts are found as it finds them.  steps has a signed byte per code point: the sum of the
    first k is the count of the first k code points as a text of their own.  chars_within is the
    longest prefix of at most `budget` tokens.  A null text is empty: no tokens, no steps.  Repeated
    rows stay, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        name = ("prefix counts", zlib.crc32(vocabulary.encode()))
        counter = worker_cache(name, lambda: PrefixCounter(vocabulary))
        for batch in batches:
            steps = []
            for texts in _groups(batch.column(3)):
                steps += counter.of_many(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([tokens_at(s, len(s)) for s in steps], pa.int64()),
                    pa.array([chars_within(s, budget) for s in steps], pa.int64()),
                    pa.array([s.tobytes() for s in steps], pa.binary()),
                ],
                names=["doc_id", "key", "n_bytes", "n_tokens", "chars_within", "steps"],
            )

    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key().alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    ).mapInArrow(count, _ROW)
