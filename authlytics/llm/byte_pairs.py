"""Byte-pair merges of a published vocabulary, on single words."""

from __future__ import annotations

import json

import numpy as np

# Fixed value: the word pattern of the vocabulary's byte-level split, `\s` written out as Unicode's
# white space, so that Java and Python agree on it.
WHITE = "\\t-\\r \\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)

MAX_VOCABULARY_BYTES = 64 << 20
_SHORT = 48  # bytes up to which merging pair by pair is quick
_KEPT_PAIRS = 1 << 20


def read_vocabulary(path: str) -> str:
    """The text of a vocabulary file of bounded size, for sending to the executors."""
    with open(path, encoding="utf-8") as file:
        text = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY_BYTES} characters")
    return text


def byte_characters() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary.

    Printable bytes stand for themselves; the others, in order, for the characters from 256 on.
    """
    # The published byte-level alphabet.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairs:
    """Encodes words, and the prefixes of words, by a vocabulary in JSON."""

    def __init__(self, vocabulary: str):
        parsed = json.loads(vocabulary)
        byte_of = byte_characters()

        def raw(token: str) -> bytes:
            return bytes(byte_of[c] for c in token)

        self.ids = {raw(token): i for token, i in parsed["model"]["vocab"].items()}
        self.pieces = {i: token for token, i in self.ids.items()}
        self.specials = {
            token["content"]: token["id"] for token in parsed["added_tokens"] if token["special"]
        }
        self.pieces |= {i: text.encode() for text, i in self.specials.items()}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        # (left, right) packed into one number: the rank and the id of what they merge to
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(parsed["model"]["merges"]):
            a, b = raw(left), raw(right)
            self.merges[self.ids[a] << 32 | self.ids[b]] = (rank, self.ids[a + b])
        self._adjacent: dict[int, bool] = {}
        self._endings = self._from_the_end()
        self._trie: _Table | None = None

    def _from_the_end(self) -> dict[int, tuple[int, int]]:
        """The tokens' bytes from the last to the first as a trie: (node, byte) packed into one
        number, to the next node and the token that it is, or -1."""
        trie: dict[int, tuple[int, int]] = {}
        for piece, token in self.ids.items():
            node, at = 0, 0
            for byte in reversed(piece):
                at = node << 8 | byte
                if at not in trie:
                    trie[at] = (len(trie) + 1, -1)
                node = trie[at][0]
            trie[at] = (node, token)
        return trie

    def prefix_steps(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The steps of the counts of `prefixes` from character to character, for many words at
        once: all words' steps one after the other, and how many each word has.

        All words advance by one byte at a time.
        """
        if self._trie is None:
            self._trie, self._pairs = _Table(18), _Table(18)
            nodes = np.array(list(self._endings.values()), dtype=np.int64)
            keys = np.fromiter(self._endings, dtype=np.int64, count=len(nodes))
            self._trie.add(keys, nodes[:, 0] << 32 | nodes[:, 1] + 1)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        at = (np.cumsum(lengths) - lengths)[order][:, None] + np.arange(longest)
        letters = flat[np.minimum(at, len(flat) - 1)].T.astype(np.int64)
        last = np.full((longest + 1, len(words)), -1, dtype=np.int64)
        counts = np.zeros((longest + 1, len(words)), dtype=np.int64)
        active = np.searchsorted(-lengths[order], -np.arange(longest + 1), side="right")
        for end in range(1, longest + 1):
            rows, node, candidates = np.arange(active[end]), np.int64(0), []
            for start in range(end - 1, -1, -1):
                value = self._trie.find(node << 8 | letters[start, rows])
                there = value >= 0
                rows, value = rows[there], value[there]
                if not len(rows):
                    break
                node = value >> 32
                token = (value & 0xFFFFFFFF) - 1
                candidates.append((start, rows[token >= 0], token[token >= 0]))
            open_ = np.ones(active[end], dtype=bool)
            for start, rows, token in reversed(candidates):
                left = open_[rows]
                rows, token = rows[left], token[left]
                fits = self._fit(last[start, rows], token)
                rows = rows[fits]
                last[end, rows], counts[end, rows] = token[fits], counts[start, rows] + 1
                open_[rows] = False
        back = np.empty(len(words), dtype=np.int64)
        back[order] = np.arange(len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # A character ends before a byte that begins one, or at the end of its word.
        begins = (flat & 0xC0) != 0x80
        ends = np.append(begins[1:], True) | (place + 1 == lengths[word])
        word, place = word[ends], place[ends]
        reached = counts[place + 1, back[word]]
        first = np.diff(word, prepend=-1) != 0
        steps = np.where(first, reached, np.diff(reached, prepend=0))
        return steps.astype(np.uint8), np.bincount(word, minlength=len(words))

    def _fit(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        keys = (before + 1 << 32) + token
        found = self._pairs.find(keys)
        new = np.unique(keys[found < 0])
        if len(new):
            answers = [self._fits((key >> 32) - 1, key & 0xFFFFFFFF) for key in new.tolist()]
            if self._pairs.size + len(new) > _KEPT_PAIRS:
                self._pairs, new = _Table(18), np.unique(keys)
                answers = [self._fits((k >> 32) - 1, k & 0xFFFFFFFF) for k in new.tolist()]
            self._pairs.add(new, np.array(answers, dtype=np.int64))
            found = self._pairs.find(keys)
        return found == 1

    def encode(self, word: bytes) -> list[int]:
        """The ids of one word of the pattern."""
        if len(word) <= _SHORT:
            return self._merge(word)
        last, _ = self.prefixes(word)
        ids, end = [], len(word)
        while end:
            ids.append(last[end])
            end -= len(self.pieces[last[end]])
        return ids[::-1]

    def _merge(self, word: bytes) -> list[int]:
        ids = [self.single[b] for b in word]
        merges = self.merges
        while len(ids) > 1:
            best, at = None, 0
            for i in range(len(ids) - 1):
                found = merges.get(ids[i] << 32 | ids[i + 1])
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            # Equal pairs merge from the left; the next round finds the others.
            ids[at : at + 2] = [best[1]]
        return ids

    def prefixes(self, word: bytes) -> tuple[list[int], list[int]]:
        """For every prefix of the word, the last token and the length of that prefix's encoding.

        A prefix's encoding is the one sequence of tokens in which every two neighbours stay apart
        when they are encoded together.  So the last token is the one that ends at the prefix's end
        and stays apart from the last token of what is before it.
        """
        last, counts = [-1], [0]
        for end in range(1, len(word) + 1):
            self._extend(word, end, last, counts)
        return last, counts

    def _extend(self, word: bytes, end: int, last: list[int], counts: list[int]) -> None:
        """Append the answers for word[:end], given those of all shorter prefixes."""
        endings, adjacent = self._endings.get, self._adjacent.get
        candidates, node = [], 0
        for start in range(end - 1, -1, -1):
            found = endings(node << 8 | word[start])
            if found is None:
                break
            node, token = found
            if token >= 0:
                candidates.append((start, token))
        for start, token in reversed(candidates):
            before = last[start]
            fits = adjacent((before << 32) + token)
            if fits is None:
                fits = self._fits(before, token)
            if fits:
                last.append(token)
                counts.append(counts[start] + 1)
                return

    def _fits(self, before: int, token: int) -> bool:
        """Whether the tokens (the second alone after -1) stay as they are when encoded together."""
        if len(self._adjacent) >= _KEPT_PAIRS:
            self._adjacent.clear()
        own = [token] if before < 0 else [before, token]
        found = self._merge(b"".join(self.pieces[t] for t in own)) == own
        self._adjacent[(before << 32) + token] = found
        return found


class _Table:
    """Values of 64-bit keys, none below 0, found for many keys at once."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of the keys, -1 where there is none."""
        slots = self._slots(keys)
        held = self.keys[slots]
        found = np.where(held == keys, self.values[slots], -1)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            slots[left] = slots[left] + 1 & len(self.keys) - 1
            held = self.keys[slots[left]]
            hit = held == keys[left]
            found[left[hit]] = self.values[slots[left[hit]]]
            left = left[~hit & (held >= 0)]
        return found

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet; at most half of the places are taken."""
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            own = self.keys >= 0
            keys = np.concatenate([self.keys[own], keys])
            values = np.concatenate([self.values[own], values])
            self.__init__((2 * self.size).bit_length())
            self.size = len(keys)
        slots = self._slots(keys)
        while len(keys):
            first = np.zeros(len(keys), dtype=bool)
            first[np.unique(slots, return_index=True)[1]] = True
            first &= self.keys[slots] < 0
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            keys, values, slots = keys[~first], values[~first], slots[~first] + 1
            slots &= len(self.keys) - 1
