"""Token ids of whole texts by a public tokenizer, word by word with a bounded cache.

The vocabularies here have fewer than 65,536 ids, so ids travel as little-endian 16-bit integers. Texts repeat words far
more often than documents; a worker keeps the ids of words it has met and hands unknown ones to the tokenizer in one
batch. Words are cut only where the tokenizer's own pattern always cuts, so the ids equal those of the whole text; a
text with any other layout is encoded as a whole.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache
from itertools import chain, islice

import numpy as np

#: Entries of a worker's cache, about 200 bytes each; beyond them the cache starts anew.
CACHE_WORDS = 1_000_000
#: Characters encoded at a time: bounds the word lists of very long texts.
BLOCK_CHARS = 4_000_000
#: Runs of letters that are encoded as one text.
RUNS_TOGETHER = 1000

#: Letters and marks of which every version of Unicode knows the kind; U+0130 is left out, as its lower case is two.
_LETTERS, _MARKS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+", r"[!-/:-@\[-`{-~]*"
_SIMPLE = re.compile(f"({_LETTERS})({_MARKS})\\Z").match
_RUN = re.compile(f"{_LETTERS}\\Z").match
#: White space to Python that the tokenizers' patterns may take for something else.
_ODD = re.compile("[\x1c-\x1f\x85]")


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file; a path is returned as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


class Encoder:
    """Encodes texts to little-endian unsigned 16-bit ids.

    ``spaced``: the vocabulary writes the space before a word into its first token (byte-level BPE); else white space
    only separates words.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.spaced = self._ids("a b") != self._ids("a") + self._ids("b")
        self.cache_words = cache_words
        #: By word: with the space before it if the vocabulary has such tokens; and without.
        self.lead = " " if self.spaced else ""
        #: And by unit, see ``_units``; None for units that can only be encoded with what is around them.
        self.known: dict[str, bytes | None] = {}
        self.bare: dict[str, bytes] = {} if self.spaced else self.known
        self.newline = self._ids("\n")
        self.folds = self._ids("Aa") == self._ids("aa")
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.edge = np.zeros(size, dtype=bool)
        for token, at in self.tokenizer.get_vocab().items():
            self.edge[at] = token.startswith("\u0120") if self.spaced else token.endswith("</w>")

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def _encode_each(self, words: list[str], lead: str, into: dict[str, bytes]) -> None:
        for at in range(0, len(words), 2000):
            batch = words[at : at + 2000]
            found = self.tokenizer.encode_batch_fast([lead + w for w in batch], add_special_tokens=False)
            into.update((w, np.array(got.ids, dtype="<u2").tobytes()) for w, got in zip(batch, found))

    def _learn(self, words: set[str]) -> None:
        """Ids of unknown words: a run of letters and what punctuation follows it are encoded apart, as the pattern does."""
        plain = set() if self.folds else {w for w in words if w.isalpha() and _RUN(w)}
        parts = {w: (m[1].lower() if self.folds and m[1].isascii() else m[1], m[2]) for w in words.difference(plain) if (m := _SIMPLE(w))}
        self._learn_letters(plain.union(stem for stem, _ in parts.values()).difference(self.known))
        self._encode_each(list({tail for _, tail in parts.values() if tail}.difference(self.bare)), "", self.bare)
        self._encode_each(list(words.difference(plain, parts, self.known)), self.lead, self.known)
        known, bare = self.known, self.bare
        known.update([(word, known[stem] + bare[tail] if tail else known[stem]) for word, (stem, tail) in parts.items()])

    def _learn_letters(self, stems: set[str]) -> None:
        """Many runs of letters in one text: every run starts, or ends, with a token that no other place has."""
        todo = list(stems)
        batches = [todo[at : at + RUNS_TOGETHER] for at in range(0, len(todo), RUNS_TOGETHER)]
        for at in range(0, len(batches), 16):
            some = batches[at : at + 16]
            found = self.tokenizer.encode_batch_fast([self.lead + " ".join(batch) for batch in some], add_special_tokens=False)
            for batch, encoded in zip(some, found):
                ids = np.array(encoded.ids, dtype="<u2")
                edges = np.flatnonzero(self.edge[ids])
                ends = np.append(edges[1:], len(ids)) if self.spaced else edges + 1
                if len(ends) == len(batch):
                    data, cuts = ids.tobytes(), [0, *(2 * ends).tolist()]
                    self.known.update([(stem, data[a:b]) for stem, a, b in zip(batch, cuts, cuts[1:])])
                else:
                    self.known.update([(stem, self._ids(self.lead + stem)) for stem in batch])

    def _units(self, text: str) -> list[str] | None:
        """Pieces that can be encoded one by one; None if the text has to be encoded as a whole.

        Where spaces belong to tokens, pieces begin at a space, which they lose, or at one or two line ends, which they keep.
        """
        if "<|" in text:  # may spell a special token
            return None
        if not self.spaced:
            # in Latin-1 lower case is the same to all, and words that begin sentences need not be learnt again
            return None if _ODD.search(text) else (text.lower() if self.folds and _latin(text) else text).split()
        return text.replace("\n", " \n").replace("\n \n", "\n\n").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        group: list[tuple[int, list[str]]] = []
        held = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            units = self._units(text)
            if units is None:
                out[i] = self._ids(text)
                continue
            group.append((i, units))
            held += len(text)
            if held > BLOCK_CHARS:
                self._finish(group, texts, out)
                group, held = [], 0
        self._finish(group, texts, out)
        return out

    def _learn_units(self, units: set[str], first: set[str]) -> None:
        """Units by their words. Those with other white space at an end, or with none but that, depend on their surroundings."""
        words = {u for u in units if u and u == u.strip()}
        parts, bare = {}, {w for w in first if w and w == w.strip()}
        for unit in units.difference(words):
            word = unit.lstrip("\n")
            ends = len(unit) - len(word)
            if word and 0 < ends <= 2 and word == word.strip():
                parts[unit] = (ends, word)
                bare.add(word)
            else:
                self.known[unit] = None
        self._learn(words)
        self._encode_each(list(bare.difference(self.bare)), "", self.bare)
        self.known.update([(unit, self.newline * ends + self.bare[word]) for unit, (ends, word) in parts.items()])

    def _finish(self, group: list[tuple[int, list[str]]], texts: list[str], out: list[bytes]) -> None:
        if len(self.known) + len(self.bare) * self.spaced > self.cache_words:
            self.known.clear()
            self.bare.clear()
        wanted = set(chain.from_iterable(units for _, units in group)).difference(self.known)
        look = self.known.__getitem__
        if not self.spaced:
            self._learn(wanted)
            for i, words in group:
                out[i] = b"".join(map(look, words))
            return
        # a text's first word has no space before it
        self._learn_units(wanted, {units[0] for _, units in group}.difference(self.bare))
        for i, units in group:
            try:
                out[i] = self.bare[units[0]] + b"".join(map(look, islice(units, 1, None)))
            except (KeyError, TypeError):  # a unit that depends on its surroundings
                out[i] = self._ids(texts[i])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
