"""Whole texts to token ids, with a bounded cache of the words between spaces.

A text is cut only at white space where the vocabulary's splitting rule always
ends a pre-token, so the ids of the parts, one after the other, are the ids of
the whole text. A text in which such a cut would not be safe is encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_INNER_SPACE = r"[\s\v\x1c-\x1f\x{85}\p{Z}] [\s\v\x1c-\x1f\x{85}\p{Z}]"
_MARKED = re.compile(r"([^\W\d_]+)([!-/:-@\[-`{-~]+)")
_BROKEN = re.compile(r"\S+(?:\n\S+)+")

# byte-level vocabularies write a byte as its Latin-1 character if that prints, else as one from U+0100 on
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = dict(zip([x for x in range(256) if x not in _SHOWN], map(chr, range(0x100, 0x200)), strict=False))


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, through a cache of words.

    ``keep_space``: the vocabulary codes the space before a word as a part of it
    (byte-level), and so does the cache; otherwise white space only parts words
    and is dropped. ``whole`` encodes texts as they are, ``learn`` adds the ids
    of words to the cache.
    """

    entries, kept = 600_000, 300_000
    """Words remembered; beyond that the first met, which are the frequent ones, stay (results do not change)."""

    def __init__(self, keep_space: bool):
        self.keep_space = keep_space
        self.cache: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def learn(self, missing: list[str]) -> None:
        raise NotImplementedError

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's begin (n + 1 places).

        Arrow cuts the texts at spaces and numbers the distinct words; Python only
        sees each distinct word of a batch once, and numpy puts the ids in place.
        """
        if len(self.cache) > self.entries:
            self.cache = dict(islice(self.cache.items(), self.kept))
        texts = texts.fill_null("")
        heads: list[str] = []
        if self.keep_space:
            # only where a space stands between white space is a cut before it not the rule's
            unsafe = pc.match_substring_regex(texts, _INNER_SPACE)
            heads, texts = texts, pc.if_else(unsafe, "", texts)
        words = pc.split_pattern(texts, " ")
        at = words.offsets.to_numpy().astype(np.int64)
        numbered = words.values.dictionary_encode()
        names, index = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy().astype(np.int64)[at[0]:at[-1]]
        at -= at[0]
        found = list(map(self.cache.get, names))
        new = [i for i, x in enumerate(found) if x is None]
        self.learn([names[i] for i in new])
        for i in new:
            found[i] = self.cache[names[i]]
        if self.keep_space:
            # a text's first word has no space before it; an unsafe text is encoded as it is
            first = words.values.take(pa.array(words.offsets.to_numpy()[:-1]))
            found += self.whole(pc.if_else(unsafe, heads, first).to_pylist())
            index[at[:-1]] = len(names) + np.arange(len(at) - 1)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, data = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), "<u4")
        counts = sizes[index]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(starts[index] - ends[:-1], counts)
        places += np.arange(len(places))
        return data[places], ends[at]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, at = self.encode_flat(pa.array(texts, pa.string()))
        return [ids[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]


class TextEncoder(WordEncoder):
    """By the tokenizers library; strings of special tokens in a text are ordinary text."""

    def __init__(self, path: str, keep_space: bool, entries: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(keep_space)
        self.entries, self.kept = entries, entries * 2 // 5
        self.bare: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        # a separator with one id that only itself can give; words that hold it or white space at an end go alone
        self.separator, self.lead = ("\r", " ") if keep_space else (" \x1c ", "")
        (self.separator_id,) = self.tokenizer.encode(self.separator, add_special_tokens=False).ids
        self.alone = re.compile(r"\r|^\s|\s$|^$" if keep_space else "[\x1c-\x1f]")

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def joined(self, words: list[str], lead: str) -> list[bytes]:
        """Ids of words without the separator: encoded as one text, then cut at the separator's id."""
        text = lead + (self.separator + lead).join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = 4 * np.flatnonzero(ids == self.separator_id)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)], strict=True)]

    def letters(self, words: list[str], store: dict[str, bytes], lead: str) -> None:
        """Learn words of letters, which are one pre-token: straight from the library's merges."""
        tokenize = self.model.tokenize
        for x in words:
            chars = x if self.keep_space else x.lower()
            if not x.isascii():
                chars = chars.encode().decode("latin-1").translate(_BYTE_CHARS)
            store[x] = array("I", [token.id for token in tokenize(lead + chars)]).tobytes()

    def words(self, missing: list[str], store: dict[str, bytes], lead: str) -> None:
        """Learn words without a line feed inside, each with ``lead`` before it."""
        letters, marked, rest = [], [], []
        for x in missing:
            if x.isalpha():
                letters.append(x)
            elif (found := _MARKED.fullmatch(x)) and found[1].isalpha() and x[len(found[1]) - 1] < "\u0100":
                marked.append(found)  # a Latin-1 letter and a run of marks are always two pre-tokens
            else:
                rest.append(x)
        letters += {x[1] for x in marked}.difference(store, letters)
        if not self.keep_space:  # of Latin-1 letters the normalizer only takes the lower case; others go the long way
            rest += [x for x in letters if max(x) >= "\u0100"]
            letters = [x for x in letters if max(x) < "\u0100"]
        self.letters(letters, store, "\u0120" if lead else "")
        alone = list(filter(self.alone.search, rest))
        store.update(zip(alone, self.whole([lead + x for x in alone]), strict=True))
        rest = list(set(rest).difference(alone))
        if rest:
            store.update(zip(rest, self.joined(rest, lead), strict=True))
        ends = list({x[2] for x in marked}.difference(self.ends))
        self.ends.update(zip(ends, self.whole(ends), strict=True))
        store.update((x[0], store[x[1]] + self.ends[x[2]]) for x in marked)

    def learn(self, missing: list[str]) -> None:
        broken = [x for x in missing if "\n" in x and _BROKEN.fullmatch(x)]
        plain = set(missing).difference(broken)
        lines = [x.split("\n") for x in broken]
        plain.update(x for x, *_ in lines)
        # a line feed inside is a pre-token or nothing, and a word after it has no space before it
        bare, feed = (self.bare, self.whole(["\n"])[0]) if self.keep_space else (self.cache, b"")
        if len(self.bare) > self.kept or len(self.ends) > self.kept:
            self.bare.clear()
            self.ends.clear()
        later = {y for _, *more in lines for y in more}
        if not self.keep_space:
            plain, later = plain | later, set()
        self.words(list(plain.difference(self.cache)), self.cache, self.lead)
        self.words(list(later.difference(bare)), bare, "")
        self.cache.update((x, feed.join([self.cache[y[0]], *map(bare.__getitem__, y[1:])]))
                          for x, y in zip(broken, lines, strict=True))


_encoders: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, keep_space: bool, entries: int = 1_000_000) -> TextEncoder:
    """The worker's encoder for a vocabulary file; loaded once. ``entries`` bounds the words it remembers."""
    key = (path, keep_space)
    if key not in _encoders:
        _encoders[key] = TextEncoder(path, keep_space, entries)
    return _encoders[key]


def forget() -> None:
    """Drop the worker's encoders, for an operator that needs none and may run in the same worker later."""
    _encoders.clear()
