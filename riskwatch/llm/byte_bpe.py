"""Byte-level BPE encoding and decoding by rank file, linear in the text.

Bytes are mapped to Latin-1 characters, so an Aho-Corasick automaton over the
vocabulary finds, at each place of a pre-token, the longest token starting
there. Encoding walks from longest matches and steps back to shorter prefixes
where two neighbours are not compatible. Two tokens are compatible if merging
their joined bytes by rank gives back the two; a token list is the exact merge
result if and only if all its neighbours are. Compatibility is found by undoing
the last merges along the boundary and remembered.

Defined results: a null or empty text has no ids; strings of special tokens are
ordinary text; a pre-token that is a token gives that token; rows are kept one
to one, with null and repeated ids as they are; other columns are left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import binary_rows, col, map_arrow, small_batches
from .encode import WordEncoder

NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe(WordEncoder):
    entries, kept = 400_000, 200_000
    pairs = 250_000
    """Neighbours whose compatibility is remembered."""

    def __init__(self, path: str, pattern: str):
        super().__init__(keep_space=True)
        self.ids = {token.decode("latin-1"): rank for token, rank in read_ranks(path).items()}
        self.text = {rank: token for token, rank in self.ids.items()}
        self.pattern = regex.compile(pattern)
        self.parts: dict[int, tuple[int, int]] = {}
        self.known: dict[int, bool] = {}
        self._index()

    def _index(self) -> None:
        """The automaton over all tokens that merges can reach, their last merges and shorter prefixes."""
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.text):
            token = self.text[rank]
            if len(token) > 1:
                parts = self._last_merge(token, rank)
                if parts is None:
                    continue
                self.parts[rank] = parts
            self.automaton.add_word(token, (rank, len(token)))
        self.automaton.make_automaton()
        reached = {token: rank for rank, token in self.text.items() if len(token) == 1 or rank in self.parts}
        self.shorter = {}
        for token, rank in reached.items():
            prefixes = (reached.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((x for x in prefixes if x is not None), None)

    def _last_merge(self, token: str, rank: int) -> tuple[int, int] | None:
        for n in range(1, len(token)):
            a, b = self.ids.get(token[:n]), self.ids.get(token[n:])
            if a is None or b is None or not all(len(self.text[x]) == 1 or x in self.parts for x in (a, b)):
                continue
            if self._stay_apart(a, b, rank):
                return a, b
        return None

    def _stay_apart(self, a: int, b: int, limit: int) -> bool:
        """Whether no merge of a rank under ``limit`` joins anything over the boundary of a and b.

        Going back in time: the later made of the two is undone, and what then
        lay at the boundary would have been joined if the rank of the two
        together came before the undone merge. Of equal ranks the left is first.
        """
        ids, text, parts = self.ids, self.text, self.parts
        while True:
            joined = ids.get(text[a] + text[b])
            if joined is not None and joined < limit:
                return False
            made_a, made_b = a if a in parts else -1, b if b in parts else -1
            if made_a > made_b:
                limit, a = made_a, parts[a][1]
            elif made_b >= 0:
                limit, b = made_b + 1, parts[b][0]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        found = self.known.get(a << 32 | b)
        if found is None:
            if len(self.known) >= self.pairs:
                self.known.clear()
            found = self.known[a << 32 | b] = self._stay_apart(a, b, NEVER)
        return found

    def merge(self, pre_token: str) -> list[int]:
        """Ids of one pre-token, its bytes given as Latin-1."""
        if not pre_token:
            return []
        single = self.ids.get(pre_token)
        if single is not None:
            return [single]
        longest = [None] * len(pre_token)
        for end, (rank, size) in self.automaton.iter(pre_token):
            longest[end + 1 - size] = rank  # of one start, later ends are longer
        out: list[int] = []
        open_ = [True] * (len(pre_token) + 1)
        at, token = 0, longest[0]
        while True:
            end = at + len(self.text[token])
            if open_[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == len(pre_token):
                    return out
                token = longest[at]
                continue
            token = self.shorter[token]
            while token is None:  # nothing fits here: no list of tokens ends at this place
                open_[at] = False
                last = out.pop()
                at -= len(self.text[last])
                token = self.shorter[last]

    def whole(self, texts: list[str]) -> list[bytes]:
        """Each match of the pattern is merged by itself."""
        out = []
        for text in texts:
            found = []
            for pre_token in self.pattern.findall(text):
                found += self.merge(pre_token.encode().decode("latin-1"))
            out.append(np.array(found, dtype="<u4").tobytes())
        return out

    def learn(self, missing: list[str]) -> None:
        self.cache.update(zip(missing, self.whole([" " + x for x in missing]), strict=True))


_coders: dict[tuple[str, str], ByteBpe] = {}
_tokens: dict[str, dict[int, bytes]] = {}


def coder(path: str, pattern: str) -> ByteBpe:
    """The worker's coder for a rank file; built once."""
    if (path, pattern) not in _coders:
        _coders[path, pattern] = ByteBpe(path, pattern)
    return _coders[path, pattern]


def tokens(path: str) -> dict[int, bytes]:
    """The bytes of each id; read once a worker."""
    if path not in _tokens:
        _tokens[path] = {rank: token for token, rank in read_ranks(path).items()}
    return _tokens[path]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path, pattern).encode_flat
        for batch in small_batches(batches, "t"):
            ids, at = code(batch.column("t"))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(np.diff(at)), binary_rows(ids, at)],
                                             ["doc_id", "n_tokens", "ids"])

    docs = df.select(col(id_col).alias("k"), col(text_col).cast("string").alias("t"))
    return map_arrow(docs, run, f"doc_id {docs.schema['k'].dataType.simpleString()}, n_tokens long, ids binary")


def decode(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded: the bytes of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = tokens(path).__getitem__
        for batch in small_batches(batches, "ids"):
            ids = [np.frombuffer(x or b"", "<u4").tolist() for x in batch.column("ids").to_pylist()]
            decoded = pa.array([b"".join(map(look, x)) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    found = df.select("doc_id", "n_tokens", "ids")
    return map_arrow(found, run,
                     f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, "
                     "decoded binary")
