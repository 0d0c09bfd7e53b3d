"""Byte-level BPE: exact merges in linear time, and decoding.

Bytes are mapped to Latin-1 characters, so an Aho-Corasick automaton over the vocabulary reports every token that occurs in a piece. An
encoding is built from the left with the longest token at each place. Two tokens may stand side by side only if merging their joined
bytes would keep the border between them; that is found by walking back through their last merges and is memoised for each pair. Where
no token fits, the last one is taken back and its next shorter prefix tried; a place that failed once isn't tried again, so the work is
linear in the piece. The result is the encoding that merges by rank would give.

Defined results: null text counts as empty and gives no ids. Repeated rows each get a row. Extra columns are not read.

Plan: one pass without a shuffle. A worker remembers the ids of chunks in a cache of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from terrasieve.llm.columns import whole_text
from terrasieve.llm.worker_memory import one_of, slices

#: Chunks and pairs that a worker remembers; beyond it the caches start anew. Longer chunks aren't remembered.
CACHED_CHUNKS, CACHED_LENGTH, CACHED_PAIRS = 700_000, 48, 500_000
#: A blank before a visible character, and a blank before none.
_BLANK, _RUN = re.compile(r" (?=\S)"), re.compile(r" (?!\S)")


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        import ahocorasick

        self.pattern = regex.compile(pattern)
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.rank = ranks
        self.data = [b""] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.data[rank] = token
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        self.length = [len(t) for t in self.data]
        self.shorter = [self._prefix(t) for t in self.data]
        self.parts: dict[int, tuple[int, int]] = {}
        self.fits: dict[int, bool] = {}
        self.cache: dict[str, tuple[int, ...]] = {}  # by chunk, without the blank before it
        self.decimal = list(map(str, range(len(self.data))))

    def _prefix(self, token: bytes) -> int:
        """The longest proper prefix that is a token, or -1."""
        return next((self.rank[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.rank), -1)

    def _last_merge(self, token: int) -> tuple[int, int]:
        """The two tokens that merging by rank joins last to form this one; the token twice if it is a byte."""
        if token not in self.parts:
            parts = [self.data[token][i : i + 1] for i in range(self.length[token])]
            while len(parts) > 2:
                rank, i = min((self.rank.get(a + b, len(self.data)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                parts[i : i + 2] = [self.data[rank]]
            self.parts[token] = (self.rank[parts[0]], self.rank[parts[-1]])
        return self.parts[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of both by rank keeps the border between them."""
        known = self.fits.get(left << 32 | right)
        if known is None:
            if len(self.fits) > CACHED_PAIRS:
                self.fits.clear()
            known = self.fits[left << 32 | right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        """Undo the latest merges on both sides of the border, from the highest rank down. At each step the two tokens at the border would
        have merged if their joined bytes were a token of a lower rank than the merges that were undone. On the left, a merge comes first
        in a tie, so there an equal rank wins too."""
        limit, data, rank = len(self.data), self.data, self.rank
        while True:
            joined = rank.get(data[left] + data[right], limit)
            if joined < limit:
                return False
            whole_left, whole_right = self.length[left] == 1, self.length[right] == 1
            if whole_left and whole_right:
                return True
            if whole_right or (not whole_left and left > right):
                limit, left = left, self._last_merge(left)[1]
            else:
                limit, right = right + 1, self._last_merge(right)[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if piece in self.rank:
            return [self.rank[piece]]
        n = len(piece)
        longest = [0] * n
        for end, (token, before_end) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - before_end] = token  # matches come by their ends, so the longest at a place comes last
        length, known, compatible = self.length, self.fits.get, self.compatible
        failed = bytearray(n + 1)
        token = longest[0]
        out = [token]
        at = length[token]
        while at < n:
            left, token = out[-1], longest[at]
            while token >= 0 and (failed[at + length[token]] or not (known(left << 32 | token) or compatible(left, token))):
                token = self.shorter[token]
            while token < 0:  # nothing fits behind the last token: put a shorter one in its place
                failed[at] = 1
                token = out.pop()
                at -= length[token]
                token = self.shorter[token]
                while token >= 0 and (failed[at + length[token]] or (out and not compatible(out[-1], token))):
                    token = self.shorter[token]
            out.append(token)
            at += length[token]
        return out

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        ids: list[int] = []
        for piece in self.pattern.findall(chunk):
            ids += self.encode_piece(piece.encode("utf-8"))
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Ids of a text. A match of the pattern always begins at a blank before a visible character, so what lies between such blanks
        can be encoded and remembered apart."""
        cache = self.cache
        if len(cache) > CACHED_CHUNKS:
            cache.clear()
        first, *rest = _BLANK.split(text) if _RUN.search(text) else text.split(" ")
        long: dict[str, tuple[int, ...]] = {}
        for chunk in [c for c in set(rest) if c not in cache]:
            (cache if len(chunk) <= CACHED_LENGTH else long)[chunk] = self._chunk(f" {chunk}")
        ids = list(self._chunk(first))
        if long:
            for chunk in rest:
                ids += cache[chunk] if chunk in cache else long[chunk]
        else:
            ids += chain.from_iterable(map(cache.__getitem__, rest))
        return ids

    def decimals(self, ids: list[int]) -> str:
        return " ".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.data.__getitem__, ids))


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder for each worker process."""
    return one_of(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def encode_ids(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids."""
    d = whole_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for b in batches:
            for part in slices(b):
                ids = [coder.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id, data (the bytes)."""
    d = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([None if i is None else coder.decode(i) for i in b.column("ids").to_pylist()], pa.binary())], names=["doc_id", "data"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass, per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    d = whole_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(path, pattern)
        for part in chain.from_iterable(map(slices, batches)):
            n, ids_sha, data_sha = [], [], []
            for text in part.column("text").to_pylist():
                ids = coder.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(coder.decimals(ids).encode()).hexdigest())
                data_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(data_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
