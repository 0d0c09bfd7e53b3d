"""Token ids of whole texts by a tokenizers file, with a bounded memory of words in each Python worker.

The vocabulary drops white space before it merges, so a text's ids are those of its white-space-separated pieces in a row. Many texts
at a time are split into words by numpy as the vocabulary's pattern splits them; the library encodes each new word once, and its ids
are looked up from then on. Pieces with anything but printable ASCII and Latin-1 letters, and those that may hold a special token, go to
the library whole.
"""

from __future__ import annotations

import json
import os

import numpy as np

from terrasieve.llm.byte_runs import CLASS, DIGIT, LETTER, LOWER, MARK, ODD, SPACE, WordTable, joined, keys
from terrasieve.llm.worker_memory import one_of

#: Words that a worker remembers unless it is told another number, about 40 MB, and ids for each; beyond either it starts anew. Longer pieces
#: aren't remembered.
CACHED_WORDS, CACHED_IDS, CACHED_LENGTH = 500_000, 8, 64
#: Words that the library encodes in one call.
RUN = 64
#: Fixed value: the pattern by which the vocabulary splits lower-case text. WordEncoder.split does the same.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Byte-level vocabularies write bytes that don't print, space excepted here, as letters from U+0100 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_LETTERS = {b: 256 + i for i, b in enumerate(_HIDDEN) if b != 32}
_QUOTE, _ONE, _TWO = ord("'"), np.isin(np.arange(256), [*b"stmd"]), [b"re", b"ve", b"ll"]


def _words_alone(spec: dict) -> dict | None:
    """The tokenizer for words that are already lower-cased, split and mapped from bytes to letters; None if its parts aren't those known."""
    parts = lambda name, inner: (spec.get(name) or {}).get(inner) or []
    changes, splits = parts("normalizer", "normalizers"), parts("pre_tokenizer", "pretokenizers")
    if [x["type"] for x in changes] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in splits] != ["Split", "ByteLevel"]:
        return None
    if splits[0]["pattern"].get("Regex") != SPLIT or not splits[0]["invert"] or splits[1]["use_regex"] or splits[1]["add_prefix_space"] or not spec["model"].get("end_of_word_suffix"):
        return None
    return {**spec, "normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}


class WordEncoder:
    def __init__(self, path: str, words: int = CACHED_WORDS):
        self.most = words
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.ends = None
        with open(path, encoding="utf-8") as f:
            alone = _words_alone(json.load(f))
        if alone:
            self.alone = Tokenizer.from_str(json.dumps(alone))
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith(alone["model"]["end_of_word_suffix"])
        self._forget()

    def _forget(self) -> None:
        """words: by number, where a word's ids stand in pool and how many they are. Words of 16 bytes have their number in table."""
        self.table, self.others = WordTable(), {}
        self.at, self.n, self.known = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32), 0
        self.pool, self.used = np.zeros(1 << 18, self.dtype), 0

    def _store(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of new words with these ids."""
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.known + len(counts) > len(self.at):
            self.at, self.n = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.n))
        numbers = np.arange(self.known, self.known + len(counts))
        self.pool[self.used : self.used + len(ids)] = ids
        self.at[numbers], self.n[numbers] = self.used + np.cumsum(counts) - counts, counts
        self.used, self.known = self.used + len(ids), self.known + len(counts)
        return numbers

    def _learn_words(self, words: list[bytes]) -> np.ndarray:
        """Words are encoded side by side; the mark at a word's end tells their ids apart."""
        out = []
        for i in range(0, len(words), RUN):
            run = words[i : i + RUN]
            text = b" ".join(run)
            text = text.decode() if text.isascii() else text.decode("latin-1").translate(_LETTERS)
            ids = np.array(self.alone.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            counts = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(counts) != len(run):
                raise AssertionError("words and their ends differ in number")
            out.append(self._store(ids, counts))
        return np.concatenate(out)

    def _learn_pieces(self, pieces: list[bytes]) -> np.ndarray:
        found = [x.ids for x in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return self._store(np.array([i for x in found for i in x], dtype=self.dtype), np.array([len(x) for x in found]))

    def split(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The buffer in lower case; starts, ends, and whether it is a piece for the library, of its words."""
        buffer, kind = LOWER[raw], CLASS[raw]
        if self.ends is None:
            kind[kind != SPACE] = ODD
        lead = np.flatnonzero(raw == 0xC3)  # U+00C0 to U+00FF, letters but for two signs
        if len(lead):
            after = raw[lead + 1]
            lead, after = lead[(after != 0x97) & (after != 0xB7)], after[(after != 0x97) & (after != 0xB7)]
            kind[lead] = kind[lead + 1] = LETTER
            buffer[lead + 1] = np.where(after < 0x9F, after + 0x20, after)
        kind[np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))] = ODD  # a special token may begin
        if (kind == ODD).any():
            blank = kind == SPACE
            edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
            odd = np.add.reduceat(kind == ODD, edge[::2], dtype=np.int64) if len(edge) else edge
            # reduceat runs to the next piece; the white space between is not odd
            for a, b in zip(edge[::2][odd > 0].tolist(), edge[1::2][odd > 0].tolist(), strict=True):
                kind[a:b] = ODD
        bound = kind[1:] != kind[:-1]
        bound |= kind[1:] == DIGIT
        quotes = np.flatnonzero(buffer == _QUOTE)
        quotes = quotes[(kind[quotes] == MARK) & (kind[quotes - 1] != MARK) & (kind[quotes + 1] == LETTER)]
        one, two = buffer[quotes + 1], buffer[quotes + 2]
        length = np.where(_ONE[one], 2, 0)
        for a, b in _TWO:
            length[(one == a) & (two == b)] = 3
        quotes, length = quotes[length > 0], length[length > 0]
        bound[quotes] = False  # bound[i] is the border before i + 1
        cut = quotes + length
        bound[cut[kind[cut] == LETTER] - 1] = True
        edge = np.flatnonzero(bound) + 1
        word = np.flatnonzero(kind[edge] != SPACE)
        starts = edge[word]
        return buffer, starts, edge[word + 1], kind[starts] == ODD

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin and the last one's end."""
        if self.known > self.most or self.used > CACHED_IDS * self.most:
            self._forget()
        raw, text_starts = joined(texts)
        buffer, starts, ends, odd = self.split(raw)
        length = ends - starts
        number = np.empty(len(starts), np.int64)
        short = np.flatnonzero(~odd & (length <= 16))
        first, second = keys(buffer, starts[short], length[short])
        found = self.table.find(first, second).astype(np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = np.lexsort((second[new], first[new]))
            a, b = first[new][order], second[new][order]
            fresh = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            at = short[new[order[fresh]]]
            data = buffer.tobytes()
            numbers = self._learn_words([data[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            self.table.add(a[fresh], b[fresh], numbers.astype(np.int32))
            found[new[order]] = numbers[np.cumsum(fresh) - 1]
        number[short] = found
        rest = np.flatnonzero(odd | (length > 16))
        if len(rest):
            number[rest] = self._others(raw, buffer, starts[rest], ends[rest], odd[rest])
        n = self.n[number].astype(np.int64)
        stop = np.cumsum(n)
        ids = self.pool[np.repeat(self.at[number] - stop + n, n) + np.arange(stop[-1] if len(stop) else 0)]
        return ids, np.concatenate([[0], stop])[np.searchsorted(starts, text_starts)]

    def _others(self, raw: np.ndarray, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> np.ndarray:
        """Numbers of long words, by their lower case, and of odd pieces, as they are."""
        whole, lower = raw.tobytes(), buffer.tobytes()
        words = [(x, whole[i:j] if x else lower[i:j]) for i, j, x in zip(starts.tolist(), ends.tolist(), odd.tolist(), strict=True)]
        known, once = self.others, {}
        for learn, kind in ((self._learn_pieces, True), (self._learn_words, False)):
            missing = [w for w in dict.fromkeys(words) if w[0] == kind and w not in known]
            for i in range(0, len(missing), RUN):
                run = missing[i : i + RUN]
                for w, k in zip(run, learn([x[1] for x in run]).tolist(), strict=True):
                    (known if len(w[1]) <= CACHED_LENGTH else once)[w] = k
        return np.array([known[w] if w in known else once[w] for w in words])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        ids, at = self.encode_flat(texts)
        at = at.tolist()
        return [ids[a:b] for a, b in zip(at, at[1:], strict=False)]


def word_encoder(path: str, words: int = CACHED_WORDS) -> WordEncoder:
    """One encoder for each worker process, which remembers so many words."""
    return one_of(("word_encoder", path, words), lambda: WordEncoder(path, words))
