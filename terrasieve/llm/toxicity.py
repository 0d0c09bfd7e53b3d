"""Toxicity: a weighted finite-state pattern grammar over clauses.

Words become symbols (insult, threat, target, negation, reporting, end of clause, other). Small transducers follow negation, reported
speech, targets and the strongest find of a clause; their product is one table. At a clause's end it emits the kind of clause that
matched; words alone emit nothing. Weights of insults (words and stems) are log-odds learned from labelled rows, weights of clause kinds
are learned by logistic loss; the fixed word lists below only seed the symbols. A text's score is the logistic of its weighted clauses.

Defined results: null text counts as empty. A text without a matched clause, the empty text too, gets the base score. Without labels of
both kinds the fixed lists and DEFAULT_WEIGHTS score. Words of any length count, and so does every clause: logs of counts dampen many, no
cap ends them. Repeated rows each get a row. An empty table gives an empty result. Extra columns are not read.

Plan: the learning sample has `most` rows of each label at most (a documented bound). Spark counts its words. All those that a hundredth
of the sample's toxic texts hold, and that are common enough among them, reach the driver: at most a hundred times as many as a toxic
text has different terms. Scoring is one pass without a shuffle; the lexicon and the table go along with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasieve.llm.columns import whole_text
from terrasieve.llm.learning import held_out, labelled_texts, logistic_fit, sigmoid
from terrasieve.llm.worker_memory import make_room, slices

# Seed word lists in English, German, French and Spanish.
INSULTS = "idiot moron stupid trash scum loser pathetic worthless disgusting clown dummkopf abschaum connard ordure imbécile estúpido basura idiota".split()
THREATS = "kill hurt destroy punch stab shoot burn beat töten schlagen tuer frapper matar golpear".split()
TARGETS = "you your yours he she him her they them du dich dir ihr euch tu te toi vous tú ti usted ustedes él ella".split()
NEGATIONS = "not no never nobody isn't aren't wasn't don't nicht kein keine nie ne pas jamais nunca ningún".split()
REPORTS = "said says wrote writes told claimed reported quoted sagte schrieb dit écrit dijo escribió".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, COMMA, STOP = range(8)
_SEEDS = {w: s for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS), (INSULT, INSULTS)) for w in words}

#: Rows of each label in the learning sample at most, and stems' lengths.
MOST, STEMS = 6000, (4, 5, 6)
#: A term joins the lexicon from this log-odds on.
LEAST_ODDS = 4.0
#: Pieces that a worker remembers; beyond it the memory starts anew. Longer pieces aren't remembered.
CACHED_PIECES, CACHED_LENGTH = 100_000, 64

# Component transducers: next state by (state, symbol). They end with a clause; reported speech ends with its sentence.


def _negation(state: int, symbol: int) -> int:
    """Words that a negation still reaches."""
    return 0 if symbol in (COMMA, STOP) else 3 if symbol == NEGATION else max(0, state - 1)


def _reported(state: int, symbol: int) -> int:
    return 0 if symbol == STOP else 1 if symbol == REPORT else state


def _target(state: int, symbol: int) -> int:
    return 0 if symbol in (COMMA, STOP) else 1 if symbol == TARGET else state


def _find(state: int, symbol: int, negated: bool) -> int:
    """Strongest find of the clause: 0 none, 1 negated insult, 2 negated threat, 3 threat, 4 insult."""
    if symbol in (COMMA, STOP):
        return 0
    return max(state, {INSULT: 1 if negated else 4, THREAT: 2 if negated else 3}.get(symbol, 0))


def compose() -> tuple[list[list[int]], list[list[int]]]:
    """The product: next state and output by [state][symbol]. Output: -1, or find * 4 + target * 2 + reported at a clause's end."""
    states = {s: i for i, s in enumerate(product(range(4), range(2), range(2), range(5)))}
    step, emit = [[0] * 8 for _ in states], [[-1] * 8 for _ in states]
    for (n, r, t, f), i in states.items():
        for symbol in range(8):
            step[i][symbol] = states[_negation(n, symbol), _reported(r, symbol), _target(t, symbol), _find(f, symbol, n > 0)]
            if symbol in (COMMA, STOP) and f:
                emit[i][symbol] = f * 4 + t * 2 + r
    return step, emit


STEP, EMIT = compose()
#: Without labels: base score, then the weight of clauses by kind (negated insults, negated threats, threats, insults; of each alone,
#: reported, with a target, both), of the strongest clause, and of their share.
DEFAULT_WEIGHTS = np.array([-2.5] + [0.2] * 4 + [0.3] * 4 + [2.0, 1.0, 3.0, 2.0] + [4.0, 2.0, 5.0, 3.0] + [0.3, 0.0])

_WORD = re.compile(r"\w+")
_SPLIT = re.compile(r"[\W_]+")


@dataclass
class Grammar:
    """lexicon: log-odds of insulting words, and of stems written with a trailing *."""

    lexicon: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: DEFAULT_WEIGHTS)

    def __post_init__(self):
        self.seen: dict[str, tuple[int, int, float]] = {}
        self.codes: dict[tuple[int, int, float], tuple[int, int, float]] = {}  # one object for each: most pieces are alike

    def insult(self, word: str) -> float:
        found = [self.lexicon.get(word, 0.0), *(self.lexicon.get(f"{word[:n]}*", 0.0) for n in STEMS if len(word) >= n)]
        return max(found)

    def symbols(self, piece: str) -> tuple[int, int, float]:
        """(symbol, symbol of the mark at its end or -1, weight) of a piece between white space."""
        runs = [m.span() for m in _WORD.finditer(piece)]
        word = piece[runs[0][0] : runs[-1][1]] if runs else ""
        end = piece[-1:]
        mark = STOP if end in ".!?…" else COMMA if end in ",;:)" else -1
        weight = max([self.insult(w) for w in {word, *_SPLIT.split(word)} if w], default=0.0)
        symbol = INSULT if weight else _SEEDS.get(word, OTHER)
        code = (symbol, mark, weight)
        return self.codes.setdefault(code, code)

    def clauses(self, text: str) -> list[tuple[int, float]]:
        """(kind, weight) of each matched clause."""
        if len(self.seen) > CACHED_PIECES:
            self.seen = {}
        seen, pieces, once = self.seen, text.lower().split(), {}
        for p in [p for p in set(pieces) if p not in seen]:
            (seen if len(p) <= CACHED_LENGTH else once)[p] = self.symbols(p)
        coded = [seen[p] if p in seen else once[p] for p in pieces] if once else [seen[p] for p in pieces]
        at = [i for i, c in enumerate(coded) if c[0] in (INSULT, THREAT)]
        out: list[tuple[int, float]] = []
        done = -1
        for i in at:  # only sentences with a find can emit
            if i < done:
                continue
            start = i
            while start and coded[start - 1][1] != STOP:
                start -= 1
            state, heavy, j = 0, 0.0, start
            while j < len(coded):
                symbol, mark, weight = coded[j]
                state = STEP[state][symbol]
                heavy = max(heavy, weight)
                j += 1
                if mark >= 0 or j == len(coded):
                    mark = STOP if j == len(coded) else mark
                    if EMIT[state][mark] >= 0:
                        out.append((EMIT[state][mark], heavy))
                    state, heavy = STEP[state][mark], 0.0
                    if mark == STOP:
                        break
            done = j
        return out

    def features(self, text: str) -> np.ndarray:
        """Bias, log counts by kind of clause, weight of the strongest clause, log of clauses for each five words. Nothing is capped: every clause
        counts."""
        x = np.zeros(len(DEFAULT_WEIGHTS))
        x[0] = 1.0
        found = self.clauses(text)
        for kind, _ in found:
            x[1 + kind - 4] += 1
        x[1:17] = np.log1p(x[1:17])
        if found:
            x[-2] = max(w for _, w in found) / 5
            x[-1] = np.log1p(20 * len(found) / max(len(text) / 6, 1))
        return x

    def score(self, texts: list[str]) -> np.ndarray:
        return sigmoid(np.stack([self.features(t) for t in texts]) @ self.weights) if texts else np.zeros(0)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word and stem of a text once: (term, label)."""
    for b in batches:
        for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
            words = {w for w in _SPLIT.split(text.lower()) if len(w) >= 3}
            terms = list(words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n})
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([label] * len(terms), pa.int32())], names=["term", "label"])


def learn_toxicity(docs: DataFrame, labels: DataFrame, mod: int = 3, remainder: int = 1, most: int = MOST, id_col: str = "doc_id", text_col: str = "text") -> Grammar:
    """Learn from labels.toxic of rows that the hold-out rule leaves. Equal texts count once."""
    sample = labelled_texts(docs, labels, "toxic", mod, remainder, most, id_col, text_col)
    once = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.min_by(F.struct("label", "text"), "doc_id").alias("s")).select("s.label", "s.text")
    totals = {r[0]: r[1] for r in once.groupBy("label").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    seeds = dict.fromkeys(INSULTS, LEAST_ODDS)
    if not clean or not toxic:
        return Grammar(seeds)
    counted = once.select("text", "label").mapInArrow(_terms, "term string, label int").groupBy("term").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    least = max(3, round(0.01 * toxic))
    found = counted.filter(F.col("t") >= least).withColumn("w", odds).filter(F.col("w") >= LEAST_ODDS).collect()
    grammar = Grammar(seeds | {r.term: r.w for r in found})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [grammar.features(t).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(x, pa.binary())], names=["label", "x"])

    learned = once.select("text", "label").mapInArrow(rows, "label int, x binary").collect()
    learned.sort(key=lambda r: (r.label, r.x))  # the bounded sample, in the driver
    x = np.stack([np.frombuffer(r.x) for r in learned])
    y = np.array([r.label for r in learned], dtype=float)
    even = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    grammar.weights = logistic_fit(x, y, l2=1e-4, steps=1500, weight=even)
    return grammar


def score_toxicity(docs: DataFrame, grammar: Grammar, cut: float = 0.7, mod: int = 3, remainder: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    d = whole_text(docs, id_col, text_col)
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("toxicity")
        for part in chain.from_iterable(map(slices, batches)):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(grammar.score(part.column("text").to_pylist()), pa.float64())], names=["doc_id", "score"])

    scored = d.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(mod, remainder).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, grammar: Grammar, cut: float = 0.7, text_col: str = "text") -> DataFrame:
    """docs without the rows whose score reaches cut, with its own columns and types."""
    at = docs.columns.index(text_col)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("toxicity")
        for b in batches:
            for part in slices(b, at):
                yield part.filter(pa.array(grammar.score([t or "" for t in part.column(at).to_pylist()]) < cut))

    return renamed.mapInArrow(run, renamed.schema).toDF(*docs.columns)
