"""Secrets in texts: fixed patterns, and formats learned from what these find.

The labelled credentials of each kind form a prefix tree over character classes. States whose outcomes are statistically
compatible are merged, which leaves a probabilistic automaton of the format. Every other run of credential characters
is scored by its likelihood under these automata against that of ordinary runs, whose classes are counted over all texts.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import as_before, as_text, stored

# The kinds in their order, their patterns, and the least characters of what is checked.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Runs that are scored: as many credential characters as the smallest credential has, or more.
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_.=-]{{{min(LEAST.values())},}}")

#: Labelled credentials of a kind that the automaton is learned from, and the most characters of one.
TRAINING = 1000
TRAINING_CHARS = 200

#: Confidence of the compatibility test, and the fewest strings that make a format.
ALPHA = 0.05
FEWEST = 5

#: Bits per character by which a format must explain a run better than ordinary runs do.
MARGIN = 0.5

#: Class strings of up to so many characters whose kind a task remembers, as words of the same classes come again and again.
REMEMBERED, REMEMBERED_CHARS = 200_000, 64

_CLASSES = {
    **dict.fromkeys("0123456789", "d"),
    **dict.fromkeys("abcdef", "h"),
    **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"),
    **dict.fromkeys("ABCDEF", "H"),
    **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "U"),
}
_SIZES = Counter(_CLASSES.values())
_AS_CLASSES = str.maketrans(_CLASSES)
END = "$"

SPAN = "struct<kind: string, start: int, end: int, value: string>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``kind, start, end`` and the credential of every match that is long enough, in order."""
    found = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                found.append(("assign", m.start(), m.end(), m[2]))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= LEAST["access"]:
            found.append(("access", m.start(), m.end(), m[0]))
    # A run of hex digits is matched whole, so asking for its least size at once finds the same runs.
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


def candidate_spans(text: str, base: Iterable[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Runs of credential characters, but for those that lie in a base span."""
    taken = [(start, end) for _, start, end, _ in base]
    runs = [("", m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text)]
    if taken:
        runs = [run for run in runs if not any(a <= run[1] and run[2] <= b for a, b in taken)]
    return runs


def class_pairs(runs: Iterable[str]) -> Counter[str]:
    """How often a class follows another in the runs; ``END`` stands before and after each of them."""
    classes = END.join(["", *runs, ""]).translate(_AS_CLASSES).encode("ascii")
    codes = np.frombuffer(classes, np.uint8).astype(np.int32)
    counts = np.bincount(codes[:-1] * 128 + codes[1:])
    return Counter({chr(pair >> 7) + chr(pair & 127): int(counts[pair]) for pair in np.flatnonzero(counts)})


def symbols(value: str) -> list[str]:
    """Character classes: digits, lower and upper hex letters, other letters; punctuation stands for itself."""
    return [_CLASSES.get(c, c) for c in value]


@dataclass
class State:
    """How many strings pass, how many end here, and where each class leads and how often."""

    passing: int = 0
    ending: int = 0
    next: dict[str, int] = field(default_factory=dict)
    count: Counter = field(default_factory=Counter)


class Automaton:
    """A probabilistic automaton learned by merging compatible states of a prefix tree."""

    def __init__(self, strings: Iterable[str], alpha: float = ALPHA) -> None:
        self.states = [State()]
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        for string in strings:
            at = self.states[0]
            at.passing += 1
            for symbol in symbols(string):
                if symbol not in at.next:
                    at.next[symbol] = len(self.states)
                    self.states.append(State())
                at.count[symbol] += 1
                at = self.states[at.next[symbol]]
                at.passing += 1
            at.ending += 1
        self._merge_all()

    @staticmethod
    def of_pairs(pairs: dict[str, int]) -> Automaton:
        """The automaton whose states are the last class read, from the result of ``class_pairs``."""
        automaton = Automaton([])
        numbers = {c: n for n, c in enumerate(sorted({c for pair in pairs for c in pair} - {END}), 1)} | {END: 0}
        automaton.states = [State() for _ in numbers]
        for (last, following), count in pairs.items():
            state = automaton.states[numbers[last]]
            state.passing += count
            if following == END:
                state.ending += count
            else:
                state.count[following] += count
                state.next[following] = numbers[following]
        return automaton

    def _differ(self, hits_a: int, a: int, hits_b: int, b: int) -> bool:
        return abs(hits_a / a - hits_b / b) > self.bound * (1 / math.sqrt(a) + 1 / math.sqrt(b))

    def _compatible(self, first: int, second: int) -> bool:
        """Whether both states, and all that follows them alike, end and continue equally often."""
        waiting = [(first, second)]
        while waiting:
            a, b = (self.states[k] for k in waiting.pop())
            if not a.passing or not b.passing:
                continue
            if self._differ(a.ending, a.passing, b.ending, b.passing):
                return False
            for symbol in a.count.keys() | b.count.keys():
                if self._differ(a.count[symbol], a.passing, b.count[symbol], b.passing):
                    return False
                if symbol in a.next and symbol in b.next:
                    waiting.append((a.next[symbol], b.next[symbol]))
        return True

    def _fold(self, into: int, other: int) -> None:
        """Add the tree below ``other`` to ``into``."""
        waiting = [(into, other)]
        while waiting:
            target, source = waiting.pop()
            a, b = self.states[target], self.states[source]
            a.passing += b.passing
            a.ending += b.ending
            for symbol, state in b.next.items():
                a.count[symbol] += b.count[symbol]
                if symbol in a.next:
                    waiting.append((a.next[symbol], state))
                else:
                    a.next[symbol] = state

    def _merge_all(self) -> None:
        """Red states are kept; each state they lead to is folded into the first compatible one or kept."""
        red = [0]
        blue = [(0, symbol) for symbol in sorted(self.states[0].next)]
        while blue:
            parent, symbol = blue.pop(0)
            child = self.states[parent].next[symbol]
            if child in red:
                continue
            for state in red:
                if self._compatible(state, child):
                    self.states[parent].next[symbol] = state
                    self._fold(state, child)
                    break
            else:
                red.append(child)
            seen = set(blue)
            for state in red:
                for s, target in sorted(self.states[state].next.items()):
                    if target not in red and (state, s) not in seen:
                        blue.append((state, s))
        kept = {state: k for k, state in enumerate(red)}
        for state in red:
            self.states[state].next = {s: kept[t] for s, t in self.states[state].next.items()}
        self.states = [self.states[state] for state in red]

    def bits(self, value: str) -> float:
        """Information of a string, its end included; classes that a state has not seen get little probability."""
        return self.bits_of(symbols(value))

    def bits_of(self, classes: Sequence[str]) -> float:
        """Of a string of these classes, whichever."""
        at, total = self.states[0], 0.0
        unseen = len(_SIZES) + 7
        for symbol in classes:
            chance = (at.count[symbol] + 0.01) / (at.passing + 0.01 * unseen)
            total -= math.log2(chance / _SIZES.get(symbol, 1))
            # After an unseen class the string is read on in the first state.
            at = self.states[at.next.get(symbol, 0)]
        return total - math.log2((at.ending + 0.01) / (at.passing + 0.01 * unseen))


@dataclass
class Formats:
    """One automaton for each kind with enough examples, and one of ordinary runs to compare with."""

    kinds: dict[str, Automaton]
    limits: dict[str, float]
    ordinary: Automaton | None

    @staticmethod
    def learned(examples: dict[str, list[str]], ordinary: list[str] | Automaton | None) -> Formats:
        enough = {kind: sorted(v) for kind, v in sorted(examples.items()) if len(v) >= FEWEST}
        kinds = {kind: Automaton(values) for kind, values in enough.items()}
        # A run must not be less likely, per character, than nearly all of the examples.
        limits = {
            kind: sorted(kinds[kind].bits(v) / len(v) for v in values)[int(0.95 * (len(values) - 1))]
            for kind, values in enough.items()
        }
        if isinstance(ordinary, list):
            ordinary = Automaton(sorted(ordinary)) if len(ordinary) >= FEWEST else None
        return Formats(kinds, limits, ordinary)

    def best(self, value: str) -> str | None:
        """The kind whose format explains the run best, if any does so well enough."""
        return self.best_of(value.translate(_AS_CLASSES))

    def best_of(self, classes: str) -> str | None:
        """The same for a run of these classes: nothing else of it matters."""
        size = len(classes)
        plain = self.ordinary.bits_of(classes) / size if self.ordinary else math.log2(68)
        scores = {kind: a.bits_of(classes) / size for kind, a in self.kinds.items()}
        fitting = {k: s for k, s in scores.items() if s <= self.limits[k] and s + MARGIN <= plain}
        return min(fitting, key=lambda k: (fitting[k], KINDS.index(k))) if fitting else None


def credential_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``kind, value, count``: the credentials of the pattern matches, and without a kind the class pairs of other runs,
    counted for every batch of texts."""
    narrow = docs.select(F.col(text_column).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter[tuple[str, str]] = Counter()
            rest: list[str] = []
            for text in batch["text"]:
                base = base_spans(text or "")
                counts.update((kind, value) for kind, _, _, value in base)
                rest += [value for *_, value in candidate_spans(text or "", base)]
            rows = [(*key, n) for key, n in counts.items()]
            rows += [("", pair, n) for pair, n in class_pairs(rest).items() if pair != END + END]
            yield pd.DataFrame(rows, columns=["kind", "value", "count"])

    return narrow.mapInPandas(run, "kind string, value string, count bigint")


def _sample(spans: DataFrame, bound: int) -> dict[str, list[str]]:
    """At most ``bound`` different values of each kind, chosen by their hash."""
    values = spans.where(F.length("value") <= TRAINING_CHARS).groupBy("kind", "value").agg(F.lit(1))
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    rows = values.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= bound)
    found: dict[str, list[str]] = {}
    for row in rows.select("kind", "value").collect():
        found.setdefault(row["kind"], []).append(row["value"])
    return found


def learn_formats(counts: DataFrame, bound: int = TRAINING) -> Formats:
    """Formats from the result of ``credential_counts``: at most ``bound`` different credentials of each kind of up to
    ``TRAINING_CHARS`` characters, and the class pairs of all other runs. The driver holds a row for each pair of classes."""
    pairs = counts.where("kind = ''").groupBy("value").agg(F.sum("count").alias("count"))
    ordinary = {row["value"]: row["count"] for row in pairs.collect()}
    fewest = sum(n for pair, n in ordinary.items() if pair[0] == END) >= FEWEST
    return Formats.learned(_sample(counts.where("kind <> ''"), bound), Automaton.of_pairs(ordinary) if fewest else None)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row; ``spans`` holds ``kind, start, end, value`` in order of start and kind.

    Positions are code points, ends exclusive. Kinds are those of ``KINDS`` for pattern matches, which are all kept, and
    ``like_`` and the kind for other runs of that format. Null and empty texts have no spans. Repeated rows are alike, a
    null id stays null, an empty table gives an empty result, other columns are ignored.

    Texts are read twice, to learn and to score, and never shuffled; what is stored and sampled are credentials and counts.
    """
    formats = docs.sparkSession.sparkContext.broadcast(learn_formats(stored(credential_counts(docs, text_column), "secrets")))
    narrow = docs.select(as_text(id_column, "doc_id"), F.col(text_column).alias("text"))
    names = ("kind", "start", "end", "value")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learned, known = formats.value, {}

        def kind_of(value: str) -> str | None:
            classes = value.translate(_AS_CLASSES)
            if classes in known:
                return known[classes]
            kind = learned.best_of(classes)
            if len(classes) <= REMEMBERED_CHARS:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[classes] = kind
            return kind

        def spans_of(text: str) -> list[dict]:
            base = base_spans(text)
            rest = candidate_spans(text, base) if learned.kinds else []
            more = [(f"like_{kind}", *span[1:]) for span in rest if (kind := kind_of(span[3]))]
            return sorted((dict(zip(names, span, strict=True)) for span in [*base, *more]), key=_order)

        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": [spans_of(text or "") for text in batch["text"]]})

    scored = narrow.mapInPandas(run, f"doc_id string, spans array<{SPAN}>")
    return as_before(scored, "doc_id", dict(docs.dtypes)[id_column])


def _order(span: dict) -> tuple:
    kind = span["kind"].removeprefix("like_")
    return span["start"], span["kind"] != kind, KINDS.index(kind)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
