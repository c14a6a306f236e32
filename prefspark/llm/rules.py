"""Quality rules as a short-circuit cascade.

Each rule reads measures of a text, which are made when first asked for. On a sample every measure is
timed, the measures that each rule reads are noted, and texts are counted by the set of rules that reject
them. The order then follows step by step: next is the rule that rejects most of the texts still left per second
of measures not made yet. A document leaves the cascade at the first rule that rejects it. The
verdict is that of all rules together, so it does not depend on the order; the order only decides how much
work is saved. `rejected_by` does depend on it, and costs are timed, so a run that must name the same rules
again is given the order (`order`).

Defined results
* A null text counts as an empty one: no words, and too short.
* Repeated rows get equal rows. An empty table gives an empty result, with the rules in given order.
* Output columns replace input columns of the same name; other columns are carried.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark.llm.common import BLANKS, without

SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 2000
SEED = 42
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Text:
    """Measures of one text, each made when it is first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "surrogatepass")

    def __getattr__(self, name: str):
        # Python asks here only for what is not there yet.
        if name not in MAKERS:
            raise AttributeError(name)
        value = MAKERS[name](self)
        setattr(self, name, value)
        return value


class TimedText(Text):
    """Notes the seconds that each measure took, without those of the measures that it asked for."""

    def __init__(self, text: str | None):
        self.seconds: dict[str, float] = {}
        self.inner = 0.0
        super().__init__(text)

    def __getattr__(self, name: str):
        before, self.inner, start = self.inner, 0.0, time.perf_counter()
        value = super().__getattr__(name)
        spent = time.perf_counter() - start
        self.seconds[name] = spent - self.inner
        self.inner = before + spent
        return value


def _chars_of_words(t: Text) -> int:
    return len(t.text) - (len(t.raw) - len(t.raw.translate(None, BLANKS)))


def _repeat_words(t: Text) -> int:
    """Words in windows of three that the text holds twice or more."""
    if t.n_words < 3:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in t.words], dtype=np.int64)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1 << 20:  # three such numbers would not fit in 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.flatnonzero(np.diff(windows[order]) == 0)
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[order[same] + shift] = True
        covered[order[same + 1] + shift] = True
    return int(covered.sum())


MAKERS: dict[str, Callable[[Text], object]] = {
    "words": lambda t: t.raw.split(),
    "n_words": lambda t: len(t.words),
    "word_chars": _chars_of_words,
    "n_symbols": lambda t: len(t.raw) - len(t.raw.translate(None, SYMBOLS)),
    "lines": lambda t: [line for line in t.raw.split(b"\n") if line.strip()],
    "n_dup_lines": lambda t: len(t.lines) - len(set(t.lines)),
    "n_repeat_words": _repeat_words,
    "n_shouted": lambda t: sum(1 for w in t.text.split() if len(w) > 1 and w.isupper()),
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]
    #: Whether it counts for `base_failed`.
    base: bool = False


RULES = (
    Rule("too_short", lambda t: t.n_words < 50, base=True),
    Rule("repetitive", lambda t: 100 * t.n_repeat_words > 50 * t.n_words, base=True),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("shouting", lambda t: 10 * t.n_shouted > 3 * t.n_words),
    Rule("same_lines", lambda t: 10 * t.n_dup_lines > 3 * len(t.lines)),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words),
)


@dataclass(frozen=True)
class Sample:
    """What a sample tells: mean seconds of measures, mean own seconds of rules and the measures they read, and
    how many texts each set of rules (as bits, by place) rejects."""

    seconds: dict[str, float]
    reads: dict[str, frozenset[str]]
    patterns: dict[int, int]

    @property
    def seen(self) -> int:
        return sum(self.patterns.values())

    def cost(self, rule: Rule, made: Iterable[str]) -> float:
        """Seconds of a rule once these measures are made."""
        return self.seconds.get(rule.name, 0.0) + sum(self.seconds.get(m, 0.0) for m in self.reads.get(rule.name, frozenset()) - set(made))

    def work(self, order: Sequence[Rule], rules: Sequence[Rule], made: Iterable[str] = ()) -> float:
        """Seconds of the cascade over the sample in an order."""
        place, made = {r.name: k for k, r in enumerate(rules)}, set(made)
        total, left = 0.0, dict(self.patterns)
        for rule in order:
            total += sum(left.values()) * self.cost(rule, made)
            made |= self.reads.get(rule.name, frozenset())
            left = {p: n for p, n in left.items() if not p >> place[rule.name] & 1}
        return total


def sampled(docs: DataFrame, rules: Sequence[Rule] = RULES, *, sample_rows=SAMPLE_ROWS, seed=SEED, text_col="text") -> Sample:
    """Times measures and counts rejections over about `sample_rows` rows.

    The driver sees a row per task and set of rules that occurs, at most as many as sampled rows.
    """
    rows = docs.count()
    sample = docs.select(F.col(text_col).alias("text"))
    if rows > sample_rows:
        sample = sample.sample(False, sample_rows / rows, seed)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, seen, read = Counter(), Counter(), set()
        for batch in batches:
            for value in batch["text"]:
                bits = 0
                for k, rule in enumerate(rules):
                    text = TimedText(value)
                    start = time.perf_counter()
                    bits |= bool(rule.rejects(text)) << k
                    whole = time.perf_counter() - start
                    spent["rule", rule.name] += max(whole - sum(text.seconds.values()), 0.0)
                    for name, seconds in text.seconds.items():
                        # A measure is made anew for each rule that reads it.
                        spent["measure", name] += seconds
                        seen["measure", name] += 1
                        read.add((rule.name, name))
                seen["texts", str(bits)] += 1
        told = [(kind, name, "", spent[kind, name], 0) for kind, name in spent]
        told += [(kind, name, "", 0.0, n) for (kind, name), n in seen.items()]
        told += [("reads", rule, name, 0.0, 0) for rule, name in read]
        yield pd.DataFrame(told, columns=["kind", "name", "other", "seconds", "n"])

    parts = sample.mapInPandas(measure, "kind string, name string, other string, seconds double, n long")
    told = parts.groupBy("kind", "name", "other").agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n")).collect()
    patterns = {int(r.name): r.n for r in told if r.kind == "texts"}
    n = max(sum(patterns.values()), 1)
    seconds = {r.name: r.seconds / (n if r.kind == "rule" else max(r.n, 1)) for r in told if r.kind in ("rule", "measure")}
    reads = {rule.name: frozenset(r.other for r in told if r.kind == "reads" and r.name == rule.name) for rule in rules}
    return Sample(seconds, reads, patterns)


def ordered(rules: Sequence[Rule], sample: Sample, made: Iterable[str] = ()) -> list[Rule]:
    """The rules, each time the one that rejects most of what is left per second beyond the measures made."""
    place, made = {r.name: k for k, r in enumerate(rules)}, set(made)
    rest, order, left = list(rules), [], dict(sample.patterns)
    while rest:
        rejected = {r.name: sum(n for p, n in left.items() if p >> place[r.name] & 1) for r in rest}
        worth = lambda r: rejected[r.name] / max(sample.cost(r, made), 1e-9)  # noqa: E731, B023
        rest.sort(key=lambda r: -worth(r))  # stable, so that equals stay in given order  # noqa: B023
        rule = rest.pop(0)
        order.append(rule)
        made |= sample.reads.get(rule.name, frozenset())
        left = {p: n for p, n in left.items() if not p >> place[rule.name] & 1}
    return order


def cascade(
    docs: DataFrame, rules: Sequence[Rule] = RULES, *, measures=False, order: Sequence[Rule] | None = None, text_col="text",
    **sampling,
) -> DataFrame:
    """The documents with `kept` and `rejected_by` (null for kept ones, else the first rule to reject).

    With `measures` also those of MEASURES and `base_failed`, which are then made for every document, before
    the cascade, and cost its rules nothing.
    """
    if order is None:
        sample = sampled(docs, rules, text_col=text_col, **sampling)
        order = ordered(rules, sample, MEASURES if measures else ())
    names = (*MEASURES, "base_failed") if measures else ()
    base = [rule for rule in rules if rule.base]

    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            text = Text(value)
            told = [getattr(text, name) for name in MEASURES] + [any(r.rejects(text) for r in base)] if measures else []
            first = next((rule.name for rule in order if rule.rejects(text)), None)
            rows.append([first is None, first, *told])
        return pd.DataFrame(rows, columns=["kept", "rejected_by", *names])

    kinds = {"base_failed": "boolean"}
    schema = ", ".join(["kept boolean", "rejected_by string", *[f"{n} {kinds.get(n, 'long')}" for n in names]])
    kept = without(docs, "kept", "rejected_by", *names)
    judged = docs.select(F.struct(*kept).alias("doc"), F.pandas_udf(judge, schema)(F.col(text_col)).alias("verdict"))
    return judged.select("doc.*", "verdict.*")
