"""A backend whose model lives in the Python workers."""

from __future__ import annotations

import inspect
import sys
import types
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from typing import Any, Protocol, Tuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark.functions.rubric_text import readable

GENERATED = "struct<texts: array<string>, error: string>"
REPLY = "struct<text: string, error: string>"


class WorkerModel(Protocol):
    """The calls a model object answers. Each takes and returns lists of equal length."""

    def score(self, pairs: list[tuple[str, str]]) -> list[float]: ...

    def generate(
        self, chats: list[list[dict[str, str]]], n: int, seed: int, stops: Sequence[str]
    ) -> list[list[str]]: ...

    def complete(self, prompts: list[str], attempt: int = 1) -> list[str]:
        """`attempt` counts how often these prompts have been asked. A model may do without it."""
        ...

    def token_ends(self, texts: list[str]) -> list[list[int]]:
        """Where each token of a text ends, in characters. Only budgets in tokens ask for it."""
        ...


Outcome = Tuple[Any, str | None]
Ask = Callable[[list], list[Outcome]]

#: Pieces of Arrow batches that may wait for the slowest call of the first of them.
AHEAD = 4
#: Bytes of such a piece, which is as much as becomes Python objects at a time. Spark's batches have rows by
#: the thousand, whatever their size.
PIECE_BYTES = 4 << 20
#: Characters of text whose token ends are held together; a longer text alone.
PORTION = 1 << 20

_TEXT = pa.string()
_SCORES = pa.list_(pa.float64())
_GENERATED = pa.struct([("texts", pa.list_(_TEXT)), ("error", _TEXT)])
_REPLY = pa.struct([("text", _TEXT), ("error", _TEXT)])
_CUTS = pa.list_(pa.struct([("n", pa.int32()), ("cut", pa.int32())]))
_WITHIN = pa.list_(pa.struct([("score", pa.float64()), ("cut", pa.bool_())]))


def _outcomes(run: Callable[[list], list], items: list) -> list[Outcome]:
    """(value, error) per item. A failed batch is tried again item by item, so that only the failing items
    carry an error."""
    try:
        values = run(items)
        if len(values) != len(items):
            raise ValueError(f"{len(values)} results for {len(items)} inputs")
        return [(value, None) for value in values]
    except Exception as failure:
        if len(items) > 1:
            return [outcome for item in items for outcome in _outcomes(run, [item])]
        return [(None, f"{type(failure).__name__}: {failure}")]


def _until(run: Callable[[list, int], list], items: list, attempts: int, settled: Callable[[Any], bool]) -> list[Outcome]:
    """As `_outcomes`, asking up to `attempts` times, each time for the items alone that have not settled.

    An error ends its item.
    """
    outcomes: list[Outcome] = [(None, None)] * len(items)
    still = list(range(len(items)))
    for attempt in range(1, attempts + 1):
        for i, outcome in zip(still, _outcomes(lambda some, k=attempt: run(some, k), [items[i] for i in still])):
            outcomes[i] = outcome
        still = [i for i in still if outcomes[i][1] is None and not settled(outcomes[i][0])]
        if not still:
            break
    return outcomes


def _pieces(batches: Iterable[Tuple[pa.Array, ...]]) -> Iterator[list[list]]:
    """The columns of Arrow batches as Python lists, a piece of the rows after another."""
    for columns in batches:
        n, size = len(columns[0]), sum(column.nbytes for column in columns)
        step = max(1, n * PIECE_BYTES // max(1, size))
        for first in range(0, n, step):
            yield [column.slice(first, step).to_pylist() for column in columns]


def _portions(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts of PORTION characters together, or one longer text."""
    portion: list[str] = []
    size = 0
    for text in texts:
        if portion and size + len(text) > PORTION:
            yield portion
            portion, size = [], 0
        portion.append(text)
        size += len(text)
    if portion:
        yield portion


class _Waiting:
    """A piece of an Arrow batch whose calls are under way."""

    def __init__(self, batch: Any, n_items: int):
        self.batch = batch
        self.results: list[Outcome] = [(None, None)] * n_items
        self.calls: list[Future] = []

    def fill(self, ask: Ask, places: list[int], items: list) -> None:
        for i, outcome in zip(places, ask(items)):
            self.results[i] = outcome

    def finished(self) -> list[Outcome]:
        for call in self.calls:
            call.result()
        return self.results


def _in_flight(
    batches: Iterable[tuple[Any, list]], ask: Ask, batch_size: int, threads: int, weight: Callable[[Any], int]
) -> Iterator[tuple[Any, list[Outcome]]]:
    """For each (batch, items) the batch with an outcome per item, in the order of the batches.

    Items of similar length share a call, so padding stays small; a null item is not asked about. Calls of
    later batches go on while one of an earlier batch is slow: there are always up to `threads` of them,
    none waits in a queue, and at most AHEAD batches are held. The batches here are pieces of bounded size.
    """
    with ThreadPoolExecutor(max_workers=threads) as pool:
        waiting: deque[_Waiting] = deque()
        running: set[Future] = set()
        for batch, items in batches:
            slot = _Waiting(batch, len(items))
            waiting.append(slot)
            order = sorted((i for i, item in enumerate(items) if item is not None), key=lambda i: weight(items[i]))
            for k in range(0, len(order), batch_size):
                if len(running) >= threads:
                    running = wait(running, return_when=FIRST_COMPLETED).not_done
                places = order[k : k + batch_size]
                call = pool.submit(slot.fill, ask, places, [items[i] for i in places])
                slot.calls.append(call)
                running.add(call)
            while waiting and (len(waiting) > AHEAD or all(call.done() for call in waiting[0].calls)):
                first = waiting.popleft()
                yield first.batch, first.finished()
        while waiting:
            first = waiting.popleft()
            yield first.batch, first.finished()


def _cut(length: int, ends: Sequence[int], most: int, keep: str) -> dict[str, int]:
    """How many characters of a text the first or last `most` of its tokens are."""
    n = len(ends)
    if n <= most:
        kept = length
    elif most <= 0:
        kept = 0
    else:
        kept = ends[most - 1] if keep == "head" else length - ends[n - most - 1]
    return {"n": n, "cut": int(kept)}


def _cuts_of(model: WorkerModel, budgets: Mapping[str, set[int]], keep: str) -> dict[tuple[str, int], dict[str, int]]:
    """`_cut` by text and budget. A text is encoded once, and its token ends go when its cuts are known."""
    cuts = {}
    for texts in _portions(budgets):
        for text, ends in zip(texts, model.token_ends(texts), strict=True):
            for most in budgets[text]:
                cuts[text, most] = _cut(len(text), ends, most, keep)
    return cuts


def _asked_for(pairs: Iterable[tuple[str | None, int]]) -> dict[str, set[int]]:
    """The budgets of each text."""
    budgets: dict[str, set[int]] = {}
    for text, most in pairs:
        if text is not None:
            budgets.setdefault(text, set()).add(most)
    return budgets


def _tail(text: str, cut: int) -> str:
    return text[len(text) - cut :]


def _tails(
    model: WorkerModel, asked: list[str | None], lists: list[list[str | None] | None], most: int
) -> Iterator[list[tuple[tuple[str, str] | None, bool]] | None]:
    """For each response its conversation cut to its tail, None where a text is, and whether that was cut.

    A response keeps its own tail and leaves its own room to the instruction.
    """
    of_answers = _cuts_of(model, _asked_for((r, most) for row in lists if row is not None for r in row), "tail")
    room = lambda r: most if r is None else max(0, most - of_answers[r, most]["n"])
    rooms = [None if row is None else [room(r) for r in row] for row in lists]
    of_asked = _cuts_of(
        model, _asked_for((a, b) for a, row in zip(asked, rooms) if row is not None for b in row), "tail"
    )
    for a, row, of in zip(asked, lists, rooms, strict=True):
        if row is None:
            yield None
            continue
        found = []
        for r, b in zip(row, of, strict=True):
            shown = None if a is None or r is None else (_tail(a, of_asked[a, b]["cut"]), _tail(r, of_answers[r, most]["cut"]))
            over = (r is not None and of_answers[r, most]["n"] > most) or (a is not None and of_asked[a, b]["n"] > b)
            found.append((shown, over))
        yield found


def _takes_attempt(call: Callable) -> bool:
    return "attempt" in inspect.signature(call).parameters


def _held_model(key: str, factory: Callable[[], WorkerModel]) -> WorkerModel:
    """The model of this worker process.

    It is kept in sys.modules: functions that travel with the job bring new module globals each time.
    """
    holder = sys.modules.setdefault("_prefspark_models", types.ModuleType("_prefspark_models"))
    if not hasattr(holder, key):
        # Another backend's model is of no more use to this process.
        holder.__dict__.clear()
        setattr(holder, key, factory())
    return getattr(holder, key)


class WorkerBackend:
    """Adapts a model object to columns by iterator Arrow UDFs.

    `factory` runs once per Python worker process, which Spark keeps from task to task. Calls that follow
    one another in a plan (a critique, then its rewrite) have processes of their own, each with its
    model. Only the model's own inputs are sent to Python; the other columns of a row wait in the JVM. Calls in flight in the whole cluster are at most
    `partitions x threads`, so the operators' `partitions` argument caps them.
    """

    def __init__(
        self,
        factory: Callable[[], WorkerModel],
        name: str = "worker",
        batch_size: int = 16,
        threads: int = 1,
    ):
        self.name = name
        key = uuid.uuid4().hex
        self._held = lambda: _held_model(key, factory)
        self._flow = lambda batches, ask, weight: _in_flight(batches, ask, batch_size, threads, weight)

    def score(self, instruction: Column, responses: Column) -> Column:
        return self._score(F.when(responses.isNotNull(), F.array(instruction)), responses)

    def score_pairs(self, instructions: Column, responses: Column) -> Column:
        return self._score(instructions, responses)

    def _score(self, instructions: Column, responses: Column) -> Column:
        """Scores by an array of one instruction for all responses of a row, or of one for each."""
        factory, flow = self._held, self._flow

        def pairs_of(asked, answers) -> list[tuple[str, str] | None]:
            of = [asked[0]] * len(answers) if len(asked) == 1 else asked
            return [None if i is None or r is None else (i, r) for i, r in zip(of, answers, strict=True)]

        def flat(asked_lists: list, lists: list) -> tuple[list[int | None], list]:
            # The lists of a piece are flattened, all pairs scored together, and the scores cut up again.
            rows = [
                None if a is None or r is None or (len(a) == 1 and a[0] is None) else pairs_of(a, r)
                for a, r in zip(asked_lists, lists)
            ]
            sizes = [None if row is None else len(row) for row in rows]
            return sizes, [pair for row in rows if row is not None for pair in row]

        @F.arrow_udf("array<double>")
        def run(batches: Iterator[Tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            model = factory()
            ask = lambda pairs: _outcomes(model.score, pairs)
            flattened = (flat(*piece) for piece in _pieces(batches))
            for sizes, outcomes in flow(flattened, ask, lambda pair: len(pair[0]) + len(pair[1])):
                values = iter([value for value, _ in outcomes])
                yield pa.array(
                    [None if size is None else [next(values) for _ in range(size)] for size in sizes], _SCORES, from_pandas=True
                )

        return run.asNondeterministic()(instructions, responses)

    def score_within(self, instruction: Column, responses: Column, most: int) -> Column:
        """Texts go to one process, once, that counts their tokens, cuts and scores them."""
        factory, flow = self._held, self._flow

        def flat(rows: list) -> tuple[list, list]:
            # What a row is, without its texts, and the pairs of all rows.
            flags = [None if row is None else [over for _, over in row] for row in rows]
            return flags, [pair for row in rows if row is not None for pair, _ in row]

        @F.arrow_udf("array<struct<score: double, cut: boolean>>")
        def run(batches: Iterator[Tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            model = factory()
            ask = lambda pairs: _outcomes(model.score, pairs)
            flattened = (flat(list(_tails(model, asked, lists, most))) for asked, lists in _pieces(batches))
            for flags, outcomes in flow(flattened, ask, lambda pair: len(pair[0]) + len(pair[1])):
                values = iter([value for value, _ in outcomes])
                told = [None if row is None else [{"score": next(values), "cut": over} for over in row] for row in flags]
                yield pa.array(told, _WITHIN, from_pandas=True)

        return run.asNondeterministic()(instruction, responses)

    def generate(
        self,
        instruction: Column,
        messages: Column,
        n: int,
        seed: int,
        stops: Sequence[str],
    ) -> Column:
        factory, flow, stops = self._held, self._flow, tuple(stops)

        @F.arrow_udf(GENERATED)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = factory()
            ask = lambda chats: _outcomes(lambda some: model.generate(some, n, seed, stops), chats)
            chats = ((None, piece) for (piece,) in _pieces((batch,) for batch in batches))
            for _, outcomes in flow(chats, ask, lambda chat: sum(len(m["content"]) for m in chat)):
                yield pa.array([{"texts": texts, "error": error} for texts, error in outcomes], _GENERATED)

        return run.asNondeterministic()(F.when(instruction.isNotNull(), messages))

    def _complete(self, prompt: Column, attempts: int = 1, settled: Callable[[str], bool] = bool) -> Column:
        factory, flow = self._held, self._flow

        @F.arrow_udf(REPLY)
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = factory()
            numbered = _takes_attempt(model.complete)
            call = lambda some, k: model.complete(some, k) if numbered else model.complete(some)
            ask = lambda prompts: _until(call, prompts, attempts, settled)
            prompts = ((None, piece) for (piece,) in _pieces((batch,) for batch in batches))
            for _, outcomes in flow(prompts, ask, len):
                yield pa.array([{"text": text, "error": error} for text, error in outcomes], _REPLY)

        return run.asNondeterministic()(prompt)

    def token_cuts(self, texts: Column, most: Column, keep: str) -> Column:
        """The positions alone come back; texts are cut in the JVM. Equal texts of a piece are encoded once."""
        factory = self._held

        @F.arrow_udf("array<struct<n: int, cut: int>>")
        def run(batches: Iterator[Tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            model = factory()
            for lists, budgets in _pieces(batches):
                rows = [None if row is None else list(zip(row, of, strict=True)) for row, of in zip(lists, budgets)]
                cuts = _cuts_of(model, _asked_for(pair for row in rows if row is not None for pair in row), keep)
                yield pa.array([None if row is None else [cuts.get(pair) for pair in row] for row in rows], _CUTS)

        return run(texts, most)

    def critique(self, instruction: Column, prompt: Column, attempt: int = 1) -> Column:
        return self._complete(prompt)

    def critique_until(self, instruction: Column, prompt: Column, attempts: int) -> Column:
        """Up to `attempts` critiques until one can be read, in one pass: only open items are asked again."""
        return self._complete(prompt, attempts, readable)

    def rewrite(self, instruction: Column, prompt: Column) -> Column:
        return self._complete(prompt)
