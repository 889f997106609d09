"""What a regular expression needs to match: the ground for skipping texts before running it.

A pattern is read only as far as it surely means the same to Java and to Python; whatever
is doubtful counts as "may match anywhere".
"""

from __future__ import annotations

import re
import sys
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_parser = re._parser
_ONCE = (_parser.MAX_REPEAT, _parser.MIN_REPEAT, _parser.POSSESSIVE_REPEAT)
#: Literals of this length or more are looked for all at once; shorter ones one by one.
SHORTEST = 3
#: From so many patterns with such a literal on, one automaton looks for all of them.
MANY = 12


@dataclass(frozen=True)
class Need:
    """``literal`` is part of every match (ASCII; None: nothing is known); ``never_empty``: no match is empty."""

    literal: str | None = None
    any_case: bool = False
    never_empty: bool = False


def _runs(parsed: list, run: list[str], out: list[str]) -> None:
    """Collect the literal runs that every match holds; ``run`` is the one being read."""

    def flush() -> None:
        if run:
            out.append("".join(run))
            run.clear()

    for op, value in parsed:
        if op is _parser.LITERAL and 32 <= value < 127:
            run.append(chr(value))
        elif op is _parser.AT:
            continue  # has no width
        elif op is _parser.SUBPATTERN and not value[1] and not value[2]:
            _runs(value[3], run, out)
        elif op is _parser.ATOMIC_GROUP:
            _runs(value, run, out)
        elif op in _ONCE and value[0] >= 1:
            _runs(value[2], run, out)  # once for sure; what follows need not be adjacent
            flush()
        else:
            flush()


def need_of(pattern: str) -> Need:
    """What every match of ``pattern`` needs."""
    with warnings.catch_warnings():
        warnings.simplefilter("error")  # sets in sets, which Java reads differently
        try:
            parsed = _parser.parse(pattern)
        except (re.error, Warning, OverflowError, RecursionError):
            return Need()
    flags = parsed.state.flags & ~re.UNICODE.value
    if "&&" in pattern or flags & ~re.IGNORECASE.value:
        return Need()
    runs: list[str] = []
    last: list[str] = []
    _runs(list(parsed), last, runs)
    if last:
        runs.append("".join(last))
    best = max(runs, key=len, default=None)
    return Need(best, bool(flags & re.IGNORECASE.value), parsed.getwidth()[0] > 0)


def _automaton(words: dict[str, list[int]]):  # noqa: ANN202
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, numbers in words.items():
        found.add_word(word, numbers)
    found.make_automaton()
    return found


def may_match(documents: DataFrame, text_col: str, patterns: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``documents`` (with a helper column, if one is needed) and per pattern a condition that its matches fulfil.

    With few patterns the condition looks for the literal in the text.  With MANY or more,
    one pass of an Aho-Corasick automaton per text finds the patterns whose literal is
    there, however many there are; the helper column ``__may`` lists their numbers.  The
    choice goes by the patterns alone and never changes what matches.
    """
    needs = [need_of(p) for p in patterns]
    long = [n for n, need in enumerate(needs) if need.literal and len(need.literal) >= SHORTEST]
    text = F.col(text_col)
    everything = F.lit(True)
    plain = [F.contains(text, F.lit(x.literal)) if x.literal and not x.any_case else everything for x in needs]
    if len(long) < MANY:
        return documents, plain
    # Lower case finds a superset, for patterns of any case too; an ASCII letter has one lower form.
    words: dict[str, list[int]] = {}
    for n in long:
        words.setdefault(needs[n].literal.lower(), []).append(n)

    @F.pandas_udf("array<int>")
    def candidates(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        look = _automaton(words)
        for texts in batches:
            yield pd.Series([
                sorted({n for _, numbers in look.iter(x.lower()) for n in numbers}) if x else [] for x in texts
            ], dtype="object")

    listed = set(long)
    found = documents.withColumn("__may", candidates(text))
    return found, [F.array_contains("__may", n) if n in listed else plain[n] for n in range(len(needs))]
