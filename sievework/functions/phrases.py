"""Which of many phrases a text holds, by one automaton that reads the text once."""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


class Phrases:
    """Phrases with a number each; they are substrings, not words. An empty phrase is in every text that is not null."""

    def __init__(self, phrases: Iterable[str]) -> None:
        self.number = {p: i for i, p in enumerate(sorted(set(phrases)))}

    def found(self, text: Column) -> Column:
        """The numbers of the phrases in a text, ascending; none for a null text. Give it a column of its own before it is used more than once."""
        numbers, automaton = self.number, ahocorasick.Automaton()
        for p, i in numbers.items():
            if p:
                automaton.add_word(p, i)
        automaton.make_automaton()
        empty = {numbers[""]} if "" in numbers else set()

        @F.arrow_udf("array<int>")
        def search(column: pa.Array) -> pa.Array:
            # none, where there is no phrase but the empty one
            hits = (lambda t: {i for _, i in automaton.iter(t)}) if len(automaton) else lambda t: set()
            return pa.array([sorted(hits(t) | empty) if t is not None else [] for t in column.to_pylist()], pa.list_(pa.int32()))

        return search(text)

    def any(self, found: Column, phrases: Iterable[str]) -> Column:
        """True where one of these phrases is among those found."""
        wanted = [F.lit(self.number[p]) for p in phrases]
        return F.arrays_overlap(found, F.array(*wanted)) if wanted else F.lit(False)
