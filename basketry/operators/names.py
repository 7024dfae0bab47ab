"""Names in texts: a leftmost-longest automaton per worker, from a written table.

The table of names is written once below ``spark.checkpoint.dir``; every worker process reads it
and builds a trie with failure links, so neither a pattern of all names nor a list on the driver is
needed and the number of names has no limit but a worker's memory. A text is read once, whatever the
number of names; of names that begin at one place the longest counts, and matches do not overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder

# Fixed value: the characters of ``functions.text.SPACE``.
BLANKS = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
# Cut marks are Unicode noncharacters, which text never contains.
CUT, HELD = "﷐", "﷑"


@dataclass(frozen=True)
class NameTable:
    """A written table ``(name, ident)`` of distinct names; ``size`` rows."""

    path: str
    size: int

    def frame(self, spark) -> DataFrame:
        return spark.read.schema("name string, ident long").parquet(self.path)


def write_names(table: DataFrame, name: str, ident: str) -> NameTable:
    """Write distinct names for the workers; of equal names the smallest ident counts, null and empty ones go."""
    path = scratch_folder(table.sparkSession, "names")
    table.filter(F.length(name) > 0).groupBy(F.col(name).cast("string").alias("name")).agg(
        F.min(F.col(ident).cast("long")).alias("ident")).write.parquet(path)
    written = table.sparkSession.read.schema("name string, ident long").parquet(path)
    return NameTable(path, written.count())


class Names:
    """The automaton of a table in one process."""

    def __init__(self, rows: dict[str, int]) -> None:
        import ahocorasick

        self.ident = rows
        self.found = ahocorasick.Automaton()
        for name in rows:
            self.found.add_word(name, name)
        if rows:
            self.found.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, str]]:
        """``(start, name)`` of every match, from left to right."""
        if not self.ident:
            return
        free = 0
        for start, _, name in sorted((end - len(name) + 1, -len(name), name) for end, name in self.found.iter(text)):
            if start >= free:
                free = start + len(name)
                yield start, name

    def mark(self, text: str) -> str:
        """The text with every match, and the blanks on its left, between cut marks."""
        out, at = [], 0
        for start, name in self.matches(text):
            out += (text[at:start].rstrip(BLANKS), CUT, HELD, name, CUT)
            at = start + len(name)
        return "".join((*out, text[at:])) if out else text


#: Automata of this process, by path: a table is written once and never changed.
_LOADED: dict[str, Names] = {}


def load(table: NameTable) -> Names:
    if table.path not in _LOADED:
        from pyarrow import dataset, fs

        store, folder = fs.FileSystem.from_uri(table.path if ":" in table.path else f"file://{table.path}")
        rows = dataset.dataset(folder, filesystem=store, format="parquet").to_table(columns=["name", "ident"])
        _LOADED.clear()
        _LOADED[table.path] = Names(dict(zip(rows["name"].to_pylist(), rows["ident"].to_pylist())))
    return _LOADED[table.path]


def marked(text: Column, table: NameTable) -> Column:
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = load(table)
        for texts in batches:
            yield texts.map(names.mark, na_action="ignore")

    return run(text)


def find_names(text: Column, table: NameTable) -> Column:
    """Array of the names in a text, in order, repeats kept; null texts have none."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = load(table)
        for texts in batches:
            yield texts.map(lambda t: [name for _, name in names.matches(t)] if t else [])

    return run(text)
