"""L3 for large rule sets and for patterns that cross lines: the first rule (lowest number) found in a log.

Every pattern has a :func:`~driftcheck.functions.patterns.shape`. An automaton
over the literals that matches must hold names the few rules worth trying on a
text, so thousands of rules cost one walk over the text. Rules fall into three
kinds:

* a match within one line: every line is searched where it is;
* a match over at most ``k`` line breaks: lines are range-partitioned in log
  order, searched in stretches that overlap by ``k`` lines, and the first and
  last ``k`` lines of each range meet those of its neighbours;
* a match over any number of lines, or one that depends on the text around it
  (anchors, look-around): only logs in which a line holds such a rule's
  literal are read in order, as a stream. Of the text only what a match may
  still start in is held; for look-around, anchors of the text and patterns
  such as ``a[\\s\\S]*b`` that is the rest of the log.

Searches are Python's, case-insensitive. A null line is an empty line, a line
that holds a line break counts as several.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcheck.functions.patterns import fold, shape
from driftcheck.session import cut_lineage, ship_package

BLOCK_RULES = 20_000
BLOCK_CHARS = 8 << 20
STRETCH_LINES = 512
STREAM_CHARS = 1 << 20


class Rules:
    """Rules by number, with an automaton that names those worth trying on a text."""

    def __init__(self, rules: Sequence[tuple[int, str]]):
        import ahocorasick

        self.rules = sorted(rules)
        self.searches: dict[int, re.Pattern] = {}
        self.always, by_literal = [], {}
        for k, (_, pattern) in enumerate(self.rules):
            literal = shape(pattern).literal
            if literal is None:
                self.always.append(k)
            else:
                by_literal.setdefault(literal, []).append(k)
        self.automaton = ahocorasick.Automaton() if by_literal else None
        for literal, ks in by_literal.items():
            self.automaton.add_word(literal, tuple(ks))
        if by_literal:
            self.automaton.make_automaton()

    def worth(self, text: str) -> set[int]:
        """Places of the rules that may be found in a text."""
        found = set(self.always)
        if self.automaton is not None:
            for _, ks in self.automaton.iter(fold(text)):
                found.update(ks)
        return found

    def first(self, text: str, below: int | None = None) -> int | None:
        """The lowest rule number found in ``text``, if it is lower than ``below``."""
        for k in sorted(self.worth(text)):
            number, pattern = self.rules[k]
            if below is not None and number >= below:
                return None
            if k not in self.searches:
                self.searches[k] = re.compile(pattern, re.IGNORECASE)
            if self.searches[k].search(text):
                return number
        return None


_COMPILED: dict[int, tuple[object, Rules]] = {}


def compiled(shared) -> Rules:
    """The rules of a broadcast, built once in a worker."""
    if shared.id not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[shared.id] = Rules(shared.value)
    return _COMPILED[shared.id]


class Shared:
    """A broadcast value with a number that tells it from others in a worker."""

    _next = 0

    def __init__(self, sc, value):
        Shared._next += 1
        self.id, self.held = f"{sc.applicationId}-{Shared._next}", sc.broadcast(value)

    @property
    def value(self):
        return self.held.value


def rule_blocks(rules: DataFrame, size: int = BLOCK_RULES) -> Iterator[list[tuple[int, str]]]:
    """(rule_no, pattern) in blocks of bounded size, lowest numbers first."""
    block, chars = [], 0
    for r in rules.select("rule_no", "pattern").orderBy("rule_no").toLocalIterator():
        if block and (len(block) >= size or chars + len(r["pattern"]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        try:
            re.compile(r["pattern"], re.IGNORECASE)
        except re.error as e:
            raise ValueError(f"rule {r['rule_no']}: {e}") from e
        block.append((r["rule_no"], r["pattern"]))
        chars += len(r["pattern"])
    if block:
        yield block


def _in_texts(shared, keys, batches):
    """Adds the first rule of each text to rows without one."""
    for batch in batches:
        rules = compiled(shared)
        old = batch.column("rule_no").to_pylist()
        new = [n if n is not None or t is None else rules.first(t) for n, t in zip(old, batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(new, pa.int64()), batch.column("text")], [*keys, "rule_no", "text"])


def first_rules(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """``texts`` (any columns and ``text``) -> its other columns and rule_no (long) of the first rule found, or null."""
    spark = texts.sparkSession
    ship_package(spark)
    keys = [c for c in texts.columns if c != "text"]
    now = texts.select(*keys, F.lit(None).cast("long").alias("rule_no"), "text")
    for block in rule_blocks(rules):
        now = now.mapInArrow(partial(_in_texts, Shared(spark.sparkContext, block), keys), now.schema)
    return now.select(*keys, "rule_no")


def _in_lines(shared, batches):
    """Lines with a rule -> key and rule; each batch keeps the lowest rule of a run of lines of one log."""
    for batch in batches:
        rules = compiled(shared)
        at, numbers, best, last = [], [], None, object()
        for k, (key, line) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if key != last:
                best, last = None, key
            found = rules.first(line, best)
            if found is not None:
                best = found
                at.append(k)
                numbers.append(found)
        if at:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(numbers, pa.int64())], ["key", "rule_no"])


def _in_stretches(shared, overlap, stretch, names, batches):
    """Sorted lines of a range -> for each log its lowest rule and the lines at its ends."""
    part = TaskContext.get().partitionId()
    key, held, new, head, n, best = object(), [], 0, [], 0, None

    def search():
        nonlocal best, held, new
        found = compiled(shared).first("\n".join(held), best)
        best = best if found is None else found
        held, new = held[-overlap:], 0

    out, key_type = [], None

    def end():
        if n:
            if new:
                search()
            out.append((key, best, part, n, head, held))

    def table():
        cols = list(zip(*out))
        types = [key_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)

    for batch in batches:
        key_type = batch.schema.field(0).type
        for k, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                end()
                key, held, new, head, n, best = k, [], 0, [], 0, None
            held.append(line)
            new, n = new + 1, n + 1
            if len(head) < overlap:
                head.append(line)
            if new >= stretch:
                search()
        if out:
            yield table()
            out.clear()
    end()
    if out:
        yield table()


def _over_borders(shared, overlap, batches):
    """The ends of a log's ranges in order -> its lowest rule over the borders."""
    for batch in batches:
        rules, at, numbers = compiled(shared), [], []
        for i, parts in enumerate(batch.column(1).to_pylist()):
            best, before = None, []
            for p in parts:
                lines = before + p["head"]
                if before:
                    found = rules.first("\n".join(lines), best)
                    best = best if found is None else found
                before = lines[-overlap:] if p["n"] <= overlap else p["tail"]
            if best is not None:
                at.append(i)
                numbers.append(best)
        if at:
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(numbers, pa.int64())], ["key", "rule_no"])


class _Stream:
    """One rule and the part of a log's text in which a match may still start."""

    def __init__(self, number: int, pattern: str, special: bool):
        import regex

        self.number, self.special, self.search = number, special, regex.compile(pattern, regex.IGNORECASE | regex.V0).search
        self.plain = re.compile(pattern, re.IGNORECASE)
        self.reset()

    def reset(self):
        self.parts, self.size, self.start, self.next = [], 0, 0, STREAM_CHARS

    def add(self, text: str) -> bool:
        self.parts.append(text)
        self.size += len(text)
        return not self.special and self.size >= self.next and self.found(False)

    def found(self, end: bool) -> bool:
        text = "".join(self.parts)
        if end:
            return self.plain.search(text, self.start) is not None
        m = self.search(text, self.start, partial=True)
        if m and not m.partial:
            return True
        cut = max(0, (m.start() if m else len(text)) - 1)  # one character before is context
        self.start = self.start if not cut else 1
        self.parts, self.size = [text[cut:]], len(text) - cut
        self.next = max(STREAM_CHARS, 2 * self.size)
        return False


def _in_stream(rules, batches):
    """Sorted lines of whole logs -> key and lowest rule of each."""
    streams = [_Stream(*r) for r in rules]
    key, open_, best, begun = None, [], None, False

    def end():
        nonlocal best
        for s in open_:
            if (best is None or s.number < best) and s.found(True):
                best = s.number
        return best

    for batch in batches:
        keys, numbers = [], []
        for k, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not begun or k != key:
                if begun and end() is not None:
                    keys.append(key)
                    numbers.append(best)
                key, open_, best, begun, first = k, streams, None, True, True
                for s in streams:
                    s.reset()
            text = line if first else "\n" + line  # noqa: F821
            first = False
            for s in open_:
                if s.add(text):
                    best = s.number if best is None else min(best, s.number)
            if best is not None:
                open_ = [s for s in open_ if s.number < best]
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(numbers, pa.int64())], ["key", "rule_no"])
        key_type = batch.schema.field(0).type
    if begun and end() is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], key_type), pa.array([best], pa.int64())], ["key", "rule_no"])


def first_rules_in_lines(lines: DataFrame, rules: DataFrame, key: str = "log_id", stretch: int = STRETCH_LINES) -> DataFrame:
    """(key, rule_no): the lowest rule found in each log of ``lines`` (key, line_no, line) that has one.

    The result equals a search of the log's lines joined by line breaks.
    """
    spark = lines.sparkSession
    ship_package(spark)
    rows = lines.select(F.col(key).alias("key"), "line_no", F.coalesce("line", F.lit("")).alias("line"))
    kind = rows.schema["key"].dataType
    hit = T.StructType([T.StructField("key", kind), T.StructField("rule_no", T.LongType())])
    found = spark.createDataFrame([], hit)
    for block in rule_blocks(rules):
        shapes = {n: shape(p) for n, p in block}
        share = lambda some: Shared(spark.sparkContext, some)
        within = [r for r in block if not shapes[r[0]].breaks and not shapes[r[0]].special]
        over = [r for r in block if 0 < shapes[r[0]].breaks < math.inf and not shapes[r[0]].special]
        rest = [r for r in block if r not in within and r not in over] if len(within) + len(over) < len(block) else []
        if within:
            found = found.unionByName(rows.select("key", "line").mapInArrow(partial(_in_lines, share(within)), hit))
        if over:
            overlap = int(max(shapes[n].breaks for n, _ in over))
            names = ["key", "rule_no", "part", "n", "head", "tail"]
            ends = T.StructType([*hit.fields, T.StructField("part", T.LongType()), T.StructField("n", T.LongType()), *(T.StructField(c, T.ArrayType(T.StringType())) for c in ("head", "tail"))])
            shared = share(over)
            ranged = rows.repartitionByRange("key", "line_no").sortWithinPartitions("key", "line_no").select("key", "line")
            ends = cut_lineage(ranged.mapInArrow(partial(_in_stretches, shared, overlap, stretch, names), ends))
            borders = ends.groupBy("key").agg(F.count(F.lit(1)).alias("ranges"), F.array_sort(F.collect_list(F.struct("part", "n", "head", "tail"))).alias("parts")).where("ranges > 1")
            found = found.unionByName(ends.where("rule_no IS NOT NULL").select("key", "rule_no"))
            found = found.unionByName(borders.select("key", "parts").mapInArrow(partial(_over_borders, shared, overlap), hit))
        if rest:
            logs = rows
            if all(shapes[n].literal for n, _ in rest):  # a log without any of their literals holds no match
                named = share([(n, re.escape(shapes[n].literal)) for n, _ in rest])
                holding = cut_lineage(rows.select("key", "line").mapInArrow(partial(_in_lines, named), hit).select(F.col("key").alias("named")).distinct())
                logs = rows.join(holding, F.col("key").eqNullSafe(F.col("named")), "left_semi")
            ordered = logs.repartition("key").sortWithinPartitions("key", "line_no").select("key", "line")
            found = found.unionByName(ordered.mapInArrow(partial(_in_stream, [(n, p, shapes[n].special) for n, p in rest]), hit))
    return found.groupBy("key").agg(F.min("rule_no").alias("rule_no")).withColumnRenamed("key", key)

