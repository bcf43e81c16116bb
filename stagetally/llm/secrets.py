"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Pattern(NamedTuple):
    """A kind of span: its regex, the group that is measured, and the least code points of that group."""

    kind: str
    regex: str
    group: int
    least: int


class CharClass(NamedTuple):
    """A kind of candidate string: its characters in one case or two, window, and least bits per character."""

    kind: str
    regex: str
    alphabet: str
    window: int
    bits: float


PATTERNS = (
    Pattern(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    # A run is taken whole by either form; asking for its length at once spares short runs.
    Pattern("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Pattern("hex", r"[0-9a-f]{24,}", 0, 24),
)

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", r"(?<![0-9A-Za-z])[0-9A-Fa-f]{24,}(?![0-9A-Za-z])", "0123456789abcdefABCDEF", 24, 2.9),
    CharClass(
        "entropy_text",
        r"[A-Za-z0-9+/_=-]{24,}",
        "0123456789" + _LETTERS + _LETTERS.upper() + "+/_=-",
        24,
        4.01,
    ),
)

#: Whole candidates that are no secrets: one digit or mark repeated, numbers, words, words joined by marks, UUIDs.
ALLOWED = (
    r"(.)\1*",
    r"[0-9_=+/-]+",
    r"[A-Z]?[a-z]+|[A-Z]+",
    r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[-_/=+]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))+[-_/=+]*",
    r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
)


def found_spans(text: Column, regex: str, group: int = 0) -> Column:
    """``array<struct<start, end, hit, part>>`` of the leftmost non-overlapping matches.

    Positions count code points, the end is exclusive; ``hit`` is the match
    and ``part`` its group.  The text between matches gives the positions.
    """
    hits = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    empty = F.array().cast("array<struct<start:int,end:int,hit:string,part:string>>")
    between = F.slice(F.split(text, regex, -1), F.lit(1), F.size(hits))
    parts = F.regexp_extract_all(text, F.lit(regex), F.lit(group)) if group else hits
    rows = F.arrays_zip(between.alias("gap"), hits.alias("hit"), parts.alias("part"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(done: Column, row: Column) -> Column:
        first = done["at"] + F.length(row["gap"])
        last = first + F.length(row["hit"])
        span = F.struct(first.alias("start"), last.alias("end"), row["hit"].alias("hit"), row["part"].alias("part"))
        return F.struct(last.alias("at"), F.concat(done["found"], F.array(span)).alias("found"))

    return F.when(text.rlike(regex), F.aggregate(rows, start, step, lambda done: done["found"])).otherwise(empty)


def entropy_runs(chars: Column, alphabet: str, window: int, bits: float) -> Column:
    """``array<struct<from, to>>``: where windows of the characters reach the entropy, overlapping ones joined.

    Keeps one count per character of the alphabet and the sum of c * log2(c);
    each step adds one character and takes away the one that leaves the window.
    """
    leaving = F.concat(F.array_repeat(F.lit(""), window), chars)
    steps = F.slice(F.arrays_zip(chars.alias("new"), leaving.alias("old")), F.lit(1), F.size(chars))
    state = F.struct(
        F.lit(0).alias("at"),
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
        F.lit(0.0).alias("weight"),
        F.array().cast("array<struct<from:int,to:int>>").alias("runs"),
    )

    def grown(counts: Column, place: Column, by: int) -> tuple[Column, Column]:
        """The counts with one changed, and the change of the weight."""
        now = F.coalesce(F.try_element_at(counts, F.nullif(place, F.lit(0))), F.lit(0))
        bits_of = lambda n: F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))
        change = F.when(place > 0, bits_of(now + by) - bits_of(now)).otherwise(F.lit(0.0))
        return F.transform(counts, lambda c, i: F.when(i + 1 == place, c + by).otherwise(c)), change

    def step(done: Column, row: Column) -> Column:
        entered, gain = grown(done["counts"], F.instr(F.lit(alphabet), row["new"]), 1)
        within = F.array(F.struct(entered.alias("counts"), (done["weight"] + gain).alias("weight")))

        def leave(now: Column) -> Column:
            gone = F.when(row["old"] == "", F.lit(0)).otherwise(F.instr(F.lit(alphabet), row["old"]))
            counts, loss = grown(now["counts"], gone, -1)
            return F.struct(counts.alias("counts"), (now["weight"] + loss).alias("weight"))

        def record(now: Column) -> Column:
            at = done["at"] + 1
            high = F.log2(F.lit(float(window))) - now["weight"] / window >= bits - 1e-9
            runs = _run(done["runs"], at, high, window)
            return F.struct(at.alias("at"), now["counts"].alias("counts"), now["weight"].alias("weight"), runs.alias("runs"))

        # One-element arrays bind what an expression would otherwise compute again and again.
        return F.element_at(F.transform(F.transform(within, leave), record), 1)

    return F.aggregate(steps, state, step, lambda done: done["runs"])


def _run(runs: Column, at: Column, high: Column, window: int) -> Column:
    """The runs with the window that ends at ``at`` joined on or put behind, if it is full and high."""
    begin, n = (at - window).cast("int"), F.size(runs)
    last = F.try_element_at(runs, F.lit(-1))
    joined = F.concat(F.slice(runs, F.lit(1), n - 1), F.array(F.struct(last["from"].alias("from"), at.alias("to"))))
    added = F.concat(runs, F.array(F.struct(begin.alias("from"), at.alias("to"))))
    return F.when((at < window) | ~high, runs).when((n > 0) & (last["to"] >= begin), joined).otherwise(added)


def secret_spans(
    docs: DataFrame,
    key: str,
    text: str,
    patterns: tuple[Pattern, ...] = PATTERNS,
    classes: tuple[CharClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """``(key, base, all)``: arrays of ``struct<start, rank, kind, end>`` sorted by start, then by kind as listed.

    ``base`` are the matches of the patterns whose group is long enough;
    ``all`` adds the runs of high entropy of candidates that no pattern of the
    allow-list matches whole.  Every row gives one row; a null text counts as
    empty and has no span.  Positions count code points.
    """
    df = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    df = df.select(
        "key",
        *(found_spans(F.col("t"), p.regex, p.group).alias(f"p{i}") for i, p in enumerate(patterns)),
        *(found_spans(F.col("t"), c.regex).alias(f"c{i}") for i, c in enumerate(classes)),
    )
    whole = "|".join(f"(?:{a})" for a in allowed)
    df = df.withColumns(
        {
            f"c{i}": F.transform(
                F.filter(f"c{i}", lambda s: ~s["hit"].rlike(f"^(?:{whole})$")),
                lambda s: F.struct(s["start"].alias("start"), F.split(s["hit"], "").alias("chars")),
            )
            for i in range(len(classes))
        }
    )

    def ranked(start: Column, end: Column, rank: int, kind: str) -> Column:
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))

    def matches(i: int, p: Pattern) -> Column:
        kept = F.filter(f"p{i}", lambda s: F.length(s["part"]) >= p.least)
        return F.transform(kept, lambda s: ranked(s["start"], s["end"], i, p.kind))

    def runs(i: int, c: CharClass) -> Column:
        def of(s: Column) -> Column:
            found = entropy_runs(s["chars"], c.alphabet, c.window, c.bits)
            return F.transform(
                found, lambda r: ranked(s["start"] + r["from"], s["start"] + r["to"], len(patterns) + i, c.kind)
            )

        return F.flatten(F.transform(f"c{i}", of))

    base = [matches(i, p) for i, p in enumerate(patterns)]
    extra = [runs(i, c) for i, c in enumerate(classes)]
    df = df.select("key", F.sort_array(F.concat(*base)).alias("base"), F.concat(*extra).alias("extra"))
    return df.select("key", "base", F.sort_array(F.concat("base", "extra")).alias("all"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
