"""Secret scans: fixed patterns, and credential values judged by what guessing them would cost.

The cost of a value is that of its cheapest segmentation into dictionary words,
dates, repeats, keyboard walks and brute-force spans, found by dynamic
programming over its characters. A map over rows; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.sources.scratch import materialize

# Base patterns: kind, pattern, group that must reach a length, that length (fixed values).
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ["assign", "access", "hex", "guess"]
_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Words that announce a credential, with the value behind them.
_CONTEXT = re.compile(
    r"""\b(?:pass(?:word|wort|phrase|code|wd)?|pwd|kennwort|contraseña|clave|mot\x20de\x20passe|secret|token|"""
    r"""api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|credentials?|bearer|auth|"""
    r"""парол[ья]|ключ|секрет|токен)\b["']?"""
    r"""(?:\x20{0,8}(?:[:=]|=>)\x20{0,8}|(\x20(?:is|ist|es|est|—|-)\x20))["']?([^\s"',;<>]{6,})""",
    re.IGNORECASE,
)
_HINTS = ("pass", "pwd", "kennwort", "contrase", "clave", "secret", "token", "key", "credential", "bearer", "auth", "парол", "ключ", "секрет", "токен")

# Common password words, the more common first (fixed values).
WORDS = """password qwerty admin welcome letmein login master dragon monkey shadow sunshine princess football
baseball superman batman trustno iloveyou hello freedom whatever starwars secret root user guest test default
changeme summer winter spring autumn january february march april may june july august september october november
december monday friday sunday love money access hunter killer soccer hockey ginger pepper cookie flower jordan
michael jessica charlie thomas andrew daniel george robert matthew database server token example demo sample temp
backup public private system oracle mysql postgres linux windows apple google hallo passwort contrasena secreto
bonjour soleil azerty""".split()
# Rows of two keyboards, the digits and the alphabet; walks go either way along them (fixed values).
WALKS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "azertyuiop", "qsdfghjklm", "wxcvbn", "abcdefghijklmnopqrstuvwxyz"]
LEET = str.maketrans({"4": "a", "@": "a", "8": "b", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"})

#: Words that stand for a value instead of being one.
PLACEHOLDERS = "example sample placeholder changeme dummy your yourpassword yoursecret yourtoken redacted none null todo xxx insert here".split()
#: Lengths of dictionary words; repeats and walks of all lengths up to the last number are spans, and the longest one.
SHORTEST_WORD, LONGEST_WORD, LONGEST_RUN = 3, 24, 64

_DATE = re.compile(
    r"(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d"
    r"|(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?"
)
_DATE_LENGTHS = range(4, 11)
_STEPS = {(a, b) for row in WALKS for x in (row, row[::-1]) for a, b in zip(x, x[1:])}


def ranks(words: Sequence[str] = ()) -> dict[str, int]:
    """Rank of each dictionary word: the common password words, and ``words``, each list in its order."""
    out = {word: rank for rank, word in enumerate(words, 1)}
    for rank, word in enumerate(WORDS, 1):
        out[word] = min(rank, out.get(word, rank))
    return out


_COMMON = ranks()


def _alphabet(c: str) -> int:
    return 10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000


def _word_cost(part: str, known: Mapping[str, int]) -> float | None:
    low = part.lower()
    plain = low.translate(LEET)
    rank = known.get(low) or known.get(plain)
    if rank is None:
        return None
    cost = math.log10(rank + 1)
    ups = sum(c.isupper() for c in part)
    if ups:
        cost += math.log10(2) if ups == len(part) or (ups == 1 and part[0].isupper()) else math.log10(2 ** len(part))
    swapped = sum(a != b for a, b in zip(low, plain)) if known.get(low) is None else 0
    return cost + swapped * math.log10(2)


def _repeat_cost(unit: str, times: int) -> float:
    return sum(math.log10(_alphabet(c)) for c in unit) + math.log10(times)


def _walk_cost(size: int, low: str, end: int) -> float:
    falls = any(low[i] > low[i + 1] for i in range(end - size, end - 1))
    return math.log10(len(_STEPS)) + math.log10(size) + falls * math.log10(2)


def _lengths(least: int, most: int, all_to: int) -> Iterator[int]:
    yield from range(least, min(most, all_to) + 1)
    if most > all_to:
        yield most


def _spans_ending(value: str, low: str, end: int, periods: list[int], walk: int, known: Mapping[str, int]) -> Iterator[tuple[int, float]]:
    """``(start, log10 guesses)`` of every span but brute force that ends at ``end``.

    ``periods[w]`` says for how many characters before ``end`` the one ``w`` places
    earlier is the same, ``walk`` how long the keyboard walk is that ends there.
    """
    for start in range(max(0, end - LONGEST_WORD), end - SHORTEST_WORD + 1):
        cost = _word_cost(value[start:end], known)
        if cost is not None:
            yield start, cost
    for size in _DATE_LENGTHS:
        if size <= end and value[end - 1].isdigit() and _DATE.fullmatch(value, end - size, end):
            yield end - size, math.log10(150) if size == 4 else math.log10(365 * 150)
    for width in (1, 2, 3, 4):
        most, unit = (periods[width] + width) // width, value[end - width : end]
        for times in _lengths(3 if width == 1 else 2, most, LONGEST_RUN // width):
            yield end - times * width, _repeat_cost(unit, times)
    for size in _lengths(3, walk, LONGEST_RUN):
        yield end - size, _walk_cost(size, low, end)


def guess_cost(value: str, known: Mapping[str, int] = _COMMON) -> float:
    """Log10 of the guesses that the cheapest segmentation of ``value`` needs; 0 for an empty value.

    A span is a dictionary word (``known`` has the ranks), a date, a repeat of one to
    four characters, a keyboard walk, or brute force. Its cost is the log10 of its
    choices; each further span adds log10 2 for where it may begin. Brute-force
    characters that follow one another are one span. All spans are tried, of the
    repeats and walks beyond ``LONGEST_RUN`` characters the longest at each place.
    """
    n, low = len(value), value.lower()
    cut = math.log10(2)
    # Best cost up to a place, by whether the last span is brute force.
    loose, tight = [math.inf] * (n + 1), [0.0] + [math.inf] * n
    periods, walk = [0] * 5, 0
    for end in range(1, n + 1):
        last = value[end - 1]
        for width in (1, 2, 3, 4):
            periods[width] = periods[width] + 1 if end > width and last == value[end - 1 - width] else 0
        walk = walk + 1 if end > 1 and (low[end - 2], low[end - 1]) in _STEPS else 1
        loose[end] = min(loose[end - 1], tight[end - 1] + cut * (end > 1)) + math.log10(_alphabet(last))
        for start, cost in _spans_ending(value, low, end, periods, walk, known):
            tight[end] = min(tight[end], min(loose[start], tight[start]) + cost + cut * (start > 0))
    return min(loose[n], tight[n])


def judged(value: str, known: Mapping[str, int], limits: Limits) -> str:
    """``placeholder``, ``guessable`` or ``secret``, by what stands in a value and by its cost."""
    parts = [p for p in re.split(r"[^a-z]+", value.lower()) if p]
    if any(p in PLACEHOLDERS for p in parts) or len(set(value)) <= 2:
        return "placeholder"
    return "secret" if guess_cost(value, known) >= limits.min_log10_guesses else "guessable"


@dataclass(frozen=True)
class Limits:
    """A credential value is a secret from ``min_log10_guesses``; a guesser knows ``dictionary`` words of the table that occur ``least_count`` times."""

    min_log10_guesses: float = 8.0
    min_length: int = 6
    dictionary: int = 20_000
    least_count: int = 3


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the base patterns, each leftmost and non-overlapping, failing matches dropped."""
    low = text.lower()
    out = []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def guess_spans(
    text: str, base: list[tuple[str, int, int]], limits: Limits, known: Mapping[str, int] = _COMMON
) -> list[tuple[str, int, int, float]]:
    """Values in a credential context that are costly to guess and lie in no base span."""
    low = text.lower()
    if not any(hint in low for hint in _HINTS):
        return []
    out = []
    for m in _CONTEXT.finditer(text):
        start, end = m.span(2)
        value = text[start:end].rstrip(".!?:)")
        end = start + len(value)
        # Behind a verb, letters in the case of a word are the sentence going on.
        if m[1] and value.isalpha() and (value.islower() or value.istitle()):
            continue
        if len(value) < limits.min_length or any(a < end and start < b for _, a, b in base):
            continue
        if judged(value, known, limits) == "secret":
            out.append(("guess", start, end, guess_cost(value, known)))
    return out


def _join(spans: list[tuple[str, int, int]]) -> str:
    spans = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SCANNED = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("log10_guesses", T.ArrayType(T.DoubleType())),
        T.StructField("judged", T.ArrayType(T.StringType())),
    ]
)
_ARROW = [pa.field(f"n_{k}", pa.int64()) for k in KINDS] + [
    pa.field("base_sha256", pa.string()),
    pa.field("spans", pa.string()),
    pa.field("log10_guesses", pa.list_(pa.float64())),
    pa.field("judged", pa.list_(pa.string())),
]

_LETTERS = re.compile(r"[^\W\d_]+")
#: Words that a counting task holds before it passes them on.
HELD = 300_000


def common_words(docs: DataFrame, most: int, least: int = 1) -> list[str]:
    """At most ``most`` lower-cased words of all texts, the most frequent that occur ``least`` times, by count, then by themselves.

    Words that occur equally often are all taken or all left.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = _LETTERS.findall(text.lower())
                counts.update(w for w in words if SHORTEST_WORD <= len(w) <= LONGEST_WORD)
                if len(counts) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    texts = docs.select("text").where("text is not null")
    counted = texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = materialize(counted.where(F.col("n") >= least), "words")
    # Words of one count come in together or not at all, so only chosen ones leave the executors.
    above = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    classes = counted.groupBy("n").agg(F.count("*").alias("words")).withColumn("so_far", F.sum("words").over(above))
    cut = classes.where(F.col("so_far") <= most).agg(F.min("n")).first()[0]
    chosen = counted.where(F.col("n") >= cut).collect() if cut is not None else []
    return [r.word for r in sorted(chosen, key=lambda r: (-r.n, r.word))]


def scan(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: counts per kind, all spans, and how their values are judged.

    ``log10_guesses`` and ``judged`` have an entry per base assignment and then per
    added span. A guesser knows the ``limits.dictionary`` most frequent words of the
    table, counted over all texts in a job of its own; they are all that reaches
    the driver. Spans are code points, end exclusive. Null text is empty text: no
    spans. Very long texts are searched whole. Repeated rows give repeated rows;
    other columns, whatever their names, are not read.
    """
    known = ranks(common_words(docs, limits.dictionary, limits.least_count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                more = guess_spans(text, base, limits, known)
                spans = base + [s[:3] for s in more]
                counts = [sum(s[0] == k for s in spans) for k in KINDS]
                values = [_ASSIGN.match(text, a)[2] for k, a, _ in base if k == "assign"]
                costs = [guess_cost(v, known) for v in values] + [s[3] for s in more]
                verdicts = [judged(v, known, limits) for v in values] + ["secret"] * len(more)
                digest = hashlib.sha256(_join(base).encode()).hexdigest()
                rows.append((*counts, digest, _join(spans), costs, verdicts))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)] if rows else [[]] * len(_ARROW)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=SCANNED.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCANNED)
