"""Secrets in text: known shapes, and windows of high entropy."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs are as long as they can be, so shorter ones can be passed over at once.
_HEX = re.compile(r"[0-9a-f]{24,}")

KINDS = ("assign", "access", "hex", "entropy")


def known_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of known shapes; leftmost, not overlapping within a kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are runs of ``characters``, at least ``window`` long; a window counts
    from ``bits`` of entropy per character on."""

    name: str
    characters: str
    window: int
    bits: float


@dataclass(frozen=True)
class EntropyRules:
    classes: tuple[CharacterClass, ...] = (
        CharacterClass("hex", "0-9a-fA-F", 20, 3.0),
        CharacterClass("base64", "A-Za-z0-9+/_=-", 24, 3.7),
    )
    #: Candidates of these whole shapes are no secrets.
    allowed: tuple[str, ...] = (
        r"[0-9]+",  # numbers, phone and card numbers
        r"[A-Za-z]+",  # words
        r"[-_=+/]*",  # rules
        r"(?:[A-Za-z]+|[0-9]{1,4})(?:[-_/=+]+(?:[A-Za-z]+|[0-9]{1,4}))*[-_/=+]*",  # paths, slugs, dates
        r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUIDs
    )
    #: Public strings that look like secrets.
    known_public: frozenset[str] = frozenset()


def entropy_windows(text: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Maximal runs covered by windows of ``text`` with at least ``bits`` of entropy.

    The window slides by one character; the sum of c * log2(c) over its character counts
    is corrected for the character that enters and the one that leaves.
    """
    if len(text) < window:
        return
    logs = [c * math.log2(c) if c else 0.0 for c in range(window + 2)]
    counts: dict[str, int] = {}
    for char in text[:window]:
        counts[char] = counts.get(char, 0) + 1
    total = sum(logs[c] for c in counts.values())
    # H = log2(w) - total / w; sums of a few hundred steps are exact to about 1e-12.
    most = (math.log2(window) - bits) * window + 1e-9
    start = end = -1
    for at in range(len(text) - window + 1):
        if at:
            leaves, enters = text[at - 1], text[at + window - 1]
            if leaves != enters:
                c = counts[leaves]
                total += logs[c - 1] - logs[c]
                counts[leaves] = c - 1
                c = counts.get(enters, 0)
                total += logs[c + 1] - logs[c]
                counts[enters] = c + 1
        if total <= most:
            if at > end:
                if end > 0:
                    yield start, end
                start = at
            end = at + window
    if end > 0:
        yield start, end


class Scanner:
    def __init__(self, rules: EntropyRules) -> None:
        self.rules = rules
        self.candidates = [
            (c, re.compile(f"[{c.characters}]{{{c.window},}}")) for c in rules.classes
        ]
        self.allowed = re.compile("|".join(f"(?:{shape})" for shape in rules.allowed))

    def entropy_spans(self, text: str) -> list[tuple[str, int, int]]:
        covered: list[tuple[int, int]] = []
        for kind, pattern in self.candidates:
            for match in pattern.finditer(text):
                run = match[0]
                if run in self.rules.known_public or self.allowed.fullmatch(run):
                    continue
                at = match.start()
                covered += [
                    (at + s, at + e) for s, e in entropy_windows(run, kind.window, kind.bits)
                ]
        spans: list[tuple[str, int, int]] = []
        for start, end in sorted(covered):
            if spans and start <= spans[-1][2]:
                spans[-1] = ("entropy", spans[-1][1], max(end, spans[-1][2]))
            else:
                spans.append(("entropy", start, end))
        return spans

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found = known_spans(text) + self.entropy_spans(text)
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


SPANS = "array<struct<kind:string,start:int,end:int>>"


def secret_spans(text: Column, rules: EntropyRules = EntropyRules()) -> Column:
    """The spans of secrets in ``text``, by start, then kind in the order of KINDS.

    Counted in code points, the end is exclusive. ``assign``, ``access`` and ``hex`` are
    known shapes. ``entropy`` joins the windows of high entropy: over every run of one
    character class a window slides, and where its Shannon entropy reaches the class's
    bound it is marked, unless the whole run has an allowed shape. NULL and empty texts
    have no spans. Each row is handled by itself, whole.
    """

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        scanner = Scanner(rules)
        return pd.Series(
            [
                [{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t or "")]
                for t in texts
            ],
            dtype=object,
        )

    return scan(text)


def find_secrets(df: DataFrame, text: str = "text", rules: EntropyRules = EntropyRules()):
    """``df`` with a column ``secret_spans``, which replaces one of that name."""
    return df.withColumn("secret_spans", secret_spans(F.col(text), rules))


def redact(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with ``mark`` in place of each maximal run covered by ``spans``."""
    parts, at, begun = [], 0, False
    for start, end in sorted(spans):
        if start > at or not begun:
            parts += [text[at:start], mark]
        at, begun = max(at, end), True
    return "".join([*parts, text[at:]])


def redact_secrets(
    df: DataFrame,
    text: str = "text",
    mark: str = "<secret>",
    rules: EntropyRules = EntropyRules(),
) -> DataFrame:
    """``df`` with every secret in ``text`` replaced by ``mark``; no row goes.

    NULL stays NULL. A column ``n_chars`` follows a text that changes; other columns stay
    as they are.
    """

    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        scanner = Scanner(rules)
        return pd.Series(
            [
                t if t is None or not (s := scanner.spans(t)) else redact(t, [x[1:] for x in s], mark)
                for t in texts
            ],
            dtype=object,
        )

    new = redacted(F.col(text))
    if "n_chars" not in df.columns:
        return df.withColumn(text, new)
    # Held aside, so that no column can clash.
    old, now = F.col("held")[text], F.col("redacted")
    length = F.length(now).cast(df.schema["n_chars"].dataType)
    following = F.when(now != old, length).otherwise(F.col("held")["n_chars"])
    put = {text: now, "n_chars": following}
    return df.select(F.struct("*").alias("held"), new.alias("redacted")).select(
        *(put.get(c, F.col("held")[c]).alias(c) for c in df.columns)
    )
