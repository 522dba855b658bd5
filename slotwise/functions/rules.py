"""Rule packs: ordered conditions and weights that compile to one SQL expression.

A pack is written once as SQL text over column names. Spark evaluates it through expr(), inside
whole-stage code generation; any other SQL engine with the same few functions can evaluate the
same text, which is how packs are tested. Only regex literals differ between dialects.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from re import _constants, _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Letters of a word that is looked for before a pattern, and how many words at most.
MIN_WORD, MOST_WORDS = 3, 60


class Dialect:
    """How a SQL engine spells regex literals, and functions that have no common name."""

    def __init__(self, raw: str, names: dict[str, str]):
        self.raw, self.names = raw, names

    def re(self, pattern: str) -> str:
        return f"{self.raw}'{pattern.replace(chr(39), chr(92) + 'x27')}'"

    def call(self, name: str, *args: str) -> str:
        return self.names[name].format(*args)


SPARK = Dialect("r", {"size": "size({0})", "max": "array_max({0})", "ints": "transform({0}, x -> cast(x AS INT))", "last": "try_element_at({0}, -1)", "first": "try_element_at({0}, 1)", "year": "year({0})", "month": "month({0})", "filter_between": "filter({0}, x -> x BETWEEN {1} AND {2})", "log10": "log10({0})", "try_int": "try_cast({0} AS INT)", "distinct": "array_distinct({0})"})
DUCKDB = Dialect("", {"size": "len({0})", "max": "list_max({0})", "ints": "list_transform({0}, lambda x: CAST(x AS INT))", "last": "{0}[len({0})]", "first": "{0}[1]", "year": "year({0})", "month": "month({0})", "filter_between": "list_filter({0}, lambda x: x BETWEEN {1} AND {2})", "log10": "log10({0})", "try_int": "TRY_CAST({0} AS INT)", "distinct": "list_distinct({0})"})


def text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'" if "'" not in s else "concat(" + ", chr(39), ".join(f"'{p}'" for p in s.split("'")) + ")"


def has(t: str, words: Iterable[str]) -> str:
    """t contains one of the words."""
    return "(" + " OR ".join(f"contains({t}, {text(w)})" for w in words) + ")"


def required(pattern: str) -> frozenset[str]:
    """Lower-case words one of which is in every text that the pattern matches, whatever its case; none if it has none
    of MIN_WORD letters."""

    def longest(parts) -> frozenset[str]:
        found, run = [], ""
        for op, arg in [*parts, (None, None)]:
            if op is _constants.LITERAL and arg < 128:
                run += chr(arg).lower()
                continue
            if op is _constants.AT:  # takes no character
                continue
            found.append(frozenset([run] if len(run) >= MIN_WORD else []))
            run = ""
            if op is _constants.SUBPATTERN:
                found.append(longest(arg[-1]))
            elif op in (_constants.MAX_REPEAT, _constants.MIN_REPEAT) and arg[0] > 0:
                found.append(longest(arg[2]))
            elif op is _constants.BRANCH:
                each = [longest(x) for x in arg[1]]
                found.append(frozenset().union(*each) if all(each) else frozenset())
        return max(found, key=lambda x: (min(map(len, x), default=0), -len(x)))

    return longest(_parser.parse(pattern))


def words_of(t: str, pattern: str) -> str | None:
    """Whether t has one of the words that the pattern needs, where there are some and not too many."""
    words = sorted(required(pattern.removeprefix("(?i)")))
    words = [w for w in words if not any(v != w and v in w for v in words)]  # one that has another in it says nothing more
    return has(t if t.startswith(("lower(", "_t")) else f"lower({t})", words) if 0 < len(words) <= MOST_WORDS else None


def found(d: Dialect, t: str, patterns: str | Iterable[str], flags: str = "(?i)") -> str:
    """One of the patterns matches somewhere in t."""
    joined = patterns if isinstance(patterns, str) else "|".join(f"(?:{p})" for p in patterns)
    return f"(regexp_extract({t}, {d.re(flags + joined)}, 0) <> '')"


def group(d: Dialect, t: str, pattern: str, n: int = 1, flags: str = "(?i)") -> str:
    """The n-th group of the first match, '' without one."""
    return f"regexp_extract({t}, {d.re(flags + pattern)}, {n})"


def every(d: Dialect, t: str, pattern: str, n: int = 1, flags: str = "(?i)") -> str:
    return f"regexp_extract_all({t}, {d.re(flags + pattern)}, {n})"


def case(rules: Sequence[tuple[str, str]], default: str = "NULL") -> str:
    """The value of the first condition that holds."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rules) + f" ELSE {default} END"


def total(rules: Sequence[tuple[str, float]], start: float = 0) -> str:
    """The sum of the weights whose conditions hold."""
    return f"({start}" + "".join(f" + CASE WHEN {c} THEN {w} ELSE 0 END" for c, w in rules) + ")"


def _calls(sql: str, name: str) -> list[str]:
    """The calls of a function in a SQL text, whole, outer ones only."""
    out, at = [], sql.find(f"{name}(")
    while at >= 0:
        depth, quoted, end = 0, False, at + len(name)
        while end < len(sql):
            c = sql[end]
            quoted ^= c == "'"
            depth += (not quoted) * ((c == "(") - (c == ")"))
            end += 1
            if not depth:
                break
        out.append(sql[at:end])
        at = sql.find(f"{name}(", end)
    return out


def shared(columns: dict[str, str]) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """(texts, matches, columns): what a pack's columns match with regular expressions, taken out of them, so that each
    text is made once and each expression is matched once for a row, in selects of their own below the columns. Where
    an expression needs one of some words, it is only matched if the text has one (a NULL text stays one)."""
    texts: dict[str, str] = {}
    matches: dict[str, str] = {}
    out = dict(columns)
    for name in ("regexp_extract_all", "regexp_extract"):
        found = [x for sql in out.values() for x in _calls(sql, name)]
        for call in dict.fromkeys(found):
            guarded = name == "regexp_extract" and _guard(call)
            if found.count(call) < 2 and not guarded or "->" in call or "regexp_extract" in call[len(name) :]:
                continue
            matches[call] = f"_m{len(matches)}"
            out = {k: v.replace(call, matches[call]) for k, v in out.items()}
    inner = {}
    for call, m in matches.items():
        for t in dict.fromkeys(_calls(call, "lower")):
            texts.setdefault(t, f"_t{len(texts)}")
    lowered = [t for sql in [*out.values(), *filter(None, map(_guard, matches))] for t in _calls(sql, "lower")]
    for t in dict.fromkeys(x for x in lowered if lowered.count(x) > 1 and "->" not in x):
        texts.setdefault(t, f"_t{len(texts)}")
    for call, m in matches.items():
        sql = f"CASE WHEN NOT {guard} THEN '' ELSE {call} END" if (guard := _guard(call)) else call
        for t, own in texts.items():
            sql = sql.replace(t, own)
        inner[m] = sql
    for t, own in texts.items():
        out = {k: v.replace(t, own) for k, v in out.items()}
    return {v: k for k, v in texts.items()}, inner, out


def _guard(call: str) -> str | None:
    """The condition below which a call of Spark's regexp_extract finds something."""
    parts = re.fullmatch(r"regexp_extract\((.*), r'(.*)', [0-9]+\)", call, re.S)
    return words_of(parts[1], parts[2]) if parts else None


def apply(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """key and a pack's columns."""
    texts, matches, outer = shared(columns)
    if texts:
        df = df.selectExpr("*", *[f"{sql} AS {c}" for c, sql in texts.items()])
    if matches:
        df = df.selectExpr("*", *[f"{sql} AS {c}" for c, sql in matches.items()])
    return df.selectExpr(key, *[f"{sql} AS {c}" for c, sql in outer.items()])


def column(sql: str) -> Column:
    return F.expr(sql)
