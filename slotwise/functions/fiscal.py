"""Fiscal-year inference: ordered cascades, each giving (year, method, confidence) as SQL expressions.

A cascade is a list of steps (condition, year, method, confidence); the first that holds decides.
The patterns, methods and confidences in the cascades are fixed values, in the order in which they are tried.
"""

from __future__ import annotations

from slotwise.functions.rules import Dialect, case, every, found, group

Step = tuple[str, str, str, float]
B, Y = r"\b", "20[0-9]{2}"


def cascade(steps: list[Step]) -> tuple[str, str, str]:
    """Year, confidence and method of the first step that holds; NULL, 0 and UNRESOLVED without one."""
    return (f"cast({case([(c, y) for c, y, _, _ in steps])} AS int)", f"cast({case([(c, str(w)) for c, _, _, w in steps], '0.0')} AS double)", case([(c, f"'{m}'") for c, _, m, _ in steps], "'unresolved'"))


def _step(d: Dialect, t: str, pattern: str, method: str, confidence: float, flags: str = "(?i)", plus: str = "") -> Step:
    return found(d, t, pattern, flags), f"{plus}cast({_some(group(d, t, pattern, 1, flags))} AS int)", method, confidence


def _some(x: str) -> str:
    return f"nullif({x}, '')"


def _range(d: Dialect, t: str, pattern: str, method: str, confidence: float, carry: bool = False) -> Step:
    """Two years, the second with 2 or 4 digits, that are the same or follow each other: the second. carry: two digits
    that are less than the first year's are of the next century."""
    a, b = f"cast({_some(group(d, t, pattern, 1))} AS int)", _some(group(d, t, pattern, 2))
    over = f" + CASE WHEN cast({b} AS int) < {a} % 100 THEN 100 ELSE 0 END" if carry else ""
    end = f"(CASE WHEN length({b}) = 4 THEN cast({b} AS int) ELSE {a} - {a} % 100 + cast({b} AS int){over} END)"
    return f"({found(d, t, pattern)} AND {end} BETWEEN {a} AND {a} + 1)", end, method, confidence


def _years(d: Dialect, t: str, pattern: str) -> str:
    return d.call("ints", every(d, t, pattern, 1, ""))


def africa(d: Dialect, t: str, period: str, published: str) -> tuple[str, str, str]:
    """period end, phrase, FY token, range, title, any year, publication (January to June: the year before)."""
    y = "20(?:1[0-9]|2[0-9])"
    years = _years(d, t, rf"\b({y})\b")
    return cascade([
        _step(d, period, rf"\b({y})\b", "metadata_period_end", 1.0),
        _step(d, t, rf"(?:year|period)\s+ended[^0-9]{{0,30}}(?:3[01]|30|[012]?[0-9])?[^0-9]{{0,20}}({y})", "period_ended_phrase", 0.99),
        _step(d, t, r"\bFY\s*[-_/]?\s*(20[0-9]{2})\b", "explicit_fy4", 0.98),
        _step(d, t, r"\bFY\s*[-_/]?\s*([0-9]{2})\b", "explicit_fy2", 0.95, plus="2000 + "),
        _range(d, t, r"\b(20[0-9]{2})\s*[-/]\s*(20[0-9]{2}|[0-9]{2})\b", "year_range", 0.95),
        _step(d, t, rf"\b({y})\s+(?:annual|integrated)\b", "year_before_title", 0.92),
        _step(d, t, rf"\b(?:annual|integrated)\s+(?:report|accounts)?[^0-9]{{0,20}}({y})\b", "year_after_title", 0.9),
        (f"{d.call('size', years)} > 0", d.call("max", years), "generic_title_year", 0.7),
        (f"{published} IS NOT NULL", f"{d.call('year', published)} - CASE WHEN {d.call('month', published)} <= 6 THEN 1 ELSE 0 END", "publication_date_heuristic", 0.55),
    ])


def middle_east(d: Dialect, title: str, period: str, published: str) -> tuple[str, str, str]:
    """period ends in three spellings, FY tokens, ranges, the title's last plausible year, publication less one."""

    def bounded(step: Step, low: int = 2010, high: int = 2030) -> Step:
        return f"({step[0]} AND {step[1]} BETWEEN {low} AND {high})", *step[1:]

    months = "jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|aug|august|sep|september|oct|october|nov|november|dec|december"
    years = d.call("filter_between", _years(d, title, r"\b(20[12][0-9])\b"), "2015", "2026")
    return cascade([
        bounded(_step(d, period, r"(20[0-9][0-9])[-/](?:0?[1-9]|1[0-2])[-/](?:0?[1-9]|[12][0-9]|3[01])", "EXPLICIT_PERIOD_END_ISO", 0.99)),
        bounded(_step(d, period, r"(?:0?[1-9]|[12][0-9]|3[01])[-/](?:0?[1-9]|1[0-2])[-/](20[0-9][0-9])", "EXPLICIT_PERIOD_END_DMY", 0.99)),
        bounded(_step(d, period, rf"(?:3[01]|[12][0-9]|0?[1-9])\s+(?:{months})\s+(20[0-9][0-9])", "EXPLICIT_PERIOD_END_TEXT", 0.99)),
        bounded(_step(d, title, r"\b(?:FY|F\.Y\.)\s*[:\-_]?\s*(20[0-9][0-9])\b", "EXPLICIT_FY_TOKEN_4DIGIT", 0.95)),
        bounded(_step(d, title, r"\b(?:FY|F\.Y\.)\s*[:\-_]?\s*([0-9]{2})\b", "EXPLICIT_FY_TOKEN_2DIGIT", 0.9, plus="2000 + ")),
        _range(d, title, r"\b(20[0-9][0-9])\s*[-/]\s*(20[0-9][0-9])\b", "YEAR_RANGE_4DIGIT", 0.95),
        _range(d, title, r"\b(20[0-9][0-9])\s*[-/]\s*([0-9]{2})\b", "YEAR_RANGE_SHORT", 0.92),
        (f"{d.call('size', years)} > 0", d.call("last", years), "TITLE_STANDALONE_YEAR", 0.85),
        (f"{published} IS NOT NULL", f"{d.call('year', published)} - 1", "PUBLICATION_DATE_HEURISTIC", 0.6),
    ])


def sri_lanka(d: Dialect, t: str) -> tuple[str, str, str]:
    """FY token, range, title year, greatest year."""
    years = _years(d, t, r"\b(20(?:1[0-9]|2[0-9]))\b")
    return cascade([
        _step(d, t, r"\bFY\s*20([0-9]{2})\b", "explicit_fy", 1.0, plus="2000 + "),
        _range(d, t, r"\b(20[0-9]{2})\s*[-/]\s*(20[0-9]{2}|[0-9]{2})\b", "year_range", 0.98),
        _step(d, t, r"\b(?:annual\s+report|integrated\s+annual\s+report)[^0-9]{0,15}(20[0-9]{2})\b", "title_year", 0.96),
        (f"{d.call('size', years)} > 0", d.call("max", years), "generic_year", 0.72),
    ])


def _window(d: Dialect, t: str, published: str, pattern: str) -> str:
    year = d.call("year", published)
    return d.call("filter_between", _years(d, t, pattern), f"{year} - 2", f"{year} + 1")


def australia(d: Dialect, t: str, published: str) -> tuple[str, str, str]:
    """FY tokens, period phrase, title, greatest plausible year, publication (January to May: the year before)."""
    near = _window(d, t, published, r"\b(20[0-9]{2})\b")
    return cascade([
        _step(d, t, r"\bFY\s*[-_/]?\s*(20[0-9]{2})\b", "title_fy4", 1.0),
        _step(d, t, r"\bFY\s*[-_/]?\s*([0-9]{2})\b", "title_fy2", 1.0, plus="2000 + "),
        _step(d, t, r"year\s+ended.{0,60}?(20[0-9]{2})", "title_year_ended", 1.0),
        _step(d, t, r"\b(20[0-9]{2})\s+annual\s+report\b", "title_year_before_report", 1.0),
        _step(d, t, r"annual\s+report[^0-9]{0,30}(20[0-9]{2})", "title_year_after_report", 1.0),
        (f"{d.call('size', near)} > 0", d.call("max", near), "title_year", 1.0),
        (f"{d.call('month', published)} <= 5", f"{d.call('year', published)} - 1", "publication_heuristic_prev", 0.5),
        (f"{published} IS NOT NULL", d.call("year", published), "publication_heuristic_same", 0.5),
    ])


def hong_kong(d: Dialect, t: str, published: str) -> tuple[str, str, str]:
    """greatest plausible year, else greatest, else publication (January to June: the year before)."""
    # adjacent years share a separator, which look-around leaves in place; a dialect without it gets two for each
    pattern = r"(?<![0-9])(20[0-9]{2})(?![0-9])" if d.raw else r"(?:^|[^0-9])(20[0-9]{2})(?:$|[^0-9])"
    t = t if d.raw else f"regexp_replace({t}, '[^0-9]', '  ', 'g')"
    near, years = _window(d, t, published, pattern), _years(d, t, pattern)
    return cascade([
        (f"{d.call('size', near)} > 0", d.call("max", near), "title", 1.0),
        (f"{d.call('size', years)} > 0", d.call("max", years), "title", 1.0),
        (f"{published} IS NOT NULL", f"{d.call('year', published)} - CASE WHEN {d.call('month', published)} <= 6 THEN 1 ELSE 0 END", "publication_heuristic", 0.5),
    ])


def canada(d: Dialect, t: str, period: str, published: str) -> tuple[str, str, str]:
    """F8: the period end's last year, title patterns, publication less one."""
    years = _years(d, f"coalesce({period}, '')", "((?:19|20)[0-9]{2})")
    return cascade([
        (f"{d.call('size', years)} > 0", d.call("last", years), "period_end", 1.0),
        _step(d, t, r"(?:FY|FISCAL\s+YEAR|YEAR\s+ENDED|YEAR\s+ENDING)\s*[-:/ ]*?(20[0-9]{2})", "title", 0.9),
        _step(d, t, r"\b(20[0-9]{2})\s+(?:ANNUAL\s+REPORT|REPORT\s+TO\s+SHAREHOLDERS)\b", "title", 0.9),
        _step(d, t, r"\b(?:ANNUAL\s+REPORT|REPORT\s+TO\s+SHAREHOLDERS)\s*[-:/ ]*?(20[0-9]{2})\b", "title", 0.9),
        (f"{published} IS NOT NULL", f"{d.call('year', published)} - 1", "publication_heuristic_minus1", 0.5),
    ])


def india(d: Dialect, t: str) -> tuple[str, str, str]:
    """the end of a range, FY token, "year ended"."""
    fy = r"\bFY\s*['-]?(20[0-9]{2}|[0-9]{2})\b"
    number = f"cast({_some(group(d, t, fy))} AS int)"
    return cascade([
        _range(d, t, r"\b(20[0-9]{2})\s*[-/–]\s*([0-9]{2}|[0-9]{4})\b", "range", 1.0, carry=True),
        (found(d, t, fy), f"CASE WHEN {number} >= 2000 THEN {number} ELSE 2000 + {number} END", "fy", 1.0),
        _step(d, t, r"\byear\s+ended.{0,45}?(20[0-9]{2})\b", "year_ended", 1.0),
    ])


def _explicit(d: Dialect, t: str, patterns: list[str], published_year: str, first: list[Step]) -> tuple[str, str, str]:
    years = _years(d, t, r"\b(20(?:1[7-9]|2[0-5]))\b")
    steps = list(first)
    for p in patterns:
        n = f"cast({_some(group(d, t, p))} AS int)"
        steps.append((found(d, t, p), f"CASE WHEN {n} < 100 THEN 2000 + {n} ELSE {n} END", "explicit", 1.0))
    steps += [(f"{d.call('size', years)} > 0", d.call("max", years), "text-year", 0.7), (f"{published_year} IS NOT NULL", published_year, "publication-heuristic", 0.5)]
    return cascade(steps)


def bangladesh(d: Dialect, t: str, published_year: str) -> tuple[str, str, str]:
    """the end of a range, explicit patterns, greatest year, publication year."""
    p = r"\b20(?:1[6-9]|2[0-5])\s*[-/]\s*(?:20)?([0-9]{2})\b"
    return _explicit(d, t, [r"\bFY\s*(?:20)?(1[7-9]|2[0-5])\b", r"\byear ended[^0-9]{0,40}(20(?:1[7-9]|2[0-5]))\b", r"\bannual report\s*[-–:_ ]*\s*(20(?:1[7-9]|2[0-5]))\b", r"\b(20(?:1[7-9]|2[0-5]))\s+annual report\b"], published_year, [_step(d, t, p, "explicit-range", 1.0, plus="2000 + ")])


def new_zealand(d: Dialect, t: str, published_year: str) -> tuple[str, str, str]:
    """explicit patterns, greatest year, publication year."""
    return _explicit(d, t, [r"\bFY\s*(?:20)?(1[7-9]|2[0-5])\b", r"\bfinancial year(?: ended)?[^0-9]{0,20}(20(?:1[7-9]|2[0-5]))\b", r"\byear ended[^0-9]{0,40}(20(?:1[7-9]|2[0-5]))\b", r"\bannual report\s*[-–:]?\s*(20(?:1[7-9]|2[0-5]))\b", r"\b(20(?:1[7-9]|2[0-5]))\s+annual report\b"], published_year, [])


def form_17a(d: Dialect, t: str) -> tuple[str, str, str]:
    """the fiscal year that a form's text names, from 2000 to 2035."""
    patterns = [r"For the fiscal year ended[\s\S]{0,80}?(20[0-9]{2})", r"period ended\s*\|?\s*[A-Za-z]{3,9}\s+[0-9]{1,2},\s*(20[0-9]{2})", r"calendar year ended\s*\|?\s*[A-Za-z]{3,9}\s+[0-9]{1,2},\s*(20[0-9]{2})", r"SEC FORM 17-A[\s\S]{0,80}?(20[0-9]{2})"]
    steps = [_step(d, t, p, "form_text", 1.0) for p in patterns]
    return cascade([(f"({c} AND {y} BETWEEN 2000 AND 2035)", y, m, w) for c, y, m, w in steps])


def unique_year(d: Dialect, t: str) -> str:
    """the only year in a text, else NULL."""
    years = d.call("distinct", _years(d, t, r"\b(20[0-9]{2})\b"))
    return f"CASE WHEN {d.call('size', years)} = 1 THEN {d.call('first', years)} END"


def last_or_first_year(d: Dialect, title: str, date: str) -> str:
    """the title's last year, else the date's first."""
    a, b = _years(d, title, r"\b(20[0-9]{2})\b"), _years(d, date, r"(20[0-9]{2})")
    return f"coalesce({d.call('last', a)}, {d.call('first', b)})"


def two_stages(d: Dialect, body: str, title: str) -> tuple[str, str]:
    """the year that the document names (confidence 1), else its title's last year (0.7)."""
    years = _years(d, title, r"\b(20[0-9]{2})\b")
    own = form_17a(d, body)[0]
    last = d.call("last", years)
    return f"coalesce({own}, {last})", f"cast(CASE WHEN {own} IS NOT NULL THEN 1.0 WHEN {last} IS NOT NULL THEN 0.7 ELSE 0.0 END AS double)"
