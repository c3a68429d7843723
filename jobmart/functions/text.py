"""Text classifiers as native Column expressions (no Python UDFs).

Every function maps Columns to a Column, so the classifiers run inside
whole-stage codegen next to the scan. Keyword tests are substring tests on
the lower-cased text, exactly like the original ``tag in text`` checks; only
the industry rules are word-bounded regexes.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def any_substring(text: Column, words) -> Column:
    """True when any of ``words`` occurs in ``text`` (NULL text -> NULL)."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def stems(pattern: str) -> list[str]:
    """What a text must contain for an alternation of words to match: every word, without an optional last letter."""
    return [re.sub(r"\\(.)", r"\1", re.sub(r"\\?.\?$", "", word)) for word in pattern.split("|")]


def matches(text: Column, lowered: Column, pattern: str, words) -> Column:
    """``text`` matches the pattern. Only a text that contains one of ``words``, which every match does, runs the
    regular expression; a substring search costs a small part of one."""
    return any_substring(lowered, words) & text.rlike(pattern)


def joined_lower(title, description) -> Column:
    """lower(title || ' ' || description), NULL parts read as ''."""
    return F.lower(F.concat_ws(" ", F.coalesce(_c(title), F.lit("")), F.coalesce(_c(description), F.lit(""))))


# --- STR-1: title seniority (observed behaviour; always jr/mid/sr) -------------

def title_seniority(title) -> Column:
    t = F.lower(_c(title))
    return (
        F.when(any_substring(t, K.SENIOR_TITLE_TAGS), "sr")
        .when(any_substring(t, K.MID_TITLE_TAGS), "mid")
        .when(t.isNotNull(), "jr")
    )


def title_keyword_or_null(title) -> Column:
    """Documented reading of the title step: junior list consulted, NULL when no keyword."""
    t = F.lower(_c(title))
    return (
        F.when(any_substring(t, K.SENIOR_TITLE_TAGS), "sr")
        .when(any_substring(t, K.MID_TITLE_TAGS), "mid")
        .when(any_substring(t, K.JUNIOR_TITLE_TAGS), "jr")
    )


# --- NUM-4: salary band ------------------------------------------------------

def salary_band(salary_min, salary_max) -> Column:
    """jr below 74k, sr above 100k, else mid; NULL/0 in either bound -> NULL."""
    lo, hi = _c(salary_min).cast("double"), _c(salary_max).cast("double")
    usable = lo.isNotNull() & hi.isNotNull() & (lo != 0) & (hi != 0)
    return F.when(usable, F.when(lo < K.SALARY_JUNIOR_BELOW, "jr").when(lo > K.SALARY_SENIOR_ABOVE, "sr").otherwise("mid"))


# --- STR-14 / STR-3: years of experience ------------------------------------

def yoe_match(text) -> Column:
    """Group 1 (digits, as text) of the first YOE pattern that matches anywhere, else NULL.

    The third and fourth pattern contain the second, so they never decide and are not run; the others only where
    the text has the start of one of their units.
    """
    t = _c(text)
    found = F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in K.YOE_PATTERNS[:2]])
    return F.when(any_substring(t, ("year", "yr", "yo")), found)


def yoe_years(text, match=None) -> Column:
    """STR-14: minimum years as bigint (ranges give the lower bound; overflow -> NULL).

    ``match``: optional precomputed :func:`yoe_match` column (wide projections
    then run the regexes once per row)."""
    return (_c(match) if match is not None else yoe_match(text)).try_cast("bigint")


def _years_band(text, mid_upper: int | None, match=None) -> Column:
    # Compare as double so an over-long number still counts as "many years".
    y = (_c(match) if match is not None else yoe_match(text)).cast("double")
    if mid_upper is None:  # STR-3: <=3 jr, >=7 sr, else mid
        return F.when(y.isNotNull(), F.when(y <= 3, "jr").when(y >= 7, "sr").otherwise("mid"))
    return F.when(y.isNotNull(), F.when(y <= 3, "jr").when(y <= mid_upper, "mid").otherwise("sr"))


def yoe_band(text, match=None) -> Column:
    """STR-3: <=3 jr, >=7 sr, else mid; no match -> NULL."""
    return _years_band(text, None, match)


def categorize_role_documented(title, description, salary_min, salary_max, yoe=None) -> Column:
    """The hierarchy as documented: title keyword -> salary band -> YOE band -> mid.

    ``yoe``: optional precomputed ``yoe_match(description)`` column."""
    return F.coalesce(title_keyword_or_null(title), salary_band(salary_min, salary_max),
                      yoe_band(_c(description), yoe), F.lit("mid"))


# --- STR-4: v1 seniority (YOE -> level N -> senior hints -> junior hints -> mid) --

def seniority_v1(title, description, yoe=None) -> Column:
    """``yoe``: optional precomputed ``yoe_match(joined_lower(title, description))`` column,
    so wide projections evaluate the four YOE regexes once per row."""
    txt = joined_lower(title, description)
    t = F.lower(_c(title))
    lvl = F.regexp_replace(F.substring_index(t, "level", -1), r"^\s+|\s+$", "")
    level = F.when(matches(t, t, K.V1_LEVEL_PATTERN, ("level",)),
                   F.when(lvl.isin("i", "1"), "jr").when(lvl.isin("ii", "2"), "mid").otherwise("sr"))
    return F.coalesce(
        _years_band(txt, 5, yoe),
        level,
        F.when(any_substring(txt, K.V1_SENIOR_TAGS), "sr"),
        F.when(any_substring(t, K.V1_JUNIOR_TAGS), "jr"),
        F.lit("mid"),
    )


# --- STR-5: remote -------------------------------------------------------------

def is_remote(title, description) -> Column:
    return any_substring(joined_lower(title, description), K.REMOTE_KEYWORDS)


# --- STR-6 / STR-7 / STR-8: job type ---------------------------------------------

def job_type_observed(description) -> Column:
    """As called in the pipeline: the description is read as the title."""
    return F.when(F.lower(_c(description)).contains("intern"), "intern").when(_c(description).isNotNull(), "full-time")


def job_type_documented(title, description) -> Column:
    t, d = F.lower(_c(title)), F.lower(F.coalesce(_c(description), F.lit("")))
    return (F.when(t.contains("intern"), "intern")
            .when(d.contains("part time"), "part-time")
            .when(d.contains("full time"), "full-time")
            .when(d.contains("contract"), "contract")
            .otherwise("full-time"))


def clean_second_source_job_type(raw) -> Column:
    return F.lower(F.substring_index(_c(raw), K.JOB_TYPE_SPLIT, 1))


def standardize_job_type(raw, description, source) -> Column:
    return (F.when(_c(source) == "adzuna", job_type_observed(description))
            .when((_c(source) == "jsearch") & (F.coalesce(_c(raw), F.lit("")) != ""), clean_second_source_job_type(raw))
            .otherwise("full-time"))


# --- STR-12 / JOIN-14 / STR-13: industry -------------------------------------------

def _word(pattern: str) -> str:
    return r"(?i)\b(" + pattern + r")\b"


def _named(text, pattern: str) -> Column:
    """One of the pattern's words stands in the text, in any case."""
    t = F.coalesce(_c(text), F.lit(""))
    return matches(t, F.lower(t), _word(pattern), stems(pattern))


def startup_company(company) -> Column:
    return _named(company, K.STARTUP_COMPANY_PATTERN)


def industry(title, company, company_postings=None) -> Column:
    """Ordered industry rules; ``company_postings`` = per-company row count (startup rule)."""
    out = None
    for label, title_pat, company_pat in K.INDUSTRY_RULES:
        cond = _named(company, company_pat)
        if title_pat:
            cond = _named(title, title_pat) | cond
        out = F.when(cond, label) if out is None else out.when(cond, label)
    startup = startup_company(company)
    if company_postings is not None:
        startup = startup & (_c(company_postings) < K.STARTUP_MAX_POSTINGS)
    return out.when(startup, "startup").otherwise("other")


def industry_hint(title, description, category) -> Column:
    txt = joined_lower(title, description)
    out = None
    for label, words in K.INDUSTRY_HINTS:
        out = F.when(any_substring(txt, words), label) if out is None else out.when(any_substring(txt, words), label)
    return out.otherwise(F.coalesce(_c(category), F.lit("")))


# --- STR-15: education (precedence ours: lowest level required) -----------------

def education(description) -> Column:
    d = F.lower(F.coalesce(_c(description), F.lit("")))
    out = None
    for label, words in (("bachelor's", r"bachelor|ba/bs|bs/ba|b\.s\.|b\.a\."), ("master's", r"master|ms/|m\.s\.|mba"),
                         ("phd", r"phd|ph\.d|doctorate")):
        cond = matches(d, d, rf"\b({words})", stems(words))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


# --- STR-10 / STR-9 / STR-11: states and locations ---------------------------------

def state_map() -> Column:
    """Literal map full name -> abbreviation (51 entries, fits in the expression)."""
    return F.create_map(*[F.lit(x) for kv in K.US_STATES.items() for x in kv])


def lower_state_map() -> Column:
    return F.create_map(*[F.lit(x) for k, v in K.US_STATES.items() for x in (k.lower(), v)])


def state_code_exact(state_full) -> Column:
    """The abbreviation of an exactly written state name, else the empty string."""
    return F.coalesce(state_map()[_c(state_full)], F.lit(""))


def state_abbreviation(x) -> Column:
    """'' for empty/NULL; valid 2-letter code -> upper; full name (any case) -> code; else input."""
    raw = _c(x)
    norm = F.lower(F.regexp_replace(raw, r"^\s+|\s+$", ""))  # strip all surrounding whitespace
    codes = F.array(*[F.lit(v) for v in K.US_STATES.values()])
    return (F.when(raw.isNull() | (raw == ""), F.lit(""))
            .when((F.length(norm) == 2) & F.array_contains(codes, F.upper(norm)), F.upper(norm))
            .otherwise(F.coalesce(lower_state_map()[norm], raw)))


def second_source_state(job_state, job_location) -> Column:
    """Name -> code with pass-through; if empty, a 2-char last ', ' part of the location."""
    st = F.coalesce(state_map()[_c(job_state)], _c(job_state), F.lit(""))
    parts = F.split(F.coalesce(_c(job_location), F.lit("")), ", ")
    last = F.regexp_replace(F.element_at(parts, -1), r"^\s+|\s+$", "")  # str.strip()
    fallback = F.when((F.size(parts) >= 2) & (F.length(last) == 2), last).otherwise(st)
    return F.when((st == "") & (F.coalesce(_c(job_location), F.lit("")) != ""), fallback).otherwise(st)


def standardize_location(city, county, state, location_raw, source) -> Column:
    c, s = F.coalesce(_c(city), F.lit("")), F.coalesce(_c(state), F.lit(""))
    return (F.when(_c(source) == "adzuna",
                   F.when((c != "") & (s != ""), F.concat_ws(", ", c, s)).otherwise(_c(location_raw)))
            .when(_c(source) == "jsearch", _c(location_raw)))


def standardize_county(county, source) -> Column:
    return F.when(_c(source) == "adzuna", _c(county)).when(_c(source) == "jsearch", F.lit(""))


# --- STR-17: display truncation -------------------------------------------------------

def truncate_display(x, max_len: int, keep: int) -> Column:
    return F.when(F.length(_c(x)) > max_len, F.concat(F.substring(_c(x), 1, keep), F.lit("..."))).otherwise(_c(x))


# --- STR-18: case-insensitive key ----------------------------------------------------

def norm_key(x) -> Column:
    return F.lower(F.trim(_c(x)))
