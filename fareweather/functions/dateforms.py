"""Written date forms beyond ISO and four-digit slashes, as ISO text.

A text is brought to a fixed shape first: its month's name becomes one letter, its numbers have two digits or
four. The shape of its date, its signature, is then looked up in a table that tells which number is what. What has no
entry is no date. All of it is built-in functions, row by row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
_NAMED = r"\b(JAN(?:UARY)?|FEB(?:RUARY)?|MAR(?:CH)?|APR(?:IL)?|MAY|JUNE?|JULY?|AUG(?:UST)?|SEPT?(?:EMBER)?|OCT(?:OBER)?|NOV(?:EMBER)?|DEC(?:EMBER)?)\b\.?"
_WEEKDAY = r"^(?:MON|TUES?|WED(?:NES)?|THU(?:RS)?|FRI|SAT(?:UR)?|SUN)(?:DAY)?\.?,? +"
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?|(?<=T)(?:\d{6}|\d{4}|\d{2})(?!\d)|\d{1,2}(?= ?[AP]M)"
_OFFSET = r"Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?"
#: Date, clock, half of the day, offset. A clock follows a space or a T.
_PARTS = rf"^(.*?)(?:(?: +|T)({_CLOCK})(?: ?([AP]M))?(?: ?({_OFFSET}))?)?$"
#: A date of the C library's form has its clock in the middle: B 15 09:00:00 2024.
_CLOCK_INSIDE = r"^(B \d{1,2}) (\d{1,2}:\d{2}(?::\d{2})?) (\d{4})$"

#: What the parts of a date are, by its signature: B stands for a month's name, 9 for a digit. Of two numbers that
#: may be the month, the first is, unless it is over twelve. Y has four digits, y two.
FORMS = {
    "B 99 9999": "bdY", "B-99-9999": "bdY", "B/99/9999": "bdY",
    "99 B 9999": "dbY", "99-B-9999": "dbY", "99/B/9999": "dbY", "99.B.9999": "dbY",
    "99 B 99": "dby", "99-B-99": "dby",
    "9999 B 99": "Ybd", "9999-B-99": "Ybd", "9999/B/99": "Ybd",
    "B 9999": "bY", "B-9999": "bY", "9999-99": "Ym", "9999/99": "Ym",
    "99-99-9999": "mdY", "99.99.9999": "mdY", "99 99 9999": "mdY",
    "99/99/99": "mdy", "99-99-99": "mdy", "99.99.99": "mdy",
    "9999.99.99": "Ymd", "9999 99 99": "Ymd",
    "99999999": "compact", "99999999999999": "compact",
}


def shaped(upper: str) -> str:
    """SQL of a text in capitals without weekday, commas and endings of numbers, its month's name as B and single digits padded."""
    text = f"regexp_replace(regexp_replace({upper}, r'{_WEEKDAY}', ''), r'{_NAMED}', 'B')"
    text = rf"regexp_replace(regexp_replace({text}, r'(\d)(?:ST|ND|RD|TH)\b', '$1'), r',(?= )|,(?=B)', '')"
    text = f"regexp_replace({text}, r'{_CLOCK_INSIDE}', '$1 $3 $2')"
    return rf"regexp_replace({text}, r'(?<![\d:.])(\d)(?![\d:])', '0$1')"


def with_iso_text(df: DataFrame, name: str, upper: str, shape: str) -> DataFrame:
    """The ISO form ``name`` of a text ``upper`` whose ``shaped`` form is ``shape``; null for what is no known form.

    Written as SQL, one column for each thing that is used more than once, so that plan and compiled code stay small.
    """
    table = ", ".join(f"'{signature}', '{form}'" for signature, form in FORMS.items())
    months = ", ".join(f"'{m}'" for m in _MONTHS)
    steps = (
        {x: f"regexp_extract({shape}, r'{_PARTS}', {i})" for i, x in enumerate(("date", "clock", "half", "offset"), 1)},
        {"padded": r"regexp_replace({date}, r'(?<!\d)(\d)(?!\d)', '0$1')"},
        {
            "form": f"element_at(map({table}), translate({{padded}}, '0123456789', '9999999999'))",
            "n": r"regexp_extract_all({padded}, r'(\d+)')",
            "month": f"lpad(array_position(array({months}), left(regexp_extract({upper}, r'{_NAMED}', 1), 3)), 2, '0')",
        },
        {
            "year": "CASE WHEN {form} IN ('Ybd', 'Ym', 'Ymd') THEN get({n}, 0) WHEN {form} IN ('bdY', 'dbY', 'dby') THEN get({n}, 1) WHEN {form} = 'bY' THEN get({n}, 0)"
                    " WHEN {form} IN ('mdY', 'mdy') THEN get({n}, 2) WHEN {form} = 'compact' THEN substring(get({n}, 0), 1, 4) END",
            "swapped": "{form} IN ('mdY', 'mdy') AND try_cast(get({n}, 0) AS INT) > 12",
            "written": "translate(CASE WHEN {form} = 'compact' AND length(get({n}, 0)) = 14 THEN substring(get({n}, 0), 9, 6) ELSE {clock} END, ',', '.')",
        },
        {
            "whole_year": "concat(CASE WHEN length({year}) = 4 THEN '' WHEN {year} < '69' THEN '20' ELSE '19' END, {year})",
            "number": "CASE WHEN {form} IN ('bdY', 'dbY', 'dby', 'Ybd', 'bY') THEN {month} WHEN {form} IN ('Ym', 'Ymd') OR {swapped} THEN get({n}, 1)"
                     " WHEN {form} IN ('mdY', 'mdy') THEN get({n}, 0) WHEN {form} = 'compact' THEN substring(get({n}, 0), 5, 2) END",
            "day": "CASE WHEN {form} IN ('bdY', 'dbY', 'dby') OR {swapped} THEN get({n}, 0) WHEN {form} IN ('Ybd', 'mdY', 'mdy') THEN get({n}, 1) WHEN {form} IN ('bY', 'Ym') THEN '01'"
                   " WHEN {form} = 'Ymd' THEN get({n}, 2) WHEN {form} = 'compact' THEN substring(get({n}, 0), 7, 2) END",
            "spelled": r"regexp_replace(regexp_replace(regexp_replace({written}, r'^(\d{2})(\d{2})(\d{2})$', '$1:$2:$3'), r'^(\d{2})(\d{2})$', '$1:$2'), r'^(\d{1,2})$', '$1:00')",
        },
        # ISO dates with a clock of its own form, as 2024-01-15T09, need no table.
        {"iso": r"coalesce(concat({whole_year}, '-', {number}, '-', {day}), CASE WHEN {written} <> '' AND {padded} RLIKE r'^\d{4}([-/])\d{2}\1\d{2}$' THEN translate({padded}, '/', '-') END)"},
    )
    own = {x: f"`{name}_{x}`" for step in steps for x in step}

    def named(sql: str) -> str:
        return re.sub(r"\{([a-z_]+)\}", lambda m: own.get(m[1], m[0]), sql)

    source = "SELECT * FROM {d}"
    for step in steps:
        columns = ", ".join(f"{named(sql)} AS {own[x]}" for x, sql in step.items())
        source = f"SELECT *, {columns} FROM ({source})"
    zone = "CASE WHEN {offset} IN ('GMT', 'UTC') THEN 'Z' ELSE {offset} END"
    joined = f"concat({{iso}}, 'T', {{spelled}}, CASE WHEN {{half}} = '' THEN '' ELSE concat(' ', {{half}}) END, {zone})"
    result = named(f"CASE WHEN {{spelled}} = '' THEN {{iso}} ELSE {joined} END")
    # One statement: a plan is looked at once, not once for each column.
    query = f"SELECT * EXCEPT ({', '.join(own.values())}), {result} AS `{name}` FROM ({source})"
    return df.sparkSession.sql(query.replace("{", "{{").replace("}", "}}").replace("{{d}}", "{d}"), d=df)
