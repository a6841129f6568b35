"""2.B cell-cleaning rules as Column -> Column expressions (JVM-side, whole-stage codegen, no UDF).

Every rule returns a :class:`Cleaned` pair: the typed value and an error message (NULL when the cell
is fine). Loaders collect the messages into an ``errors`` array; the bad-row policy (fail or
quarantine) is applied afterwards, so one bad cell never needs a driver-side loop to be found.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters Python's ``str.strip()`` removes (``str.isspace``), as a regex class
# valid in Java regex and RE2: \t \n \v \f \r, FS GS RS US, space, NEL, NBSP, Ogham space,
# en quad .. hair space, line/paragraph separators, narrow NBSP, medium math space, ideographic space.
PY_SPACE = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Text tokens that mean "no date".
DATE_NULL_TOKENS = ("-", "n/a", "na", "none", "null")

# Accepted date layouts, as (shape of the text, how it is read). A text is parsed once, by the first
# layout that has its shape; free-form guessing is not reproduced.
_ISO_TIME = r"[T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?( ?(Z|[+-]\d{2}:?\d{2}))?"
_US_TIME = r" \d{1,2}:\d{2}(:\d{2})?( ?[AaPp][Mm])?"
DATE_LAYOUTS = (
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}({_ISO_TIME})?$", "yyyy-M-d"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}({_US_TIME})?$", "M/d/yyyy"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}}({_ISO_TIME})?$", "yyyy/M/d"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{2}}({_US_TIME})?$", "M/d/yy"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2},? \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2}[- ][A-Za-z]{3}[- ]\d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}[- ][A-Za-z]{4,9}[- ]\d{4}$", "d MMMM yyyy"),
)
FIRST_TWO_DIGIT_YEAR = 69  # two-digit years from here on are of the 1900s, the others of the 2000s

# Boolean tokens (compared after strip + lower-case).
TRUE_TOKENS = ("yes", "y", "true", "1", "posted")
FALSE_TOKENS = ("no", "n", "false", "0", "not posted")

CODES = ("NAI", "VAI", "OAI")

INTEGER_TEXT = r"^[+-]?[0-9]+(_[0-9]+)*$"
INTEGRAL_DECIMAL_TEXT = r"^([0-9]+)\.0+$"


class Cleaned(NamedTuple):
    value: Column
    error: Column


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _quoted(raw: Column) -> Column:
    """The raw cell as Python's repr would show a string: in single quotes."""
    return F.concat(F.lit("'"), raw.cast("string"), F.lit("'"))


def no_error() -> Column:
    return F.lit(None).cast("string")


def is_missing(c: str | Column, dtype: T.DataType | None = None) -> Column:
    """B1: NULL, or NaN for floating columns."""
    c = _c(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def text_date(s: Column) -> Column:
    """The date in a stripped text, or NULL: one parse, chosen by the text's shape; a time of day is dropped."""
    day = F.regexp_replace(F.regexp_replace(s, r"(?<=\d)[T ]+\d{1,2}:.*$", ""), ",", "")
    out = F.lit(None).cast("date")
    for shape, layout in reversed(DATE_LAYOUTS):
        text = F.replace(day, F.lit("-"), F.lit(" ")) if layout.startswith("d MMM") else day
        parsed = F.try_to_date(text, layout)
        if layout.endswith("yy") and not layout.endswith("yyyy"):
            late = F.year(parsed) >= 2000 + FIRST_TWO_DIGIT_YEAR
            parsed = F.when(late, F.add_months(parsed, -1200)).otherwise(parsed)
        out = F.when(s.rlike(shape), parsed).otherwise(out)
    # the usual layout needs no formatter
    return F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), s.try_cast("date")).otherwise(out)


# The same characters as a plain set for ``btrim`` (a character loop, far cheaper than a regex).
PY_SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def py_strip(c: str | Column) -> Column:
    """Strip Unicode whitespace the way Python's ``str.strip`` does (SQL ``trim`` drops spaces only).

    ``btrim`` looks every character up in the whole set; a text that begins and ends with a visible ASCII character is itself."""
    text = _c(c).cast("string")
    bare = (text >= "!") & (text < "\x7f") & F.substring(text, -1, 1).between("!", "~")
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(PY_SPACE_CHARS)))


def _stripped(c: str | Column, s: Column | None) -> Column:
    """The stripped text of ``c``; ``s`` is a pre-stripped column when the caller staged it."""
    return s if s is not None else py_strip(c)


def _is_token(s: Column, tokens: Sequence[str]) -> Column:
    """Whether the lower-cased text is one of the tokens; longer texts are not lower-cased, which takes no characters away."""
    return (F.length(s) <= max(map(len, tokens))) & F.lower(s).isin(*tokens)


def optional_text(c: str | Column, null_values: tuple[str, ...] = (), s: Column | None = None) -> Column:
    """B2: stripped text; empty -> NULL; listed tokens (case-insensitive) -> NULL."""
    s = F.nullif(_stripped(c, s), F.lit(""))
    if null_values:
        s = F.when(_is_token(s, [v.lower() for v in null_values]), F.lit(None)).otherwise(s)
    return s


def required(value: Column, field: str) -> Column:
    return F.when(value.isNull(), F.lit(f"{field} has no value"))


def required_text(c: str | Column, field: str, null_values: tuple[str, ...] = (), s: Column | None = None) -> Cleaned:
    """B3."""
    v = optional_text(c, null_values, s)
    return Cleaned(v, required(v, field))


def optional_identifier(c: str | Column, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    """Identifiers are labels: ``3012457996.0`` -> ``3012457996``, ``007`` kept, ``12.50`` kept."""
    c = _c(c)
    if isinstance(dtype, T.BooleanType):
        return Cleaned(F.lit(None).cast("string"), F.when(c.isNotNull(), F.concat(
            F.lit("a boolean cannot identify anything: "), F.when(c, "True").otherwise("False"))))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return Cleaned(c.cast("string"), no_error())
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        finite = ~(F.isnan(c) | c.isin(float("inf"), float("-inf")))
        integral = finite & (c == F.floor(c))
        as_text = optional_text(c)
        return Cleaned(
            F.when(integral, c.cast("decimal(38,0)").cast("string")).when(finite, as_text),
            no_error(),
        )
    s = optional_text(c, s=s)
    # most texts cannot match: the pattern is asked of the others only
    whole = F.when(s.endswith("0") & s.contains("."), F.regexp_extract(s, INTEGRAL_DECIMAL_TEXT, 1))
    return Cleaned(F.when(whole != "", whole).otherwise(s), no_error())


def required_identifier(c: str | Column, field: str, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    """B5."""
    v, e = optional_identifier(c, dtype, s)
    return Cleaned(v, F.coalesce(e, required(v, field)))


def optional_integer(c: str | Column, field: str, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    """Identifier rule, then an integer literal (``int()`` semantics: sign, digits, ``_``)."""
    ident, e = optional_identifier(c, dtype, s)
    ok = ident.rlike(INTEGER_TEXT)
    value = F.when(ok, F.replace(ident, F.lit("_"), F.lit("")).try_cast("bigint"))
    bad = ident.isNotNull() & value.isNull()
    msg = F.concat(F.lit(f"{field} is not a whole number: "), _quoted(_c(c)))
    return Cleaned(value, F.coalesce(e, F.when(bad, msg)))


def required_integer(c: str | Column, field: str, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    v, e = optional_integer(c, field, dtype, s)
    return Cleaned(v, F.coalesce(e, required(v, field)))


def optional_date(c: str | Column, field: str, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    """dates/timestamps pass; text null tokens -> NULL; otherwise one of ``DATE_LAYOUTS``."""
    c = _c(c)
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return Cleaned(c.cast("date"), no_error())
    if dtype is not None and not isinstance(dtype, T.StringType):
        return Cleaned(
            F.lit(None).cast("date"),
            F.when(c.isNotNull(), F.concat(F.lit(f"{field} is of a type that holds no date: "), c.cast("string"))),
        )
    s = _stripped(c, s)
    token = (s == "") | _is_token(s, DATE_NULL_TOKENS)
    parsed = text_date(s)
    value = F.when(~token, parsed)
    bad = c.isNotNull() & ~token & parsed.isNull()
    msg = F.concat(F.lit(f"{field} is not a date: "), _quoted(c))
    return Cleaned(value, F.when(bad, msg))


def required_date(c: str | Column, field: str, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    v, e = optional_date(c, field, dtype, s)
    return Cleaned(v, F.coalesce(e, required(v, field)))


def optional_boolean(c: str | Column, field: str, dtype: T.DataType | None = None, s: Column | None = None) -> Cleaned:
    """yes/y/true/1/posted and no/n/false/0/not posted; anything else is an error."""
    c = _c(c)
    if isinstance(dtype, T.BooleanType):
        return Cleaned(c, no_error())
    norm = F.lower(_stripped(c, s))
    value = F.when(norm.isin(*TRUE_TOKENS), True).when(norm.isin(*FALSE_TOKENS), False)
    bad = c.isNotNull() & value.isNull()
    msg = F.concat(F.lit(f"{field} is neither yes nor no: "), _quoted(c))
    return Cleaned(value, F.when(bad, msg))


def classification_code(classification: str | Column, explicit: str | Column | None = None,
                        s_explicit: Column | None = None) -> Cleaned:
    """An explicit code wins (must be NAI/VAI/OAI); else the text equals a code or contains ``(CODE)``,
    tested in the order NAI, VAI, OAI."""
    text = F.upper(optional_text(classification))
    derived = F.lit(None).cast("string")
    for code in reversed(CODES):
        derived = F.when((text == code) | text.contains(f"({code})"), F.lit(code)).otherwise(derived)
    if explicit is None:
        return Cleaned(derived, no_error())
    given = optional_text(explicit, s=s_explicit)
    ex = F.when(given.isin(*CODES), given).otherwise(F.upper(given))
    value = F.when(ex.isNotNull(), F.when(ex.isin(*CODES), ex)).otherwise(derived)
    error = F.when(ex.isNotNull() & ~ex.isin(*CODES), F.lit("Classification Code is none of NAI, VAI, OAI"))
    return Cleaned(value, error)


# What JSON writes with an escape: the quote, the backslash, control characters.
JSON_SPECIAL = r'["\\\x00-\x1f]'
# The short escapes of JSON; other control characters are written by their code.
JSON_ESCAPES = (('"', '\\"'), ("\\", "\\\\"), ("\b", "\\b"), ("\t", "\\t"), ("\n", "\\n"), ("\f", "\\f"), ("\r", "\\r"))


def _escaped(text: Column) -> Column:
    """The text with JSON's escapes: cut at the special characters, which are then written one by one."""
    def written(part: Column) -> Column:
        code = F.concat(F.lit("\\u00"), F.lpad(F.lower(F.hex(F.ascii(part))), 2, "0"))
        out = F.when(part < " ", code).otherwise(part)
        for char, escape in JSON_ESCAPES:
            out = F.when(part == char, escape).otherwise(out)
        return out

    plain = JSON_SPECIAL.replace("[", "[^") + "+"
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"{plain}|{JSON_SPECIAL}"), F.lit(0)), written), "")


def canonical_json(values: dict[str, Column], types: dict[str, T.DataType]) -> Column:
    """Compact JSON of strings, whole numbers, booleans and dates: keys sorted, NULLs kept, non-ASCII raw, dates ISO, as
    Python's ``json.dumps(..., sort_keys=True, separators=(",", ":"), ensure_ascii=False)`` writes it.

    One pattern over all strings of a row tells whether anything has to be escaped; other rows are pieces put together."""
    names = sorted(values)
    strings = [n for n in names if isinstance(types[n], T.StringType)]

    def payload(escape: bool) -> Column:
        pieces = []
        for i, name in enumerate(names):
            v, kind = values[name], types[name]
            if isinstance(kind, T.StringType):
                cell = F.concat(F.lit('"'), _escaped(v) if escape else v, F.lit('"'))
            elif isinstance(kind, T.DateType):
                cell = F.concat(F.lit('"'), v.cast("string"), F.lit('"'))
            elif isinstance(kind, (T.IntegralType, T.BooleanType)):
                cell = v.cast("string")
            else:
                raise TypeError(f"{name}: no canonical form for {kind.simpleString()}")
            pieces += [F.lit(f"{',' if i else '{'}{json.dumps(name, ensure_ascii=False)}:"), F.coalesce(cell, F.lit("null"))]
        return F.concat(*pieces, F.lit("}")) if names else F.lit("{}")

    if not strings:
        return payload(False)
    return F.when(F.concat_ws("", *[values[n] for n in strings]).rlike(JSON_SPECIAL), payload(True)).otherwise(payload(False))


def row_hash(values: dict[str, Column], types: dict[str, T.DataType] | None = None) -> Column:
    """SHA-256 of compact JSON with sorted keys, NULLs kept, non-ASCII raw, dates ISO.

    With ``types`` the JSON is put together by ``canonical_json``; without, ``to_json`` writes it (any type, slower)."""
    if types is not None:
        return F.sha2(canonical_json(values, types), 256)
    fields = [values[k].alias(k) for k in sorted(values)]
    payload = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return F.sha2(payload, 256)


def errors_array(*errors: Column) -> Column:
    """Non-null messages, in field order, as ``array<string>`` (empty when the row is clean).

    ``filter`` is interpreted, with all rules below it where a condition on the array is pushed down: only rows with a message get there."""
    if not errors:
        return F.array().cast("array<string>")
    return F.when(F.coalesce(*errors).isNull(), F.array().cast("array<string>")).otherwise(F.filter(F.array(*errors), lambda e: e.isNotNull()))
