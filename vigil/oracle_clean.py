"""DuckDB oracle SQL for the cleaning rules (2.B), loaders (2.C) and integrity checks (2.F).

The rules are re-stated here as DuckDB SQL expressions (RE2 regexes, ``try_strptime``, ``TRY_CAST``);
no rule, pattern or token list is shared with :mod:`vigil.functions.clean`.
"""

from __future__ import annotations

from vigil.operators.loaders import DATASETS, Field
from vigil.oracle import oracle
from vigil.sources.adapter import RAW_EXTRACTS

# the rules stated for DuckDB, apart from the operators' own statements
PY_SPACE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NO_DATE = ("-", "n/a", "na", "none", "null")
YES, NO = ("1", "true", "y", "yes", "posted"), ("0", "false", "n", "no", "not posted")
# layouts of dates and of dates with a time of day, tried one after the other
_DAYS = ("%m/%d/%y", "%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%Y%m%d", "%b %d, %Y", "%b %d %Y", "%B %d, %Y", "%B %d %Y", "%d-%b-%Y", "%d %b %Y", "%d-%B-%Y", "%d %B %Y")
_TIMES = {"%m/%d/%y": (" ",), "%Y-%m-%d": ("T", " "), "%Y/%m/%d": ("T", " "), "%m/%d/%Y": (" ",)}
_CLOCKS = {"T": ("%H:%M", "%H:%M:%S", "%H:%M:%S.%f", "%H:%M:%SZ"), " ": ("%H:%M", "%H:%M:%S", "%H:%M:%S.%f")}
DUCK_DATE_FORMATS = (*_DAYS, *[d + t + c for d, ts in _TIMES.items() for t in ts for c in _CLOCKS[t]])


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def strip(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '^{PY_SPACE}+|{PY_SPACE}+$', '', 'g')"


def opt_text(x: str, nulls=()) -> str:
    s = f"NULLIF({strip(x)}, '')"
    if nulls:
        return f"(CASE WHEN lower({s}) IN ({_list(v.lower() for v in nulls)}) THEN NULL ELSE {s} END)"
    return s


def ident(x: str) -> str:
    s = opt_text(x)
    # digits, a point and nothing but zeros after it: the zeros go
    point = f"split_part({s}, '.', 2)"
    return f"(CASE WHEN translate({s}, '0123456789', '') = '.' AND {point} <> '' AND replace({point}, '0', '') = '' AND {s} NOT LIKE '.%' THEN split_part({s}, '.', 1) ELSE {s} END)"


def quoted(x: str) -> str:
    return f"('''' || CAST({x} AS VARCHAR) || '''')"


def integer(x: str) -> str:
    i = ident(x)
    digits = f"ltrim({i}, '+-')"
    plain = f"length({i}) - length({digits}) <= 1 AND translate({digits}, '0123456789_', '') = '' AND {digits} NOT LIKE '!_%' ESCAPE '!' AND {digits} NOT LIKE '%!_' ESCAPE '!' AND NOT contains({digits}, '__') AND {digits} <> ''"
    return f"(CASE WHEN {plain} THEN TRY_CAST(replace({i}, '_', '') AS BIGINT) END)"


def integer_error(x: str, field: str) -> str:
    return f"(CASE WHEN {ident(x)} IS NOT NULL AND {integer(x)} IS NULL THEN '{field} is not a whole number: ' || {quoted(x)} END)"


def _date_token(x: str) -> str:
    s = strip(x)
    return f"({s} = '' OR lower({s}) IN ({_list(NO_DATE)}))"


def date(x: str) -> str:
    s = strip(x)
    parsed = "COALESCE(" + ", ".join(f"CAST(try_strptime({s}, '{f}') AS DATE)" for f in DUCK_DATE_FORMATS) + ")"
    return f"(CASE WHEN NOT {_date_token(x)} THEN {parsed} END)"


def date_error(x: str, field: str) -> str:
    return (
        f"(CASE WHEN {x} IS NOT NULL AND NOT {_date_token(x)} AND {date(x)} IS NULL "
        f"THEN '{field} is not a date: ' || {quoted(x)} END)"
    )


def boolean(x: str) -> str:
    n = f"lower({strip(x)})"
    return f"(CASE WHEN {n} IN ({_list(YES)}) THEN true WHEN {n} IN ({_list(NO)}) THEN false END)"


def boolean_error(x: str, field: str) -> str:
    return f"(CASE WHEN {x} IS NOT NULL AND {boolean(x)} IS NULL THEN '{field} is neither yes nor no: ' || {quoted(x)} END)"


def code(classification: str, explicit: str | None) -> str:
    t = f"upper({opt_text(classification)})"
    derived = (
        f"(CASE WHEN {t} = 'NAI' OR contains({t}, '(NAI)') THEN 'NAI' "
        f"WHEN {t} = 'VAI' OR contains({t}, '(VAI)') THEN 'VAI' "
        f"WHEN {t} = 'OAI' OR contains({t}, '(OAI)') THEN 'OAI' END)"
    )
    if explicit is None:
        return derived
    e = f"upper({opt_text(explicit)})"
    return f"(CASE WHEN {e} IS NOT NULL THEN (CASE WHEN {e} IN ('NAI', 'VAI', 'OAI') THEN {e} END) ELSE {derived} END)"


def code_error(explicit: str) -> str:
    e = f"upper({opt_text(explicit)})"
    return f"(CASE WHEN {e} IS NOT NULL AND {e} NOT IN ('NAI', 'VAI', 'OAI') THEN 'Classification Code is none of NAI, VAI, OAI' END)"


def required(v: str, field: str) -> str:
    return f"(CASE WHEN {v} IS NULL THEN '{field} has no value' END)"


def row_hash(values: dict[str, str]) -> str:
    body = ", ".join(f"'{k}': {values[k]}" for k in sorted(values))
    return f"sha256(to_json({{{body}}}))"


def errors_list(errors: list[str]) -> str:
    return "list_filter([" + ", ".join(f"CAST({e} AS VARCHAR)" for e in errors) + "], lambda e: e IS NOT NULL)"


# ------------------------------------------------------------------------------------------ 2.B

RC = "raw_cells"
CLEAN_ORACLES: dict[str, str] = {
    "clean_text": oracle(
        f"SELECT k, line, {opt_text('raw_text', ('-',))} AS text_value, "
        f"{required(opt_text('raw_text'), 'Text')} AS text_error FROM {RC}",
        tables=(RC,),
    ),
    "clean_identifier": oracle(f"SELECT k, line, {ident('raw_id')} AS identifier FROM {RC}", tables=(RC,)),
    "clean_integer": oracle(
        f"SELECT k, line, {integer('raw_id')} AS int_value, {integer_error('raw_id', 'Number')} AS int_error FROM {RC}",
        tables=(RC,),
    ),
    "clean_date": oracle(
        f"SELECT k, line, {date('raw_date')} AS date_value, {date_error('raw_date', 'Date')} AS date_error FROM {RC}",
        tables=(RC,),
    ),
    "clean_boolean": oracle(
        f"SELECT k, line, {boolean('raw_bool')} AS bool_value, {boolean_error('raw_bool', 'Flag')} AS bool_error FROM {RC}",
        tables=(RC,),
    ),
    "classification_code": oracle(
        f"SELECT k, line, {code('raw_class', None)} AS code_from_text, {code('raw_class', 'raw_text')} AS code_explicit, "
        f"{code_error('raw_text')} AS code_error FROM {RC}",
        tables=(RC,),
    ),
    "row_hash": oracle(
        "SELECT k, line, "
        + row_hash({c: c for c in ("k", "line", "raw_id", "raw_text", "raw_date", "raw_bool", "raw_class")})
        + f" AS row_hash FROM {RC}",
        tables=(RC,),
    ),
}


# ------------------------------------------------------------------------------------------ 2.C


def raw_cte(dataset: str) -> tuple[str, str]:
    base, cells = RAW_EXTRACTS[dataset]
    body = ", ".join(f'{expr} AS "{header}"' for header, expr in cells)
    return f"raw_{dataset}", f"SELECT {body} FROM {base}"


def _field_sql(f: Field, present: set[str], classification_sql: str | None) -> tuple[str, str | None]:
    header = next((h for h in f.headers if h in present), None)
    x = f'"{header}"' if header else "CAST(NULL AS VARCHAR)"
    k = f.kind
    if k == "text":
        return opt_text(x, f.nulls), None
    if k == "req_text":
        v = opt_text(x, f.nulls)
        return v, required(v, f.label)
    if k == "ident":
        return ident(x), None
    if k == "req_ident":
        v = ident(x)
        return v, required(v, f.label)
    if k == "int":
        return integer(x), integer_error(x, f.label)
    if k == "req_int":
        v = integer(x)
        return v, f"COALESCE({integer_error(x, f.label)}, {required(v, f.label)})"
    if k == "date":
        return date(x), date_error(x, f.label)
    if k == "req_date":
        v = date(x)
        return v, f"COALESCE({date_error(x, f.label)}, {required(v, f.label)})"
    if k == "bool":
        return boolean(x), boolean_error(x, f.label)
    if k == "code":
        explicit = x if header else None
        return code(classification_sql, explicit), (code_error(explicit) if explicit else None)
    raise ValueError(k)


def loader_sql(dataset: str) -> tuple[str, dict[str, str]]:
    """(final SELECT, CTEs) of one loader over its raw extract."""
    ds = DATASETS[dataset]
    present = {h for h, _ in RAW_EXTRACTS[dataset][1]}
    name, body = raw_cte(dataset)
    values: dict[str, str] = {}
    errors: list[str] = []
    classification = None
    for f in ds.fields:
        v, e = _field_sql(f, present, classification)
        if f.name == "classification":
            classification = f'"{f.headers[0]}"'
        values[f.name] = v
        if e is not None:
            errors.append(e)
    where = ""
    if ds.skip_field is not None:
        skip_v, _ = _field_sql(ds.skip_field, present, None)
        where = f" WHERE {skip_v} IS NOT NULL"
    cols = ", ".join(f"{v} AS {n}" for n, v in values.items())
    final = f"SELECT {cols}, {row_hash(values)} AS hash, {errors_list(errors)} AS errors FROM {name}{where}"
    return final, {name: body}


def loader_oracle(dataset: str) -> str:
    base = RAW_EXTRACTS[dataset][0]
    final, ctes = loader_sql(dataset)
    return oracle(final, ctes, tables=(base,))


LOADER_ORACLES = {f"load_{d}": loader_oracle(d) for d in DATASETS}


# ------------------------------------------------------------------------------------------ 2.F


def duplicate_oracle(dataset: str) -> str:
    base = RAW_EXTRACTS[dataset][0]
    final, ctes = loader_sql(dataset)
    keys = ", ".join(DATASETS[dataset].key)
    ctes = dict(ctes, loaded=final)
    return oracle(
        f"SELECT {keys}, count(*) AS duplicate_count FROM loaded GROUP BY {keys} HAVING count(*) > 1",
        ctes,
        tables=(base,),
    )


DUPLICATE_ORACLES = {f"duplicate_identities_{d}": duplicate_oracle(d) for d in DATASETS}
