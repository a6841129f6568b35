"""2.C dataset loaders: one ``select`` of 2.B rules per extract, plus the bad-row policy.

A loader never iterates rows on the driver: the whole extract becomes one projection (typed values,
row hash, ``errors array<string>``). ``mode="fail"`` runs one distributed count of rows with errors and
raises with up to ten examples; ``mode="quarantine"`` returns the clean rows and keeps the bad ones
apart; ``mode="keep"`` returns everything with the ``errors`` column.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions import clean as C
from vigil.sources.readers import column_type, pick_column, require_columns


class Field(NamedTuple):
    name: str
    kind: str  # text | req_text | ident | req_ident | int | req_int | date | req_date | bool | code
    headers: tuple[str, ...]
    label: str = ""
    nulls: tuple[str, ...] = ()


class Dataset(NamedTuple):
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    skip_field: Field | None = None  # rows where this cleans to NULL are skipped before any check


def _f(name, kind, *headers, nulls=()):
    return Field(name, kind, tuple(headers), headers[0], tuple(nulls))


# Accepted raw headers per dataset and the rule of each field.
DATASETS: dict[str, Dataset] = {
    "inspections": Dataset(
        "inspections",
        (
            _f("inspection_id", "req_int", "Inspection ID"),
            _f("fei_number", "ident", "FEI Number"),
            _f("legal_name", "text", "Legal Name"),
            _f("city", "text", "City"),
            _f("state", "text", "State", nulls=("-",)),
            _f("zip_code", "ident", "Zip Code", "ZIP Code", "Zip"),
            _f("country", "text", "Country/Area", "Country"),
            _f("inspection_end_date", "req_date", "Inspection End Date"),
            _f("fiscal_year", "int", "Fiscal Year"),
            _f("posted_citations", "bool", "Posted Citations"),
            _f("classification", "text", "Classification"),
            _f("classification_code", "code", "Classification Code"),
            _f("project_area", "req_text", "Project Area"),
            _f("product_type", "text", "Product Type"),
            _f("additional_details", "text", "Additional Details"),
            _f("fmd_145_date", "date", "FMD-145 Date", "FMD 145 Date"),
        ),
        ("inspection_id", "project_area", "product_type", "additional_details"),
    ),
    "inspections_citations": Dataset(
        "inspections_citations",
        (
            _f("inspection_id", "req_int", "Inspection ID"),
            _f("fei_number", "ident", "FEI Number"),
            _f("legal_name", "req_text", "Legal Name"),
            _f("inspection_end_date", "req_date", "Inspection End Date"),
            _f("program_area", "req_text", "Program Area"),
            _f("act_cfr_number", "req_text", "Act/CFR Number"),
            _f("short_description", "text", "Short Description", nulls=("-",)),
            _f("long_description", "text", "Long Description", nulls=("-",)),
        ),
        ("inspection_id", "program_area", "act_cfr_number", "short_description", "long_description"),
        skip_field=_f("act_cfr_number", "text", "Act/CFR Number", nulls=("-",)),
    ),
    "compliance_actions": Dataset(
        "compliance_actions",
        (
            _f("fei_number", "req_ident", "FEI Number"),
            _f("legal_name", "req_text", "Legal Name"),
            _f("state", "text", "State", nulls=("-",)),
            _f("country_area", "req_text", "Country/Area"),
            _f("product_type", "req_text", "Product Type"),
            _f("action_taken_date", "req_date", "Action Taken Date"),
            _f("action_type", "req_text", "Action Type"),
            _f("case_injunction_id", "req_ident", "Case/Injunction ID"),
        ),
        ("case_injunction_id", "fei_number", "product_type"),
    ),
    "recalls": Dataset(
        "recalls",
        (
            _f("fei_number", "req_ident", "FEI Number"),
            _f("legal_name", "req_text", "Recalling Firm Name"),
            _f("product_type", "text", "Product Type"),
            _f("product_classification", "text", "Product Classification"),
            _f("status", "req_text", "Status"),
            _f("distribution_partner", "text", "Distribution Pattern"),
            _f("recalling_firm_city", "text", "Recalling Firm City"),
            _f("recalling_firm_state", "text", "Recalling Firm State"),
            _f("recalling_firm_country", "text", "Recalling Firm Country"),
            _f("center_classification_date", "date", "Center Classification Date"),
            _f("reason_recall", "text", "Reason for Recall"),
            _f("product_description", "text", "Product Description"),
            _f("event_id", "req_int", "Event ID"),
            _f("event_classification", "text", "Event Classification"),
            _f("product_id", "int", "Product ID"),
            _f("center", "text", "Center"),
            _f("recall_details", "text", "Recall Details"),
        ),
        ("fei_number", "event_id", "product_id"),
    ),
    "published483": Dataset(
        "published483",
        (
            _f("fei_number", "ident", "FEI Number"),
            _f("legal_name", "req_text", "Legal Name"),
            _f("record_date", "req_date", "Record Date"),
            _f("record_type", "req_text", "Record Type"),
            _f("publish_date", "req_date", "Publish Date"),
            _f("download", "req_text", "Download"),
            _f("record_id", "req_ident", "Record ID"),
        ),
        ("record_id", "fei_number"),
        skip_field=_f("fei_number", "ident", "FEI Number", "FEI"),
    ),
}

# Headers that are read when present but not required.
OPTIONAL_HEADERS = {"inspections": ("Classification Code",)}


def clean_field(df: DataFrame, f: Field, classification: Column | None = None, staged: bool = False) -> C.Cleaned:
    """One field's (value, error). With ``staged=True`` the frame carries a pre-stripped copy of each
    string header in ``__s:<header>``; rules then read it instead of re-stripping (messages still quote
    the raw cell)."""
    raw = pick_column(df, *f.headers)
    dtype = column_type(df, *f.headers)
    header = next((h for h in f.headers if h in df.columns), None)
    s = F.col(f"`__s:{header}`") if staged and header is not None and f"__s:{header}" in df.columns else None
    k = f.kind
    if k == "text":
        return C.Cleaned(C.optional_text(raw, f.nulls, s), C.no_error())
    if k == "req_text":
        return C.required_text(raw, f.label, f.nulls, s)
    if k == "ident":
        return C.optional_identifier(raw, dtype, s)
    if k == "req_ident":
        return C.required_identifier(raw, f.label, dtype, s)
    if k == "int":
        return C.optional_integer(raw, f.label, dtype, s)
    if k == "req_int":
        return C.required_integer(raw, f.label, dtype, s)
    if k == "date":
        return C.optional_date(raw, f.label, dtype, s)
    if k == "req_date":
        return C.required_date(raw, f.label, dtype, s)
    if k == "bool":
        return C.optional_boolean(raw, f.label, dtype, s)
    if k == "code":
        return C.classification_code(classification, raw if header is not None else None, s)
    raise ValueError(f"unknown field kind {k!r}")


def load(raw: DataFrame, dataset: str, filename: str | None = None, hashed: bool = True, mark_skipped: bool = False) -> DataFrame:
    """Typed rows of one extract: the dataset's fields, ``hash`` (B10 over the typed values) and ``errors``.

    ``mark_skipped=True`` keeps the rows the loader would skip and flags them in a ``skipped`` column
    (one pass for counts of raw, loaded and bad rows)."""
    ds = DATASETS[dataset]
    required = {f.name: f.headers for f in ds.fields if f.kind != "code"}
    require_columns(raw, required, filename or dataset)
    df = raw
    skipped = F.lit(False)
    if ds.skip_field is not None:
        keep, _ = clean_field(raw, ds.skip_field)
        if mark_skipped:
            skipped = keep.isNull()
        else:
            df = raw.where(keep.isNotNull())
    # Stage 0: strip every string header once; the rules below read these columns.
    strings = [c for c in df.columns if isinstance(df.schema[c].dataType, T.StringType)]
    df = df.select("*", *[C.py_strip(F.col(f"`{c}`")).alias(f"__s:{c}") for c in strings])
    classification = None
    values: dict[str, Column] = {}
    errors: list[Column] = []
    for f in ds.fields:
        v, e = clean_field(df, f, classification, staged=True)
        if f.name == "classification":
            classification = v
        values[f.name] = v
        errors.append(e)
    # Stage the cleaned values and messages as columns first: the hash and the error array then read
    # plain attributes instead of re-embedding every rule's expression tree (Catalyst keeps the two
    # projections apart because the staged values are used more than once). A condition on the errors
    # stays above this stage: pushed below, it would run every rule again, each time it is named. The
    # row number, never negative, is there because conditions are not pushed below such a column.
    errors[0] = F.when(F.monotonically_increasing_id() >= 0, errors[0])
    staged = df.select(
        *[v.alias(f"__v{i}") for i, v in enumerate(values.values())],
        *[e.alias(f"__e{i}") for i, e in enumerate(errors)],
        skipped.alias("__skipped"),
    )
    names = list(values)
    refs = {n: F.col(f"__v{i}") for i, n in enumerate(names)}
    cols = [refs[n].alias(n) for n in names]
    if hashed:
        typed = staged.schema
        cols.append(C.row_hash(refs, {n: typed[f"__v{i}"].dataType for i, n in enumerate(names)}).alias("hash"))
    cols.append(C.errors_array(*[F.col(f"__e{i}") for i in range(len(errors))]).alias("errors"))
    if mark_skipped:
        cols.append(F.col("__skipped").alias("skipped"))
    return staged.select(*cols)


class BadRowsError(ValueError):
    pass


def apply_policy(loaded: DataFrame, mode: str = "fail", examples: int = 10, key: tuple[str, ...] = ()):
    """F6. ``fail``: raise naming up to ``examples`` bad rows (by key and messages).
    ``quarantine``: return ``(good, bad)``. ``keep``: return the frame unchanged."""
    if mode == "keep":
        return loaded
    bad = loaded.where(F.size("errors") > 0)
    good = loaded.where(F.size("errors") == 0).drop("errors")
    if mode == "quarantine":
        return good, bad
    if mode == "fail":
        sample = bad.select(*key, "errors").limit(examples).collect()  # bounded: at most `examples` rows
        if sample:
            n = bad.count()
            shown = "; ".join(
                ", ".join(f"{k}={r[k]!r}" for k in key) + ": " + " | ".join(r["errors"]) for r in sample
            )
            raise BadRowsError(f"{n} rows cannot be loaded, among them {shown}")
        return good
    raise ValueError(f"unknown mode {mode!r}")
