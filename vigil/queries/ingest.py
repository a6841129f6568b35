"""2.B cleaning, 2.C loaders and 2.F integrity queries over the adapter tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions import clean as C
from vigil.operators import integrity as I
from vigil.operators.loaders import DATASETS, apply_policy, load
from vigil.oracle import oracle
from vigil.oracle_clean import CLEAN_ORACLES, DUPLICATE_ORACLES, LOADER_ORACLES, loader_sql
from vigil.registry import register
from vigil.session import set_aside
from vigil.sources.adapter import RAW_EXTRACTS
from vigil.sources.catalog import Catalog, raw_extract


def _rc(spark, sf_dir) -> DataFrame:
    return Catalog(spark, sf_dir).raw_cells


@register("clean_text", CLEAN_ORACLES["clean_text"])
def clean_text(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    return rc.select(
        "k", "line",
        C.optional_text("raw_text", ("-",)).alias("text_value"),
        C.required_text("raw_text", "Text").error.alias("text_error"),
    )


@register("clean_identifier", CLEAN_ORACLES["clean_identifier"])
def clean_identifier(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    return rc.select("k", "line", C.optional_identifier("raw_id").value.alias("identifier"))


@register("clean_integer", CLEAN_ORACLES["clean_integer"])
def clean_integer(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    v, e = C.optional_integer("raw_id", "Number")
    return rc.select("k", "line", v.alias("int_value"), e.alias("int_error"))


@register("clean_date", CLEAN_ORACLES["clean_date"])
def clean_date(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    v, e = C.optional_date("raw_date", "Date")
    return rc.select("k", "line", v.alias("date_value"), e.alias("date_error"))


@register("clean_missing", oracle("SELECT k, line, x IS NULL OR isnan(x) AS missing FROM (SELECT k, line, CASE line % 3 WHEN 0 THEN 'NaN'::DOUBLE "
                                  "WHEN 1 THEN CAST(k AS DOUBLE) END AS x FROM raw_cells) r", tables=("raw_cells",)))
def clean_missing(spark, sf_dir):
    """B1 over a number that is there, absent, or not a number."""
    x = F.when(F.col("line") % 3 == 0, float("nan")).when(F.col("line") % 3 == 1, F.col("k").cast("double"))
    rows = _rc(spark, sf_dir).select("k", "line", x.alias("x"))
    return rows.select("k", "line", C.is_missing("x", rows.schema["x"].dataType).alias("missing"))


@register("clean_boolean", CLEAN_ORACLES["clean_boolean"])
def clean_boolean(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    v, e = C.optional_boolean("raw_bool", "Flag")
    return rc.select("k", "line", v.alias("bool_value"), e.alias("bool_error"))


@register("classification_code", CLEAN_ORACLES["classification_code"])
def classification_code(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    explicit = C.classification_code("raw_class", "raw_text")
    return rc.select(
        "k", "line",
        C.classification_code("raw_class").value.alias("code_from_text"),
        explicit.value.alias("code_explicit"),
        explicit.error.alias("code_error"),
    )


@register("row_hash", CLEAN_ORACLES["row_hash"])
def row_hash(spark, sf_dir):
    rc = _rc(spark, sf_dir)
    cols = ("k", "line", "raw_id", "raw_text", "raw_date", "raw_bool", "raw_class")
    return rc.select("k", "line", C.row_hash({c: F.col(c) for c in cols}, {c: rc.schema[c].dataType for c in cols}).alias("row_hash"))


def loaded(spark, sf_dir, dataset: str) -> DataFrame:
    return load(raw_extract(Catalog(spark, sf_dir), dataset), dataset)


def _register_loader(dataset: str):
    register(f"load_{dataset}", LOADER_ORACLES[f"load_{dataset}"])(lambda spark, sf_dir: loaded(spark, sf_dir, dataset))


def _register_duplicates(dataset: str):
    def q(spark, sf_dir):
        return I.duplicate_identities(loaded(spark, sf_dir, dataset), DATASETS[dataset].key)

    register(f"duplicate_identities_{dataset}", DUPLICATE_ORACLES[f"duplicate_identities_{dataset}"])(q)


for _d in DATASETS:
    _register_loader(_d)
    _register_duplicates(_d)


def _violations_oracle(kinds: tuple[str, ...]) -> str:
    ctes: dict[str, str] = {}
    selects = []
    for d in DATASETS:
        final, raw = loader_sql(d)
        ctes.update(raw)
        ctes[f"loaded_{d}"] = final
        rules = []
        for rule, sql in I.CHECKS.get(d, []):
            rules.append(("check", rule, f"NOT COALESCE({sql}, true)"))
        for col in I.NOT_NULL.get(d, ()):
            rules.append(("not_null", col, f"{col} IS NULL"))
        for col, n in I.MAX_LENGTH.get(d, {}).items():
            rules.append(("max_length", f"{col}<={n}", f"COALESCE(length({col}) > {n}, false)"))
        for kind, rule, cond in rules:
            if kind in kinds:
                selects.append(
                    f"SELECT '{d}' AS table_name, '{kind}' AS kind, '{rule}' AS rule, "
                    f"count(*) FILTER (WHERE {cond}) AS violations FROM loaded_{d}"
                )
    tables = tuple(RAW_EXTRACTS[d][0] for d in DATASETS)
    return oracle("\nUNION ALL\n".join(selects), ctes, tables=tables)


def _all_loaded(spark, sf_dir, hashed: bool = True) -> dict[str, DataFrame]:
    cat = Catalog(spark, sf_dir)
    return {d: load(raw_extract(cat, d), d, hashed=hashed) for d in DATASETS}


@register("constraint_violations", _violations_oracle(("check", "max_length")))
def constraint_violations(spark, sf_dir):
    """F2, F4 over the loaded rows. The hash is a SHA-256 that the loader writes: its length needs no computing."""
    return I.violation_table(_all_loaded(spark, sf_dir, hashed=False), ("check", "max_length"), computed=("hash",))


@register("not_null_violations", _violations_oracle(("not_null",)))
def not_null_violations(spark, sf_dir):
    return I.violation_table(_all_loaded(spark, sf_dir, hashed=False), ("not_null",), computed=("hash",))


# The loaders let no illegal code through and the extracts hold no long texts, so the rules are also run over loaded
# rows into which a breach of every rule was planted: the hash's first digits pick which one (valid in both dialects).


def planted_breaches(table: str) -> list[tuple[str, str]]:
    """(column, bad value) per rule of a stored table."""
    out = [(c, "NULL") for c in I.NOT_NULL.get(table, ())]
    out += [(c, f"repeat('x', {n + 1})") for c, n in I.MAX_LENGTH.get(table, {}).items()]
    return out + {"inspections": [("classification_code", "'ABC'")], "compliance_actions": [("action_type", "'Letter'")]}.get(table, [])


def planted_columns(table: str, pick: str) -> str:
    breaches = planted_breaches(table)
    columns = [f.name for f in DATASETS[table].fields] + ["hash"]
    cells = []
    for c in columns:
        bad = " ".join(f"WHEN {pick} % {len(breaches)} = {i} THEN {value}" for i, (name, value) in enumerate(breaches) if name == c)
        cells.append(f"CASE {bad} ELSE {c} END AS {c}" if bad else c)
    return ", ".join(cells)


def _planted_oracle() -> str:
    ctes: dict[str, str] = {}
    selects = []
    for d in DATASETS:
        final, raw = loader_sql(d)
        ctes |= raw
        ctes[f"loaded_{d}"] = final
        ctes[f"planted_{d}"] = f"SELECT {planted_columns(d, _DUCK_PICK)} FROM loaded_{d}"
        for rule, sql in I.CHECKS.get(d, []):
            selects.append((d, "check", rule, f"({sql}) = false"))
        selects += [(d, "not_null", c, f"{c} IS NULL") for c in I.NOT_NULL.get(d, ())]
        selects += [(d, "max_length", f"{c}<={n}", f"length({c}) > {n}") for c, n in I.MAX_LENGTH.get(d, {}).items()]
    body = "\nUNION ALL\n".join(f"SELECT '{d}' AS table_name, '{kind}' AS kind, '{rule}' AS rule, count(*) FILTER (WHERE {bad}) AS violations FROM planted_{d}" for d, kind, rule, bad in selects)
    return oracle(body, ctes, tables=tuple(RAW_EXTRACTS[d][0] for d in DATASETS))


_DUCK_PICK = "CAST('0x' || substr(hash, 1, 4) AS INTEGER)"
_SPARK_PICK = "CAST(conv(substr(hash, 1, 4), 16, 10) AS INT)"


@register("violations_planted", _planted_oracle())
def violations_planted(spark, sf_dir):
    """F2-F4 over rows that break every rule."""
    loaded = _all_loaded(spark, sf_dir)
    broken = {d: spark.sql(f"SELECT {planted_columns(d, _SPARK_PICK)} FROM {{rows}}", rows=df) for d, df in loaded.items()}
    return I.violation_table(broken)


_AGAIN = "SELECT * FROM {rows} UNION ALL SELECT * FROM {rows} WHERE substr(hash, 1, 1) = '0' UNION ALL SELECT * FROM {rows} WHERE substr(hash, 1, 2) = '0a'"


def _repeated_oracle() -> str:
    final, raw = loader_sql("recalls")
    key = ", ".join(DATASETS["recalls"].key)
    ctes = raw | {"ld": final, "twice": _AGAIN.replace("{rows}", "ld")}
    return oracle(f"SELECT {key}, count(*) AS duplicate_count FROM twice GROUP BY {key} HAVING count(*) >= 2", ctes, tables=(RAW_EXTRACTS["recalls"][0],))


@register("duplicate_identities_planted", _repeated_oracle())
def duplicate_identities_planted(spark, sf_dir):
    """F1 over recalls of which some come two or three times."""
    return I.duplicate_identities(spark.sql(_AGAIN, rows=loaded(spark, sf_dir, "recalls")), DATASETS["recalls"].key)


def _quarantine_oracle() -> str:
    ctes: dict[str, str] = {}
    parts = []
    for d in DATASETS:
        final, raw = loader_sql(d)
        ctes |= raw
        ctes[f"loaded_{d}"] = final
        parts.append(f"SELECT '{d}' AS dataset, hash, array_to_string(errors, '; ') AS reasons FROM loaded_{d} WHERE len(errors) > 0")
    return oracle("\nUNION ALL\n".join(parts), ctes, tables=tuple(RAW_EXTRACTS[d][0] for d in DATASETS))


@register("quarantined_rows", _quarantine_oracle())
def quarantined_rows(spark, sf_dir):
    """what quarantine sets aside, with the reasons."""
    parts = []
    for d, df in _all_loaded(spark, sf_dir).items():
        _good, bad = apply_policy(df, "quarantine")
        parts.append(bad.select(F.lit(d).alias("dataset"), "hash", F.array_join("errors", "; ").alias("reasons")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _ingest_counts_oracle() -> str:
    ctes: dict[str, str] = {}
    selects = []
    for d in DATASETS:
        final, raw = loader_sql(d)
        ctes.update(raw)
        ctes[f"loaded_{d}"] = final
        raw_name = next(iter(raw))
        selects.append(
            f"SELECT '{d}' AS dataset, (SELECT count(*) FROM {raw_name}) AS raw_rows, "
            f"(SELECT count(*) FROM loaded_{d}) AS loaded_rows, "
            f"(SELECT count(*) FROM loaded_{d} WHERE len(errors) > 0) AS bad_rows"
        )
    tables = tuple(RAW_EXTRACTS[d][0] for d in DATASETS)
    return oracle("\nUNION ALL\n".join(selects), ctes, tables=tables)


@register("ingest_counts", _ingest_counts_oracle())
def ingest_counts(spark, sf_dir):
    """F5 counts: raw rows, loaded rows (after skips) and rows with errors, per dataset, one scan each."""
    cat = Catalog(spark, sf_dir)
    parts = []
    for d in DATASETS:
        ld = load(raw_extract(cat, d), d, hashed=False, mark_skipped=True)
        parts.append(
            ld.agg(
                F.count(F.lit(1)).alias("raw_rows"),
                F.count_if(~F.col("skipped")).alias("loaded_rows"),
                F.count_if(~F.col("skipped") & (F.size("errors") > 0)).alias("bad_rows"),
            ).select(F.lit(d).alias("dataset"), "raw_rows", "loaded_rows", "bad_rows")
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


# F7 keyed upserts ------------------------------------------------------------------------------------
# Fixture: validated rows unique per identity key, split by the first hex digit of their row hash:
# incoming = digits 0-b, stored = digits 4-f (stored with a stale hash and 2020 timestamps), so the
# merge sees inserts (0-3), updates (4-b) and untouched stored rows (c-f).

RUN_TS = "2024-01-01 00:00:00"
OLD_TS = "2020-01-01 00:00:00"


def unique_valid(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Clean rows whose identity key occurs once. Rows are not carried through an aggregate: the few repeated keys are
    found first and their rows left out."""
    ok = df.where(F.size("errors") == 0).drop("errors")
    repeated = set_aside(I.duplicate_identities(ok, keys).select(*[F.col(k).alias(f"r_{k}") for k in keys]), "repeated")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys])
    return ok.join(repeated, same, "left_anti")


def upsert_fixture(spark, sf_dir, dataset: str):
    from vigil.sources.sinks import keyed_merge

    ds = DATASETS[dataset]
    # cleaned once: the key check and both sides of the merge read the stored rows
    rows = unique_valid(set_aside(loaded(spark, sf_dir, dataset)), ds.key)
    digit = F.substring("hash", 1, 1)
    incoming = rows.where(digit < "c")
    stored = rows.where(digit >= "4").withColumns({
        "hash": F.lit("stale"),
        "first_seen_at": F.lit(OLD_TS).cast("timestamp_ntz"),
        "last_seen_at": F.lit(OLD_TS).cast("timestamp_ntz"),
    })
    update = tuple(f.name for f in ds.fields if f.name not in ds.key) + ("hash",)
    return keyed_merge(stored, incoming, ds.key, update, now=F.lit(RUN_TS).cast("timestamp_ntz"))


def _upsert_oracle(dataset: str) -> str:
    ds = DATASETS[dataset]
    final, raw = loader_sql(dataset)
    keys = list(ds.key)
    fields = [f.name for f in ds.fields]
    update = [f.name for f in ds.fields if f.name not in keys] + ["hash"]
    ctes = dict(raw)
    ctes["ld"] = final
    kl = ", ".join(keys)
    # NULL-safe uniqueness: compare groups with IS NOT DISTINCT FROM via a join
    ctes["grp"] = f"SELECT {kl}, count(*) AS n FROM ld WHERE len(errors) = 0 GROUP BY {kl}"
    on = " AND ".join(f"l.{k} IS NOT DISTINCT FROM g.{k}" for k in keys)
    ctes["uq"] = f"SELECT l.* EXCLUDE (errors) FROM ld l JOIN grp g ON {on} WHERE len(l.errors) = 0 AND g.n = 1"
    ctes["inc"] = "SELECT * FROM uq WHERE substr(hash, 1, 1) < 'c'"
    sel_old = ", ".join(c for c in fields if c not in keys)
    ctes["sto"] = (f"SELECT {kl}, {sel_old}, 'stale' AS hash, TIMESTAMP '{OLD_TS}' AS first_seen_at, "
                   f"TIMESTAMP '{OLD_TS}' AS last_seen_at FROM uq WHERE substr(hash, 1, 1) >= '4'")
    on2 = " AND ".join(f"s.{k} IS NOT DISTINCT FROM i.{k}" for k in keys)
    cols = [f"CASE WHEN i.hash IS NOT NULL THEN i.{k} ELSE s.{k} END AS {k}" for k in keys]
    cols += [f"CASE WHEN i.hash IS NOT NULL THEN i.{c} ELSE s.{c} END AS {c}" for c in update]
    cols += [f"CASE WHEN i.hash IS NOT NULL AND s.first_seen_at IS NULL THEN TIMESTAMP '{RUN_TS}' ELSE s.first_seen_at END AS first_seen_at",
             f"CASE WHEN i.hash IS NOT NULL THEN TIMESTAMP '{RUN_TS}' ELSE s.last_seen_at END AS last_seen_at"]
    return oracle(f"SELECT {', '.join(cols)} FROM sto s FULL OUTER JOIN inc i ON {on2}", ctes,
                  tables=(RAW_EXTRACTS[dataset][0],))


def _register_upsert(dataset: str):
    register(f"upsert_{dataset}", _upsert_oracle(dataset))(lambda spark, sf_dir: upsert_fixture(spark, sf_dir, dataset))


for _d in DATASETS:
    _register_upsert(_d)


# SURVEY's short name for the citations loader (C2): the same query as load_inspections_citations.
register("load_citations", LOADER_ORACLES["load_inspections_citations"])(
    lambda spark, sf_dir: loaded(spark, sf_dir, "inspections_citations")
)
