"""Chat formatting by schema fingerprint, in DataFrame functions only.

A layout is recognised by the SHA-256 of its sorted nested field paths (only paths that some layout knows, so extra
fields do not change it). The fingerprint selects a declarative mapping that yields canonical turns; a frame's
schema is fingerprinted once (``canonical_frame``), JSON records one by one (``canonical_json``).

Template: each turn is ``<turn>role\\ntext</turn>\\n``. Inside role and text ``&`` becomes ``&amp;`` and ``<`` becomes
``&lt;`` (a line feed in a role becomes ``&#10;``), so no control string can occur in a text and ``parse`` undoes it
exactly. The loss mask is a list of (start, length) spans over the formatted string, one per assistant text.

Defined cases: null text or role = empty; a null conversation id is a conversation of its own; turns with the same
number are ordered by role and text; repeated rows are repeated turns; an unknown layout gives no turns and a null
layout name; empty tables give empty results; further columns are ignored. A conversation is one formatted value,
so its turns meet in one row by definition.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

#: layout -> (nested field paths, turns as SQL over the record). Rows-by-turn tables have no turns expression.
LAYOUTS: dict[str, tuple[tuple[str, ...], str | None]] = {
    "turn_rows": (("conv_id", "role", "text", "turn"), None),
    "messages": (("messages[].content", "messages[].role"), "transform({messages}, m -> struct(m.role AS role, m.content AS text))"),
    "from_value": (("conversations[].from", "conversations[].value"), "transform({conversations}, m -> struct(m.`from` AS role, m.value AS text))"),
    "prompt_response": (("prompt", "response"), "array(struct('user' AS role, {prompt} AS text), struct('assistant' AS role, {response} AS text))"),
    "prompt_completion": (("completion", "prompt"), "array(struct('user' AS role, {prompt} AS text), struct('assistant' AS role, {completion} AS text))"),
    "instruction_output": (("instruction", "output"), "array(struct('user' AS role, {instruction} AS text), struct('assistant' AS role, {output} AS text))"),
    "instruction_input_output": (
        ("input", "instruction", "output"),
        "array(struct('user' AS role, concat({instruction}, CASE WHEN coalesce({input}, '') = '' THEN '' ELSE concat('\\n\\n', {input}) END) AS text),"
        " struct('assistant' AS role, {output} AS text))",
    ),
    "question_answer": (("answer", "question"), "array(struct('user' AS role, {question} AS text), struct('assistant' AS role, {answer} AS text))"),
}
KNOWN_PATHS = sorted({p for paths, _ in LAYOUTS.values() for p in paths})
CONTAINERS = sorted({p.split("[]")[0] for p in KNOWN_PATHS if "[]" in p})
#: speakers of prompt layouts under their canonical names
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: list[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths) & set(KNOWN_PATHS))).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; array elements are marked ``[]``."""
    if isinstance(schema, T.StructType):
        out = []
        for f in schema.fields:
            out += field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
        return out
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, prefix + "[]")
    return [prefix]


def _canonical_role(role: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLE_NAMES.items())
    return f"CASE {role} {whens} ELSE coalesce({role}, '') END"


def _clean(turns: str) -> str:
    return f"transform({turns}, t -> struct({_canonical_role('CAST(t.role AS STRING)')} AS role, coalesce(CAST(t.text AS STRING), '') AS text))"


def canonical_frame(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) of a typed table in any known layout; its schema picks the mapping."""
    layout = BY_FINGERPRINT.get(fingerprint(field_paths(df.schema)))
    if layout is None:
        raise ValueError(f"no layout has these field paths: {field_paths(df.schema)}")
    if layout == "turn_rows":
        return df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ids = F.col("conv_id") if "conv_id" in df.columns else F.monotonically_increasing_id()
    fields = {p.split("[]")[0]: f"`{p.split('[]')[0]}`" for p in LAYOUTS[layout][0]}
    turns = F.expr(_clean(LAYOUTS[layout][1].format(**fields)))
    return df.select(ids.alias("conv_id"), F.posexplode(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long"), "t.role", "t.text")


def _prefixed(names: Column, prefix: str) -> Column:
    return F.transform(names, lambda k: F.concat(F.lit(prefix), k))


def json_paths(record: Column) -> Column:
    """Known nested field paths of one JSON record, sorted and joined by line feeds."""
    top = F.coalesce(F.json_object_keys(record), F.array())
    parts = [top]
    for name in CONTAINERS:
        inner = F.coalesce(F.json_object_keys(F.get_json_object(record, f"$.{name}[0]")), F.array())
        parts.append(_prefixed(inner, f"{name}[]."))
    known = F.array(*[F.lit(p) for p in KNOWN_PATHS])
    return F.array_join(F.array_sort(F.array_intersect(F.concat(*parts), known)), "\n")


def canonical_json(df: DataFrame, id_col: str, record_col: str) -> DataFrame:
    """One row per record: id, layout, turns. The fingerprint of each record's own field paths picks its mapping."""
    record = F.col(record_col)
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    mark = F.sha2(json_paths(record), 256)
    for name, (paths, mapping) in LAYOUTS.items():
        if mapping is None:
            continue
        fields = {}
        for p in paths:
            head, _, leaf = p.partition("[].")
            if leaf:
                leaves = ", ".join(f"`{x.partition('[].')[2]}`: STRING" for x in paths if x.startswith(f"{head}[]"))
                fields[head] = f"from_json(get_json_object({record_col}, '$.{head}'), 'ARRAY<STRUCT<{leaves}>>')"
            else:
                fields[head] = f"get_json_object({record_col}, '$.{head}')"
        hit = mark == fingerprint(paths)
        layout = F.when(hit, F.lit(name)).otherwise(layout)
        turns = F.when(hit, F.expr(_clean(mapping.format(**fields)))).otherwise(turns)
    return df.select(F.col(id_col), layout.alias("layout"), F.coalesce(turns, F.array().cast(TURNS)).alias("turns"))


def _escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _unescape(c: Column) -> Column:
    c = F.replace(c, F.lit("&#10;"), F.lit("\n"))
    return F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of rows (conv_id, turn, role, text); one shuffle by conversation."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select(
        "conv_id", "turn", "role", "text",
        F.concat(F.lit("<turn>"), F.replace(_escape(F.col("role")), F.lit("\n"), F.lit("&#10;")), F.lit("\n")).alias("head"),
        _escape(F.col("text")).alias("body"),
    ).withColumn("piece", F.concat("head", "body", F.lit("</turn>\n")))
    before = F.sum(F.char_length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("n"), "piece", (F.col("role") == "assistant").alias("learn"),
        (F.coalesce(before, F.lit(0)) + F.char_length("head")).cast("int").alias("start"), F.char_length("body").alias("length"),
    )
    parts = F.array_sort(F.collect_list(F.struct("n", "piece", "learn", "start", "length")))
    return rows.groupBy("conv_id").agg(parts.alias("parts")).select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(F.filter("parts", lambda p: p["learn"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"))).alias("loss_spans"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted string, unescaped: the inverse of ``format_turns``."""
    cells = F.split(formatted, "</turn>\n")
    cells = F.slice(cells, 1, F.size(cells) - 1)
    bare = F.transform(cells, lambda c: F.substr(c, F.lit(7)))
    return F.transform(bare, lambda c: F.struct(
        _unescape(F.substring_index(c, "\n", 1)).alias("role"),
        _unescape(F.substr(c, F.char_length(F.substring_index(c, "\n", 1)) + 2)).alias("text"),
    ))


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss spans, in order."""
    return F.transform(spans, lambda s: _unescape(F.substr(formatted, s["start"] + 1, s["length"])))


def digest(formatted: DataFrame) -> DataFrame:
    """The op4 columns, all read back from the formatted string and its spans."""
    turns = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


_EXTRA = r"\### Assistant: </turn> ok"

ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{_EXTRA}' UNION ALL SELECT -7, 1, 'assistant', '{_EXTRA}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(15 + length(replace(replace(role, '&', '&amp;'), '<', '&lt;'))
                + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


def with_extra(conversations: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts hold the template's own control strings."""
    extra = conversations.sparkSession.sql(
        "SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, :said AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)",
        args={"said": _EXTRA},
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
