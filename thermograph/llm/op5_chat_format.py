"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record may hold a conversation in any of the layouts of ``LAYOUTS``.  The
nested paths of ``FIELDS`` that a record fills, sorted and hashed, are its
fingerprint; each layout declares the fingerprints it answers to (its paths,
with and without the optional ones) and how its fields become turns.  So
records of different layouts may lie in one table, typed or as JSON text.

Template: ``<s>[role] text </s>`` for each turn.  Inside roles and texts a
backslash is written ``\\s``, ``<`` as ``\\l``, ``[`` as ``\\b`` and ``]`` as
``\\e``: no control string of any kind can appear there, and reading back undoes
it.  The loss mask is a list of (start, length) in code points, one for each
assistant text.

Nulls: a null text or role is empty; a record that fills no known layout has
layout ``unknown`` and no turns (formatted: empty).  Records keep their order
of turns; in a table with one row per turn, rows are ordered by turn, role and
text (nulls first), repeated ones kept, and rows with a null conversation id
are one conversation.  Columns beyond ``FIELDS`` don't matter.  An empty table
gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role: string, text: string>>"
# Known fields: name -> type, and the nested names inside arrays.
FIELDS = {
    "messages": ("array<struct<role: string, content: string>>", ("role", "content")),
    "conversations": ("array<struct<`from`: string, value: string>>", ("from", "value")),
    "turns": (TURNS, ("role", "text")),
    **{name: ("string", ()) for name in (
        "system", "prompt", "response", "completion", "instruction", "input", "output",
        "question", "answer")},
}
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def _role(role: Column) -> Column:
    out = F.coalesce(role, F.lit(""))
    for theirs, ours in ROLES.items():
        out = F.when(role == theirs, ours).otherwise(out)
    return out


def _turn(role, text: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _listed(array: Column, role: str, text: str) -> Column:
    return F.transform(array, lambda x: _turn(_role(x[role]), x[text]))


def _as_is(array: Column) -> Column:
    return F.transform(array, lambda x: _turn(F.coalesce(x["role"], F.lit("")), x["text"]))


def _exchange(*ask: str, reply: str):
    """System, then the question's fields in one user turn, then the answer."""
    def turns(r: Column) -> Column:
        asked = F.concat_ws("\n\n", *[F.when(r[a] != "", r[a]) for a in ask])
        first = F.when(r["system"].isNotNull(), F.array(_turn("system", r["system"]))).otherwise(
            F.array().cast(TURNS))
        return F.concat(first, F.array(_turn("user", asked), _turn("assistant", r[reply])))
    return turns


# name: (paths, optional paths, turns of a record)
LAYOUTS = {
    "messages": (("messages[].role", "messages[].content"), (),
                 lambda r: _listed(r["messages"], "role", "content")),
    "sharegpt": (("conversations[].from", "conversations[].value"), (),
                 lambda r: _listed(r["conversations"], "from", "value")),
    "turns": (("turns[].role", "turns[].text"), (), lambda r: _as_is(r["turns"])),
    "prompt_response": (("prompt", "response"), ("system",), _exchange("prompt", reply="response")),
    "prompt_completion": (("prompt", "completion"), ("system",),
                          _exchange("prompt", reply="completion")),
    "instruction": (("instruction", "output"), ("input", "system"),
                    _exchange("instruction", "input", reply="output")),
    "question_answer": (("question", "answer"), ("system",), _exchange("question", reply="answer")),
}


def _path_list(paths) -> str:
    return ",".join(sorted(paths))


def record_type() -> str:
    return "struct<" + ", ".join(f"{n}: {t}" for n, (t, _) in FIELDS.items()) + ">"


def _has(name: str):
    return lambda x: x[name].isNotNull()


def _strings(names):
    return lambda x: F.struct(*[x[n].cast("string").alias(n) for n in names])


def fingerprint(r: Column) -> Column:
    """Hash of the sorted nested paths that the record ``r`` fills."""
    filled = []
    for name, (_, inner) in FIELDS.items():
        if not inner:
            filled.append(F.when(r[name].isNotNull(), name))
        for k in inner:
            filled.append(F.when(F.exists(r[name], _has(k)), f"{name}[].{k}"))
    return F.xxhash64(F.array_join(F.array_sort(F.array_compact(F.array(*filled))), ","))


def canonical(df: DataFrame, record: str) -> DataFrame:
    """``df`` (with a struct column ``record`` of ``record_type()``) and the
    columns fingerprint, layout and turns (array of role, text)."""
    df = df.withColumn("fingerprint", fingerprint(F.col(record)))
    layout, turns = F.lit("unknown"), F.array().cast(TURNS)
    for name, (paths, optional, make) in LAYOUTS.items():
        prints = [F.xxhash64(F.lit(_path_list([*paths, *extra])))
                  for k in range(len(optional) + 1) for extra in combinations(optional, k)]
        hit = F.col("fingerprint").isin(*prints)
        layout = F.when(hit, name).otherwise(layout)
        turns = F.when(hit, make(F.col(record)).cast(TURNS)).otherwise(turns)
    return df.withColumns({"layout": layout, "turns": turns})


def records(df: DataFrame, json_col: str | None = None) -> DataFrame:
    """``df`` with a column ``record``: from its own columns of known names and
    types (others are null), or from JSON text in ``json_col``."""
    if json_col:
        return df.withColumn("record", F.from_json(json_col, record_type()))
    own = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for name, (kind, inner) in FIELDS.items():
        have = own.get(name)
        if inner:
            fits = isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType) \
                and set(inner) <= set(have.elementType.names)
            value = F.transform(F.col(name), _strings(inner)) if fits else F.lit(None)
        else:
            value = F.col(name) if isinstance(have, T.StringType) else F.lit(None)
        fields.append(value.cast(kind).alias(name))
    return df.withColumn("record", F.struct(*fields))


ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("]", "\\e"))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def format_turns(df: DataFrame) -> DataFrame:
    """``df`` (with turns) and the columns formatted and loss_spans (array of
    start, length; code points, from 1)."""
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit("<s>["), escape(t["role"]), F.lit("] ")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    df = df.withColumn("_parts", parts)
    start = F.struct(F.lit(1).alias("at"),
                     F.array().cast("array<struct<start: int, length: int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        head, body = F.length(p["head"]), F.length(p["body"])
        span = F.struct((acc["at"] + head).alias("start"), body.alias("length"))
        return F.struct((acc["at"] + head + body + 5).alias("at"),
                        F.when(p["loss"], F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))
    formatted = F.array_join(F.transform("_parts", lambda p: F.concat(
        p["head"], p["body"], F.lit(" </s>"))), "")
    return df.withColumns({"formatted": formatted, "loss_spans": F.aggregate(
        "_parts", start, step)["spans"]}).drop("_parts")


def read_back(formatted: Column) -> Column:
    """Turns (array of role, text) of a formatted conversation."""
    turn = F.lit(r"<s>\[([^\]<]*)\] ([^<\[]*) </s>")
    roles, texts = (F.regexp_extract_all(formatted, turn, F.lit(k)) for k in (1, 2))
    return F.zip_with(roles, texts, lambda r, t: F.struct(
        unescape(r).alias("role"), unescape(t).alias("text")))


def under_mask(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"], s["length"]))), "")


def gather_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One record per conversation from a table with one row per turn."""
    blank = F.lit("")
    row = F.struct(F.col(turn_col).alias("n"), F.coalesce(role_col, blank).alias("role"),
                   F.coalesce(text_col, blank).alias("text"))
    out = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(
        F.sort_array(F.collect_list(row)).alias("turns"))
    return out.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"], t["text"])))


def op5_chat_format(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted and read back."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    hard = spark.range(1).select(
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role",
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    own = gather_turns(rows.unionByName(hard))
    done = format_turns(canonical(records(own), "record"))
    back = done.select("conv_id", "formatted", read_back(F.col("formatted")).alias("back"),
                       under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    digest = F.array_join(F.transform("back", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("back").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
