"""Chat formatting of records in whatever layout they come.

A layout is known by its fingerprint: a hash of the sorted nested field paths of a schema. Each known
fingerprint selects a declarative mapping that turns a record into canonical turns (conversation, turn,
role, text): rows that are turns already, prompt and response, instruction with input and output, and
lists of messages.

Turns are written between control strings; control strings and the escape sign inside texts are
escaped, so the texts can be read back exactly. Conversations are put out in chunks of whole turns, so
a very long one needs no memory of its size.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from tripledger.llm.tables import scratch_path, table

# Fixed values of the template.
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|end|>"
LEARNED_ROLE = "assistant"
CHUNK_CHARS = 1_000_000


def escape(text: str) -> str:
    """The text without control strings: the escape sign doubled, and ``<|`` held apart by one."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    out, at = [], 0
    while (next_at := text.find("\\", at)) >= 0:
        out += [text[at:next_at], text[next_at + 1 : next_at + 2]]
        at = next_at + 2
    return "".join([*out, text[at:]])


def field_paths(kind: DataType, prefix: str = "") -> list[str]:
    """Paths of all nested fields; a list is ``[]`` in a path. Types of plain values don't count."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: Sequence[str]) -> str:
    """The layout's name: a hash of its paths in order, whatever the order of the fields."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


# A mapping: the conversation, and either one turn or a list of turns as (role, text).
Rule = Mapping[str, object]

LAYOUTS: dict[str, tuple[list[str], Rule]] = {
    "turn rows": (["conv_id", "turn", "role", "text"], {"turn": "turn", "role": "role", "text": "text"}),
    "prompt": (["conv_id", "prompt", "response"], {"turns": [("user", "prompt"), ("assistant", "response")]}),
    "instruction": (
        ["conv_id", "instruction", "input", "output"],
        {"turns": [("user", ("instruction", "input")), ("assistant", "output")]},
    ),
    "messages": (
        ["conv_id", "messages[].role", "messages[].content"],
        {"list": "messages", "role": "role", "text": "content"},
    ),
}
MAPPINGS = {fingerprint(paths): mapping for paths, mapping in LAYOUTS.values()}


def _text(source: object) -> Column:
    if isinstance(source, tuple):  # parts that are there, a blank line between them
        return F.concat_ws("\n\n", *[F.when(F.length(part) > 0, F.col(part)) for part in source])
    return F.col(str(source))


def canonical_turns(records: DataFrame, extra: Sequence[str] = (), mappings: Mapping[str, Rule] = MAPPINGS) -> DataFrame:
    """(conv_id, turn, role, text) of records of a known layout; columns named in ``extra`` are ignored."""
    own = records.drop(*extra)
    name = fingerprint(field_paths(own.schema))
    if name not in mappings:
        raise ValueError(f"no mapping for layout {name}: {sorted(field_paths(own.schema))}")
    rule = mappings[name]
    if "turns" in rule:
        turns = F.array(*[F.struct(F.lit(role).alias("role"), _text(source).alias("text")) for role, source in rule["turns"]])
    elif "list" in rule:
        turns = F.transform(rule["list"], lambda m: F.struct(m[rule["role"]].alias("role"), m[rule["text"]].alias("text")))
    else:
        return own.select(
            F.col("conv_id").cast("long"), F.col(rule["turn"]).cast("long").alias("turn"), F.col(rule["role"]).alias("role"), F.col(rule["text"]).alias("text")
        )
    spread = own.select(F.col("conv_id").cast("long"), F.posexplode(turns).alias("turn", "_one"))
    return spread.select("conv_id", F.col("turn").cast("long").alias("turn"), "_one.role", "_one.text")


def by_layout(records: DataFrame, record: str, layouts: Mapping[str, str]) -> DataFrame:
    """Canonical turns of JSON records of mixed layouts in one column; ``layouts`` names each layout's schema as DDL.

    A record belongs to the layout whose fingerprint its own field paths have. Records of no known
    layout give no turns; :func:`unknown_layouts` counts them.
    """
    marked = records.select(record, _json_fingerprint(F.col(record)).alias("_layout"))
    found = None
    for schema in layouts.values():
        kind = StructType.fromDDL(schema)
        own = marked.where(F.col("_layout") == fingerprint(field_paths(kind)))
        part = canonical_turns(own.select(F.from_json(record, kind).alias("_r")).select("_r.*"))
        found = part if found is None else found.unionByName(part)
    return found


def unknown_layouts(records: DataFrame, record: str, layouts: Mapping[str, str]) -> DataFrame:
    known = [fingerprint(field_paths(StructType.fromDDL(schema))) for schema in layouts.values()]
    marked = records.select(_json_fingerprint(F.col(record)).alias("layout"))
    return marked.where(~F.coalesce(F.col("layout").isin(known), F.lit(False))).groupBy("layout").agg(F.count(F.lit(1)).alias("n"))


def _json_fingerprint(record: Column) -> Column:
    def paths(value: object, prefix: str = "") -> Iterator[str]:
        if isinstance(value, dict):
            for key, inner in value.items():
                yield from paths(inner, f"{prefix}.{key}" if prefix else key)
        elif isinstance(value, list):
            for inner in value or [None]:
                yield from paths(inner, f"{prefix}[]")
        else:
            yield prefix

    @F.pandas_udf("string")
    def named(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            try:
                return fingerprint(list(paths(json.loads(text))))
            except (TypeError, ValueError):
                return None

        return texts.map(one)

    return named(record)


def formatted_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where the text learned from begins and ends in it."""
    head = f"{OPEN}{escape(role)}{MIDDLE}"
    body = escape(text)
    learned = role == LEARNED_ROLE
    return f"{head}{body}{CLOSE}", len(head), len(head) + (len(body) if learned else 0)


def write_chats(turns: DataFrame, path: str) -> None:
    """(conv_id, chunk, formatted, loss): chunks of formatted turns and the spans learned from, in order.

    Null roles and texts are empty. Turns of one number go by role, then text; null turns come first.
    A chunk ends after the turn that fills it. An empty table writes no row.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunk, parts, size, spans, out, held = (None, True), 0, [], 0, [], [], 0
        started = False

        def batch_of(rows):
            ids, chunks, texts, loss = zip(*rows, strict=True) if rows else ([], [], [], [])
            kind = pa.list_(pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(chunks, pa.int32()), pa.array(texts, pa.string()), pa.array(loss, kind)],
                ["conv_id", "chunk", "formatted", "loss"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]
            for conv_id, role, text in zip(*columns, strict=True):
                if started and (conv_id != now or size >= CHUNK_CHARS):
                    out.append((now, chunk, "".join(parts), spans))
                    held += size
                    chunk = chunk + 1 if conv_id == now else 0
                    parts, size, spans = [], 0, []
                now, started = conv_id, True
                one, low, high = formatted_turn(role, text)
                if role == LEARNED_ROLE:
                    spans.append([size + low, size + high])
                parts.append(one)
                size += len(one)
                if held >= 8 * CHUNK_CHARS:
                    yield batch_of(out)
                    out, held = [], 0
        if started:
            out.append((now, chunk, "".join(parts), spans))
        yield batch_of(out)

    filled = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    ordered = filled.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, chunk int, formatted string, loss array<array<long>>"
    ordered.mapInArrow(write, schema).write.parquet(path)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted chunk."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at character {at}")
        middle = formatted.index(MIDDLE, at)
        end = formatted.index(CLOSE, middle)
        yield unescape(formatted[at + len(OPEN) : middle]), unescape(formatted[middle + len(MIDDLE) : end])
        at = end + len(CLOSE)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    """Per conversation, from the written text alone: turns and their digest, learned text and its digest, size."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        state: list | None = None

        def closed() -> None:
            if state:
                rows.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")]
            for conv_id, formatted, loss in zip(*columns, strict=True):
                if state is None or state[0] != conv_id:
                    closed()
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_turns(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for low, high in loss or []:
                    learned = unescape(formatted[low:high])
                    state[3] += len(learned)
                    state[4].update(learned.encode("utf-8", "surrogatepass"))
                state[5] += len(formatted)
        closed()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    chunks = spark.read.parquet(path)
    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return ordered.mapInArrow(read, schema)


ORACLE = {
    "op5_chat_formatting": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), s AS (
            SELECT *, role || text AS said, {len(OPEN + MIDDLE + CLOSE)} + length(role || text)
                   + 2 * length(role) - length(replace(role, '\', '')) - length(replace(role, '<|', '<'))
                   + 2 * length(text) - length(replace(text, '\', '')) - length(replace(text, '<|', '<')) AS chars
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               cast(sum(CASE WHEN role = '{LEARNED_ROLE}' THEN length(text) ELSE 0 END) AS bigint) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                               FILTER (role = '{LEARNED_ROLE}'), '')) AS loss_sha256,
               cast(sum(chars) AS bigint) AS formatted_chars
        FROM s GROUP BY conv_id
    """
}


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations (turn rows) and conversation -1 (a prompt record), written and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(said).alias("prompt"), F.lit(said).alias("response"))
    path = scratch_path(spark, "chats")
    write_chats(canonical_turns(rows).unionByName(canonical_turns(probe)), path)
    return read_chats(spark, path)
