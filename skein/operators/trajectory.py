"""Ordered operators on messages and events: call and result association, integrity, answers, budgets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.decisions import event_type, training_role
from skein.storage import materialize

MESSAGE = "struct<role: string, content: string, tool_calls: array<struct<id: string, name: string, arguments: string>>, tool_call_id: string>"


_TYPED = "array<struct<role: string, content: string, listed: boolean, valid: boolean, call: string, answers: string, tool_call: string>>"


def parsed(value: Column, is_text: bool) -> Column:
    """A value as a variant, text being read as JSON: null for what is none."""
    return F.try_parse_json(value if is_text else F.to_json(value))


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, ... of a variant."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _text_of(v: Column, path: str) -> Column:
    """A field that is text; null for any other kind."""
    field = F.try_variant_get(v, path, "variant")
    return F.when(_kind(field) == "STRING", F.try_variant_get(v, path, "string"))


def typed_messages(messages: Column) -> Column:
    """A variant as array<struct(role, content, listed, valid, call, answers, tool_call)>, null unless it is a list of objects.

    listed: an assistant's tool_calls hold anything (an empty list, text, number and false hold nothing); valid: that is exactly
    one object with a textual id, which is `call`. answers: the tool_call_id, if it is text. Content that is no text is its JSON.
    """

    def one(m: Column) -> Column:
        role = _text_of(m, "$.role")
        calls = F.try_variant_get(m, "$.tool_calls", "variant")
        holds = F.coalesce(~F.to_json(calls).isin("null", "[]", "{}", '""', "0", "false", "0.0"), F.lit(False))
        first = F.try_element_at(F.when(_kind(calls) == "ARRAY", F.try_variant_get(m, "$.tool_calls", "array<variant>")), F.lit(1))
        single = F.coalesce((_kind(calls) == "ARRAY") & (F.size(F.try_variant_get(m, "$.tool_calls", "array<variant>")) == 1) & (_kind(first) == "OBJECT"), F.lit(False))
        call = F.when(single, _text_of(first, "$.id"))
        content = F.try_variant_get(m, "$.content", "variant")
        shown = F.when(_kind(content) == "STRING", F.try_variant_get(m, "$.content", "string")).otherwise(F.to_json(content))
        listed = F.coalesce(role == "assistant", F.lit(False)) & holds
        own = F.when(listed & single, F.to_json(first)).when(_kind(F.try_variant_get(m, "$.tool_call", "variant")) == "OBJECT", F.to_json(F.try_variant_get(m, "$.tool_call", "variant")))
        return F.struct(role.alias("role"), shown.alias("content"), listed.alias("listed"), call.isNotNull().alias("valid"), call.alias("call"), _text_of(m, "$.tool_call_id").alias("answers"), own.alias("tool_call"))

    items = F.when(_kind(messages) == "ARRAY", F.try_variant_get(messages, "$", "array<variant>"))
    return F.when(F.forall(items, lambda m: F.coalesce(_kind(m) == "OBJECT", F.lit(False))), F.transform(items, one)).cast(_TYPED)


def associate(messages: Column, attempt: Column) -> Column:
    """struct(pending, calls, links, error) of typed messages, folded message by message; the first error stays.

    A message of role tool_call is a call whose id is its place in the attempt; an assistant that lists calls has one valid one.
    A tool_response takes the oldest open call, whatever id it carries. A tool message answers the call that it names, which may have
    been answered before; without a name, or with one that no call before it has, it is an orphan.
    """
    ids = "array<string>"
    start = F.struct(F.array().cast(ids).alias("pending"), F.array().cast(ids).alias("calls"), F.array().cast(ids).alias("links"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("n"))

    def step(s: Column, m: Column) -> Column:
        bad = m.listed & ~m.valid
        new = F.when(m.listed, m.call).when(m.role == "tool_call", F.concat(attempt, F.lit(":source-call:"), s.n.cast("string")))
        answered = F.when(m.role == "tool_response", F.try_element_at(s.pending, F.lit(1))).when(m.role == "tool", m.answers)
        orphan = m.role.isin("tool", "tool_response") & (answered.isNull() | ~F.array_contains(s.calls, answered))
        error = F.when(bad, "INVALID_MESSAGE").when(new.isNotNull() & F.array_contains(s.calls, new), "DUPLICATE_TOOL_CALL").when(orphan, "ORPHAN_TOOL_RESULT")
        some = lambda c: F.array_compact(F.array(c))
        return F.struct(F.concat(F.array_remove(s.pending, F.coalesce(answered, F.lit("\x00"))), some(new)).alias("pending"), F.concat(s.calls, some(new)).alias("calls"), F.concat(s.links, F.array(F.coalesce(answered, new))).alias("links"), F.coalesce(s.error, error).alias("error"), (s.n + 1).alias("n"))

    return F.aggregate(messages, start, step)


def answer(messages: Column) -> Column:
    """The last typed message that is an assistant's without listed calls; a bare tool_call counts as one."""
    return F.try_element_at(F.filter(messages, lambda m: (m.role == "tool_call") | (m.role == "assistant") & ~m.listed), F.lit(-1))


def histories_of(items: DataFrame, column: str = "item") -> DataFrame:
    """records(id, messages, tools, task, status, raw) of JSON texts, for import_histories.

    The id is that of `id`, even if it is null there, else of `uuid`; ids that are no text, and items that are no objects, have
    none. messages and tools stay as they are, text or nested.
    """
    v = F.col("v")
    part = lambda name: F.try_variant_get(v, f"$.{name}", "variant")
    own = F.when(part("id").isNotNull(), _text_of(v, "$.id")).otherwise(_text_of(v, "$.uuid"))
    rows = items.select(F.try_parse_json(F.col(column)).alias("v"), F.col(column).alias("raw")).withColumn("is_object", F.coalesce(_kind(v) == "OBJECT", F.lit(False)))
    text = lambda name: F.when(F.col("is_object"), F.when(_kind(part(name)) == "STRING", F.try_variant_get(v, f"$.{name}", "string")).otherwise(F.to_json(part(name))))
    return rows.select(F.when(F.col("is_object"), own).alias("id"), text("messages").alias("messages"), text("tools").alias("tools"), F.coalesce(text("question"), text("task")).alias("task"), text("status").alias("status"), "raw")


def import_histories(records: DataFrame, snapshot_id: str | None = None) -> DataFrame:
    """records(id or uuid, messages, tools, and task or question, status, raw if there) with record_id, reason (null if good), links, answer, events and messages.

    messages and tools are JSON text or nested columns. Reasons in order: INVALID_MESSAGE for an id that is missing, empty or no text,
    and for messages that are no list of objects; MISSING_TOOL_DEFINITION for tools that are no list or object; what `associate` finds;
    MISSING_ANSWER. A bare call's id has the attempt in it, `snapshot:record:historical`. A table with a column id has its ids there; uuid counts in its absence. JSON objects that repeat a key are not read.
    """
    kind = {f.name: f.dataType.simpleString() for f in records.schema.fields}
    key = "id" if "id" in kind else "uuid"
    own = F.when(F.length(F.col(key)) > 0, F.col(key)) if kind[key] == "string" else F.lit(None).cast("string")
    optional = lambda *names: next((F.col(n) if kind[n] == "string" else F.to_json(n) if kind[n][:5] in ("array", "struc", "map<s") else F.col(n).cast("string") for n in names if n in kind), F.lit(None).cast("string"))
    variant = lambda name: F.col(name) if kind[name] == "variant" else F.try_parse_json(F.col(name).cast("string") if kind[name] in ("string", "void") else F.to_json(name))
    read = records.select(own.alias("record_id"), typed_messages(variant("messages")).alias("m"), variant("tools").alias("tools"), optional("question", "task").alias("task"), optional("status").alias("status"), optional("raw").alias("raw"))
    some = F.coalesce("m", F.array().cast(_TYPED))
    attempt = F.concat(F.lit(f"{snapshot_id}:" if snapshot_id else ""), F.coalesce("record_id", F.lit("")), F.lit(":historical"))
    folded = read.withColumn("a", associate(some, attempt)).withColumn("answer", answer(F.col("m")))
    reason = (
        F.when(F.col("record_id").isNull() | F.col("m").isNull(), "INVALID_MESSAGE")
        .when(~F.coalesce(_kind(F.col("tools")).isin("ARRAY", "OBJECT"), F.lit(False)), "MISSING_TOOL_DEFINITION")
        .when(F.col("a.error").isNotNull(), F.col("a.error"))
        .when(F.col("answer").isNull(), "MISSING_ANSWER")
    )
    events = F.transform("m", lambda m, i: F.struct(i.alias("seq"), event_type(F.coalesce(m.role, F.lit("")), m.listed).alias("event_type"), training_role(m.role).alias("role"), m.content.alias("content"), F.get(F.col("a.links"), i).alias("tool_call_id")))

    def shown(m: Column, i: Column) -> Column:
        bare = m.role == "tool_call"
        call = F.when(bare, F.to_json(F.struct(F.get(F.col("a.links"), i).alias("id"), F.coalesce(m.content, F.lit("")).alias("raw_content")))).otherwise(m.tool_call)
        return F.struct(training_role(m.role).alias("role"), F.when(bare, F.lit("")).otherwise(m.content).alias("content"), call.alias("tool_call"))

    return folded.select("record_id", reason.alias("reason"), F.col("a.links").alias("links"), "answer", events.alias("events"), F.transform("m", shown).alias("messages"), F.to_json("tools").alias("tools"), "task", "status", "raw")


def pair_in_order(calls: DataFrame, results: DataFrame, keys: list[str], order: str, id_col: str) -> DataFrame:
    """(keys, n, call, result): the n-th result answers the n-th call of a key; calls without one stay open."""
    w = Window.partitionBy(*keys).orderBy(order, id_col)
    c = calls.select(*keys, F.row_number().over(w).alias("n"), F.col(id_col).alias("call"))
    r = results.select(*keys, F.row_number().over(w).alias("n"), F.col(id_col).alias("result"))
    return c.join(r, [*keys, "n"], "left")


def places(events: DataFrame, key: str, order: str) -> DataFrame:
    """events with `place`, 1 for a key's first."""
    return events.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(order)))


def sequence_violations(events: DataFrame, key: str, seq: str, arrival: str) -> DataFrame:
    """Events whose number does not lie above that of the one that arrived before: a key without any is strictly increasing."""
    before = F.lag(seq).over(Window.partitionBy(key).orderBy(arrival))
    return events.withColumn("before", before).filter(F.col(seq) <= F.col("before"))


def orphan_links(events: DataFrame) -> DataFrame:
    """Tool results of calls that their attempt does not have."""
    calls = events.filter("event_type = 'TOOL_CALL'").select("attempt_id", "tool_call_id")
    return events.filter("event_type = 'TOOL_RESULT'").join(calls, ["attempt_id", "tool_call_id"], "left_anti")


def edge_violations(events: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges(attempt_id, from_event_id, to_event_id) an end of which is no event of their attempt."""
    ids = events.select("attempt_id", "event_id").distinct()
    ends = edges.withColumn("event_id", F.explode(F.array("from_event_id", "to_event_id")))
    return ends.join(ids, ["attempt_id", "event_id"], "left_anti").select(*edges.columns).distinct()


def within_budget(actions: DataFrame, key: str, order: list[str], limits: dict[str, int], most: int = 10_000) -> DataFrame:
    """actions with `allowed`: whether an action fits into what its key has left of every limit, in order.

    What is refused reserves nothing, so a later and smaller action may be allowed; that is a fold, not a running sum. A null
    cost is 0. Keys of at most `most` rows are folded as arrays; the rows of a longer one pass by once, in order, and the task
    keeps its sums alone.
    """
    names = actions.columns
    spread = actions.toDF(*(f"c{i}" for i in range(len(names))))
    k = f"c{names.index(key)}"
    long = materialize(spread.groupBy(k).agg(F.count("*").alias("n")).filter(F.col("n") > most).select(k), "long-keys")
    if long.isEmpty():
        return _folded(spread, k, names, order, limits).toDF(*names, "allowed")
    same = F.col(k).eqNullSafe(F.col("own"))
    own = long.select(F.col(k).alias("own"))
    short = _folded(spread.join(own, same, "left_anti"), k, names, order, limits)
    return short.union(_streamed(spread.join(own, same, "left_semi"), k, names, order, limits)).toDF(*names, "allowed")


def _folded(spread: DataFrame, k: str, names: list[str], order: list[str], limits: dict[str, int]) -> DataFrame:
    """All columns and `allowed`, by a fold over each key's rows."""
    costs = [f"c{names.index(c)}" for c in limits]
    by = [F.col(f"c{names.index(o)}").alias(f"o{i}") for i, o in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*by, F.struct(*spread.columns).alias("row"))))
    start = F.struct(*(F.lit(0).cast("long").alias(f"u{i}") for i in range(len(costs))), F.array().cast("array<boolean>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        new = [s[f"u{i}"] + F.coalesce(x["row"][c].cast("long"), F.lit(0)) for i, c in enumerate(costs)]
        fits = F.lit(True)
        for n, limit in zip(new, limits.values(), strict=True):
            fits = fits & (n <= limit)
        return F.struct(*(F.when(fits, n).otherwise(s[f"u{i}"]).alias(f"u{i}") for i, n in enumerate(new)), F.concat(s.out, F.array(fits)).alias("out"))

    grouped = spread.groupBy(k).agg(rows.alias("rows")).select("rows", F.aggregate("rows", start, step).out.alias("out"))
    each = grouped.select(F.explode(F.arrays_zip("rows", "out")).alias("x"))
    return each.select(*(F.col(f"x.rows.row.{c}").alias(c) for c in spread.columns), F.col("x.out").alias("allowed"))


def _streamed(spread: DataFrame, k: str, names: list[str], order: list[str], limits: dict[str, int]) -> DataFrame:
    """All columns and `allowed`, a key's rows passing by in order."""
    fields = [(f.name, f.dataType.simpleString()) for f in spread.schema.fields]
    at, places, most = int(k[1:]), [names.index(c) for c in limits], list(limits.values())

    def run(batches):
        last, used = None, [0] * len(most)
        for b in batches:
            keys, rows = b.column(at).to_pylist(), list(zip(*(b.column(i).to_pylist() for i in places), strict=True))
            out = []
            for key, row in zip(keys, rows, strict=True):
                if key != last:
                    last, used = key, [0] * len(most)
                new = [u + (x or 0) for u, x in zip(used, row, strict=True)]
                fits = all(n <= m for n, m in zip(new, most, strict=True))
                if fits:
                    used = new
                out.append(fits)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.bool_())], [*(n for n, _ in fields), "allowed"])

    by = [k, *(f"c{names.index(o)}" for o in order)]
    return spread.repartition(F.col(k)).sortWithinPartitions(*by).mapInArrow(run, ", ".join([*(f"{n} {t}" for n, t in fields), "allowed boolean"]))


def replay_calls(events: DataFrame) -> DataFrame:
    """The tool calls of recorded events, in order: what a replay runs as a new attempt."""
    return events.filter("event_type = 'TOOL_CALL'").select(F.concat(F.lit("replay-"), "attempt_id").alias("replay_attempt_id"), F.col("attempt_id").alias("parent_attempt_id"), "seq", "payload").orderBy("parent_attempt_id", "seq")


def inspect(events: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per attempt: how many events it has, and how it ended."""
    counted = events.groupBy("attempt_id").agg(F.count(F.lit(1)).alias("event_count"))
    return attempts.select("attempt_id", "end_reason").join(counted, "attempt_id", "left").select("attempt_id", F.coalesce("event_count", F.lit(0)).alias("event_count"), "end_reason")
