"""Chat formatting by tool-call linking, with DataFrame functions only.

Calls and results are matched by identifier in one hash join, put in an order
in which every call follows those it depends on, checked against the schema of
their tool, and written as canonical JSON (sorted keys, no white space).

Explicit calls are ``<tool_call>{"id", "name", "arguments", "depends_on"}</tool_call>``
blocks of assistant messages, explicit results are messages of role ``tool``
with ``{"tool_call_id", "content"}``. A plain exchange is linked the same way: a
user's turn is a call of ``reply``, the next turn, if the assistant's, is its
result, and it depends on the exchange before it. Everything else is a message.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

# Turns ranked in one group: a conversation's order is found in buckets of so many turns.
BUCKET = 256
# Schemas by tool; field -> (type, required). Types: string, integer, number, boolean, array, object.
SCHEMAS = {"reply": {"text": ("string", True), "turn": ("integer", True)}}
# How a variant's type is written.
TYPES = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "boolean": "^BOOLEAN$",
    "array": "^ARRAY", "object": "^OBJECT",
}
PART = "conv_id long, turn long, n int, kind string, id string, name string, arguments string, depends_on array<string>, content string, role string, copies long"


def canonical(json: str) -> str:
    """SQL: canonical form of a JSON text (null if it isn't JSON): a variant keeps its keys sorted."""
    return f"to_json(try_parse_json({json}))"


def quoted(text: str) -> str:
    """SQL: a text as a JSON string, whatever characters it holds; null as ``null``."""
    return f"coalesce(substr(to_json(array({text})), 2, length(to_json(array({text}))) - 2), 'null')"


def parts(messages: DataFrame) -> DataFrame:
    """Calls, results and messages of (conv_id, turn, role, text), with the number of copies of repeated rows."""
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    blocks = F.regexp_extract_all("text", F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), F.lit(1))
    linked = "conv_id is not null and turn is not null"  # else a row has no identifier
    rows = rows.withColumn("blocks", F.when((F.col("role") == "assistant") & F.expr(linked), blocks))
    explicit = rows.where("size(blocks) > 0").select("conv_id", "turn", "role", "copies", F.posexplode("blocks").alias("n", "block"))
    explicit = explicit.selectExpr(
        "conv_id", "turn", "n", "'call' kind", "coalesce(get_json_object(block, '$.id'), concat(conv_id, ':', turn, ':', n)) id",
        "get_json_object(block, '$.name') name", "coalesce(get_json_object(block, '$.arguments'), block) arguments",
        "from_json(get_json_object(block, '$.depends_on'), 'array<string>') depends_on", "cast(null as string) content", "role", "copies",
    )
    plain = rows.where("blocks is null or size(blocks) = 0")
    told = "role = 'tool' and get_json_object(text, '$.tool_call_id') is not null"
    plain = plain.selectExpr(
        "conv_id", "turn", "0 n",
        f"""case when not ({linked}) then 'message' when {told} or role = 'assistant' and turn > 0 then 'result'
            when role = 'user' then 'call' else 'message' end kind""",
        f"""case when {told} then get_json_object(text, '$.tool_call_id')
            when role = 'assistant' then concat(conv_id, ':', turn - 1) else concat(conv_id, ':', turn) end id""",
        "case when role = 'user' then 'reply' end name",
        "case when role = 'user' then to_json(named_struct('text', text, 'turn', turn), map('ignoreNullFields', 'false')) end arguments",
        "case when role = 'user' and turn > 1 then array(concat(conv_id, ':', turn - 2)) end depends_on",
        f"case when {told} then get_json_object(text, '$.content') else text end content", "role", "copies",
    )
    return explicit.unionByName(plain)


def firsts(rows: DataFrame) -> DataFrame:
    """``rows`` with ``first``: whether the row is the earliest of its (conv_id, id).
    The minimum is found by partial aggregation and joined back, one row a key."""
    order = F.struct("turn", "n", F.xxhash64("arguments", "content", "role"))
    low = rows.groupBy("conv_id", "id").agg(F.min(order).alias("low"))
    low = low.select(F.col("conv_id").alias("c"), F.col("id").alias("i"), "low")
    return rows.join(low, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i"))).withColumn("first", order == F.col("low")).drop("c", "i", "low")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level) for conversations in which a call depends on a later
    one: rounds of Kahn's algorithm, null for calls on a cycle. Other
    conversations don't appear: their turns are in order as they stand."""
    ids = calls.where("first").select("conv_id", "id", "turn", "n")
    edges = calls.where("first").select("conv_id", "id", "turn", "n", F.explode("depends_on").alias("on"))
    on = ids.select(F.col("conv_id").alias("c"), F.col("id").alias("on_id"), F.struct("turn", "n").alias("on_at"))
    edges = edges.join(on, (F.col("conv_id") == F.col("c")) & (F.col("on") == F.col("on_id")))
    late = edges.where(F.struct("turn", "n") <= F.col("on_at")).select("conv_id").distinct()
    late = written(late, "late")
    left = ids.select("conv_id", "id").join(late, "conv_id", "left_semi")
    if late.isEmpty():
        return left.withColumn("level", F.lit(None).cast("int"))
    edges = written(edges.select("conv_id", "id", "on").join(late, "conv_id", "left_semi").distinct(), "dependencies")
    left, done, level = written(left, "unordered"), None, 0
    while True:
        waiting = edges.select("conv_id", "id").distinct()
        free = written(left.join(waiting, ["conv_id", "id"], "left_anti").withColumn("level", F.lit(level)), "level")
        if free.isEmpty():
            rest = left.withColumn("level", F.lit(None).cast("int"))
            return rest if done is None else done.unionByName(rest)
        done = free if done is None else done.unionByName(free)
        gone = free.select("conv_id", F.col("id").alias("on"))
        edges = written(edges.join(gone, ["conv_id", "on"], "left_anti"), "dependencies")
        left = written(left.join(free, ["conv_id", "id"], "left_anti"), "unordered")
        level += 1


def checked(schemas: dict[str, dict[str, tuple[str, bool]]]) -> str:
    """SQL: whether the variant ``v`` has what the schema of tool ``name`` asks for; null for unknown tools."""
    cases = []
    for name, fields in schemas.items():
        tests = ["startswith(schema_of_variant(v), 'OBJECT')"]
        for field, (kind, required) in fields.items():
            got = f"schema_of_variant(try_variant_get(v, '$.{field}', 'variant'))"
            fits = f"coalesce({got}, 'VOID') rlike '{TYPES[kind]}'"
            tests.append(fits if required else f"({got} is null or {fits})")
        cases.append(f"when name = '{name}' then coalesce({' and '.join(tests)}, false)")
    return f"case {' '.join(cases)} end"


def link_calls(messages: DataFrame, schemas: dict | None = None) -> DataFrame:
    """One row for each call with its result, and for each message or result left over:
    conv_id, position (from 1, calls after what they depend on), turn, id, status
    (linked, no_result, orphan_result, duplicate, cycle, message), valid (null but for calls of known tools), copies, json.

    Repeated rows are one row with their number in ``copies``. Of several calls
    or results of one identifier the earliest is linked, the others are
    duplicates. A dependency that names no call is kept and orders nothing. Nulls: a null conv_id or turn makes a row a message (it has no
    identifier; null turns come first); a null role stays a message; a null
    text fails validation. Empty text is text. Empty table: no rows. Other
    columns are not read.
    """
    rows = written(parts(messages), "parts")
    calls = firsts(rows.where("kind = 'call'"))
    results = firsts(rows.where("kind = 'result'"))
    calls = written(calls, "calls")
    level = levels(calls).withColumn("ordered", F.lit(True))
    lead = results.where("first").select(
        F.col("conv_id").alias("r_conv"), F.col("id").alias("r_id"), F.col("content").alias("result"), F.col("copies").alias("r_copies"),
        F.col("turn").alias("r_turn"), F.col("role").alias("r_role"), F.lit(True).alias("answered"),
    )
    one = calls.where("first").join(lead, (F.col("conv_id") == F.col("r_conv")) & (F.col("id") == F.col("r_id")), "full")
    one = one.join(level, ["conv_id", "id"], "left")
    argued = one.withColumn("v", F.expr("try_parse_json(arguments)"))
    linked = argued.selectExpr(
        "coalesce(conv_id, r_conv) conv_id", "coalesce(turn, r_turn) turn", "coalesce(n, 0) n", "coalesce(id, r_id) id", "level",
        """case when kind is null then 'orphan_result' when ordered and level is null then 'cycle'
            when answered then 'linked' else 'no_result' end status""",
        f"{checked(schemas or SCHEMAS)} valid", "coalesce(copies, r_copies) copies",
        f"""case when kind is null then to_json(named_struct('content', result, 'role', r_role), map('ignoreNullFields', 'false'))
            else concat('{{"arguments":', coalesce(to_json(v), to_json(named_struct('malformed', arguments), map('ignoreNullFields', 'false'))),
                ',"depends_on":', coalesce(to_json(array_sort(depends_on)), '[]'), ',"id":', {quoted("id")}, ',"name":', {quoted("name")},
                ',"result":', {quoted("result")}, '}}') end json""",
    )
    other = rows.where("kind = 'message'").withColumn("status", F.lit("message"))
    other = other.unionByName(calls.where("not first").unionByName(results.where("not first")).drop("first").withColumn("status", F.lit("duplicate")))
    other = other.selectExpr(
        "conv_id", "turn", "n", "id", "cast(null as int) level", "status", "cast(null as boolean) valid", "copies",
        """to_json(named_struct('arguments', case when status = 'duplicate' then arguments end, 'content', content, 'role', role)) json""",
    )
    everything = written(linked.unionByName(other), "linked")
    return _positions(everything)


def _positions(rows: DataFrame) -> DataFrame:
    """Ranks within each conversation, by level (of calls out of order), turn and place: ranked in
    buckets of turns, so that a long conversation is no one's task, plus the rows of the buckets before."""
    level = F.coalesce("level", F.lit(0))
    bucket = F.coalesce(F.floor(F.col("turn") / BUCKET), F.lit(-1))
    rows = rows.withColumn("l", level).withColumn("bucket", bucket)
    in_bucket = Window.partitionBy("conv_id", "l", "bucket").orderBy("turn", "n", "status", "json")
    before = Window.partitionBy("conv_id").orderBy("l", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "l", "bucket").agg(F.count("*").alias("k")).withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0)))
    counts = counts.select(F.col("conv_id").alias("c"), F.col("l").alias("cl"), F.col("bucket").alias("cb"), "before")
    ranked = rows.withColumn("rank", F.row_number().over(in_bucket))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("l") == F.col("cl")) & (F.col("bucket") == F.col("cb"))
    return ranked.join(counts, same).select(
        "conv_id", (F.col("before") + F.col("rank")).alias("position"), "turn", "id", "status", "valid", "copies", "json"
    )


def op7_toolcalls(spark, sf_dir) -> DataFrame:
    return link_calls(table(spark, sf_dir, "conversations"))
