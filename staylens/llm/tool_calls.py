"""Tool calls linked to their results, ordered, validated and written as canonical JSON, in DataFrame functions only.

calls: conv_id, call_id, turn, name, arguments (JSON text), needs (array of call_ids that have to come before).
results: call_id, turn, content. schemas: name, parameter, type, required and, if there is such a column, allowed.

Links: results are reduced to the earliest of each identifier, so an identifier that many rows hold is combined on the map
side, and calls meet them in a shuffled hash join whose built side has one row per identifier; calls that share an identifier
are dealt to several tasks. Order: ``level`` is 0 for a call that needs none and else one more than the highest level it
needs; calls of a conversation sorted by (level, turn, call_id) are in topological order. Chains of single needs are followed
by pointer jumping, calls with several needs are resolved in rounds (Kahn); every round ends in a table in the shared folder
and nothing is grouped by conversation, so a conversation may hold any share of the rows. Calls in or behind a cycle, or
behind an unknown call, have a null level.

Validation names each missing, mistyped, not allowed and unknown argument. A parameter is a name or a path into objects
(``filter.lang``), which is missing only where its object is there. Types: string, integer, number, boolean, object, array,
and array<one of these>. ``allowed`` is an array of canonical JSON texts, or null. Unknown are names of the outermost object.

Canonical JSON has sorted keys, no white space, and one form for each number, whatever its notation, made from its digits
without rounding: 1E2, 100.0 and 100 are 100; up to 21 digits before the point and 6 zeros behind it are written out, beyond
that there is one digit before the point and an exponent (1e+400). Numbers of over 1 000 digits are malformed.

Nulls: a call with a null or repeated call_id is kept; a null identifier links to nothing and has no level, repeated calls all get the result.
Null or malformed arguments give the error ``json``; unknown tools the error ``tool``. Results without a call are in
orphans(). Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.skew import spread_join
from staylens.llm.storage import written

#: A string, a number, or anything else of a JSON text; possessive, so no text is too long for it.
TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|-?\d++(?:\.\d++)?+(?:[eE][+-]?\d++)?+|[^"\d-]++'
#: Digits before the point, and zeros behind it, that canonical numbers write out.
MOST_DIGITS, MOST_ZEROS = 21, 6


def chain_heads(known: DataFrame) -> DataFrame:
    """(call_id, head, steps): where the chain of single needs of each call ends, at a call with no need or several, and
    how many steps that is. Each round doubles the steps (pointer jumping), so a chain of n calls takes log n rounds.
    Calls whose chain ends nowhere (unknown calls, cycles) are left out."""
    many = F.size("needs") != 1
    state = written(
        known.select(
            "call_id",
            F.when(many, F.col("call_id")).otherwise(F.col("needs")[0]).alias("head"),
            F.when(many, 0).otherwise(1).cast("long").alias("steps"),
            many.alias("done"),
        ),
        "heads",
    )
    rounds = max(1, state.count()).bit_length() + 1
    for _ in range(rounds):
        if not state.filter("NOT done").limit(1).count():
            break
        ahead = state.select(F.col("call_id").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"), F.col("done").alias("ends"))
        moved = spread_join(state.filter("NOT done"), ahead, "head", "call_id").select(
            "call_id", F.col("next").alias("head"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ends").alias("done")
        )
        state = written(state.filter("done").unionByName(moved), "heads")
    return state.filter("done").select("call_id", "head", "steps")


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of every distinct call that can be ordered."""
    known = written(
        calls.filter("call_id IS NOT NULL")
        .select("call_id", F.explode_outer("needs").alias("need"))
        .groupBy("call_id")
        .agg(F.array_sort(F.collect_set("need")).alias("needs")),
        "calls",
    )
    heads = chain_heads(known)
    free = known.filter(F.size("needs") == 0).select(F.col("call_id").alias("head"), F.lit(0).cast("long").alias("level"))
    joints = known.filter(F.size("needs") > 1)
    if joints.limit(1).count():
        free = _joint_levels(joints, heads, free)
    return spread_join(heads, free, "head", "call_id").select("call_id", (F.col("level") + F.col("steps")).alias("level"))


def _joint_levels(joints: DataFrame, heads: DataFrame, free: DataFrame) -> DataFrame:
    """(head, level) of free calls and of those with several needs, in rounds over the graph of the latter alone."""
    wanted = joints.select(F.col("call_id").alias("head"), F.size("needs").alias("wanted"))
    ends = heads.select(F.col("call_id").alias("need"), F.col("head").alias("at"), "steps")
    needs = joints.select(F.col("call_id").alias("head"), F.explode("needs").alias("need"))
    edges = written(spread_join(needs, ends, "need", "head").select("head", "need", "at", "steps"), "needs")
    done = written(free, "level")
    while True:
        ready = (
            spread_join(edges, done.select(F.col("head").alias("at"), "level"), "at", "head")
            .groupBy("head")
            .agg(F.count(F.lit(1)).alias("met"), F.max(F.col("level") + F.col("steps")).alias("highest"))
        )
        new = written(
            ready.join(wanted, "head").filter("met = wanted").join(done, "head", "left_anti").select("head", (F.col("highest") + 1).alias("level")), "level"
        )
        if not new.limit(1).count():
            return done
        done = written(done.unionByName(new), "level")


def schema_arrays(schemas: DataFrame) -> DataFrame:
    """(name, parameters): one row for each tool."""
    allowed = F.col("allowed") if "allowed" in schemas.columns else F.lit(None)
    one = F.struct("parameter", F.split("parameter", r"\.").alias("path"), "type", F.col("required").alias("must"), allowed.cast("array<string>").alias("allowed"))
    return schemas.filter("name IS NOT NULL").groupBy("name").agg(F.array_sort(F.collect_list(one)).alias("parameters"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value bound as a lambda variable, so it is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def _fits(wanted: Column, found: Column) -> Column:
    whole = (found == "BIGINT") | found.rlike(r"^DECIMAL\(\d+,0\)$")
    return (
        F.when(wanted == "string", found == "STRING")
        .when(wanted == "integer", whole)
        .when(wanted == "number", whole | (found == "DOUBLE") | found.startswith("DECIMAL"))
        .when(wanted == "boolean", found == "BOOLEAN")
        .when(wanted == "object", found.startswith("OBJECT"))
        .when(wanted == "array", found.startswith("ARRAY"))
        .otherwise(F.lit(False))
    )


def _type_ok(wanted: Column, found: Column) -> Column:
    item = lambda x, name: F.regexp_extract(x, rf"^{name}<(.*)>$", 1)
    items = (item(found, "ARRAY") == "VOID") | _fits(item(wanted, "array"), item(found, "ARRAY"))
    return F.when(wanted.startswith("array<"), found.startswith("ARRAY<") & items).otherwise(_fits(wanted, found))


def _inside(value: Column, path: Column) -> Column:
    """The variant at a path of names inside a variant, or null."""
    return F.aggregate(path, value, lambda at, name: F.try_element_at(F.from_json(F.to_json(at), "map<string,variant>"), name))


def argument_errors(arguments: Column, parameters: Column) -> Column:
    """Sorted names of what is wrong with canonical arguments: missing:p, type:p, value:p, unknown:p; ``json`` or ``tool`` alone."""
    fields = F.from_json(arguments, "map<string,variant>")

    def of_parameter(p: Column, fields: Column) -> Column:
        depth = F.size(p["path"])
        first = F.try_element_at(fields, p["path"][0])
        value = F.when(depth == 1, first).otherwise(_inside(first, F.slice(p["path"], 2, F.greatest(depth - 1, F.lit(0)))))
        parent = (depth == 1) | _inside(first, F.slice(p["path"], 2, F.greatest(depth - 2, F.lit(0)))).isNotNull()
        wrong = lambda kind: F.concat(F.lit(f"{kind}:"), p["parameter"])
        judged = lambda v: (
            F.when(v.isNull(), F.when(p["must"] & parent, wrong("missing")))
            .when(~_type_ok(p["type"], F.schema_of_variant(v)), wrong("type"))
            .when(p["allowed"].isNotNull() & ~F.array_contains(p["allowed"], F.to_json(v)), wrong("value"))
        )
        return _let(value, judged)

    def of_fields(fields: Column) -> Column:
        unknown = F.transform(F.array_except(F.map_keys(fields), F.transform(parameters, lambda p: p["path"][0])), lambda k: F.concat(F.lit("unknown:"), k))
        return F.array_sort(F.filter(F.concat(F.transform(parameters, lambda p: of_parameter(p, fields)), unknown), lambda e: e.isNotNull()))

    return (
        F.when(arguments.isNull() | ~arguments.startswith("{"), F.array(F.lit("json")))
        .when(parameters.isNull(), F.array(F.lit("tool")))
        .otherwise(_let(fields, of_fields))
    )


def canonical_number(number: Column) -> Column:
    """The one form of all notations of a JSON number's value."""

    def cut(t: Column) -> Column:
        whole, rest = F.regexp_extract(t, r"^-?(\d+)", 1), F.regexp_extract(t, r"\.(\d+)", 1)
        power = F.coalesce(F.nullif(F.regexp_extract(t, r"[eE]\+?(-?\d+)$", 1), F.lit("")), F.lit("0")).try_cast("long")
        digits = F.concat(whole, rest)
        return F.struct(t.alias("t"), digits.alias("digits"), F.regexp_replace(digits, "^0+", "").alias("left"), (F.length(whole) + power).alias("point"))

    def placed(c: Column) -> Column:
        point = c["point"] - (F.length(c["digits"]) - F.length(c["left"]))
        return F.struct(c["t"].alias("t"), F.regexp_replace(c["left"], "0+$", "").alias("d"), point.alias("point"))

    def written_out(c: Column) -> Column:
        d, n, point = c["d"], F.length(c["d"]), c["point"]
        zeros = lambda k: F.repeat(F.lit("0"), k.cast("int"))
        behind = F.substring(d, F.lit(2), n)
        small = F.concat(F.lit("0."), zeros(-point), d)
        plain = F.when(n <= point, F.concat(d, zeros(point - n))).otherwise(F.concat(F.substring(d, F.lit(1), point.cast("int")), F.lit("."), F.substring(d, (point + 1).cast("int"), n)))
        power = F.concat(F.lit("e"), F.when(point > 0, "+").otherwise(""), (point - 1).cast("string"))
        long = F.concat(F.substring(d, F.lit(1), F.lit(1)), F.when(n > 1, F.concat(F.lit("."), behind)).otherwise(""), power)
        value = F.when((point > 0) & (point <= MOST_DIGITS), plain).when((point > -MOST_ZEROS) & (point <= 0), small).otherwise(long)
        return F.when(d == "", F.lit("0")).otherwise(F.coalesce(F.concat(F.when(c["t"].startswith("-"), "-").otherwise(""), value), c["t"]))

    return _let(_let(_let(number, cut), placed), written_out)


def canonical(arguments: Column) -> Column:
    """Canonical text of a JSON text, null if it is malformed.

    Numbers stand as the place of their token while a variant sorts the keys, and come back in their canonical form, so no
    number is rounded and no string can be taken for one.
    """
    is_number = lambda t: t.rlike(r"^[-\d]")
    split = lambda text: F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    placed = lambda tokens: F.array_join(F.transform(tokens, lambda t, i: F.when(is_number(t), i.cast("string")).otherwise(t)), "")
    values = lambda tokens: F.size(F.filter(tokens, lambda t: t.rlike(r'^[-\d"]')))
    signs = lambda tokens: F.length(F.translate(F.array_join(F.filter(tokens, lambda t: ~t.rlike(r'^[-\d"]')), ""), " \t\r\n", ""))

    def back(x: Column) -> Column:
        """The numbers put back, where the parser has taken all of the text."""
        whole = (values(x["own"]) == values(x["ordered"])) & (signs(x["own"]) == signs(x["ordered"]))
        restored = F.transform(x["ordered"], lambda t: F.when(is_number(t), canonical_number(F.get(x["own"], t.cast("int")))).otherwise(t))
        return F.when(whole, F.array_join(restored, ""))

    ordered = lambda own: F.struct(own.alias("own"), split(F.to_json(F.try_parse_json(placed(own)))).alias("ordered"))
    return F.when(F.try_parse_json(arguments).isNotNull(), _let(_let(split(arguments), ordered), back))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per row of calls: conv_id, call_id, name, turn, level, result_turn, n_results, errors, canonical."""
    first = (
        results.filter("call_id IS NOT NULL")
        .groupBy("call_id")
        .agg(F.min(F.struct("turn", "content")).alias("first"), F.count(F.lit(1)).alias("n_results"))
    )
    known = levels(calls).join(first, "call_id", "full")
    own = calls.select("conv_id", "call_id", "turn", "name", canonical(F.col("arguments")).alias("arguments"))
    # Identifiers that are null match nothing, so they are not shuffled to meet anything.
    joined = spread_join(own.filter("call_id IS NOT NULL"), known, "call_id", "turn", "left", hashed=True).unionByName(
        own.filter("call_id IS NULL"), allowMissingColumns=True
    )
    joined = spread_join(joined, schema_arrays(schemas), "name", "turn", "left", hashed=True)
    text = lambda c: F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"})
    quoted = lambda c: _let(text(c), lambda t: F.substring(t, F.lit(6), F.length(t) - 6))  # noqa: E731  of {"x":...} what is behind the colon
    whole = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")),
        F.lit(',"result":'), quoted(F.col("first.content")), F.lit("}"),
    )
    return joined.select(
        "conv_id",
        "call_id",
        "name",
        F.col("turn").cast("long").alias("turn"),
        "level",
        F.col("first.turn").cast("long").alias("result_turn"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.array_join(argument_errors(F.col("arguments"), F.col("parameters")), ",").alias("errors"),
        whole.alias("canonical"),
    )


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose identifier no call has."""
    return results.join(calls.select("call_id").distinct(), "call_id", "left_anti")


#: Schemas of the three tools that the conversations are read as calls of.
TOOLS = (
    ("search", "query", "string", True),
    ("search", "limit", "integer", False),
    ("lookup", "key", "integer", True),
    ("lookup", "query", "string", True),
    ("summarise", "query", "string", True),
    ("summarise", "style", "string", True),
)


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The table read as calls and results: a user's turn calls a tool that its length picks, the assistant's turn right
    after it is the result, and a call needs the one two turns before where there is one; the last call of a conversation
    needs the first one too."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    ident = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    users = rows.filter("role = 'user'")
    pick = F.length("text") % 3
    calls = users.select(
        "conv_id",
        ident(F.col("turn")).alias("call_id"),
        "turn",
        F.when(pick == 0, "search").when(pick == 1, "lookup").otherwise("summarise").alias("name"),
        F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("limit"), F.when(F.col("turn") % 4 != 0, F.length("text")).alias("key"))).alias("arguments"),
        ident(F.col("turn") - 2).alias("back"),
    )
    earlier = users.select(ident(F.col("turn")).alias("back"), F.lit(True).alias("there")).distinct()
    ends = users.groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last")).filter("first < last")
    ends = ends.select(ident(F.col("last")).alias("call_id"), ident(F.col("first")).alias("start")).dropDuplicates(["call_id"])
    calls = calls.join(earlier, "back", "left").join(ends, "call_id", "left")
    needs = F.array_distinct(F.array_compact(F.array(F.when(F.col("there"), F.col("back")), F.col("start"))))
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments", needs.alias("needs"))
    results = rows.filter("role = 'assistant'").select(ident(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def op1_tool_calls(spark, sf_dir: str) -> DataFrame:
    """Every conversation's calls with their results."""
    calls, results = conversation_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    rows = ", ".join(f"('{n}', '{p}', '{t}', {str(must).lower()})" for n, p, t, must in TOOLS)
    return linked(calls, results, spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, parameter, type, required)"))


ORACLE = """
WITH RECURSIVE r AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, turn, text, conv_id || '-' || turn AS call_id, length(text) % 3 AS pick FROM r WHERE role = 'user'),
e AS (SELECT conv_id, min(turn) AS first, max(turn) AS last FROM c GROUP BY conv_id),
lv AS (SELECT conv_id, turn, CASE WHEN turn = last AND first < last THEN 1 ELSE 0 END AS level FROM c JOIN e USING (conv_id) WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.conv_id = c.conv_id AND b.turn = c.turn - 2)
  UNION ALL SELECT c.conv_id, c.turn, lv.level + 1 FROM lv JOIN c ON c.conv_id = lv.conv_id AND c.turn = lv.turn + 2),
a AS (SELECT conv_id, turn AS result_turn, text AS content FROM r WHERE role = 'assistant')
SELECT c.conv_id, c.call_id, CASE pick WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'summarise' END AS name, c.turn, lv.level,
  a.result_turn, (a.result_turn IS NOT NULL)::BIGINT AS n_results,
  CASE pick WHEN 0 THEN CASE WHEN c.turn % 4 <> 0 THEN 'unknown:key' ELSE '' END
    WHEN 1 THEN CASE WHEN c.turn % 4 <> 0 THEN 'unknown:limit' ELSE 'missing:key,unknown:limit' END
    ELSE CASE WHEN c.turn % 4 <> 0 THEN 'missing:style,unknown:key,unknown:limit' ELSE 'missing:style,unknown:limit' END END AS errors,
  '{"arguments":{' || CASE WHEN c.turn % 4 <> 0 THEN '"key":' || length(text) || ',' ELSE '' END || '"limit":' || c.turn || ',"query":' || to_json(text)
    || '},"id":"' || c.call_id || '","name":"' || CASE pick WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'summarise' END
    || '","result":' || coalesce(to_json(a.content)::VARCHAR, 'null') || '}' AS canonical
FROM c LEFT JOIN lv ON lv.conv_id = c.conv_id AND lv.turn = c.turn LEFT JOIN a ON a.conv_id = c.conv_id AND a.result_turn = c.turn + 1
"""
