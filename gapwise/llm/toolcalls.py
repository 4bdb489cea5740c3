"""Tool calls linked to their results, ordered, validated and written as canonical JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.llm.tables import broadcast_if_small, compact, ranked
from gapwise.scratch import materialize

DEPTH = 2  # levels of properties and items below the top that arguments are checked on
# Keywords of JSON schemas that are checked, and those that ask for nothing.
CHECKED = (
    "type",
    "properties",
    "required",
    "additionalProperties",
    "items",
    "enum",
    "minimum",
    "maximum",
    "exclusiveMinimum",
    "exclusiveMaximum",
    "minLength",
    "maxLength",
    "minItems",
    "maxItems",
)
SAID = ("title", "description", "default", "examples", "format", "$schema", "$id", "$comment")
LAST = 2**31 - 1  # level of calls in or behind a circle

_CALL = ("conv_id", "turn", "call_id", "name", "arguments", "after")
# The type names of JSON schemas, and Spark's names for the values they admit.
_TYPES = {
    "string": "STRING",
    "integer": r"BIGINT|DECIMAL\(\d+,0\)",
    "number": r"BIGINT|DECIMAL.*|DOUBLE|FLOAT",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
    "null": "VOID",
}


def _no_texts() -> Column:
    return F.array().cast("array<string>")


def _named(kind: str, keys: Column) -> Column:
    return F.transform(keys, lambda k: F.concat(F.lit(f"{kind}:"), k))


def _keywords(rule: Column) -> Column:
    """A JSON schema's keywords with their values as text; inner objects and lists as JSON text."""
    return F.from_json(rule, "map<string, string>")


def _listed(text: Column) -> Column:
    return F.from_json(text, "array<string>")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is written and computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _broken(value: Column, rule: Column, found: Column) -> Column:
    """The first rule that a value breaks by itself: type, range, length, size or enum; null if
    none. ``rule`` has the keywords, ``found`` is the value's type."""
    names = F.when(rule["type"].startswith("["), _listed(rule["type"])).otherwise(F.array(rule["type"]))

    def admits(name: Column) -> Column:
        right = F.lit(True)
        for known, pattern in _TYPES.items():
            right = F.when(name == known, found.rlike(f"^({pattern})$")).otherwise(right)
        return right

    def within(number: Column, low: str, high: str, open_low: str | None = None, open_high: str | None = None) -> Column:
        inside = F.lit(True)
        for keyword, test in ((low, lambda n: number >= n), (high, lambda n: number <= n)):
            inside = inside & F.coalesce(test(rule[keyword].try_cast("double")), F.lit(True))
        for keyword, test in ((open_low, lambda n: number > n), (open_high, lambda n: number < n)):
            if keyword:
                inside = inside & F.coalesce(test(rule[keyword].try_cast("double")), F.lit(True))
        return inside

    number = F.when(found.rlike(f"^({_TYPES['number']})$"), F.try_variant_get(value, "$", "double"))
    length = F.when(found == "STRING", F.char_length(F.try_variant_get(value, "$", "string")))
    size = F.when(found.startswith("ARRAY"), F.size(F.from_json(F.to_json(value), "array<variant>")))
    listed = rule["enum"].isNull() | F.coalesce(
        F.array_contains(_listed(rule["enum"]), F.try_variant_get(value, "$", "string")), F.lit(False)
    )
    return (
        F.when(rule["type"].isNotNull() & ~F.exists(names, admits), "type")
        .when(~within(number, "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"), "range")
        .when(~within(length, "minLength", "maxLength"), "length")
        .when(~within(size, "minItems", "maxItems"), "size")
        .when(~listed, "enum")
    )


def _in_value(value: Column, rule: Column, path: Column, depth: int) -> Column:
    """What is wrong with a value and with the values in it, named by the path to them."""

    def wrong(rule: Column, found: Column) -> Column:
        own = _let(
            _broken(value, rule, found),
            lambda kind: F.when(kind.isNotNull(), F.array(F.concat_ws(":", kind, path))).otherwise(_no_texts()),
        )
        if not depth:
            return own
        text = F.to_json(value)
        members = F.when(
            found.startswith("OBJECT"),
            _let(
                F.from_json(text, "map<string, variant>"),
                lambda inner: _in_object(inner, rule, F.concat(path, F.lit(".")), depth - 1),
            ),
        )
        items = F.when(
            found.startswith("ARRAY") & rule["items"].startswith("{"),
            F.flatten(
                F.transform(
                    F.from_json(text, "array<variant>"),
                    lambda v, at: _in_value(
                        v, rule["items"], F.concat(path, F.lit("["), at.cast("string"), F.lit("]")), depth - 1
                    ),
                )
            ),
        )
        return F.concat(own, F.coalesce(members, _no_texts()), F.coalesce(items, _no_texts()))

    return _let(_keywords(rule), lambda words: _let(F.schema_of_variant(value), lambda found: wrong(words, found)))


def _in_object(given: Column, rule: Column, prefix: Column, depth: int) -> Column:
    """What is missing from, unexpected in or wrong in the values of an object."""
    required = F.coalesce(_listed(rule["required"]), _no_texts())

    def named(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.concat(F.lit(f"{kind}:"), prefix, k))

    def wrong(properties: Column) -> Column:
        unexpected = F.when(
            rule["additionalProperties"] == "false", F.array_except(F.map_keys(given), F.map_keys(properties))
        ).otherwise(_no_texts())
        entries = F.map_entries(F.map_filter(given, lambda k, _: F.map_contains_key(properties, k)))
        broken = F.transform(
            entries,
            lambda e: _in_value(e["value"], F.element_at(properties, e["key"]), F.concat(prefix, e["key"]), depth),
        )
        missing = named("missing", F.array_except(required, F.map_keys(given)))
        return F.concat(missing, named("unexpected", unexpected), F.flatten(broken))

    return _let(F.coalesce(_keywords(rule["properties"]), F.create_map().cast("map<string, string>")), wrong)


def problems(arguments: Column, rules: Column) -> Column:
    """Sorted reasons why a JSON text breaks a tool's parameters, a JSON schema (null: no such tool).

    Checked are the keywords of ``CHECKED``, at the top and ``DEPTH`` levels below it. Values are
    named by their path, such as ``type:point.x`` or ``range:sizes[2]``.
    """
    no_rules = F.create_map().cast("map<string, string>")

    def found(given: Column) -> Column:
        whole = F.try_parse_json(arguments).isNotNull() & given.isNotNull()
        wrong = _let(F.coalesce(_keywords(rules), no_rules), lambda rule: _in_object(given, rule, F.lit(""), DEPTH))
        return (
            F.when(rules.isNull(), F.array(F.lit("unknown tool")))
            .when(~F.coalesce(whole, F.lit(False)), F.array(F.lit("no object")))
            .otherwise(F.array_sort(wrong))
        )

    return _let(F.from_json(arguments, "map<string, variant>"), found)


def unchecked(rules: Column, depth: int = DEPTH) -> Column:
    """``schema:`` and the keyword for what a schema asks that ``problems`` does not check, with
    ``schema:depth`` for rules that lie deeper than it looks."""

    def asked(rule: Column) -> Column:
        known = F.array(*[F.lit(k) for k in (*CHECKED, *SAID)])
        odd = F.array_compact(
            F.array(
                F.when(rule["additionalProperties"].startswith("{"), "additionalProperties"),
                F.when(rule["items"].startswith("["), "items"),
            )
        )
        own = F.transform(
            F.concat(F.array_except(F.map_keys(rule), known), odd), lambda k: F.concat(F.lit("schema:"), k)
        )
        inner = F.concat(
            F.coalesce(F.map_values(_keywords(rule["properties"])), _no_texts()),
            F.coalesce(F.when(rule["items"].startswith("{"), F.array(rule["items"])), _no_texts()),
        )
        if depth < 0:
            deeper = F.when(F.size(inner) > 0, F.array(F.lit("schema:depth"))).otherwise(_no_texts())
        else:
            deeper = F.flatten(F.transform(inner, lambda r: unchecked(r, depth - 1)))
        return F.coalesce(F.array_distinct(F.concat(own, deeper)), _no_texts())

    return _let(_keywords(rules), asked)


def levels(edges: DataFrame, calls: DataFrame) -> DataFrame:
    """``calls`` (``conv``, ``id``) with ``level``, one more than the highest level of the calls
    that ``edges`` (``conv``, ``id``, ``needs``) name; ``LAST`` in or behind a circle.

    Calls that need one other call form chains.  Pointers along a chain double their reach each
    round, so all calls know after a few rounds how far behind its end they are, however long it is.
    What is left are calls with several needs: those are met round by round, as many rounds as such
    calls lie behind each other.
    """
    needs = edges.groupBy("conv", "id").agg(F.count("*").alias("open"), F.min("needs").alias("needs"))
    marked = calls.join(needs, ["conv", "id"], "left")
    single = F.col("open") == 1
    nodes = materialize(
        marked.select(
            "conv",
            "id",
            F.when(single, F.col("needs")).otherwise(F.col("id")).alias("end"),
            F.when(single, 1).otherwise(0).alias("far"),
            (~F.coalesce(single, F.lit(False))).alias("done"),
            F.coalesce("open", F.lit(0)).alias("open"),
        ),
        "chains",
    )
    rows = nodes.count()
    # In a circle no pointer ever arrives; after so many rounds all others have.
    for _ in range(rows.bit_length()):
        if nodes.where("NOT done").isEmpty():
            break
        ahead = nodes.select(
            "conv", F.col("id").alias("end"), F.col("end").alias("_end"), F.col("far").alias("_far"), F.col("done").alias("_done")
        )
        moved = nodes.where("NOT done").join(ahead, ["conv", "end"]).select(
            "conv", "id", F.col("_end").alias("end"), (F.col("far") + F.col("_far")).alias("far"), F.col("_done").alias("done"), "open"
        )
        nodes = materialize(compact(nodes.where("done").unionByName(moved), rows), "chains")
    ends = nodes.select("conv", F.col("id").alias("needs"), "end", "far", "done")
    several = nodes.where("open > 1").select("conv", "id")
    # Of each call with several needs: the ends of their chains, and how far behind those it comes.
    waits = edges.join(several, ["conv", "id"]).join(ends, ["conv", "needs"]).select(
        "conv", "id", "end", (F.col("far") + 1).alias("far"), "done"
    )
    waits = materialize(waits, "waits")
    known = materialize(nodes.where("open = 0").select("conv", "id", F.lit(0).alias("level")), "levels")
    left = materialize(several, "left")
    while not left.isEmpty():
        met = waits.join(left, ["conv", "id"]).join(
            known.select("conv", F.col("id").alias("end"), "level"), ["conv", "end"], "left"
        )
        free = met.groupBy("conv", "id").agg(
            F.every(F.col("done") & F.col("level").isNotNull()).alias("free"), F.max(F.col("level") + F.col("far")).alias("level")
        )
        free = materialize(compact(free.where("free").select("conv", "id", "level"), rows), "free")
        if free.isEmpty():
            break
        known = materialize(compact(known.unionByName(free), rows), "levels")
        left = materialize(compact(left.join(free, ["conv", "id"], "left_anti"), rows), "left")
    found = nodes.join(known.select("conv", F.col("id").alias("end"), "level"), ["conv", "end"], "left")
    level = F.when(F.col("done"), F.col("level") + F.col("far"))
    return found.select("conv", "id", F.coalesce(level, F.lit(LAST)).alias("level"))


def link_calls(
    calls: DataFrame, results: DataFrame, tools: DataFrame, messages: DataFrame | None = None
) -> DataFrame:
    """One row per call, per result that no call has, and per message.

    ``calls``: ``conv_id``, ``turn``, ``call_id``, ``name``, ``arguments`` (JSON text), ``after``
    (identifiers of calls that come first); ``results``: ``conv_id``, ``turn``, ``call_id``,
    ``content``; ``tools``: ``name``, ``parameters`` (JSON schema; a repeated name counts once);
    ``messages``, turns that are neither: ``conv_id``, ``turn``, ``role``, ``content``.
    Columns: ``conv_id``, ``position``, ``turn``, ``call_id``, ``name``, ``status``, ``valid``,
    ``problems``, ``result_turn``, ``message``. Other columns are ignored. Every row of ``calls`` and
    ``messages`` has one row here, every row of ``results`` has one or is the result of a call.

    Calls and results meet by conversation and identifier. Of calls with one identifier the first
    by turn is the call, the others are ``repeated`` and get no result; of results the first counts,
    the others are ``repeated`` rows of their own. ``status`` is ``linked``, ``open`` (no result),
    ``repeated``, ``circular``, ``orphan`` (a result without call) or ``message``. Positions (from 0,
    per conversation) order the calls topologically, by turn where nothing else decides; calls in
    circles come last, all other rows have none. Only conversations where a call names itself or a
    later one need rounds, in all others the order of turns already is topological. A named call that
    does not exist is a problem, ``after:`` and its identifier, and so is what a tool's schema asks
    that is not checked (see ``unchecked``). Null identifiers meet nothing.

    ``message`` is JSON with sorted keys at every depth, no white space and numbers in their
    shortest form; arguments that are no JSON are kept as a text.
    """
    print_ = F.xxhash64("name", "arguments")
    asked = calls.select(*_CALL)
    first = asked.groupBy(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_id")).agg(
        F.min(F.struct("turn", print_.alias("print"))).alias("_first")
    )
    same = (F.col("conv_id") == F.col("_conv")) & (F.col("call_id") == F.col("_id"))
    again = F.col("_first").isNotNull() & (
        (F.col("_first.turn") != F.col("turn")) | (F.col("_first.print") != print_)
    )
    asked = asked.join(first, same, "left").select(*_CALL, again.alias("again"))
    asked = materialize(asked, "calls")
    keyed = asked.where("call_id IS NOT NULL AND NOT again").select(
        F.col("conv_id").alias("conv"), F.col("call_id").alias("id"), "turn", "after"
    )
    known = keyed.select("conv", "id", "turn").dropDuplicates(["conv", "id"])
    named = keyed.select(
        "conv", "id", F.col("turn").alias("_turn"), F.explode("after").alias("needs")
    ).distinct()
    targets = known.select("conv", F.col("id").alias("needs"), F.col("turn").alias("_needed"))
    edges = materialize(named.join(targets, ["conv", "needs"], "left"), "edges")
    lost = edges.where(F.col("_needed").isNull()).groupBy("conv", "id").agg(F.collect_set("needs").alias("lost"))
    edges = edges.where(F.col("_needed").isNotNull())
    mixed_up = materialize(edges.where("_needed >= _turn").select("conv").distinct(), "mixed_up")
    order = levels(
        materialize(edges.join(mixed_up, "conv", "left_semi").select("conv", "id", "needs"), "edges"),
        known.join(mixed_up, "conv", "left_semi").select("conv", "id"),
    ).where("level > 0")
    results = results.select("conv_id", "turn", "call_id", "content")
    # Rows get a number, so that of equal results one is the first.
    results = materialize(results.withColumn("_at", F.monotonically_increasing_id()), "results")
    came = (
        results.where("call_id IS NOT NULL")
        .groupBy(F.col("conv_id").alias("conv"), F.col("call_id").alias("id"))
        .agg(F.min(F.struct(F.col("turn").alias("result_turn"), "content", "_at")).alias("result"))
    )
    rules = tools.groupBy(F.col("name").alias("_tool")).agg(F.coalesce(F.min("parameters"), F.lit("{}")).alias("rules"))
    rules = materialize(rules.withColumn("_unchecked", unchecked(F.col("rules"))), "rules")
    same = (F.col("conv_id") == F.col("conv")) & (F.col("call_id") == F.col("id")) & ~F.col("again")
    linked = (
        asked.join(order, same, "left")
        .drop("conv", "id")
        .join(lost, same, "left")
        .drop("conv", "id")
        .join(came.hint("shuffle_hash"), same, "left")
        .drop("conv", "id")
        .join(broadcast_if_small(rules, F.octet_length("rules") + 256), F.col("name") == F.col("_tool"), "left")
    )
    found = F.concat(
        problems(F.col("arguments"), F.col("rules")),
        F.coalesce(F.array_sort("_unchecked"), _no_texts()),
        F.coalesce(_named("after", F.array_sort("lost")), _no_texts()),
    )
    status = (
        F.when(F.col("again"), "repeated")
        .when(F.col("level") == LAST, "circular")
        .when(F.col("result").isNull(), "open")
        .otherwise("linked")
    )
    linked = linked.select(
        *_CALL[:-1],
        found.alias("problems"),
        status.alias("status"),
        F.coalesce("level", F.lit(0)).alias("level"),
        "result.result_turn",
        "result.content",
    )
    placed = ranked(linked, ["conv_id"], ["level", "turn", "call_id"])
    arguments = F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant"))
    message = F.to_json(
        F.struct(
            F.struct(arguments.alias("arguments"), F.col("call_id").alias("id"), "name").alias("call"),
            F.when(F.col("result_turn").isNotNull(), F.struct("content")).alias("result"),
            F.lit("tool_call").alias("role"),
        )
    )
    out = placed.select(
        "conv_id",
        F.col("_rank").alias("position"),
        "turn",
        "call_id",
        "name",
        "status",
        (F.size("problems") == 0).alias("valid"),
        "problems",
        "result_turn",
        message.alias("message"),
    )
    by_call = (F.col("conv_id") == F.col("conv")) & (F.col("call_id") == F.col("id"))
    orphans = results.join(known.select("conv", "id"), by_call, "left_anti")
    later = results.join(known.select("conv", "id"), by_call, "left_semi").join(came, by_call).where(
        F.col("_at") != F.col("result._at")
    )
    rows = [
        _without_call(orphans, "orphan", "no call"),
        _without_call(later, "repeated", "repeated result"),
    ]
    if messages is not None:
        said = F.to_json(F.struct("content", "role"))
        rows.append(
            messages.select(
                "conv_id",
                F.lit(None).cast("long").alias("position"),
                "turn",
                F.lit(None).cast("string").alias("call_id"),
                F.lit(None).cast("string").alias("name"),
                F.lit("message").alias("status"),
                F.lit(True).alias("valid"),
                _no_texts().alias("problems"),
                F.lit(None).cast("long").alias("result_turn"),
                said.alias("message"),
            )
        )
    for more in rows:
        out = out.unionByName(more)
    return out


def _without_call(results: DataFrame, status: str, problem: str) -> DataFrame:
    message = F.to_json(F.struct(F.col("call_id").alias("call_id"), "content", F.lit("tool_result").alias("role")))
    return results.select(
        "conv_id",
        F.lit(None).cast("long").alias("position"),
        "turn",
        "call_id",
        F.lit(None).cast("string").alias("name"),
        F.lit(status).alias("status"),
        F.lit(False).alias("valid"),
        F.array(F.lit(problem)).alias("problems"),
        F.col("turn").alias("result_turn"),
        message.alias("message"),
    )


# The tools of the test conversations: what their turns are read as.
TOOLS = [
    (
        "search",
        '{"type":"object","properties":{"query":{"type":"string"},'
        '"limit":{"type":"integer","minimum":1,"maximum":50}},"required":["query","limit"]}',
    ),
    (
        "shorten",
        '{"type":"object","properties":{"text":{"type":"string"},"words":{"type":"integer"}},'
        '"required":["text"],"additionalProperties":false}',
    ),
    (
        "translate",
        '{"type":"object","properties":{"text":{"type":"string"},'
        '"into":{"type":"string","enum":["en","fr"]}},"required":["text","into"]}',
    ),
]


def read_as_calls(turns: DataFrame, words: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conversation turns (``conv_id``, ``turn``, ``role``, ``text``) as calls, results and messages.

    A user's turn is a call: the number of its ``words`` picks the tool and fills the arguments, and
    tells whether it comes after the user's turn before it or (every seventh) after the one behind
    it. An assistant's turn is the result of the call in the turn before it. Turns of any other role,
    or of none, are messages.
    """
    name = lambda turn: F.substring(F.md5(F.concat_ws(":", "conv_id", turn)), 1, 16)
    rows = turns.withColumn("_n", words)
    text = F.col("text")
    n = F.col("_n")
    arguments = (
        F.when(n % 4 == 0, F.to_json(F.struct(text.alias("query"), n.alias("limit"))))
        .when(n % 4 == 1, F.to_json(F.struct((n / 2).alias("words"), text.alias("text"))))
        .when(n % 4 == 2, F.to_json(F.struct(text.alias("text"), F.when(n > 9, "fr").alias("into"))))
        .otherwise(text)
    )
    tools = F.array(*[F.lit(tool) for tool, _ in TOOLS], F.lit("guess"))
    tool = F.element_at(tools, (n % 4 + 1).cast("int"))
    step = F.when(n % 7 == 6, 2).otherwise(-2)
    after = F.when((F.col("turn") + step >= 0) & (F.col("turn") > 0), F.array(name(F.col("turn") + step)))
    calls = rows.where("role = 'user'").select(
        "conv_id",
        "turn",
        name(F.col("turn")).alias("call_id"),
        tool.alias("name"),
        arguments.alias("arguments"),
        after.alias("after"),
    )
    results = rows.where("role = 'assistant'").select(
        "conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), text.alias("content")
    )
    messages = rows.where("role IS NULL OR role NOT IN ('user', 'assistant')").select(
        "conv_id", "turn", "role", text.alias("content")
    )
    return calls, results, messages
