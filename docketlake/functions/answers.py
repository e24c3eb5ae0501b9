"""Cleaning and validating the JSON answers of an extractor, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from docketlake.functions.text import in_head, let, py_strip
from docketlake.schemas import ACTION_ELEMENT

# A string literal (the last one may be cut off), a brace, or a run of anything else.
_TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[{}]|[^"{}]++'
_STRING_OR_REST = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[^"]++'


def clean_answer(c: Column) -> Column:
    """Drop closed think blocks and a code fence, keep the first top-level object."""
    c = py_strip(in_head(py_strip(c), "(?-i:</think>)", lambda x: F.regexp_replace(x, r"(?s)<think>.*?</think>", "")))
    return let(py_strip(_drop_fence(c)), _first_object)


def _drop_fence(c: Column) -> Column:
    def body(lines: Column) -> Column:
        closes = (F.size(lines) > 1) & (py_strip(F.get(lines, F.size(lines) - 1)) == "```")
        keep = F.size(lines) - 1 - F.when(closes, 1).otherwise(0)
        return F.array_join(F.slice(lines, F.lit(2), keep), "\n")

    return F.when(F.startswith(c, F.lit("```")), let(F.split(c, "\n", -1), body)).otherwise(c)


def _first_object(c: Column) -> Column:
    """Cut after the brace that closes the first one, ignoring braces in strings."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(False).alias("done"))

    def step(state: Column, token: Column) -> Column:
        depth = state["depth"] + F.when(token == "{", 1).when(token == "}", -1).otherwise(0)
        return F.when(state["done"], state).otherwise(F.struct(
            depth.alias("depth"),
            (state["length"] + F.length(token)).alias("length"),
            ((token == "}") & (depth == 0)).alias("done"),
        ))

    cut = F.aggregate(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), start, step,
                      lambda s: F.when(s["done"], s["length"]))
    return F.when(F.startswith(c, F.lit("{")),
                  F.coalesce(F.left(c, cut), c)).otherwise(c)


def parse_answer(cleaned: Column) -> Column:
    """The answer as VARIANT, null when it is not one whole JSON value."""
    plain = F.try_parse_json(cleaned)
    # try_parse_json ignores what follows the first value. A cleaned object has
    # nothing after it; for anything else both wrappings must parse.
    whole = (
        F.startswith(cleaned, F.lit("{"))
        | (
            F.try_parse_json(F.concat(F.lit('{"v":'), cleaned, F.lit("}"))).isNotNull()
            & (F.size(F.try_variant_get(
                F.try_parse_json(F.concat(F.lit("["), cleaned, F.lit("]"))),
                "$", "array<variant>")) == 1)
        )
    )
    strict = F.when(whole, plain)
    has_special = F.contains(cleaned, F.lit("NaN")) | F.contains(cleaned, F.lit("Infinity"))
    return F.coalesce(strict, F.when(
        has_special & F.startswith(cleaned, F.lit("{")), F.try_parse_json(_plain_numbers(cleaned))
    ))


def _plain_numbers(c: Column) -> Column:
    """NaN and Infinity outside strings to 0.5: a number no field accepts, as they are."""
    special = r"(?<![\w.+-])(?:NaN|-?Infinity)(?![\w.])"
    return F.array_join(F.transform(
        F.regexp_extract_all(c, F.lit(_STRING_OR_REST), F.lit(0)),
        lambda t: F.when(F.startswith(t, F.lit('"')), t)
        .otherwise(F.regexp_replace(t, special, "0.5")),
    ), "")


# --- validation --------------------------------------------------------------
#
# A check gives null for "fine" or the path of the first field at fault. A failed
# check makes the digest ``failed``; a shape that the rules do not foresee makes
# it an ``error``, which leaves no output and is tried again later.

# Texts that count as a boolean.
TRUE_WORDS = ["1", "on", "t", "true", "y", "yes"]
FALSE_WORDS = ["0", "off", "f", "false", "n", "no"]


def _field(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def _kind(v: Column) -> Column:
    """Scalar kind; only called on values that are neither arrays nor objects in good data."""
    return F.schema_of_variant(v)


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _text(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "string")


def _check_text(v: Column, name: str, path: Column, required: bool) -> Column:
    value = _field(v, name)
    fine = _kind(value) == "STRING"
    if not required:
        fine = value.isNull() | F.is_variant_null(value) | fine
    return F.when(~F.coalesce(fine, F.lit(False)), F.concat(path, F.lit(f".{name}")))


def lax_boolean(value: Column) -> Column:
    """Boolean of a VARIANT by lax rules, null when there is none."""
    number = F.try_variant_get(value, "$", "double")
    word = F.lower(F.try_variant_get(value, "$", "string"))
    kind = _kind(value)
    is_number = (kind == "BIGINT") | (kind == "DOUBLE") | F.startswith(kind, F.lit("DECIMAL"))
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(is_number, F.when(number == 1, True).when(number == 0, False))
        .when(kind == "STRING", F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False))
    )


def _check_boolean(v: Column, name: str, path: Column) -> Column:
    value = _field(v, name)
    fine = value.isNull() | F.is_variant_null(value) | lax_boolean(value).isNotNull()
    return F.when(~fine, F.concat(path, F.lit(f".{name}")))


def _check_list(v: Column, name: str, path: Column, required: list[str], optional: list[str]) -> Column:
    """First fault in a list of flat objects; the list may be absent but not null."""
    value = _field(v, name)
    items = F.try_variant_get(v, f"$.{name}", "array<variant>")
    here = F.concat(path, F.lit(f".{name}"))

    def check(item: Column, i: Column) -> Column:
        spot = F.concat(here, F.lit("["), i.cast("string"), F.lit("]"))
        return F.when(~_is_object(item), spot).otherwise(F.coalesce(
            *[_check_text(item, n, spot, True) for n in required],
            *[_check_text(item, n, spot, False) for n in optional],
        ))

    faults = F.filter(F.transform(items, check), lambda f: f.isNotNull())
    return F.when(value.isNotNull(), F.when(items.isNull(), here).otherwise(F.get(faults, F.lit(0))))


def _check_action(action: Column, path: Column) -> Column:
    return F.coalesce(
        _check_text(action, "action_type", path, True),
        _check_text(action, "title", path, False),
        _check_list(action, "respondents", path, ["name"], ["entity_type", "location"]),
        _check_list(action, "violations", path, [], ["statute", "description"]),
        _check_list(action, "sanctions", path, [],
                    ["sanction_type", "description", "duration", "amount"]),
        _check_boolean(action, "settlement", path),
        *[_check_text(action, n, path, False) for n in ("court", "case_number", "release_number")],
        _check_text(action, "full_text", path, True),
    )


def _objects(v: Column, name: str, fields: list[str]) -> Column:
    items = F.try_variant_get(v, f"$.{name}", "array<variant>")
    built = F.transform(items, lambda item: F.struct(*[_text(item, f).alias(f) for f in fields]))
    return F.coalesce(built, F.array().cast(
        "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>"))


def _build_action(action: Column) -> Column:
    return F.struct(
        _text(action, "action_type").alias("action_type"),
        _text(action, "title").alias("title"),
        _objects(action, "respondents", ["name", "entity_type", "location"]).alias("respondents"),
        _objects(action, "violations", ["statute", "description"]).alias("violations"),
        _objects(action, "sanctions",
                 ["sanction_type", "description", "duration", "amount"]).alias("sanctions"),
        lax_boolean(_field(action, "settlement")).alias("settlement"),
        *[_text(action, n).alias(n)
          for n in ("court", "case_number", "release_number", "full_text")],
    )


def validate_answer(v: Column) -> Column:
    """Judge a parsed answer.

    ``struct<outcome, error_class, error_path>``: outcome ``ok``, ``failed`` (the
    digest is recorded without actions) or ``error`` (no record, retried later).
    """
    def verdict(outcome: str, cls: str | None, path: Column | None = None) -> Column:
        return F.struct(
            F.lit(outcome).alias("outcome"),
            F.lit(cls).cast("string").alias("error_class"),
            (F.lit(None).cast("string") if path is None else path).alias("error_path"),
        )

    actions = _field(v, "actions")
    items = F.try_variant_get(v, "$.actions", "array<variant>")
    as_map = F.try_variant_get(v, "$.actions", "map<string,variant>")
    empty = (
        actions.isNull()
        | (as_map.isNotNull() & (F.size(as_map) == 0))
        | ((_kind(actions) == "STRING") & (_text(v, "actions") == ""))
    )

    def check(action: Column, i: Column) -> Column:
        spot = F.concat(F.lit("actions["), i.cast("string"), F.lit("]"))
        return F.when(~_is_object(action), verdict("error", "TypeError", spot)).otherwise(
            let(_check_action(action, spot),
                lambda fault: F.when(fault.isNotNull(), verdict("failed", "ValidationError", fault))))

    notes = _field(v, "extraction_notes")
    notes_fine = notes.isNull() | F.is_variant_null(notes) | (_kind(notes) == "STRING")
    first_fault = F.get(F.filter(F.transform(items, check), lambda x: x.isNotNull()), F.lit(0))
    return (
        F.when(v.isNull(), verdict("failed", "JSONDecodeError"))
        .when(~_is_object(v), verdict("error", "AttributeError"))
        .when(items.isNull() & ~F.coalesce(empty, F.lit(False)),
              verdict("error", "TypeError", F.lit("actions")))
        .otherwise(F.coalesce(
            first_fault,
            F.when(~notes_fine, verdict("failed", "ValidationError", F.lit("extraction_notes"))),
            verdict("ok", None),
        ))
    )


def answer_actions(v: Column) -> Column:
    """Actions of an answer that was judged ``ok``, in the document's types."""
    items = F.try_variant_get(v, "$.actions", "array<variant>")
    none = F.array().cast(f"array<{ACTION_ELEMENT}>")
    return F.coalesce(F.transform(items, _build_action), none)


def answer_notes(v: Column) -> Column:
    return _text(v, "extraction_notes")
