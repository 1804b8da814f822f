"""JSON containment (`@>`) compiled to a Catalyst predicate.

The pattern is a constant, so it is turned on the driver into one
expression tree over ``try_parse_json(col)``: no Python runs per row and
the predicate stays in whole-stage codegen.

Semantics (those of JSONB containment):
  * object pattern: every key is present and its value contains the
    pattern's value (recursively); ``{}`` matches any object;
  * array pattern: every pattern element is contained in *some* element
    of the document array (order and multiplicity ignored);
  * scalar pattern: type-checked equality — the string ``"true"`` does not
    equal the boolean ``true``; numbers compare by value (``1`` = ``1.0``), plainly written ones of up to
    38 digits by their exact digits, longer ones and those with an exponent as doubles;
  * a top-level document array also contains a bare scalar pattern;
  * NULL document -> NULL; malformed document -> false.
"""

from __future__ import annotations

import json
import re
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, functions as F



_PLAIN_KEY = re.compile(r"[A-Za-z0-9_ -]+")


def _member(node: Column, key: str) -> Column:
    if _PLAIN_KEY.fullmatch(key):
        return F.try_variant_get(node, f'$["{key}"]', "variant")      # one field, no map of the whole object
    # A map lookup takes any key literally (quotes, backslashes, non-ASCII).
    return F.try_element_at(F.try_variant_get(node, "$", "map<string,variant>"), F.lit(key))


def _kind(node: Column) -> Column:
    return F.schema_of_variant(node)


def _is_object(node: Column) -> Column:
    return F.try_variant_get(node, "$", "map<string,variant>").isNotNull()


def _array_of(node: Column) -> Column:
    return F.try_variant_get(node, "$", "array<variant>")


_EXACT, _BINARY = ["TINYINT", "SMALLINT", "INT", "BIGINT"], ["FLOAT", "DOUBLE"]


def _number_eq(node: Column, pat: int | float | Decimal) -> Column:
    """Equality by value, without a fixed scale.

    Numbers written plainly are exact (integer or decimal) and compare as digits without
    trailing zeros; numbers with an exponent are doubles and compare as doubles.
    """
    exact = Decimal(repr(pat)) if isinstance(pat, float) else Decimal(pat)
    digits = format(exact.normalize(), "f") if exact else "0"
    kind = _kind(node)
    text = F.regexp_replace(F.to_json(node), r"(\.\d*?)0+$", "$1")
    plain = F.regexp_replace(F.regexp_replace(text, r"\.$", ""), r"^-0$", "0") == F.lit(digits)
    near = F.try_variant_get(node, "$", "double") == F.lit(float(exact))
    return (((kind.isin(_EXACT) | kind.startswith("DECIMAL")) & plain) | (kind.isin(_BINARY) & near))


def _scalar_eq(node: Column, pat: Any) -> Column:
    if pat is None:
        return F.is_variant_null(node)
    if isinstance(pat, bool):
        return (_kind(node) == F.lit("BOOLEAN")) & (
            F.try_variant_get(node, "$", "boolean") == F.lit(pat))
    if isinstance(pat, (int, float, Decimal)):
        return _number_eq(node, pat)
    if isinstance(pat, str):
        return (_kind(node) == F.lit("STRING")) & (
            F.try_variant_get(node, "$", "string") == F.lit(pat))
    raise TypeError(f"unsupported JSON pattern value {pat!r}")


def _element_matcher(elem: Any):
    # A one-argument lambda (Spark passes an index to two-argument ones).
    return lambda x: _contains(x, elem)


def _contains(node: Column, pat: Any, top: bool = False) -> Column:
    if isinstance(pat, dict):
        # A member lookup only succeeds on an object, so the explicit object
        # test is needed for the empty pattern alone.
        cond = _is_object(node) if not pat else F.lit(True)
        for k, v in pat.items():
            child = _member(node, k)
            cond = cond & child.isNotNull() & _contains(child, v)
        return cond
    if isinstance(pat, list):
        arr = _array_of(node)
        cond = arr.isNotNull()
        for elem in pat:
            cond = cond & F.exists(arr, _element_matcher(elem))
        return cond
    eq = _scalar_eq(node, pat)
    if top:
        # A top-level array contains a bare scalar.
        eq = eq | F.coalesce(F.exists(_array_of(node), lambda x: _scalar_eq(x, pat)), F.lit(False))
    return eq


def _literal_tokens(pat: Any) -> list[str]:
    """Text that must occur verbatim in any matching document written
    without escapes: every key, every string value, and true/false/null
    (numbers have many spellings and give no token)."""
    out: list[str] = []
    if isinstance(pat, dict):
        for k, v in pat.items():
            out.append(json.dumps(k, ensure_ascii=False))
            out += _literal_tokens(v)
    elif isinstance(pat, list):
        for v in pat:
            out += _literal_tokens(v)
    elif isinstance(pat, str):
        out.append(json.dumps(pat, ensure_ascii=False))
    elif pat is None or isinstance(pat, bool):
        out.append(json.dumps(pat))
    return out


def json_contains(col: Column | str, pattern: Any) -> Column:
    """``col @> pattern`` where ``pattern`` is a dict/list/scalar or JSON text.

    A cheap text pre-check runs first: a document without any backslash
    (so without escaped characters) can only match if every key and string
    of the pattern occurs in it verbatim.  Documents failing it are false
    without being parsed; documents with escapes are always parsed, so the
    result is exact.
    """
    if isinstance(pattern, str):
        pattern = json.loads(pattern, parse_float=Decimal)
    c = F.col(col) if isinstance(col, str) else col
    doc = F.try_parse_json(c)
    match = F.coalesce(_contains(doc, pattern, top=True), F.lit(False))
    tokens = sorted(set(_literal_tokens(pattern)))
    if tokens:
        present = None
        for t in tokens:
            p = c.contains(t)
            present = p if present is None else present & p
        cannot = ~c.contains("\\") & ~present
        match = F.when(cannot, F.lit(False)).otherwise(match)
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(match)


def json_text_eq(col: Column | str, key: str, value: str) -> Column:
    """``col ->> key = value`` (text comparison, like the ->> operator)."""
    c = F.col(col) if isinstance(col, str) else col
    path = "$." + key if key.isidentifier() else "$['" + key.replace("'", "\\'") + "']"
    return F.get_json_object(c, path) == F.lit(value)


def to_payload(df, col: str = "properties"):
    """``df`` with a JSON text column as Variant, so that a store keeps it parsed (malformed text: null)."""
    return df.withColumn(col, F.try_parse_json(F.col(col)))


def member_eq(payload: str, key: str, value: Any) -> Column:
    """``payload @> {key: value}`` for a stored Variant column and a scalar: no text is parsed."""
    child = _member(F.col(payload), key)
    return F.coalesce(child.isNotNull() & _scalar_eq(child, value), F.lit(False))


def variant_contains(payload: str, pattern: Any) -> Column:
    """``payload @> pattern`` for a stored Variant column (null payload: null)."""
    if isinstance(pattern, str):
        pattern = json.loads(pattern, parse_float=Decimal)
    node = F.col(payload)
    return F.when(node.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(_contains(node, pattern, top=True), F.lit(False)))
