"""JSON column functions (warehouse-style JSON on Spark VARIANT).

A document is parsed once into a VARIANT (``safe_parse``/``strict_parse``)
and then addressed by JSONPath.  All functions are built-in Catalyst
expressions: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Strict JSON: no single quotes, no NaN/Infinity literals (as parse_json);
# strings as long as a text can be.
STRICT_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxStringLen": str(2 ** 31 - 1)}

# A VARIANT holds 128 MiB; its encoding takes less than four times the text.
VARIANT_BYTES = 128 << 20
_LARGE_TEXT = VARIANT_BYTES // 4


def _end_mark(text: Column) -> Column:
    """A text's own hash as digits: what follows a whole document below."""
    return F.xxhash64(text).cast("string")


def _with_end(text: Column, shape: str, before: str = '"', after: str = '"') -> Column:
    """Parse ``text`` followed by its end mark as one array.

    The parser stops at the end of a value and would accept text behind it.
    Inside ``[text, mark]`` such text breaks the array or displaces the mark,
    so a parse of two items whose second is the mark is exact, in one pass."""
    return F.from_json(F.concat(F.lit("["), text, F.lit("," + before), _end_mark(text), F.lit(after + "]")),
                       f"array<{shape}>", STRICT_JSON_OPTIONS)


def safe_parse(text: ColumnOrName) -> Column:
    """FN-1: text -> VARIANT; NULL for NULL text and for text that is not
    exactly one JSON document (text behind the document makes it bad)."""
    t = _c(text)
    items = _with_end(t, "variant")
    whole = (F.size(items) == 2) & (F.try_variant_get(F.get(items, F.lit(1)), "$", "string") == _end_mark(t))
    return F.when(whole, F.coalesce(F.get(items, F.lit(0)), F.parse_json(F.lit("null"))))


def strict_parse(text: ColumnOrName) -> Column:
    """FN-2: text -> VARIANT; text that is not exactly one JSON document fails
    the query."""
    t = _c(text)
    return F.when(t.isNotNull(), F.coalesce(safe_parse(t), F.raise_error(F.lit(NOT_ONE_DOCUMENT)).cast("variant")))


NOT_ONE_DOCUMENT = "the text is not one JSON document"


def root_items(text: ColumnOrName) -> Column:
    """Items of the JSON array that is the whole text, as ARRAY<VARIANT>; NULL
    for other text.  Every item is a VARIANT of its own, so the array may be
    larger than one VARIANT can be."""
    t = _c(text)
    parsed = _with_end(t, "array<variant>", '["', '"]')
    mark = F.try_variant_get(F.get(F.get(parsed, F.lit(1)), F.lit(0)), "$", "string")
    return F.when((F.size(parsed) == 2) & (mark == _end_mark(t)), F.get(parsed, F.lit(0)))


def _item_texts(text: Column) -> Column:
    """Items of the JSON array that is the whole text, as JSON texts (strings
    without their quotes)."""
    parsed = _with_end(text, "array<string>", '["', '"]')
    whole = (F.size(parsed) == 2) & (F.get(F.get(parsed, F.lit(1)), F.lit(0)) == _end_mark(text))
    return F.when(whole, F.get(parsed, F.lit(0)))


def _may_exceed_variant(text: Column) -> Column:
    return F.octet_length(text) >= _LARGE_TEXT


def _string_like_object(text: Column) -> Column:
    """True where a string of the document starts like an object: among item
    texts the two could not be told apart."""
    return text.contains('"{')


def document_objects(text: ColumnOrName) -> Column:
    """LAT-5 item list of a document's text: array root -> its items, object
    root -> [root], anything else (scalar, NULL, bad text) -> no items.

    Where an item of a large array exceeds a VARIANT, the array's objects are
    parsed one by one: the exceeding ones are NULL here (``oversized_items``
    names them), the others stay."""
    t = _c(text)
    kind = text_kind(t)
    one_by_one = F.transform(F.filter(_item_texts(t), lambda s: text_kind(s) == "OBJECT"), safe_parse)
    items = F.coalesce(root_items(t), F.when(_may_exceed_variant(t) & ~_string_like_object(t), one_by_one))
    return F.when(kind == "ARRAY", items).when(kind == "OBJECT", F.array(safe_parse(t))).otherwise(F.array().cast("array<variant>"))


def rejected_items(text: ColumnOrName) -> Column:
    """What ``document_objects`` cannot hand on, as ARRAY<STRUCT<item: int,
    bytes: bigint, reason: string>>: item numbers count from 0; a document
    rejected as a whole has item NULL.  Empty for good documents."""
    t = _c(text)
    kind = text_kind(t)

    def reject(item, size, reason):
        return F.struct(item.cast("int").alias("item"), size.cast("bigint").alias("bytes"), F.lit(reason).alias("reason"))

    whole = lambda reason: F.array(reject(F.lit(None), F.octet_length(t), reason))
    none = F.array().cast("array<struct<item:int,bytes:bigint,reason:string>>")
    sized = F.transform(_item_texts(t), lambda s, i: F.when((text_kind(s) == "OBJECT") & safe_parse(s).isNull(),
                                                            reject(i, F.octet_length(s), "the item exceeds a VARIANT")))
    large = F.when(_string_like_object(t), whole("an item exceeds a VARIANT, and strings look like objects")).otherwise(F.filter(sized, lambda r: r.isNotNull()))
    fits = F.when(kind == "ARRAY", root_items(t).isNotNull()).otherwise(safe_parse(t).isNotNull())
    return (F.when(t.isNull() | ~is_one_document(t), whole(NOT_ONE_DOCUMENT)).when(fits, none)
            .when(kind == "ARRAY", large).otherwise(whole("the document exceeds a VARIANT")))


def _node(v: ColumnOrName, path: str) -> Column:
    return F.try_variant_get(_c(v), path, "variant")


def json_kind(v: ColumnOrName) -> Column:
    """Upper-case top-level kind of a VARIANT: OBJECT, ARRAY, STRING, BIGINT,
    DECIMAL, DOUBLE, BOOLEAN, VOID (JSON null) ... NULL when absent."""
    # the leading type name of the schema text, without a regex:
    # 'OBJECT<a: BIGINT>' -> 'OBJECT', 'DECIMAL(2,1)' -> 'DECIMAL'
    schema = F.schema_of_variant(_c(v))
    return F.substring_index(F.substring_index(schema, "<", 1), "(", 1)


def text_kind(text: ColumnOrName) -> Column:
    """Root kind of JSON *text* from its first non-blank character:
    'OBJECT' for ``{``, 'ARRAY' for ``[``, else 'SCALAR'.  Exact for text
    that parses; O(1) per document, where ``json_kind`` walks the value."""
    first = F.regexp_extract(_c(text), r"^\s*(\S)", 1)
    return F.when(first == "{", "OBJECT").when(first == "[", "ARRAY").otherwise("SCALAR")


def json_value(v: ColumnOrName, path: str = "$") -> Column:
    """FN-3: scalar at ``path`` as STRING; object, array, JSON null, missing
    key and unparsable input give NULL.

    The value is read as text directly; only text starting with ``{`` or
    ``[`` (an object or array rendered as JSON, or a string that merely
    starts that way) pays for the type test, evaluated lazily in the CASE.
    """
    text = F.try_variant_get(_c(v), path, "string")
    suspicious = text.startswith("{") | text.startswith("[")
    return F.when(suspicious & json_kind(_node(v, path)).isin("OBJECT", "ARRAY"),
                  F.lit(None).cast("string")).otherwise(text)


def default_if_missing(v: ColumnOrName, path: str, default: str) -> Column:
    """PRJ-7: the scalar at ``path`` as text; ``default`` only where the key is
    missing.  A key that is present with JSON null stays NULL."""
    return F.when(_node(v, path).isNull(), F.lit(default)).otherwise(json_value(v, path))


def int_of_json(v: ColumnOrName, path: str, default: int) -> Column:
    """FN-18: whole part of the number or integer text at ``path``, ``default``
    where the key is missing; JSON null and other values fail the query."""
    text = json_value(v, path)
    number = json_kind(_node(v, path)).isin("DECIMAL", "DOUBLE", "FLOAT")
    whole = F.when(number, text.cast("decimal(38,9)").cast("bigint")).otherwise(text.cast("bigint"))
    fail = F.raise_error(F.lit(f"no integer at {path}")).cast("bigint")
    return (F.when(_node(v, path).isNull(), F.lit(default).cast("bigint"))
            .when(text.isNull(), fail).otherwise(whole))


def is_one_document(text: ColumnOrName) -> Column:
    """True where the whole text is one JSON value, of any size."""
    t = _c(text)
    parsed = _with_end(t, "string")
    return F.coalesce((F.size(parsed) == 2) & (F.get(parsed, F.lit(1)) == _end_mark(t)), F.lit(False))


def json_query(v: ColumnOrName, path: str = "$") -> Column:
    """FN-4: the JSON text of the value at ``path`` (objects, arrays and
    quoted strings alike); missing -> NULL."""
    return F.to_json(_node(v, path))


def json_query_array(v: ColumnOrName, path: str = "$") -> Column:
    """FN-5: the array at ``path`` as ARRAY<VARIANT>; non-array -> NULL."""
    return F.try_variant_get(_c(v), path, "array<variant>")


def json_text(c: ColumnOrName) -> Column:
    """FN-24 / SNK-1: serialise a struct, array or VARIANT to JSON text.
    Non-ASCII characters are written as they are (no \\u escapes)."""
    return F.to_json(_c(c))


# Possessive repeats: a long string is matched in a loop, without recursion.
_JSON_TOKEN = r'("[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^"\[\]{},:\s]+)'
_STRING_PIECE = r"([^\\]++|\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\.)"

# Characters that stay escaped in JSON text, and how.
_SHORT_ESCAPES = {"0008": r"\b", "0009": r"\t", "000a": r"\n", "000c": r"\f", "000d": r"\r", "0022": r"\"", "005c": r"\\"}


def _unescaped(piece: Column) -> Column:
    """One piece of a JSON string literal without needless escapes."""
    code = F.lower(F.substring(piece, 3, 4))
    short = F.lit(None).cast("string")
    for digits, escape in _SHORT_ESCAPES.items():
        short = F.when(code == digits, F.lit(escape)).otherwise(short)
    pair = F.decode(F.unhex(F.concat(code, F.substring(piece, 9, 4))), "UTF-16BE")
    return (F.when(piece == r"\/", F.lit("/")).when(~piece.startswith("\\u"), piece)
            .when(F.length(piece) == 12, pair)
            .when(short.isNotNull(), short)
            # other control characters, and halves of a pair, have no other form
            .when(code.rlike("^(00[01]|d[89a-f])"), F.concat(F.lit("\\u"), code))
            .otherwise(F.decode(F.unhex(code), "UTF-16BE")))


def json_rewritten(text: ColumnOrName) -> Column:
    """FN-24 for a document's text: the same JSON with ``, `` and ``: `` as its
    only white space outside strings, and characters instead of ``\\u`` escapes
    (``json.dumps(json.loads(text), ensure_ascii=False)``).  Keys keep their
    order, repeated keys stay, numbers stay as written; half a surrogate pair
    stays escaped.  NULL for NULL and for text that is not one document."""
    t = _c(text)
    tokens = F.regexp_extract_all(t, F.lit(_JSON_TOKEN), F.lit(1))
    string = lambda s: F.array_join(F.transform(F.regexp_extract_all(s, F.lit(_STRING_PIECE), F.lit(1)), _unescaped), "")
    written = F.transform(tokens, lambda s: F.when(s == ",", F.lit(", ")).when(s == ":", F.lit(": "))
                          .when(s.contains("\\u") | s.contains(r"\/"), string(s)).otherwise(s))
    return F.when(is_one_document(t), F.array_join(written, ""))


def parse_shape(text: ColumnOrName, ddl: str) -> Column:
    """Parse JSON text against a partial *shape* whose leaves are VARIANT,
    e.g. ``location variant, forecast struct<forecastday: array<variant>>``.

    The fixed outer levels are read by the streaming JSON parser straight
    into structs (no full VARIANT to build and walk again); everything below
    stays VARIANT, so path functions keep their exact semantics.  A level
    with the wrong JSON type (object where an array is expected, ...) and text
    that is not exactly one JSON object give NULL."""
    t = _c(text)
    items = _with_end(t, f"struct<{ddl}, end_mark string>", '{"end_mark":"', '"}')
    return F.when((F.size(items) == 2) & (F.get(items, F.lit(1))["end_mark"] == _end_mark(t)), F.get(items, F.lit(0)))
