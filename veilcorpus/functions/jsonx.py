"""JSON text: exact encoding and strict parsing.

`to_json` leaves out the spaces that the training target has, and `from_json`
accepts trailing text and takes what it can from broken input; both would change results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from veilcorpus.fixed_values import CATEGORIES
from veilcorpus.functions.text import let
from veilcorpus.schema import build_annotation, strings_or_empty

#: What Python's `json` writes for each character that it escapes; the backslash comes first.
_ESCAPES = (
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
    ("\b", "\\b"),
    ("\f", "\\f"),
    *((chr(i), f"\\u{i:04x}") for i in range(32) if chr(i) not in "\n\r\t\b\f"),
)


def quote(text: Column) -> Column:
    """A JSON string literal; non-ASCII text is kept, control characters are escaped.

    `to_json` writes the same, but for rare control characters, whose codes it puts in upper case.
    """
    pairs = F.array(*[F.struct(F.lit(raw).alias("raw"), F.lit(escaped).alias("escaped")) for raw, escaped in _ESCAPES])

    def one(t: Column) -> Column:
        plain = F.to_json(F.array(t))
        escaped = F.aggregate(pairs, t, lambda done, p: F.replace(done, p["raw"], p["escaped"]))
        return F.when(t.rlike("[\\x00-\\x07\\x0b\\x0e-\\x1f]"), F.concat(F.lit('"'), escaped, F.lit('"'))).when(
            t.isNotNull(), F.substr(plain, F.lit(2), F.length(plain) - 2)
        )

    return let(text, one)


def encode_strings(values: Column) -> Column:
    """`["a", "b"]`."""
    return F.concat(
        F.lit("["), F.array_join(F.transform(strings_or_empty(values), quote), ", "), F.lit("]")
    )


def encode_annotation(annotation: Column) -> Column:
    """All 11 keys in fixed order: `{"address": [], "company_name": ["a"], ...}`."""
    pieces: list[Column] = []
    for i, name in enumerate(CATEGORIES):
        pieces.append(F.lit(("{" if i == 0 else ", ") + f'"{name}": '))
        pieces.append(encode_strings(annotation.getField(name)))
    return F.concat(*pieces, F.lit("}"))


def decode_annotation(text: Column) -> Column:
    """Trusted corpus JSON to the annotation struct; a missing key is an empty array."""
    ddl = ", ".join(f"{c} ARRAY<STRING>" for c in CATEGORIES)
    parsed = F.from_json(text, ddl)
    return build_annotation(parsed.getField)


def strict_object(text: Column, fields: str) -> Column:
    """Parse `text` only if the whole of it is one JSON object, else null.

    The text is put twice into a wrapper that ends in a marker: once as an object
    value and once inside an array. Trailing text breaks the wrapper before the
    marker, text that continues as `,"k": v` breaks the array copy, and text that
    closes a bracket breaks the object copy, so only a single value gets through.
    """

    def once(t: Column) -> Column:
        wrapped = F.concat(F.lit('{"p":'), t, F.lit(',"again":['), t, F.lit('],"end":1}'))
        return F.from_json(wrapped, f"p STRUCT<{fields}>, end INT", {"allowSingleQuotes": "false"})

    return let(let(text, once), lambda parsed: F.when(parsed.getField("end") == 1, parsed.getField("p")))


# --- Values as Python writes them ----------------------------------------------------------------
#
# A JSON text is cut at its quotes, so that every second part is inside a string. Quotes and backslashes
# that belong to a string are first put out of sight: raw control characters occur in no valid JSON text.

_BACKSLASH, _QUOTE, _MARK = "\x01", "\x02", "\x03"


def _parts(text: Column) -> Column:
    """Parts of a JSON text outside (even) and inside (odd) its strings."""
    hidden = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    return F.split(hidden, '"', -1)


def _shown(part: Column) -> Column:
    return F.replace(F.replace(part, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _string_value(part: Column) -> Column:
    """The value of a string from the part between its quotes."""
    value = F.from_json(F.concat(F.lit('["'), _shown(part), F.lit('"]')), "array<string>")[0]
    return F.when(part.rlike(f"[\\\\{_BACKSLASH}{_QUOTE}]"), value).otherwise(part)


def _is_even(i: Column) -> Column:
    return i % 2 == 0


def mark_strings(text: Column) -> Column:
    """The same JSON text with a mark at the start of every string that is a value (not of keys)."""

    def marked(parts: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            key = F.coalesce(F.get(parts, i + 1), F.lit("")).rlike("^[ \\t\\n\\r]*:")
            return F.when(_is_even(i) | key, part).otherwise(F.concat(F.lit("\\u0003"), part))

        return _shown(F.array_join(F.transform(parts, one), '"'))

    return let(_parts(text), marked)


def python_float(value: Column, inf: str = "inf", nan: str = "nan") -> Column:
    """Shortest text that reads back as the same double, in the form of Python's `repr`.

    Where two texts of that length do, which takes 17 digits and a value beyond 2 ** 53, it may be the other one.
    """

    def shortest(x: Column) -> Column:
        # With each number of digits, rounded and cut; one of them is the nearest text of that length.
        full = F.format_string("%.16e", x)
        power = F.concat(F.lit("e"), F.substring_index(full, "e", -1))
        head = F.substring_index(full, "e", 1)

        def of_length(k: Column) -> Column:
            rounded = F.call_function("format_string", F.concat(F.lit("%."), k.cast("string"), F.lit("e")), x)
            return F.array(rounded, F.concat(F.substring(head, F.lit(1), F.when(k > 0, k + 2).otherwise(1)), power))

        texts = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(16)), of_length))
        return let(F.get(F.filter(texts, lambda t: t.cast("double") == x), 0), laid_out)

    def laid_out(t: Column) -> Column:
        digits = F.replace(F.substring_index(t, "e", 1), F.lit("."), F.lit(""))
        return let(F.struct(digits.alias("d"), F.substring_index(t, "e", -1).cast("int").alias("e")), placed)

    def placed(at: Column) -> Column:
        d, e = at["d"], at["e"]
        n = F.length(d)
        whole = F.concat(F.rpad(d, e + 1, "0"), F.lit(".0"))
        cut = F.concat(F.substring(d, F.lit(1), e + 1), F.lit("."), F.substring(d, e + 2, n))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), d)
        rest = F.when(n > 1, F.concat(F.lit("."), F.substring(d, F.lit(2), n))).otherwise(F.lit(""))
        power = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.when(F.abs(e) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(e).cast("string"))
        far = F.concat(F.substring(d, 1, 1), rest, power)
        return F.when((e < -4) | (e >= 16), far).when(e < 0, small).when(n <= e + 1, whole).otherwise(cut)

    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(F.isnan(value), F.lit(nan))
        .when(F.abs(value) == float("inf"), F.concat(sign, F.lit(inf)))
        .when(value == 0, F.format_string("%.1f", value))
        .otherwise(F.concat(sign, shortest(F.abs(value))))
    )


#: What Python's `repr` writes as an escape: all that is neither printable nor a plain blank.
_UNPRINTED = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"


def python_string(text: Column) -> Column:
    """A string as Python's `repr` writes it."""

    def escaped(c: Column) -> Column:
        def code(n: int, head: str, x: Column) -> Column:
            return F.concat(F.lit(head), F.lower(F.lpad(F.hex(x), n, "0")))

        number = F.ascii(c).cast("bigint")
        by_size = F.when(number < 256, code(2, "\\x", number)).when(number < 65536, code(4, "\\u", number)).otherwise(code(8, "\\U", number))
        short = F.when(c == "\n", F.lit("\\n")).when(c == "\r", F.lit("\\r")).when(c == "\t", F.lit("\\t"))
        return F.when(c.rlike(_UNPRINTED), short.otherwise(by_size)).otherwise(c)

    def quoted(t: Column) -> Column:
        plain = F.replace(t, F.lit("\\"), F.lit("\\\\"))
        shown = F.when(plain.rlike(_UNPRINTED), F.array_join(F.transform(F.split(plain, ""), escaped), "")).otherwise(plain)
        double = F.contains(t, F.lit("'")) & ~F.contains(t, F.lit('"'))
        return F.when(double, F.concat(F.lit('"'), shown, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), F.replace(shown, F.lit("'"), F.lit("\\'")), F.lit("'"))
        )

    return let(text, quoted)


def _number(token: Column, inf: str, nan: str) -> Column:
    """A number (other tokens stay): floats are written anew, and there is no negative zero among integers."""
    is_float = token.rlike("^-?[0-9]+[.eE]")
    return F.when(is_float, python_float(F.when(is_float, token).cast("double"), inf, nan)).when(token == "-0", F.lit("0")).otherwise(token)


def _written(text: Column, string: Callable[[Column], Column], names: dict[str, str], inf: str, nan: str, marked: bool) -> Column:
    """A JSON value with `string` for its strings, other names for its constants, and `, ` and `: ` between its parts."""

    def outside(part: Column) -> Column:
        packed = F.regexp_replace(part, "[ \\t\\n\\r]+", "")
        for name, other in names.items():
            packed = F.replace(packed, F.lit(name), F.lit(other))

        def numbers(t: Column) -> Column:
            tokens = F.split(t, r"(?<=[\[\]{},:])|(?=[\[\]{},:])")
            odd = F.array_join(F.transform(tokens, lambda x: _number(x, inf, nan)), "")
            return F.when(t.rlike("[0-9][.eE]|-0(?![0-9.eE])"), odd).otherwise(t)

        return F.replace(F.replace(let(packed, numbers), F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": "))

    def one(part: Column, i: Column) -> Column:
        bare = F.regexp_replace(part, r"^\\u0003", "") if marked else part
        return F.when(_is_even(i), outside(part)).otherwise(string(_string_value(bare)))

    return F.array_join(F.transform(_parts(text), one), "")


def python_json(text: Column, marked: bool = False) -> Column:
    """A JSON value written anew as `json.dumps(value, ensure_ascii=False)` writes it, keys in their order.

    The text must be valid JSON, with marked strings or without. A key that an object repeats stays repeated.
    """
    return _written(text, quote, {}, "Infinity", "NaN", marked)


def python_text(text: Column, marked: bool = False) -> Column:
    """A JSON value as Python's `repr` writes it."""
    names = {"true": "True", "false": "False", "null": "None", "NaN": "nan", "Infinity": "inf"}
    return _written(text, python_string, names, "inf", "nan", marked)


def marked_string(value: Column) -> Column:
    """What a marked string holds; null if the value is no string."""
    return F.when(F.startswith(value, F.lit(_MARK)), F.substring(value, F.lit(2), F.length(value)))


# --- Model output --------------------------------------------------------------------------------

_LIST_FIELDS = ", ".join(f"{c}: ARRAY<STRING>" for c in CATEGORIES)


def strict_annotation(text: Column) -> Column:
    """Strictly parsed model output, its strings marked (see `native_annotation`); null if it is not an object."""
    return strict_object(mark_strings(text), _LIST_FIELDS)


def _text_of(element: Column) -> Column:
    """A string as it is, all else as Python's `str` has it."""
    return F.coalesce(marked_string(element), python_text(element, marked=True))


def _values_of(element: Column) -> Column:
    """What of a list element is shown: of an object its non-null values (of a repeated key the last), else itself."""
    # The reader keeps every entry of an object, so later ones of a key are found by place.
    entries = F.map_entries(F.from_json(element, "map<string,string>"))

    def last(entries_: Column) -> Column:
        def held(e: Column, i: Column) -> Column:
            later = F.slice(entries_, i + 2, F.size(entries_))
            return e["value"].isNotNull() & ~F.exists(later, lambda x: x["key"] == e["key"])

        return F.transform(F.filter(entries_, held), lambda e: e["value"])

    return (
        F.when(element.isNull(), F.array(F.lit(_MARK + "None")))
        .when(F.startswith(element, F.lit("{")), let(entries, last))
        .otherwise(F.array(element))
    )


def list_texts(values: Column) -> Column:
    """Texts of a list's elements, as Python's `str` has them; null for a null list."""
    plain = F.forall(values, lambda v: F.coalesce(F.startswith(v, F.lit(_MARK)), F.lit(False)))
    strings = F.transform(values, lambda v: F.substring(v, F.lit(2), F.length(v)))
    return F.when(plain, strings).otherwise(F.transform(F.flatten(F.transform(values, _values_of)), _text_of))


def native_annotation(parsed: Column) -> Column:
    """Annotation struct of a strict parse: element texts as Python's `str` has them; a value that is no list is empty."""
    lists = F.array(*[parsed.getField(c) for c in CATEGORIES])
    return let(F.transform(lists, list_texts), lambda texts: build_annotation(lambda name: texts[CATEGORIES.index(name)]))


def summary_value(summary: Column, key: str) -> Column:
    """One key of a summary that arrives as JSON text; null unless the text is an object."""
    return strict_object(summary, f"`{key}`: STRING").getField(key)
