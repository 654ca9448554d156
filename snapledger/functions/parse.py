"""Strict, declarative coercions: each gives a value and whether the input is bad, as Columns.

``text`` is a JSON value as text (strings without quotes), ``kind`` its JSON type as schema_of_variant() names it,
or null where the key is missing or the value null. Nothing is normalised beyond what the type demands.

A type also tells which kinds it may take, as a regular expression (``kinds``; others are bad), and what Spark is to read
its values as (``read``), so that a whole record can be judged by its schema and read in one go; see validate.valid().
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Parsed = tuple[Column, Column]


def _takes(kinds: str, read: str = "string") -> Callable:
    def tell(type_: Callable[[Column, Column], Parsed]) -> Callable[[Column, Column], Parsed]:
        type_.kinds, type_.read = kinds, read
        return type_

    return tell


_NUMBERS = r"BIGINT|DECIMAL\(\d+,\s?\d+\)|DOUBLE|FLOAT"


def _is_text(kind: Column) -> Column:
    return kind == "STRING"


def _is_number(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


@_takes("STRING")
def text(text: Column, kind: Column) -> Parsed:
    return text, ~_is_text(kind)


def short_text(most: int) -> Callable[[Column, Column], Parsed]:
    return _takes("STRING")(lambda text, kind: (text, ~_is_text(kind) | (F.char_length(text) > most)))


@_takes(f"STRING|{_NUMBERS}")
def text_id(text: Column, kind: Column) -> Parsed:
    """A string, or a whole number that is written out as one."""
    number = text.try_cast("decimal(38,10)")
    whole = number == F.floor(number)
    return F.when(_is_text(kind), text).when(_is_number(kind) & whole, number.cast("decimal(38,0)").cast("string")), ~(_is_text(kind) | (_is_number(kind) & F.coalesce(whole, F.lit(False))))


@_takes("STRING|BOOLEAN")
def text_or_false(text: Column, kind: Column) -> Parsed:
    """A string, or JSON false, which becomes the text "false"; true is bad."""
    return text, ~(_is_text(kind) | ((kind == "BOOLEAN") & (text == "false")))


def integer(type_: str = "int") -> Callable[[Column, Column], Parsed]:
    """A JSON whole number; strings are bad."""
    return _takes("BIGINT")(lambda text, kind: (text.try_cast(type_), ~(kind == "BIGINT") | text.try_cast(type_).isNull()))


def loose_integer(type_: str = "int", blank: bool = False) -> Callable[[Column, Column], Parsed]:
    """A whole number, a number without a fraction, or digits in a string; ``blank``: an empty string is null."""

    @_takes(f"STRING|{_NUMBERS}")
    def parse(text: Column, kind: Column) -> Parsed:
        number = text.try_cast("decimal(38,10)")
        digits = _is_text(kind) & text.rlike(r"^\s*[+-]?[0-9]+\s*$")
        fine = digits | (_is_number(kind) & F.coalesce(number == F.floor(number), F.lit(False)))
        value = F.when(fine, F.trim(text).try_cast("decimal(38,10)").try_cast(type_))
        empty = _is_text(kind) & (text == "") if blank else F.lit(False)
        return value, ~empty & (~fine | value.isNull())

    return parse


def flag(yes: str, no: str, blank: bool = False) -> Callable[[Column, Column], Parsed]:
    """One of two words; ``blank``: an empty string is null."""

    @_takes("STRING")
    def parse(text: Column, kind: Column) -> Parsed:
        fine = _is_text(kind) & text.isin(yes, no, *([""] if blank else []))
        return F.when(text == yes, True).when(text == no, False), ~fine

    return parse


def day(*formats: str, blank: bool = False) -> Callable[[Column, Column], Parsed]:
    """A date or time in one of the formats, as a UTC timestamp; ``blank``: an empty string is null.

    A format with quoted letters is tried first and only on texts that hold them, as a format that fails costs more
    than one that fits.
    """
    letters = {f: "".join(f.split("'")[1::2]) if f.count("'") == 2 else "" for f in formats}

    def one(text: Column, f: str) -> Column:
        found = F.try_to_timestamp(text, F.lit(f))
        return F.when(text.contains(letters[f]), found) if letters[f] else found

    @_takes("STRING")
    def parse(text: Column, kind: Column) -> Parsed:
        value = F.coalesce(*(one(text, f) for f in sorted(formats, key=lambda f: not letters[f])))
        empty = text == "" if blank else F.lit(False)
        return F.when(text != "", value), ~_is_text(kind) | (~empty & value.isNull())

    return parse


def one_of(*values: str) -> Callable[[Column, Column], Parsed]:
    return _takes("STRING")(lambda text, kind: (text, ~(_is_text(kind) & text.isin(*values))))


@_takes("ARRAY<(?:STRING|VOID)>", "array<string>")
def strings(text: Column, kind: Column) -> Parsed:
    """An array of strings; an array without elements has no element type."""
    return F.from_json(text, "array<string>"), ~kind.isin("ARRAY<STRING>", "ARRAY<VOID>")


def members(kinds: dict[str, str], required: Iterable[str]) -> str:
    """A regular expression for the members of an object with these keys and kinds, as schema_of_variant() writes them: sorted.

    A key that isn't ``required`` may be missing or have nulls only.
    """
    each = ((k, f"{k}: (?:{kinds[k]}{'' if k in required else '|VOID'})(?:, |(?=>))") for k in sorted(kinds))
    return "".join(x if k in required else f"(?:{x})?" for k, x in each)


def opened(type_: Callable[[Column, Column], Parsed], text: Column) -> Column:
    """What ``type_`` takes as its text: its elements, opened once for value and verdict, if it has such a step."""
    return getattr(type_, "opened", lambda x: x)(text)


def objects(required: dict[str, str], optional: dict[str, str]) -> Callable[[Column, Column], Parsed]:
    """An array of flat objects {key: name of the field}; unknown keys, missing ones and non-strings are bad.

    Takes what ``opened`` makes of the text: each element beside its members.
    """
    names = required | optional
    order = sorted(names.items(), key=lambda x: x[1])

    def elements(text: Column) -> Column:
        return F.transform(F.from_json(text, "array<string>"), lambda e: F.struct(e.alias("text"), F.from_json(e, "map<string,string>").alias("fields")))

    def bad(element: Column) -> Column:
        fields = element["fields"]
        unknown = F.size(F.array_except(F.map_keys(fields), F.array(*map(F.lit, names)))) > 0
        missing = [F.try_element_at(fields, F.lit(k)).isNull() for k in required]
        types = [F.regexp_like(element["text"], F.lit(rf'"{k}"\s*:\s*(?:-?[0-9]|true|false|\[|\{{)')) for k in names]
        return F.coalesce(fields.isNull() | unknown | F.lit(False), F.lit(True)) | _any(missing) | _any(types)

    def struct(element: Column) -> Column:
        return F.struct(*(F.try_element_at(element["fields"], F.lit(k)).alias(name) for k, name in order))

    def parse(raw: Column, kind: Column) -> Parsed:
        return F.coalesce(F.transform(raw, struct), F.transform(elements(F.lit("[]")), struct)), ~kind.startswith("ARRAY") | F.coalesce(F.exists(raw, bad), F.lit(False))

    def whole(raw: Column) -> Parsed:
        """Of an array whose elements are known to have no other keys and kinds, read as it is."""
        lacks = F.exists(raw, lambda e: _any([e.isNull(), *(e[k].isNull() for k in required)]))
        return F.coalesce(raw, F.array()).cast(f"array<struct<{','.join(f'{name}:string' for _, name in order)}>>"), F.coalesce(lacks, F.lit(False))

    parse.opened, parse.whole = elements, whole
    kinds = members(dict.fromkeys(names, "STRING"), required)
    return _takes(f"ARRAY<(?:VOID|OBJECT<{kinds}>)>", f"array<struct<{','.join(f'{k}:string' for k, _ in order)}>>")(parse)


def _any(of: list[Column]) -> Column:
    out = F.lit(False)
    for x in of:
        out = out | F.coalesce(x, F.lit(False))
    return out
