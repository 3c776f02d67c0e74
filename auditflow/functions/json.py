"""JSON objects held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unquoted keys and single quotes are accepted.
LENIENT_JSON = {
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
}


# Stands before numbers and nulls that are carried as strings; a private-use character.
_MARK = "\ue000"
# A mark of one byte: Java holds a text of such characters in half the memory and searches it faster.
# No name without quotes holds it.
BYTE_MARK = "~"

# A JSON text in pieces: strings, names without quotes, and what stands between values.
_NULL = r"null(?![\w$])"
# Java runs through one class of characters in a tight loop only where the loop is not a possessive one.
_STRING = r'"[^"\\]*(?:\\[\s\S][^"\\]*)*+"'
_BETWEEN = r"[^\"'\w$+\-]"
# A string and what follows it are one step, which halves the steps.
_OTHER = (
    rf"(?:{_STRING}[,:{{}}\[\]\s]*|{_BETWEEN}++" r"|'[^'\\]*+(?:\\[\s\S][^'\\]*+)*+'"
    rf"|(?!{_NULL})[A-Za-z_$][\w$]*+|[+\-](?![0-9]))*+"
)
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+(?![\w.+-])"
# Each match goes on where the last one ended, so no string is ever entered.
_LITERAL = rf"\G({_OTHER})({_NUMBER}|{_NULL})"
# Texts in which a number might be written anew, or a member be null.
_AT_RISK = r"null|[0-9][.eE]|[0-9]{18}|-0"


def one_object(text: Column, fields: str) -> Column:
    """The object a text consists of, read by a schema; null unless the text is exactly one object.

    A parser stops after the first value. Here the text is the first element of an array whose second
    one names the text's hash, so the parser has to come to the end of the text at the same depth:
    more than one object, an array, a bare value and whatever stands after the object are told apart.
    """
    mark = F.xxhash64(text).cast("string")
    whole = F.concat(F.lit("["), text, F.lit(',{"' + _MARK + '":"'), mark, F.lit('"}]'))
    found = F.from_json(whole, f"array<struct<{fields}, `{_MARK}` string>>", LENIENT_JSON)
    # Through a variable, so that the text is parsed once.
    ends = lambda all_: (F.size(all_) == 2) & (F.get(all_, 1)[_MARK] == F.get(F.array(mark), 0))
    first = lambda all_: F.get(all_, 0).dropFields(f"`{_MARK}`")
    return F.get(F.transform(F.array(found), lambda all_: F.when(ends(all_), first(all_))), 0)


def with_literals_as_text(text: Column, mark: str = _MARK) -> Column:
    """JSON text whose numbers and nulls are strings that begin with a mark.

    A parser keeps strings as they are, so every number comes out as it was written, whatever its
    digits and exponent, and null members can be told from all other text. Strings that begin with
    the mark themselves get another one. Texts without fractions, exponents, long numbers and nulls
    stay as they are. What is no valid number is left for the parser to refuse.
    """
    escaped = "".join(f"[{c}{c.upper()}]" for c in f"{ord(mark):04x}")
    # A quote that is written as an escape comes out as one, too.
    begins = rf"([\"']|(?<!\\)(?:\\\\)*+\\u002[27])(?={mark}|\\u{escaped})"
    # Plain searches first: they cost far less than a pattern that looks at every quote.
    may_begin = text.contains(mark) | text.contains("\\u")
    marked = F.when(may_begin, F.regexp_replace(text, begins, f"$1{mark}")).otherwise(text)
    return F.when(text.rlike(_AT_RISK), F.regexp_replace(marked, _LITERAL, f'$1"{mark}$2"')).otherwise(marked)


def as_written(text: Column, mark: str = _MARK) -> Column:
    """JSON text without blanks made from ``with_literals_as_text``: numbers and nulls as they were."""
    # What stands before a literal is looked at behind its mark, not at every place of the text.
    plain = F.regexp_replace(text, f'"{mark}(?<![^\\[,:]"{mark})([^"{mark}]*)"', "$1")
    return F.when(text.contains(mark * 2), _once_marked(plain, mark)).when(text.contains(mark), plain).otherwise(text)


def _once_marked(text: Column, mark: str) -> Column:
    return F.regexp_replace(text, f"([\"']){mark}{mark}", f"$1{mark}")


def scalar_as_written(text: Column, mark: str = _MARK) -> Column:
    """The text of a member read as a string from ``with_literals_as_text``; null for null."""
    own = F.substring(text, F.lit(2), F.length(text) - 1)
    scalar = F.when(own != "null", F.when(own.contains(mark * 2), _once_marked(own, mark)).otherwise(own))
    return F.when(F.startswith(text, F.lit(mark)), scalar).otherwise(as_written(text, mark))


def without_null_members(text: Column, mark: str = _MARK) -> Column:
    """JSON text made from ``with_literals_as_text``, less the members that are null, at every depth.

    Array elements stay. A null is a string no other text can be, and no unescaped quote but that of
    its name stands before it.
    """
    null = f'{_STRING}:"{mark}null"'
    followed = F.regexp_replace(text, f",{null}", "")
    plain = F.regexp_replace(followed, r"\{" + f"{null},?", "{")
    return F.when(text.contains(f':"{mark}null"'), plain).otherwise(text)


def without_keys(item: Column, *keys: str) -> Column:
    """A variant object as a map without the given keys and without null values.

    Null if the variant is no object.
    """
    members = item.try_cast("map<string,variant>")
    return F.map_filter(members, lambda k, v: ~k.isin(*keys) & ~F.is_variant_null(v))


def merge_objects(left: Column, right: Column) -> Column:
    """The members of two objects without common keys, both written without blanks."""
    return continued(opened(left), right)


def opened(text: Column) -> Column:
    """An object written without blanks, less its last brace."""
    return F.substring(text, F.lit(1), F.length(text) - 1)


def continued(head: Column, right: Column) -> Column:
    """The object that ``head`` opens (see ``opened``) with the members of another one put behind.

    The other one's first brace goes by trimming: no text starts with two, and none is counted through.
    """
    return (
        F.when(head == "{", right)
        .when(right == "{}", F.concat(head, F.lit("}")))
        .otherwise(F.concat(head, F.lit(","), F.ltrim(right, F.lit("{"))))
    )
