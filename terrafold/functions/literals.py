"""Dict literals in texts, read by expressions alone: a tokeniser of strings, numbers, names and nesting.

A text is cut into tokens by one pattern. Escapes of strings are undone piece by
piece, names and tuples get their JSON forms, and the result is read as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings in either quotes, with escapes; numbers; names; punctuation; blanks. No group repeats what another may match, so long strings need no deep stack.
_SINGLE, _DOUBLE = r"'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'", r'"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
_NUMBER = r"[-+]?(?:\d+(?:_\d+)*+\.?\d*+|\.\d++)(?:[eE][-+]?\d++)?"
_TOKEN = rf"(?s)[uU]?(?:{_SINGLE}|{_DOUBLE})|{_NUMBER}|\w++|,\s*+[\}}\]\)]|[\{{\}}\[\]\(\):,]|\s++|."
_PIECE = r"(?s)[^\\]++|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\[0-7]{1,3}|\\."
#: Escapes of one letter.
_LETTERS = {"\\n": "\n", "\\r": "\r", "\\t": "\t", "\\a": "\a", "\\b": "\b", "\\f": "\f", "\\v": "\v", "\\\\": "\\", "\\'": "'", '\\"': '"', "\\\n": ""}


def _code_point(digits: Column) -> Column:
    """The character of a code point in hex digits."""
    return F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32")


def _unescaped(text: Column) -> Column:
    """What a string's inside stands for."""

    def piece(p: Column) -> Column:
        letter = F.create_map(*(F.lit(x) for pair in _LETTERS.items() for x in pair))[p]
        octal = F.conv(F.substr(p, F.lit(2)), 8, 16)
        coded = F.when(p.rlike(r"^\\[xuU][0-9a-fA-F]{2,}$"), _code_point(F.substr(p, F.lit(3)))).when(p.rlike(r"^\\[0-7]+$"), _code_point(octal))
        return F.when(~p.startswith("\\"), p).otherwise(F.coalesce(letter, coded, p))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), piece), "")


def _json(token: Column) -> Column:
    """A token's JSON form."""
    bare = F.regexp_replace(token, "^[uU]", "")
    inside = F.substr(bare, F.lit(2), F.length(bare) - 2)
    text = F.to_json(F.array(_unescaped(inside)))
    string = F.substr(text, F.lit(2), F.length(text) - 2)
    number = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "_", ""), r"^\+", ""), r"\.$", ".0")
    number = F.regexp_replace(F.regexp_replace(number, r"^(-?)\.", "$10."), r"\.(?=[eE])", ".0")
    mark = F.regexp_replace(token, r"^,\s*(?=[\}\]\)])", "")
    names = F.create_map(*(F.lit(x) for x in ("None", "null", "True", "true", "False", "false", "(", "[", ")", "]")))
    return F.when(token.rlike(f"^[uU]?(?:{_SINGLE}|{_DOUBLE})$"), string).when(token.rlike(f"^{_NUMBER}$"), number).otherwise(F.coalesce(names[mark], mark))


def literal_json(text: Column) -> Column:
    """The JSON form of a literal of dicts, lists, tuples, strings, numbers, True, False and None.

    Commas before a closing bracket go. Bytes, sets, triple quotes, joined strings and numbers to other bases are not
    read. A text that is no such literal gives something that is no JSON, which from_json makes NULL.
    """
    tokens = F.filter(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda t: ~t.rlike(r"^\s+$"))
    # blanks between tokens, or two of them would make one
    return F.array_join(F.transform(tokens, _json), " ")


def literal_map(text: Column) -> Column:
    """A dict literal with texts as keys, as a map of texts: strings as they are, None NULL, all else in JSON. NULL if it is no such literal."""
    # in a list, since what follows a whole value would be passed over
    found = F.from_json(F.concat(F.lit("["), literal_json(text), F.lit("]")), "array<map<string,string>>")
    return F.when(F.size(found) == 1, found[0])
