"""Row-level cleaning. Every function is one projection or filter, without actions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from terrafold.functions.literals import literal_map

#: Names that stand for merged or renamed provinces.
PROVINCE_ALIASES = {"Huế": "Thừa Thiên Huế", "Vũng Tàu": "Bà Rịa Vũng Tàu"}


def _folding() -> tuple[str, str]:
    """Every lower-case Latin letter that decomposes into a letter and combining marks, and that letter. đ does not decompose."""
    letters = [chr(c) for c in range(0xC0, 0x1EFA) if unicodedata.name(chr(c), "").startswith("LATIN SMALL")]
    plain = [unicodedata.normalize("NFD", x)[0] for x in letters]
    pairs = [(a, b) for a, b in zip(letters, plain, strict=True) if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _folding()


def _strings(df: DataFrame, change) -> DataFrame:
    """change applied to every string column, in one projection."""
    return df.select([change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema.fields])


def trim_strings(df: DataFrame) -> DataFrame:
    return _strings(df, F.trim)


def invalid_to_null(df: DataFrame, invalid: tuple[str, ...] = ("", "0")) -> DataFrame:
    """NULL where a trimmed text is one of invalid."""
    return _strings(df, lambda c: F.when(~F.trim(c).isin(*invalid), c))


def empty_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in columns})


def require(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all columns, and the others with the first column that is missing as reject_reason."""
    missing = F.coalesce(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns))
    return df.dropna(subset=columns), df.filter(missing.isNotNull()).withColumn("reject_reason", missing)


def has_web_scheme(url: Column) -> Column:
    return url.startswith("http://") | url.startswith("https://")


def path_safe(text: Column, keep_comma: bool = False, fill: str = " ") -> Column:
    """Without characters that paths of partitions can't hold."""
    marks = r'+/\\:*?"<>|' if keep_comma else r'+,/\\:*?"<>|'
    return F.trim(F.regexp_replace(text, f"[{marks}]", fill))


def aliased(text: Column, names: dict[str, str]) -> Column:
    """names[text], else text."""
    out = text
    for key in names:
        out = F.when(text == key, names[key]).otherwise(out)
    return out


def mapped(text: Column, names: dict[str, str]) -> Column:
    """The same by a literal map, for many names."""
    pairs = [F.lit(x) for pair in sorted(names.items()) for x in pair]
    return F.coalesce(F.create_map(*pairs)[text], text)


def in_enum(text: Column, values: list[str]) -> Column:
    """NULL or one of values; rows shifted by a broken CSV line fail this."""
    return text.isNull() | text.isin(*values)


def clean_list(text: Column) -> Column:
    """A comma list without empty members, trailing comma and 'show all' tail."""
    t = F.regexp_replace(text, r"\s+", " ")
    t = F.regexp_replace(t, r",?\s*Xem tất cả \d+ tiện nghi\s*$", "")
    t = F.regexp_replace(t, r",(\s*,)+", ",")
    return F.trim(F.regexp_replace(t, r"\s*,\s*$", ""))


def clean_text(text: Column) -> Column:
    """Free text: tags, urls, newlines and symbols as blanks; lower case; single spaces. The patterns are fixed values.

    Texts without a trace of a tag or url skip those passes; symbols and white space go in one.
    """
    t = F.trim(text)
    t = F.when(t.contains("<"), F.regexp_replace(t, r"<[^>]+>", " ")).otherwise(t)
    t = F.when(t.contains("http") | t.contains("www."), F.regexp_replace(t, r"http\S+|www\.[^\s]+", " ")).otherwise(t)
    return F.trim(F.lower(F.regexp_replace(t, r"(?:[^\p{L}\p{N}\p{P}\p{Z}]|\s)++", " ")))


def strip_handle(text: Column) -> Column:
    """'@name' without the @, trimmed."""
    return F.regexp_replace(F.trim(text), "^@", "")


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.regexp_replace(text, f"^{prefix}", "")


def fold_accents(text: Column) -> Column:
    """Lower case, accents folded, single spaces."""
    plain = F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{Mn}+", "")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def flatten_pairs(text: Column) -> Column:
    """\"{'a': '1', 'b': ''}\" as 'a: 1'; NULL where nothing is left or the text is no such literal. See literal_map."""
    kept = F.filter(F.map_entries(literal_map(text)), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.nullif(F.concat_ws(", ", F.transform(kept, lambda e: F.concat_ws(": ", e["key"], e["value"]))), F.lit(""))


def guarded_ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def smoothed_ratio(a: Column, b: Column) -> Column:
    return a / (b + 1.0)


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def unify_columns(df: DataFrame) -> DataFrame:
    """Column names stripped, lower-cased, blanks as underscores."""
    return df.toDF(*(c.strip().replace(" ", "_").lower() for c in df.columns))
