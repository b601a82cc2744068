"""Numbers and structured readings out of model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notevalue.functions import fixed

# How a reply is read: which match counts, and what is removed before matching.
RULES = ("first", "last", "unstripped", "clamped")

TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")


def _number(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def parse_guess(reply: Column, rule: str = "first") -> Column:
    """The number a reply states; 0 when it states none.

    `first` and `last` drop dollar signs and thousands separators, `unstripped` reads the text
    after the last answer prefix as it stands, `clamped` keeps the result inside [0, 1000].
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if rule == "clamped":
        plain = F.regexp_replace(reply, r"\$", "")
        found = F.regexp_replace(F.regexp_extract(plain, fixed.NUMBER_WITH_COMMAS, 0), ",", "")
        return F.greatest(F.lit(0.0), F.least(F.lit(fixed.HIGHEST_GUESS), _number(found)))
    if rule == "unstripped":
        return _number(F.regexp_extract(F.substring_index(reply, fixed.PREFIX, -1), fixed.NUMBER, 0))
    plain = F.regexp_replace(reply, r"[$,]", "")
    if rule == "first":
        return _number(F.regexp_extract(plain, fixed.NUMBER, 0))
    return _number(F.try_element_at(F.regexp_extract_all(plain, F.lit(fixed.NUMBER), F.lit(0)), F.lit(-1)))


def field_type(parsed: Column, path: str) -> Column:
    """The JSON type of a field, null when the field is absent."""
    return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))


def whole_number(parsed: Column, path: str, low: int, high: int) -> Column:
    """A field read as an integer in `[low, high]`: numbers, numeric strings and booleans count
    when their value is whole; anything else is null."""
    kind = field_type(parsed, path)
    value = F.try_variant_get(parsed, path, "double")
    scalar = ~kind.startswith("ARRAY") & ~kind.startswith("OBJECT")
    return F.when(scalar & (value == F.floor(value)) & value.between(low, high), value.cast("bigint"))


def truth(parsed: Column, path: str) -> Column:
    """A field read as a boolean: JSON booleans, 0 and 1, and the usual words."""
    kind = field_type(parsed, path)
    word = F.lower(F.try_variant_get(parsed, path, "string"))
    number = F.try_variant_get(parsed, path, "double")
    numeric = (kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(parsed, path, "boolean"))
        .when(numeric & (number == 1), F.lit(True))
        .when(numeric & (number == 0), F.lit(False))
        .when((kind == "STRING") & word.isin(*TRUE_WORDS), F.lit(True))
        .when((kind == "STRING") & word.isin(*FALSE_WORDS), F.lit(False))
    )


def string(parsed: Column, path: str) -> Column:
    """A field that must be a JSON string."""
    return F.when(field_type(parsed, path) == "STRING", F.try_variant_get(parsed, path, "string"))


def tasting(parsed: Column, root: str = "$") -> Column:
    """The structured reading under `root`, or null unless every field is valid."""
    scores = {
        name: whole_number(parsed, f"{root}.{name}", fixed.LOWEST_SCORE, fixed.HIGHEST_SCORE)
        for name in fixed.DIMENSIONS
    }
    fields = {**scores, "age_worthy": truth(parsed, f"{root}.age_worthy"), "summary": string(parsed, f"{root}.summary")}
    complete = F.lit(True)
    for value in fields.values():
        complete = complete & value.isNotNull()
    return F.when(complete, F.struct(*[value.alias(name) for name, value in fields.items()]))


def tasting_text(reading: Column) -> Column:
    """Summary, then the scores on one line, with the boolean spelled True or False."""
    scores = [F.concat(F.lit(f"{name}="), reading[name].cast("string")) for name in fixed.DIMENSIONS]
    worthy = F.when(reading["age_worthy"], F.lit("True")).otherwise(F.lit("False"))
    line = F.concat_ws(" ", *scores, F.concat(F.lit("age_worthy="), worthy))
    return F.when(reading.isNotNull(), F.concat(reading["summary"], F.lit("\n"), line))
