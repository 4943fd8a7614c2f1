"""Text to tokens and back, all as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordmill.functions.constants import STOPWORDS
from wordmill.functions.entities import entity_list, mark_entities, placeholder_text

def tokens_of_marked(marked: Column) -> Column:
    """Tokens of a marked text: what remains between characters that are no letter, ``<``, ``>``."""
    return F.regexp_extract_all(placeholder_text(marked), F.lit("[a-zA-Z<>]++"), F.lit(0))


def tokenize(text: Column) -> Column:
    """Cleaned tokens of a raw text."""
    return tokens_of_marked(mark_entities(text))


def clean_text(text: Column) -> Column:
    """Cleaned text: lower case, placeholders for entities, letters only, single blanks."""
    return join_tokens(tokenize(text))


def extract_entities(text: Column, kind: str) -> Column:
    return entity_list(mark_entities(text), kind)


def remove_stopwords(tokens: Column, stopwords: list[str] | None = None) -> Column:
    """Tokens that are no stopword. Tokens of the shape ``<...>`` always stay."""
    words = STOPWORDS if stopwords is None else stopwords
    droppable = [w for w in words if not (w.startswith("<") and w.endswith(">"))]
    return F.filter(tokens, lambda t: ~t.isin(droppable))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def split_on_blank(text: Column) -> Column:
    """Split on each single blank; an empty or missing text has one empty token."""
    return F.split(F.coalesce(text, F.lit("")), " ")


def split_on_whitespace(text: Column) -> Column:
    """Split on runs of whitespace; an empty or missing text has no token."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)[^\s\x1c-\x1f]++"), F.lit(0))


def split_on_word_pattern(text: Column) -> Column:
    """Lower-cased runs of two or more word characters; placeholders lose their brackets."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0)
    )


def format_entities(entities: Column) -> Column:
    """Entities as one ``"; "``-joined string in which numeric parts are normalised.

    The joined string is cut at every ``;`` again. A part that reads as a number is rewritten
    (``007`` becomes ``7``); any other part keeps its blanks, so text entities from the second on
    show two blanks.
    """
    parts = F.split(F.array_join(entities, "; "), ";")
    return F.array_join(F.transform(parts, _format_part), "; ")


def _format_part(part: Column) -> Column:
    trimmed = F.trim(part)
    negative = trimmed.startswith("-")
    decimal_number = trimmed.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?$")
    value = F.when(decimal_number, trimmed.try_cast("double"))
    magnitude = F.abs(value)
    infinite = (magnitude == float("inf")) | trimmed.rlike(r"^[+-]?inf(?:inity)?$")
    sign = F.when(negative, F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(infinite, F.when(negative, F.lit("-inf")).otherwise(F.lit("inf")))
        .when(trimmed.rlike(r"^[+-]?nan$"), F.lit("NaN"))
        .when(value.isNull(), part)
        .when(magnitude == F.rint(magnitude), F.concat(sign, _integral_digits(magnitude)))
        .otherwise(F.concat(sign, _fraction_digits(magnitude)))
    )


def _integral_digits(magnitude: Column) -> Column:
    """All digits of an integral double, exactly."""
    return F.when(magnitude < float(2**63), magnitude.cast("bigint").cast("string")).otherwise(
        _large_digits(magnitude)
    )


_LIMB = 10**9  # a limb times 2**30 and a carry fit a long


def _large_digits(magnitude: Column) -> Column:
    """Digits of ``mantissa * 2**exponent``, multiplied out in limbs of nine digits."""
    # One bit below the leading 53, so that a rounded logarithm does not cut a bit off.
    exponent = F.floor(F.log2(magnitude)).cast("int") - 53
    mantissa = (magnitude / F.pow(F.lit(2.0), exponent)).cast("bigint")
    limbs = F.array(mantissa % _LIMB, F.call_function("div", mantissa, F.lit(_LIMB)))
    steps = F.transform(
        F.sequence(F.lit(0), F.floor(exponent / 30).cast("int")),
        lambda i: F.pow(F.lit(2.0), F.least(F.lit(30), exponent - i * 30)).cast("bigint"),
    )
    product = F.aggregate(steps, limbs, _times)
    text = F.array_join(F.transform(F.reverse(product), lambda x: F.lpad(x.cast("string"), 9, "0")), "")
    return F.regexp_replace(text, "^0+", "")


def _times(limbs: Column, factor: Column) -> Column:
    """Limbs, lowest first, times a factor of at most 2**30."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, limb: Column) -> Column:
        whole = limb * factor + acc["carry"]
        carry, rest = F.call_function("div", whole, F.lit(_LIMB)), whole % F.lit(_LIMB)
        return F.struct(carry.alias("carry"), F.concat(acc["out"], F.array(rest)).alias("out"))

    # Two more limbs of zero take up the last carry.
    zero = F.lit(0).cast("bigint")
    return F.aggregate(F.concat(limbs, F.array(zero, zero)), start, step, lambda acc: acc["out"])


def _fraction_digits(magnitude: Column) -> Column:
    """Shortest digits of a fractional double, never in exponent form: the point moves in the text."""
    text = magnitude.cast("string")
    form = r"^([0-9])\.([0-9]+)E(-?[0-9]+)$"
    digits = F.regexp_replace(F.concat(F.regexp_extract(text, form, 1), F.regexp_extract(text, form, 2)), "0+$", "")
    power = F.regexp_extract(text, form, 3).try_cast("int")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    large = F.concat(digits.substr(F.lit(1), power + 1), F.lit("."), digits.substr(power + 2, F.length(digits)))
    return F.when(power.isNull(), text).when(power < 0, small).otherwise(large)


def term_counts(tokens: Column) -> Column:
    """``array<struct<token, tf>>`` of one document, counted inside its row.

    Sorting the tokens puts equal ones side by side, so counts are distances between run starts;
    no row leaves its partition.
    """
    return _with_value(F.sort_array(tokens), lambda ordered: _runs(ordered))


def _runs(ordered: Column) -> Column:
    starts = F.filter(
        F.transform(
            ordered, lambda t, i: F.when((i == 0) | (F.get(ordered, i - 1) != t), i)
        ),
        lambda i: i.isNotNull(),
    )
    return _with_value(
        starts,
        lambda begun: F.transform(
            begun,
            lambda start, k: F.struct(
                F.get(ordered, start).alias("token"),
                (F.coalesce(F.get(begun, k + 1), F.size(ordered)) - start).cast("bigint").alias("tf"),
            ),
        ),
    )


def _with_value(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where lambdas inside refer to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
