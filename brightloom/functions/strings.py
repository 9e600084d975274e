"""String expressions. All stay inside the JVM; null in gives null out unless noted."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unicode-aware non-word run. Java's \W is ASCII only, this one is not.
NON_WORD = r"[^\p{L}\p{N}_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def entity_from_path(path: Column | str) -> Column:
    """Upper-cased file name without folder and last extension; either slash splits."""
    return F.upper(F.regexp_extract(_col(path), r"([^/\\]+)\.[^./\\]*$", 1))


def split_single_space(text: Column | str) -> Column:
    """Split at every single space; doubled spaces leave empty strings."""
    return F.split(_col(text), " ")


def split_whitespace(text: Column | str) -> Column:
    """Split at runs of whitespace without empty strings."""
    return F.filter(F.split(_col(text), r"\s+"), lambda w: w != "")


def split_non_word(text: Column | str) -> Column:
    """Split at runs of characters that are neither letter, digit nor underscore."""
    return F.split(_col(text), NON_WORD)


def nth_part(text: Column | str, delimiter: str, n: int) -> Column:
    """The n-th (from 0) part around a literal delimiter, null if there are fewer."""
    return F.get(F.split(_col(text), "\\Q" + delimiter + "\\E"), F.lit(n))


def strip_chars(text: Column | str, chars: str = " \t\n\r\x0b\x0c") -> Column:
    """Remove the given characters from both ends."""
    return F.btrim(_col(text), F.lit(chars))


def remove_literal(text: Column | str, marker: str) -> Column:
    """Remove every occurrence of a literal."""
    return F.replace(_col(text), F.lit(marker), F.lit(""))


def parenthesised_count(text: Column | str) -> Column:
    """From after the first ``(`` up to the last character exclusive, ``'0'`` for null.
    Without a bracket the text only loses its last character."""
    c = _col(text)
    at = F.locate("(", c)
    inner = c.substr(at + 1, F.greatest(F.length(c) - at - 1, F.lit(0)))
    return F.coalesce(inner, F.lit("0"))


def recommendation_lines(text: Column | str) -> dict[str, Column]:
    """Split a block of one to three lines into recommends, outlook and CEO approval.

    Line 1 recommends. A second line is the outlook unless it names the CEO.
    CEO approval is line 3 of three, or line 2 of two when it names the CEO.
    """
    lines = F.split(_col(text), "\n")
    n = F.size(lines)
    second, third = F.get(lines, F.lit(1)), F.get(lines, F.lit(2))
    names_ceo = second.contains("CEO")
    return {
        "recommends": F.get(lines, F.lit(0)),
        "outlook": F.when(n.isin(2, 3) & ~names_ceo, second),
        "ceo_approval": F.when(n == 3, third).when((n == 2) & names_ceo, second),
    }


def contains_ci(text: Column | str, needle: str) -> Column:
    """Case-insensitive contains; null counts as false."""
    return F.coalesce(F.lower(_col(text)).contains(needle.lower()), F.lit(False))


def has_hash(token: Column | str) -> Column:
    """``#`` anywhere in the token."""
    return _col(token).contains("#")


def is_alphabetic(token: Column | str) -> Column:
    return _col(token).rlike(r"^\p{L}+$")


def is_digits(token: Column | str) -> Column:
    return _col(token).rlike("^[0-9]+$")


def joined_length(*texts: Column | str, per: float = 1.0) -> Column:
    """Sum of the character counts, divided by `per`; null if any text is null."""
    total = F.length(_col(texts[0]))
    for t in texts[1:]:
        total = total + F.length(_col(t))
    return total / F.lit(per) if per != 1.0 else total


def labelled_concat(*parts: Column | str) -> Column:
    """Null-propagating concatenation; plain strings are literals, use F.col for columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def with_suffix(number: Column | str, suffix: str) -> Column:
    return F.concat(_col(number).cast("string"), F.lit(suffix))


def employment_status(text: Column | str) -> Column:
    """``ex`` when the tenure text says worked, else ``current``; null stays null."""
    c = _col(text)
    return F.when(c.isNull(), None).when(contains_ci(c, "worked"), "ex").otherwise("current")


def employment_type(text: Column | str) -> Column:
    c = _col(text)
    return (F.when(contains_ci(c, "full-time"), "full-time")
            .when(contains_ci(c, "part-time"), "part-time")
            .when(c.isNotNull(), "unknown"))


def tenure_years(text: Column | str) -> Column:
    """Sum of the all-digit tokens, ``a year`` counts as 1; ``more`` adds a half,
    otherwise ``less`` takes a half off."""
    c = _col(text)
    digits = F.filter(split_whitespace(c), is_digits)
    total = F.aggregate(digits, F.lit(0.0), lambda acc, w: acc + w.cast("double"))
    years = F.when(contains_ci(c, "a year"), F.lit(1.0)).otherwise(total)
    shift = (F.when(contains_ci(c, "more"), 0.5).when(contains_ci(c, "less"), -0.5)
             .otherwise(0.0))
    return F.when(c.isNotNull(), years + shift)
