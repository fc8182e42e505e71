"""Text expressions: everything here is a Column built of Spark functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(x: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once a row: used by name in several places, Catalyst would write it out in each of them."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def squeezed(x: Column | str) -> Column:
    """White space runs of any script to one space, none at the ends."""
    return F.trim(F.regexp_replace(col(x), r"(?U)\s+", " "))


def normalized(x: Column | str) -> Column:
    return squeezed(F.lower(F.coalesce(col(x), F.lit(""))))


def stripped(x: Column | str) -> Column:
    return F.regexp_replace(col(x), r"(?U)^\s+|\s+$", "")


def slug(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any(x: Column | str, phrases: Iterable[str]) -> Column:
    """Substring tests, not word tests."""
    return any_of(col(x).contains(p) for p in phrases)


def has_word(x: Column | str, word: str) -> Column:
    """The word between spaces, or at an end."""
    return F.concat(F.lit(" "), col(x), F.lit(" ")).contains(f" {word} ")


def tokens(x: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(x)), F.lit("[a-z0-9]+"), F.lit(0))


def filled(x: Column | str) -> Column:
    """null for null and empty strings."""
    return F.nullif(col(x), F.lit(""))


def base_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def stem(path: Column | str) -> Column:
    """The file name without its last suffix; names that begin with their only dot stay."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def cut(x: Column | str, most: int, mark: str) -> Column:
    """The first `most` characters and a mark, if there are more."""
    return F.when(F.length(col(x)) > most, F.concat(F.left(col(x), F.lit(most)), F.lit(mark))).otherwise(col(x))


def truncated(x: Column | str, most: int, mark: str = " [truncated]") -> Column:
    """At most `most` characters with the mark; white space before the mark goes."""
    head = F.regexp_replace(F.left(col(x), F.lit(max(0, most - len(mark)))), r"(?U)\s+$", "")
    return F.when(F.length(col(x)) > most, F.concat(head, F.lit(mark))).otherwise(col(x))


def similarity_text(question: Column, answer: Column, context: Column | None = None, mode: str = "qa_concat", most: int = 0) -> Column:
    """The text of an example by mode: question_only, answer_only, or both under headings."""
    question, answer = (stripped(F.coalesce(x, F.lit(""))) for x in (question, answer))
    parts = []
    if mode != "answer_only":
        parts.append((question, "Question: "))
    if mode != "question_only":
        parts.append((answer, "Answer: "))
    if context is not None:
        parts.append((stripped(F.coalesce(context, F.lit(""))), "Context: "))
    if mode in ("question_only", "answer_only") and context is None:
        text = parts[0][0]
    else:
        text = F.concat_ws("\n", *[F.when(x != "", F.concat(F.lit(h), x)) for x, h in parts])
    return truncated(text, most) if most else text


def md5_modulo(x: Column | str, n: int) -> Column:
    """The md5 as a number, modulo n, digit by digit so that no step overflows."""
    digest = F.md5(col(x))
    digits = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.conv(F.substr(digest, i * 8 + 1, F.lit(8)), 16, 10).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: (a * 4294967296 + d) % n)
