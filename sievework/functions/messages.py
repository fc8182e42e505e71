"""Conversations: the four rules for a question, answers, and question-answer pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import base_name, filled, stripped


def first_content(messages: Column) -> Column:
    """The first message with content, of any role."""
    return F.get(F.filter(F.transform(messages, lambda m: stripped(F.coalesce(m["content"], F.lit("")))), lambda c: c != ""), F.lit(0))


def _of_role(messages: Column, role: str, *gone: str) -> Column:
    def content(m: Column) -> Column:
        c = F.coalesce(m["content"], F.lit(""))
        for x in gone:
            c = F.replace(c, F.lit(x), F.lit(""))
        return stripped(c)

    return F.transform(F.filter(messages, lambda m: m["role"] == role), content)


def question(messages: Column) -> Column:
    """The first user message with content besides image marks; empty if none."""
    return F.coalesce(F.get(F.filter(_of_role(messages, "user", "<image>"), lambda c: c != ""), F.lit(0)), F.lit(""))


def strict_question(messages: Column) -> Column:
    """The first user message, even if it is blank."""
    return F.coalesce(F.get(_of_role(messages, "user", "<image>"), F.lit(0)), F.lit(""))


def questions(messages: Column) -> Column:
    return F.filter(_of_role(messages, "user"), lambda c: c != "")


def answer(messages: Column) -> Column:
    return F.get(F.filter(_of_role(messages, "assistant"), lambda c: c != ""), F.lit(0))


def image_path(image: Column, images: Column, images_source: Column, root: str = "") -> Column:
    first = F.coalesce(image, F.when(F.size(images) > 0, F.get(images, F.lit(0))), F.when(F.size(images_source) > 0, F.get(images_source, F.lit(0))), F.lit(""))
    return F.when(first == "", "").otherwise(F.concat(F.lit(root.rstrip("/") + "/"), base_name(first))) if root else first


def pairs(qas: Column | None, flat_question: Column, flat_answer: Column, messages: Column | None = None) -> Column:
    """Questions with answers of a record: the list of pairs, else the flat fields, else the messages, else one empty pair."""
    pair = lambda q, a: F.struct(stripped(F.coalesce(q, F.lit(""))).alias("question"), stripped(a).alias("answer"))
    flat = pair(flat_question, flat_answer)
    if messages is not None:
        own = F.struct(question(messages).alias("question"), answer(messages).alias("answer"))
        flat = F.when(filled(flat["question"]).isNull() & messages.isNotNull(), own).otherwise(flat)
    if qas is None:
        return F.array(flat)
    listed = F.filter(F.transform(qas, lambda x: pair(x["question"], x["answer"])), lambda x: x["question"] != "")
    return F.when(F.size(listed) > 0, listed).otherwise(F.array(flat))
