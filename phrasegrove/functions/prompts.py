"""Naming prompts as expressions, and the reading of JSON answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two keys of an answer, and the record used when no answer is usable.
ANSWER_SCHEMA = "nome string, dor string"
FALLBACK = "ERRO"

_ANSWER_FORM = (
    'Reply with one JSON object and nothing else: {"nome": "<short name>", '
    '"dor": "<main pain or need>"}'
)

SYSTEM_TEXT = {
    1: "Below is a list of short messages. They were put together because they are near each "
    "other in meaning. Say in a few words what they have in common, and which difficulty or wish "
    "their writers share. " + _ANSWER_FORM,
    2: "Below are labels, each of which stands for many messages. Find one label under which all "
    "of them fit, and the difficulty or wish that runs through them. " + _ANSWER_FORM,
    3: "Below are labels of whole groups of messages. Find the one heading that someone deciding "
    "what to build next would file them under, and the need at the root of them. " + _ANSWER_FORM,
}

USER_TEXT = {
    1: "%d messages:",
    2: "%d labels of clusters:",
    3: "%d labels of groups:",
}


def bullet_list(items: str) -> Column:
    return F.concat_ws("\n", F.transform(items, lambda item: F.concat(F.lit("- "), item)))


def system_prompt(level: int) -> Column:
    """A level outside 1 to 3 takes the text of level 1."""
    return F.lit(SYSTEM_TEXT.get(level, SYSTEM_TEXT[1]))


def user_prompt(level: int, items: str) -> Column:
    """A level outside 1 to 3 takes the text of level 3."""
    head = F.format_string(USER_TEXT.get(level, USER_TEXT[3]), F.size(items))
    return F.concat(head, F.lit("\n\n"), bullet_list(items))


def parse_answer(answer: str) -> Column:
    """``struct<nome, dor, ok>``; an answer that lacks either key becomes the fallback record."""
    record = F.from_json(answer, ANSWER_SCHEMA)
    ok = record["nome"].isNotNull() & record["dor"].isNotNull()
    return F.struct(
        F.when(ok, record["nome"]).otherwise(FALLBACK).alias("nome"),
        F.when(ok, record["dor"]).otherwise(FALLBACK).alias("dor"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    )
