"""Drafting replies and filling prompts, as column expressions.

``neighbours`` is array<struct<similarity, tweet, apple_reply, intent>>, best first.
"""

import re

from pyspark.sql import Column, functions as F

from deskflow import fixed
from deskflow.functions.text import SPACE_CLASS, fixed_point, word_count, words


def cap_words(c: Column, limit: int = fixed.MAX_REPLY_WORDS) -> Column:
    """Text of at most ``limit`` words is kept; a longer one is cut, tidied and closed by a full stop."""
    cut = F.array_join(F.slice(words(c), 1, limit), " ")
    cut = F.regexp_replace(cut, rf"[,;:\-{SPACE_CLASS}]+$", "")
    closed = F.when(F.right(cut, F.lit(1)).isin(".", "!", "?"), cut).otherwise(F.concat(cut, F.lit(".")))
    return F.when(word_count(c) <= limit, c).otherwise(closed)


def _blocks(neighbours: Column, block, empty: str) -> Column:
    joined = F.array_join(F.transform(neighbours, block), "\n\n")
    return F.when(F.coalesce(F.size(neighbours), F.lit(0)) > 0, joined).otherwise(F.lit(empty))


def context_block(neighbours: Column) -> Column:
    """Numbered examples with intent and relevance."""
    return _blocks(
        neighbours,
        lambda n, i: F.concat(
            F.lit("[Example "), (i + 1).cast("string"), F.lit("] (Intent: "), F.coalesce(n["intent"], F.lit("unknown")),
            F.lit(", Relevance: "), fixed_point(F.coalesce(n["similarity"], F.lit(0.0)), 2),
            F.lit(")\nCustomer: "), n["tweet"], F.lit("\nApple Support Reply: "), n["apple_reply"],
        ),
        fixed.NO_CONTEXT,
    )


def prompt_examples(neighbours: Column) -> Column:
    """Numbered question / answer examples."""
    return _blocks(
        neighbours,
        lambda n, i: F.concat(
            F.lit("Example "), (i + 1).cast("string"), F.lit(":\nQ: "), n["tweet"], F.lit("\nA: "), n["apple_reply"]
        ),
        fixed.NO_EXAMPLES,
    )


def fill(template: str, **values: Column) -> Column:
    """Text template with ``{name}`` fields filled from columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[
        F.coalesce(values[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)
    ])


def reply_prompt(tweet: Column, intent: Column, context: Column) -> Column:
    return fill(fixed.REPLY_PROMPT, tweet=tweet, intent=intent, context=context)


def judge_prompt(tweet: Column, intent: Column, gold_reply: Column, generated_reply: Column) -> Column:
    return fill(fixed.JUDGE_PROMPT, tweet=tweet, intent=intent, gold_reply=gold_reply,
                generated_reply=generated_reply)


def draft_reply(neighbours: Column, limit: int = fixed.MAX_REPLY_WORDS) -> Column:
    """Reply of the best neighbour within the word limit, or a fixed sentence when there is none."""
    best = F.get(neighbours, F.lit(0))["apple_reply"]
    return F.coalesce(cap_words(best, limit), F.lit(fixed.DEFAULT_REPLY))
