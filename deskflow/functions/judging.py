"""Rubric scores of replies, as column expressions."""

from pyspark.sql import Column, functions as F

from deskflow import fixed, schemas
from deskflow.functions.routing import contains_any
from deskflow.functions.text import round_binary, word_count

_BROKEN = "_broken"


def _scored(scores: dict[str, Column], explanation: Column) -> Column:
    mean = round_binary(sum((scores[n] for n in fixed.RUBRIC), F.lit(0)) / F.lit(4.0), 2)
    return F.struct(
        *[scores[n].alias(n) for n in fixed.RUBRIC], mean.alias("average_score"), explanation.alias("explanation")
    )


def heuristic_scores(reply: Column, limit: int = fixed.MAX_REPLY_WORDS) -> Column:
    """Struct of four scores and their mean, from length and key words of the reply."""
    reply = F.coalesce(reply, F.lit(""))
    return _scored({
        "correctness": F.when(word_count(reply) > limit, 4).otherwise(5),
        "helpfulness": F.when(contains_any(reply, fixed.HELPFUL_TOKENS), 5).otherwise(4),
        "brand_tone": F.when(contains_any(reply, fixed.TONE_TOKENS), 5).otherwise(4),
        "groundedness": F.when(F.length(reply) > 20, 5).otherwise(3),
    }, F.lit(fixed.HEURISTIC_EXPLANATION))


def parse_judge_answer(answer: Column, reply: Column) -> Column:
    """Scores of a JSON answer: a missing score is 4; an unreadable answer, or one with a score that is null or no number,
    gets the heuristic scores."""
    fields = ", ".join([f"{n} string" for n in schemas.JUDGE_ANSWER.names] + [f"{_BROKEN} string"])
    parsed = F.from_json(answer, fields, {"columnNameOfCorruptRecord": _BROKEN})
    numbers = {}
    unreadable = answer.isNull() | parsed[_BROKEN].isNotNull()
    given = F.coalesce(F.json_object_keys(answer), F.array().cast("array<string>"))
    for name in fixed.RUBRIC:
        number = parsed[name].try_cast("double")
        unreadable = unreadable | (F.array_contains(given, name) & number.isNull())
        numbers[name] = F.coalesce(number.cast("int"), F.lit(4))
    return F.when(unreadable, heuristic_scores(reply)).otherwise(_scored(numbers, parsed["explanation"]))


def human_mean(*scores: Column) -> Column:
    return round_binary(sum(scores[1:], scores[0]) / F.lit(float(len(scores))), 2)
