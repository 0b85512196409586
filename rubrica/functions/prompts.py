"""Rendering of prompts, judge messages and chat text."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rubrica import templates
from rubrica.functions.text import strip


def render(template: str, **values: Column) -> Column:
    """Fill every ``{name}`` of the template for the given names, in one pass.

    The template is cut on the driver, so a value that itself holds ``{name}`` is not expanded again and the plan is a
    single ``concat``. Other braces stay as they are.
    """
    if not values:
        return F.lit(template)
    pieces = re.split("(" + "|".join(re.escape("{%s}" % n) for n in values) + ")", template)
    columns = [values[p[1:-1]] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    return F.concat(*columns) if columns else F.lit("")


def message(role: str | Column, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def safety_judge_messages(request: Column, response: Column) -> Column:
    return F.array(
        message("system", F.lit(templates.SAFETY_JUDGE_SYSTEM)),
        message("user", render(templates.SAFETY_JUDGE_USER, request=request, response=response)),
    )


def chat_text(
    messages: Column,
    begin: str = templates.CHAT_BEGIN,
    role_open: str = templates.CHAT_ROLE_OPEN,
    role_close: str = templates.CHAT_ROLE_CLOSE,
    turn_end: str = templates.CHAT_TURN_END,
    add_generation_prompt: bool = True,
) -> Column:
    """Flatten ``ARRAY<STRUCT<role, content>>`` to the text a chat model is given; contents lose white space at both ends."""
    turns = F.transform(
        messages,
        lambda m: F.concat(F.lit(role_open), m["role"], F.lit(role_close), strip(m["content"]), F.lit(turn_end)),
    )
    tail = role_open + "assistant" + role_close if add_generation_prompt else ""
    return F.concat(F.lit(begin), F.array_join(turns, ""), F.lit(tail))


def pairwise_judge_prompt(instruction: Column, output_1: Column, output_2: Column) -> Column:
    return render(templates.PAIRWISE_JUDGE, instruction=instruction, output_1=output_1, output_2=output_2)
