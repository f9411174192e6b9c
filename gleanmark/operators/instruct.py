"""Instruction records, chat messages and rendered prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmark.functions.text import _col

# ---- fixed values: prompts, as the exported files spell them ----------------
HIERARCHICAL_TASK = "Classify this customer support message into one of 27 intents."
FLAT_TASK = "Classify the following customer banking query into its intent."
HIERARCHICAL_SYSTEM = (
    "You are a customer support intent classifier. Given a customer message, "
    "output exactly two lines: 'Category: <CATEGORY>' then 'Intent: <intent>'. "
    "Do not add any other text."
)
FLAT_SYSTEM = (
    "You are a banking support intent classifier. Given a customer banking "
    "query, output exactly one line: 'Intent: <intent>'. "
    "Do not add any other text."
)
HIERARCHICAL_USER = "Classify the following customer message into its category and intent.\nMessage: "
FLAT_USER = "Classify the following customer banking query into its intent.\nQuery: "
# -----------------------------------------------------------------------------

# Default rendering of one message and of the cue for an answer; pass others to
# match another model's template.
MESSAGE_TEMPLATE = "<|im_start|>{role}\n{content}<|im_end|>\n"
ANSWER_CUE = "<|im_start|>assistant\n"


def hierarchical_record(
    text: str | Column, category: str | Column, label: str | Column, task: str = HIERARCHICAL_TASK
) -> Column:
    """``{instruction, input, output}`` with an upper-case category and a lower-case label."""
    answer = F.concat(
        F.lit("Category: "), F.upper(_col(category)), F.lit("\nIntent: "), F.lower(_col(label))
    )
    return F.struct(
        F.lit(task).alias("instruction"), _col(text).alias("input"), answer.alias("output")
    )


def flat_record(text: str | Column, label: str | Column, task: str = FLAT_TASK) -> Column:
    """``{instruction, input, output}`` with the label as it is."""
    return F.struct(
        F.lit(task).alias("instruction"),
        _col(text).alias("input"),
        F.concat(F.lit("Intent: "), _col(label)).alias("output"),
    )


def chat_messages(
    text: str | Column, answer: str | Column | None, system: str, user: str
) -> Column:
    """System and user message, and the assistant's answer when one is given."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = [
        message("system", F.lit(system)),
        message("user", F.concat(F.lit(user), _col(text))),
    ]
    if answer is not None:
        messages.append(message("assistant", _col(answer)))
    return F.array(*messages)


def render_chat(
    messages: str | Column,
    for_generation: bool = False,
    template: str = MESSAGE_TEMPLATE,
    cue: str = ANSWER_CUE,
) -> Column:
    """One text per conversation; ``for_generation`` ends with the answer cue."""
    before, rest = template.split("{role}")
    between, after = rest.split("{content}")
    body = F.array_join(
        F.transform(
            _col(messages),
            lambda m: F.concat(F.lit(before), m["role"], F.lit(between), m["content"], F.lit(after)),
        ),
        "",
    )
    return F.concat(body, F.lit(cue)) if for_generation else body


def json_line(record: str | Column) -> Column:
    """A record as one JSON line, non-ASCII characters left as they are."""
    return F.to_json(_col(record), {"ignoreNullFields": "false"})


def first_without_anchor(df: DataFrame, rendered: str | Column, anchor: str, row_id: str) -> DataFrame:
    """``row_id, rendered`` of the first text that lacks the anchor; no row when none does."""
    texts = df.select(row_id, _col(rendered).alias("rendered"))
    return texts.where(~F.col("rendered").contains(anchor)).orderBy(row_id).limit(1)


def anchor_presence(df: DataFrame, rendered: str | Column, anchor: str, row_id: str) -> DataFrame:
    """One row: texts, texts without the anchor, and the first such row."""
    lacks = ~_col(rendered).contains(anchor)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(lacks).alias("n_missing"),
        F.min(F.when(lacks, F.col(row_id))).alias("first_missing"),
        (F.count_if(lacks) == 0).alias("ok"),
    )
