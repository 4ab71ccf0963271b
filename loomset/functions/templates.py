"""Prompt templates and the way they are filled."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prompt texts and defaults below must match to the character.

DEFAULT_SYSTEM = "You are a helpful assistant."

ALPACA_INPUT = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"
)
ALPACA_PLAIN = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Response:\n{output}"
)

# The training loader's wording differs from the preparer's by runs of five spaces.
LOADER_ALPACA_INPUT = (
    "Below is an instruction that describes a task, paired with an input that provides     further context. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n{output}"
)
LOADER_ALPACA_PLAIN = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately     completes the request.\n\n"
    "### Instruction:\n{instruction}\n\n### Response:\n{output}"
)

CHATML = (
    "<|im_start|>system\n{system}<|im_end|>\n"
    "<|im_start|>user\n{user}<|im_end|>\n"
    "<|im_start|>assistant\n{assistant}<|im_end|>"
)
LLAMA = (
    "<|begin_of_text|>"
    "<|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>"
    "<|start_header_id|>user<|end_header_id|>\n\n{user}<|eot_id|>"
    "<|start_header_id|>assistant<|end_header_id|>\n\n{assistant}<|eot_id|>"
)

CUSTOM_CONTEXT = (
    "### System:\n{system}\n\n### Instruction:\n{instruction}\n\n"
    "### Context:\n{context}\n\n### Response:\n{response}"
)
CUSTOM_PLAIN = "### System:\n{system}\n\n### Instruction:\n{instruction}\n\n### Response:\n{response}"

SHAREGPT_NAMED_ROLES = ("system", "human", "user")
SHAREGPT_ASSISTANT_ROLES = ("gpt", "assistant")
SHAREGPT_SEPARATOR = "\n\n"

# End of fixed values.


def fill(template: str, **values: Column) -> Column:
    """Concatenate the template's literal parts with columns.

    Values never pass through a pattern or a format string, so braces, ``$``,
    ``%`` and backslashes in the data stay as they are.
    """
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field:
            parts.append(values[field])
    return F.concat(*parts)
