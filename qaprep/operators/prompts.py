"""Prompt rendering: templates compiled to one ``concat`` per variant.

A template is data: a list of literal strings and column references.  The
eight (family x context kind) variants are one ``explode`` over an array of
structs, so the whole matrix is a single projection inside whole-stage
codegen.  Contexts are never null when rendered (``concat`` would null the
whole prompt); a missing context drops that variant row instead.
"""

from __future__ import annotations

import string
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def render(template: str, cols: Mapping[str, Column]) -> Column:
    """``str.format``-style template -> one ``concat`` Column."""
    parts = []
    for literal, field, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(cols[field])
    return F.concat(*parts) if parts else F.lit("")


def plain_prompt(question: Column) -> Column:
    return render("{head}\n### Question:\n{q}\n\n### Response:\n",
                  {"head": F.lit(K.PLAIN_HEAD), "q": question})


def plain_prompt_with_context(question: Column, context: Column) -> Column:
    """Intended form of the context variants: context, blank line, question
    in the question slot (the surveyed script printed a tuple there)."""
    return render("{head}\n### Question:\n{c}\n\n{q}\n\n### Response:\n",
                  {"head": F.lit(K.PLAIN_HEAD), "c": context, "q": question})


def template(family: str, with_context: bool) -> str:
    """Chat template of a model family, with the places ``{q}`` and ``{c}``."""
    body = "{c}\n\n{q}" if with_context else "{q}"
    if family == "gemma":
        return K.GEMMA_USER + "\n" + body + K.GEMMA_EOT + "\n" + K.GEMMA_MODEL
    return K.LLAMA_USER + " " + K.LLAMA_SYSTEM + "\n" + body + K.LLAMA_EOT


def gemma_prompt(question: Column, context: Column | None = None) -> Column:
    return render(template("gemma", context is not None), {"q": question, "c": context})


def llama_prompt(question: Column, context: Column | None = None) -> Column:
    return render(template("llama", context is not None), {"q": question, "c": context})


def context_question(context: Column, question: Column) -> Column:
    return render(K.CONTEXT_QUESTION, {"context": context, "question": question})


def instruction_prompt(instruction: Column, inp: Column) -> Column:
    """Short template when ``input`` is empty, long template otherwise."""
    return F.when(inp == "", render(K.INSTRUCTION_NO_INPUT, {"instruction": instruction})) \
        .otherwise(render(K.INSTRUCTION_WITH_INPUT, {"instruction": instruction, "input": inp}))


def ensure_suffix(c: Column, suffix: str = K.EOS) -> Column:
    """Append ``suffix`` unless the text already ends with it."""
    return F.when(c.endswith(suffix), c).otherwise(F.concat(c, F.lit(suffix)))


def prompt_matrix(df: DataFrame, keep: Sequence[str] = ("idx", "type", "source", "answer"),
                  families: Sequence[str] = tuple(K.FAMILIES),
                  kinds: Sequence[str] = tuple(K.CONTEXT_KINDS)) -> DataFrame:
    """Long form: one row per (row, family, context kind) with its prompt.

    A row without a question has no prompt, and a variant whose context is null
    has none either: these rows are left out."""
    q = F.col("question")
    variants = []
    for fam in families:
        fn = gemma_prompt if fam == "gemma" else llama_prompt
        for kind in kinds:
            ctx = None if kind == "no_context" else F.col(kind)
            p = fn(q) if ctx is None else fn(q, ctx)
            variants.append(F.struct(F.lit(fam).alias("family"), F.lit(kind).alias("context_kind"),
                                     p.alias("prompt")))
    out = df.select(*keep, F.explode(F.array(*variants)).alias("_v"))
    return (out.select(*keep, "_v.family", "_v.context_kind", "_v.prompt")
            .where(F.col("prompt").isNotNull()))


def examples(df: DataFrame, prompt_col: str = "prompt", output_col: str = "answer",
             eos: str = K.EOS) -> DataFrame:
    """prompt, output (EOS ensured) and example = prompt + output."""
    out = ensure_suffix(F.col(output_col), eos)
    return (df.withColumn("output", out)
              .withColumn("example", F.concat(F.col(prompt_col), F.col("output"))))


def context_question_long(df: DataFrame, key: str = "idx", answer: str = "answer",
                          variants: Sequence[tuple[str, str]] = (("RCQ", "relevant_context"),
                                                                 ("WD_RCQ", "wrong_date_context"),
                                                                 ("ICQ", "ic"), ("WD_ICQ", "wd_ic"))) -> DataFrame:
    """Wide -> long: each context variant rendered as ``Context: .. Question: ..``
    into one ``cq`` column (the irrelevant variants include the question too).
    Variants with a null context or question are left out."""
    arr = F.array(*[F.struct(F.lit(name).alias("variant"),
                             context_question(F.col(col), F.col("question")).alias("cq"))
                    for name, col in variants])
    out = df.select(key, answer, F.explode(arr).alias("_v"))
    return out.select(key, "_v.variant", "_v.cq", answer).where(F.col("cq").isNotNull())
