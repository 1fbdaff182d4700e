"""The model boundary: judges and completers as functions from DataFrame to DataFrame, with clients injected.

``client_judge`` calls a client from Arrow batches, one client for each partition; a failure is a row without
verdict, never an error of the job. ``replay_judge`` joins answers recorded before."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundmill.clients import Client, chat
from groundmill.functions.jsonx import VERDICTS, judge_answer

# Limits of the calls, in tokens and seconds.
JUDGE_TOKENS, JUDGE_READ_S, JUDGE_DEADLINE_S = 512, 60, 90
CANDIDATE_TOKENS, CANDIDATE_DEADLINE_S = 4096, 600
JUDGE_SYSTEM = "You check whether the spans of a document support a claim or relation. Answer with a JSON object: verdict (grounded, partial or ungrounded), failing_values (a list) and reason."
EXTRACT_SYSTEM = "You list the facts of a passage as a JSON array. Each has quote (copied from the passage), record_type, fields, and where they apply actor, event_date, claim_relevance and confidence."


FILL_SYSTEM = "You fill one record from a passage, of one of the given types. The quote is copied from the passage and holds every value. Answer with a JSON object: quote, record_type, tier, fields, actor, event_date and confidence from 0 to 1. A rejection that is told must be mended."
PROSE_SYSTEM = "You tell whether a passage is mainly running text. Answer with one word: prose or non_prose."
TYPES_SYSTEM = "You name the kinds of records in a passage, not their values, as a JSON array of short snake_case names."
MERGE_SYSTEM = "You merge names of record types that mean the same. Answer with a JSON object: canonical (a list) and mapping (each given name to its canonical name)."
KEYWORDS_SYSTEM = "You name the words of a passage that bear on the decision of the claim, as a JSON array of short lower-case phrases."
MEANING_SYSTEM = "You say in one or two sentences what a passage means for the claim, and which questions it answers. Answer with a JSON object: claim_meaning and questions_answered (a list)."


def record_prompt(claim: Column, span: Column, tier: Column) -> Column:
    fact = "This is a fact: the span must literally state every value of the claim. Name each value that it does not state."
    ask = F.when(tier == "interpretation", "This is an interpretation: it must follow reasonably from the span and not contradict it.").otherwise(fact)
    return F.concat(ask, F.lit("\n\nSpan:\n"), span, F.lit("\n\nClaim:\n"), claim)


def link_prompt(relation: Column, a: Column, b: Column, rationale: Column, tier: Column) -> Column:
    fact = "This is a fact: the spans must state outright that A has this relation to B."
    ask = F.when(tier == "interpretation", "This is an interpretation: the relation must follow reasonably from the spans and not contradict them.").otherwise(fact)
    return F.concat(ask, F.lit("\n\nRelation: A "), relation, F.lit(" B\n\nSpan A:\n"), a, F.lit("\n\nSpan B:\n"), b, F.lit("\n\nRationale:\n"), rationale)


def extraction_prompt(text: Column) -> Column:
    return F.concat(F.lit("Passage:\n"), text)


def fill_prompt(types: Column, text: Column, feedback: Column) -> Column:
    told = F.coalesce(F.concat(F.lit("\n\nThe last try was rejected: "), feedback), F.lit(""))
    return F.concat(F.lit("Types: "), F.to_json(types), F.lit("\nPassage:\n"), text, told)


def readable(answer: str | None) -> bool:
    """Whether a verdict can be read of an answer, as judge_answer of functions/jsonx.py reads it."""
    raw = answer or ""
    try:
        value = json.loads(raw)
    except ValueError:
        try:
            value = json.loads(raw[raw.find("{") : raw.rfind("}") + 1])
        except ValueError:
            return False
    return isinstance(value, dict) and str(value.get("verdict")).strip().lower() in VERDICTS


def completed(df: DataFrame, system: str, prompt: Column, connect: Callable[[], Client], into: str = "answer", retry: Callable[[str], bool] | None = None) -> DataFrame:
    """``df`` with the answer to ``prompt``, its error and its tokens. ``connect`` makes a client on the worker; it holds the
    deadline. An answer that ``retry`` refuses is asked for once more, an error is not."""

    def run(prompts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = connect()
        for s in prompts:
            rows = []
            for p in s:
                try:
                    text, tokens = client(system, p)
                    if retry and retry(text):
                        text, more = client(system, p)
                        tokens += more
                    rows.append((text, None, tokens))
                except Exception as e:  # the error is the row's
                    rows.append((None, f"{type(e).__name__}: {e}"[:500], 0))
            yield pd.DataFrame(rows, columns=["answer", "error", "tokens"])

    got = F.pandas_udf(run, "answer string, error string, tokens bigint").asNondeterministic()(prompt)
    return df.withColumn("_c", got).withColumns({into: F.col("_c.answer"), f"{into}_error": F.col("_c.error"), f"{into}_tokens": F.col("_c.tokens")}).drop("_c")


def with_verdict(df: DataFrame, answer: str = "answer") -> DataFrame:
    j = judge_answer(answer)
    return df.withColumn("_j", j).withColumns({"verdict": F.col("_j.verdict"), "failing_values": F.col("_j.failing_values"), "judge_reason": F.col("_j.reason")}).drop("_j", answer)


def client_judge(connect: Callable[[], Client], prompt: Column) -> Callable[[DataFrame], DataFrame]:
    """Asks once more where no verdict can be read; a call that fails leaves the row without verdict at once."""
    return lambda df: with_verdict(completed(df, JUDGE_SYSTEM, prompt, connect, retry=lambda a: not readable(a))).drop("answer_error", "answer_tokens")


def http_judge(url: str, model: str, prompt: Column) -> Callable[[DataFrame], DataFrame]:
    return client_judge(chat(url, model, JUDGE_TOKENS, JUDGE_DEADLINE_S, JUDGE_READ_S, as_json=True), prompt)


def http_candidate(url: str, model: str, extra: dict | None = None) -> Callable[[], Client]:
    return chat(url, model, CANDIDATE_TOKENS, CANDIDATE_DEADLINE_S, extra=extra)


def replay_judge(answers: DataFrame, key: str) -> Callable[[DataFrame], DataFrame]:
    """``answers``: the key and ``answer``; a row without recorded answer has no verdict."""
    return lambda df: with_verdict(df.join(answers.dropDuplicates([key]), key, "left"))


def rule_judge(answer: Column) -> Callable[[DataFrame], DataFrame]:
    """A judge whose answer is an expression, for replays and tests."""
    return lambda df: with_verdict(df.withColumn("answer", answer))
