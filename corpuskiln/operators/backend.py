"""The boundary to an external text generator: requests, answers and their checks."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskiln.operators.masking import PREFIX, TOKEN, token_errors

#: What a generator is: prompts in, one answer (a JSON text) for each out. It runs in tasks and must be picklable.
Backend = Callable[[list[str]], list[str]]
ANSWER = "translation string, candidate_terms array<struct<source:string,target:string,domain:string,reason:string>>"
ATTEMPTS = 2
_PLACES = re.compile(f"(?=({TOKEN}))")


def echo(prompts: list[str]) -> list[str]:
    """A stand-in that answers with the source part of each prompt."""
    return [json.dumps({"translation": p.split("<SOURCE>\n", 1)[-1].rsplit("\n</SOURCE>", 1)[0], "candidate_terms": []}, ensure_ascii=False) for p in prompts]


def rule_lines(rules: DataFrame, by: list[str]) -> DataFrame:
    """One text of rules per chunk, in order of first match: source, target, matched form if it differs, note."""
    form = F.when(F.lower("matched_text") != F.lower("source"), F.concat(F.lit("; found as: "), "matched_text")).otherwise("")
    note = F.when(F.col("note") != "", F.concat(F.lit("; note: "), "note")).otherwise("")
    line = F.concat(F.lit("- "), "source", F.lit(" -> "), "target", form, note)
    return rules.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("start", line.alias("line")))).alias("l")).select(*by, F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("rules"))


def translation_prompt(chunk: Column, rules: Column, domain: Column, kind: Column, source_format: Column) -> Column:
    """The request for one chunk: what to keep, the rules of its terms, and its text."""
    return F.concat(
        F.lit("Translate the source into the target language. Keep every protected token exactly once, and all headings, lists, labels and references.\nDomain: "),
        F.coalesce(domain, F.lit("unspecified")),
        F.lit("\nDocument: "),
        kind,
        F.lit("\nFormat: "),
        source_format,
        F.lit("\nTerms:\n"),
        F.coalesce(rules, F.lit("(none)")),
        F.lit("\n<SOURCE>\n"),
        chunk,
        F.lit("\n</SOURCE>"),
    )


@lru_cache(maxsize=1)
def _read(answer: str) -> object:
    """The value of an answer; its shape and its tokens are checked one after the other."""
    return json.loads(answer)


def answer_error(answer: str | None) -> str | None:
    """Why an answer is not of the declared shape, null if it is; extra keys are not allowed."""
    try:
        value = _read(answer or "")
    except ValueError:
        return "not JSON"
    if not isinstance(value, dict) or set(value) != {"translation", "candidate_terms"} or not isinstance(value["translation"], str) or not isinstance(value["candidate_terms"], list):
        return "wrong shape"
    fields = {"source", "target", "domain", "reason"}
    if any(not isinstance(c, dict) or c.keys() != fields or {*map(type, c.values())} != {str} for c in value["candidate_terms"]):
        return "wrong candidate"
    return None


def generate(requests: DataFrame, backend: Backend = echo, check: Callable[[str, str, list[str]], str | None] | None = None, attempts: int = ATTEMPTS, batch: int = 32, shape: Callable[[str | None], str | None] = answer_error, drop: tuple[str, ...] = ()) -> DataFrame:
    """``requests`` (with prompt, chunk and tokens), without the columns ``drop``, and answer, error, tries; a failed check is told to the next try.

    The backend runs inside tasks, so its load is set by the number of partitions. A request that still fails keeps
    its error; nothing fails the job. A null prompt is not asked and has no answer. The same answers give the same rows, whatever the batches.
    """

    names = [n for n in requests.columns if n not in drop]

    def answered(part: pa.RecordBatch) -> pa.RecordBatch:
        held = {n: part.column(n).to_pylist() for n in ("prompt", *(("chunk", "tokens") if check else ()))}
        answers, errors, tries = [None] * part.num_rows, [None] * part.num_rows, [0] * part.num_rows
        open_ = [i for i, prompt in enumerate(held["prompt"]) if prompt is not None]
        for attempt in range(1, attempts + 1):
            asked = [held["prompt"][i] + (f"\nThe last answer failed: {errors[i]}" if errors[i] else "") for i in open_]
            for i, answer in zip(open_, backend(asked) if open_ else [], strict=True):
                error = shape(answer)
                if not error and check:
                    error = check(held["chunk"][i], _read(answer)["translation"], list(held["tokens"][i]))
                answers[i], errors[i], tries[i] = answer, error, attempt
            open_ = [i for i in open_ if errors[i]]
        made = [pa.array(answers, pa.string()), pa.array(errors, pa.string()), pa.array(tries, pa.int32())]
        return pa.RecordBatch.from_arrays([*map(part.column, names), *made], [*names, "answer", "error", "tries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:  # Spark bounds its bytes; prompts and answers are objects for one slice only
            for at in range(0, whole.num_rows, batch):
                yield answered(whole.slice(at, batch))

    schema = ", ".join(f"`{n}` {k}" for n, k in requests.dtypes if n in names)
    return requests.mapInArrow(run, f"{schema}, answer string, error string, tries int")


def check_tokens(chunk: str, output: str, tokens: list[str]) -> str | None:
    """First token of the chunk that its output does not hold exactly once."""
    held, given = (Counter(_PLACES.findall(x) if PREFIX in x else ()) for x in (chunk, output))
    for t in tokens:
        masked = _PLACES.match(t) is not None
        if (held[t] if masked else t in chunk) and (given[t] if masked else output.count(t)) != 1:
            return f"token not exactly once: {t}"
    return None


def parsed(answers: DataFrame) -> DataFrame:
    """``answers`` with the answer as columns translation and candidate_terms, null where it failed."""
    value = F.when(F.col("error").isNull(), F.from_json("answer", ANSWER))
    return answers.withColumn("translation", value["translation"]).withColumn("candidate_terms", value["candidate_terms"])


def checked(parsed_rows: DataFrame) -> DataFrame:
    """Adds token_error, the JVM-side form of the same check."""
    return parsed_rows.withColumn("token_error", token_errors(F.col("chunk"), F.col("translation"), F.col("tokens")))
