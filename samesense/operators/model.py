"""Run a caller's text model over a prompt table.

A reply costs more than anything else in a run. ``answered_once`` keeps replies in a table
keyed by what was asked: equal prompts are asked once, a run that was stopped goes on with
the prompts that have no reply yet, and a later run asks only what is new.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samesense.functions.text import CHARS_PER_TOKEN, context_name
from samesense.skew import lookup
from samesense.storage import discard, exists, fresh_path, store

# Generation defaults and the number of attempts.
MAX_NEW_TOKENS = 2048
TEMPERATURE = 0.2
REPEAT_PENALTY = 1.2
ATTEMPTS = 3

# Prompts of one task: a lost task repeats no more calls than these.
TASK_PROMPTS = 256
# Tasks per slot whose replies are written together: what a stopped run may have to ask again.
GROUP_WAVES = 2

Generate = Callable[..., list[str]]


class PerWorker:
    """A model that is built where it is used: ``make()`` runs at a task's first prompt.

    ``make`` returns the function that maps prompts to texts; nothing it loads is sent
    from the driver.
    """

    def __init__(self, make: Callable[[], Generate]):
        self.make = make
        self.loaded: Generate | None = None

    def __getstate__(self):
        return {"make": self.make, "loaded": None}

    def __call__(self, prompts: list[str], **options) -> list[str]:
        if self.loaded is None:
            self.loaded = self.make()
        return self.loaded(prompts, **options)


def _batches(prompts: list[str], batch_prompts: int, batch_tokens: int) -> Iterator[slice]:
    """Runs of prompts bounded in number and in estimated tokens."""
    start, tokens = 0, 0
    for i, prompt in enumerate(prompts):
        size = len(prompt or "") // CHARS_PER_TOKEN
        if i > start and (i - start >= batch_prompts or tokens + size > batch_tokens):
            yield slice(start, i)
            start, tokens = i, 0
        tokens += size
    if start < len(prompts):
        yield slice(start, len(prompts))


def infer(
    df: DataFrame,
    generate: Generate,
    prompt: str = "prompt",
    *,
    max_tokens: int = MAX_NEW_TOKENS,
    temperature: float = TEMPERATURE,
    repeat_penalty: float = REPEAT_PENALTY,
    attempts: int = ATTEMPTS,
    on_error: str = "raise",
    batch_prompts: int = 16,
    batch_tokens: int = 32_768,
    partitions: int | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Add ``response, attempts, error``.

    ``generate(prompts, max_tokens=..., temperature=..., repeat_penalty=...)`` returns one
    text per prompt and always text, also for JSON. A failed batch is tried again prompt
    by prompt until ``attempts`` is used up; then the last error is raised, or recorded
    with a null response if ``on_error`` is ``"record"``. Prompts are few bytes but much
    work, so they are dealt out over ``partitions`` instead of being left in the few
    partitions their size would suggest: by default ``TASK_PROMPTS`` a task, and at least one task
    per slot. For that the prompts are counted, so ``df`` should be cheap to read twice.
    With ``in_place`` prompts are asked where they are made, are not counted or shuffled, and end
    there: the result has the other columns.
    """
    if on_error not in ("raise", "record"):
        raise ValueError("on_error must be 'raise' or 'record'")
    position = df.columns.index(prompt)
    options = {
        "max_tokens": max_tokens,
        "temperature": temperature,
        "repeat_penalty": repeat_penalty,
    }

    def call(texts: list[str]) -> list[str]:
        replies = list(generate(texts, **options))
        if len(replies) != len(texts):
            raise ValueError(f"{len(replies)} replies to {len(texts)} prompts")
        return replies

    def alone(text: str, used: int) -> tuple[str | None, int, str | None]:
        error: Exception | None = None
        while used < attempts:
            used += 1
            try:
                return call([text])[0], used, None
            except Exception as failure:
                error = failure
        if on_error == "raise" and error is not None:
            raise error
        return None, used, repr(error)

    kept = [i for i in range(len(df.columns)) if not in_place or i != position]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prompts = batch.column(position).to_pylist()
            out: list[tuple[str | None, int, str | None]] = []
            for part in _batches(prompts, batch_prompts, batch_tokens):
                texts = prompts[part]
                if len(texts) == 1:
                    out.append(alone(texts[0], 0))
                    continue
                try:
                    out += [(reply, 1, None) for reply in call(texts)]
                except Exception as failure:
                    if attempts <= 1 and on_error == "raise":
                        raise
                    if attempts <= 1:
                        out += [(None, 1, repr(failure))] * len(texts)
                    else:
                        out += [alone(text, 1) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in kept],
                    pa.array([o[0] for o in out], pa.string()),
                    pa.array([o[1] for o in out], pa.int32()),
                    pa.array([o[2] for o in out], pa.string()),
                ],
                names=[*[batch.schema.names[i] for i in kept], "response", "attempts", "error"],
            )

    fields = [df.schema.fields[i] for i in kept]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    dealt = df if in_place else df.repartition(partitions or _parts(df))
    return dealt.mapInArrow(run, f"{schema}response string, attempts int, error string")


def _parts(prompts: DataFrame) -> int:
    slots = prompts.sparkSession.sparkContext.defaultParallelism
    return max(slots, -(-prompts.count() // TASK_PROMPTS))


def answered(df: DataFrame, generate: Generate, label: str, folder: str | None = None, **options) -> DataFrame:
    """``infer``, written to the shared folder: a reply is costly and never the same twice.

    The prompts are written first, so that they can be counted: tasks get a bounded number
    of them, and all slots work if there are few. With ``folder`` replies are kept there under
    ``label``, as ``answered_once`` does.
    """
    prompts = store(df, f"{label}-prompts")
    if folder is None:
        replies = store(infer(prompts, generate, **options), label)
    else:
        replies = store(answered_once(prompts, generate, f"{folder}/{label}", **options), label)
    discard(prompts)
    return replies


def reply_key(prompt: Column, model: str = "", **parameters) -> Column:
    """What was asked, as a hash: the prompt, the model's name and the generation parameters."""
    said = json.dumps([model, parameters], sort_keys=True)
    return F.sha2(F.concat(F.lit(said), F.when(prompt.isNull(), "-").otherwise(F.concat(F.lit("+"), prompt))), 256)


def known_replies(spark: SparkSession, folder: str) -> DataFrame | None:
    """Replies kept in ``folder``: ``key, response, attempts, error``, one row per key.

    A prompt that failed and was answered later has its answer; None if there is no table.
    """
    if not exists(spark, folder):
        return None
    said = spark.read.schema("key string, response string, attempts int, error string").parquet(folder)
    best = F.max_by(F.struct("response", "attempts", "error"), F.col("error").isNull())
    return said.groupBy("key").agg(best.alias("said")).select("key", "said.*")


def answered_once(
    df: DataFrame,
    generate: Generate,
    folder: str,
    prompt: str = "prompt",
    *,
    model: str = "",
    group_prompts: int | None = None,
    max_tokens: int = MAX_NEW_TOKENS,
    temperature: float = TEMPERATURE,
    repeat_penalty: float = REPEAT_PENALTY,
    **options,
) -> DataFrame:
    """Add ``response, attempts, error`` to a stored ``df``, asking no prompt twice.

    Replies are kept in ``folder``, keyed by prompt, ``model`` and generation parameters. Prompts
    without a reply there are asked in groups of about ``group_prompts`` (by default what all
    slots do in ``GROUP_WAVES`` rounds of tasks); a group's replies are committed together,
    so a run that is stopped loses one group, and the same call goes on from there. Failed
    prompts are recorded, and asked again by the next call.
    """
    spark = df.sparkSession
    parameters = {"max_tokens": max_tokens, "temperature": temperature, "repeat_penalty": repeat_penalty}
    key = reply_key(F.col(prompt), model, **parameters)
    asked = df.groupBy(key.alias("key")).agg(F.first(prompt).alias("prompt"))
    known = known_replies(spark, folder)
    if known is not None:
        asked = asked.join(known.where("error is null").select("key"), "key", "left_anti")
    asked = store(asked, "asked")
    missing = asked.count()
    if missing:
        slots = spark.sparkContext.defaultParallelism
        size = group_prompts or slots * GROUP_WAVES * TASK_PROMPTS
        groups = -(-missing // size)
        path = fresh_path(spark, "groups")
        number = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
        asked.withColumn("group", number).repartition("group").write.partitionBy("group").parquet(path)
        tasks = min(size, max(slots, -(-min(size, missing) // TASK_PROMPTS)))
        for group in range(groups):
            part = spark.read.schema("key string, prompt string, group int").parquet(path).where(F.col("group") == group)
            said = infer(part, generate, **parameters, **{"partitions": tasks, **options})
            said.select("key", "response", "attempts", "error").write.mode("append").parquet(folder)
    discard(asked)
    replies = known_replies(spark, folder)
    keyed = df.withColumn("key", key)
    if replies is None:
        empty = [F.lit(None).cast(kind).alias(name) for name, kind in (("response", "string"), ("attempts", "int"), ("error", "string"))]
        return keyed.select(*df.columns, *empty)
    # a prompt that many rows share is a hot key
    return lookup(keyed, replies, ["key"], df.columns).select(*df.columns, "response", "attempts", "error")


def reply_archive(replies: DataFrame) -> DataFrame:
    """Raw replies with a file-safe context name and the time: ``context, response, ts``."""
    return replies.select(
        context_name(F.col("context")).alias("context"),
        "response",
        F.current_timestamp().alias("ts"),
    )
