"""Remote models as a source of answers (S11, S12, H33): asked once for each prompt, with retries and a store."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silkgrain.sources.tables import Log

#: What a model gives: its text, or pieces as they stream in, each with its kind (reasoning or content).
Reply = str | Iterable[tuple[str, str]]
ANSWER = "prompt_hash string, model string, status string, text string, reasoning string, reason string, tries int"


def _collected(reply: Reply) -> tuple[str, str]:
    """Text and reasoning."""
    if isinstance(reply, str):
        return reply.strip(), ""
    parts: dict[str, list[str]] = {"content": [], "reasoning": []}
    for kind, piece in reply:
        parts[kind].append(piece)
    return "".join(parts["content"]).strip(), "".join(parts["reasoning"]).strip()


def _tried(model: Callable[[str], Reply], prompt: str, tries: int, pause: Callable[[float], None]) -> tuple[str, str, str, str | None, int]:
    why = ""
    for attempt in range(1, max(1, tries) + 1):
        try:
            return ("ok", *_collected(model(prompt)), None, attempt)
        except Exception as e:  # noqa: BLE001  the reason is kept in the row
            why = f"{type(e).__name__}: {e}"
            if attempt < tries:
                pause(min(2 ** (attempt - 1), 8))
    return "error", "", "", why, max(1, tries)


def answers_of(prompts: DataFrame, model: Callable[[str], Reply], name: str = "model", tries: int = 3, at_once: int = 4, pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """ANSWER rows for prompts (prompt_hash, prompt): each task asks `at_once` at a time, waits 1, 2, 4, then 8 seconds
    between tries and keeps the last failure as a row. Answers come in the order of the prompts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(at_once) as pool:
            for pdf in batches:
                got = list(pool.map(lambda p: _tried(model, p, tries, pause), pdf["prompt"]))
                out = pd.DataFrame(got, columns=["status", "text", "reasoning", "reason", "tries"])
                yield out.assign(prompt_hash=list(pdf["prompt_hash"]), model=name)[["prompt_hash", "model", "status", "text", "reasoning", "reason", "tries"]]

    return prompts.select("prompt_hash", "prompt").mapInPandas(run, ANSWER)


class ModelSource:
    """A model with the answers it has given, in a table in the shared folder.

    ask() sends each different prompt that has no answer yet, once; what fails is a row with its reason, and is asked again by
    the next call. So neither a repeated prompt, nor a second run, nor a job that reads the answers again asks anything twice.
    """

    def __init__(self, spark, model: Callable[[str], Reply], name: str = "model", tries: int = 3, at_once: int = 4, pause: Callable[[float], None] = time.sleep, path: str | None = None) -> None:  # noqa: ANN001
        self.model, self.name, self.tries, self.at_once, self.pause = model, name, tries, at_once, pause
        self.log = Log(spark, ANSWER, path)

    def _told(self) -> DataFrame:
        mine = self.log.rows().where(F.col("model") == self.name)
        last = F.max_by(F.struct("status", "text", "reasoning", "reason", "tries"), F.struct(F.col("status") == "ok", "tries"))
        return mine.groupBy("prompt_hash").agg(last.alias("a")).select("prompt_hash", "a.*")

    def ask(self, prompts: DataFrame) -> DataFrame:
        """prompts (prompt_id, prompt) with model, status, text, reasoning, reason and tries; a null prompt is an error and isn't sent."""
        hashed = prompts.select("prompt_id", "prompt", F.sha2("prompt", 256).alias("prompt_hash"))
        open_ = hashed.where("prompt IS NOT NULL").groupBy("prompt_hash").agg(F.first("prompt").alias("prompt"))
        known = self._told().where("status = 'ok'").select("prompt_hash")
        self.log.append(answers_of(open_.join(known, "prompt_hash", "left_anti"), self.model, self.name, self.tries, self.at_once, self.pause))
        x = hashed.join(self._told(), "prompt_hash", "left")
        return x.select("prompt_id", F.lit(self.name).alias("model"), F.coalesce("status", F.lit("error")).alias("status"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("reasoning", F.lit("")).alias("reasoning"),
                        F.when(F.col("status").isNull(), "no prompt").otherwise(F.col("reason")).alias("reason"), F.coalesce("tries", F.lit(0)).alias("tries"))
