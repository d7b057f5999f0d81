"""Model replies: sending requests, summaries and their merging."""

import json
import sys
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.functions.text import blank, cjk_spacing, strip
from curate.operators.rating import chat_request

# Workers get this module with the function, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Settings of the model calls, and the three texts asked for.
MAX_TRIES = 3
RETRY_DELAY = 2.0
AT_ONCE = 10  # of a run
SUMMARY_MODEL = "gpt-4o"
ZH_TITLE, ZH_SUMMARY, EN_SUMMARY = "zh_title", "zh_summary", "en_summary"


class Pace:
    """Lets calls through at an even rate, whatever number of threads asks."""

    def __init__(self, per_second: float | None):
        self.gap = 1 / per_second if per_second else 0.0
        self.lock, self.free = threading.Lock(), 0.0

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = time.monotonic()
            turn = max(now, self.free)
            self.free = turn + self.gap
        time.sleep(turn - now)


def ask(client, request: str, max_tries: int, retry_delay: float, pace: Pace):
    """One reply with its error, the number of tries it took, and the seconds. Each pause is twice the one before."""
    start = time.monotonic()
    for attempt in range(1, max_tries + 1):
        try:
            pace.wait()
            answer = client.request(json.loads(request))
            return answer["choices"][0]["message"]["content"], None, attempt, time.monotonic() - start
        except Exception as problem:
            error = f"{type(problem).__name__}: {problem}"
            if attempt < max_tries:
                time.sleep(retry_delay * 2 ** (attempt - 1))
    return None, error, max_tries, time.monotonic() - start


def asker(client_factory, max_tries, retry_delay, at_once, per_second):
    def run(batches):
        # A client belongs to one thread.
        own, pace = threading.local(), Pace(per_second)

        def one(request):
            if not hasattr(own, "client"):
                own.client = client_factory()
            return ask(own.client, request, max_tries, retry_delay, pace)

        with ThreadPoolExecutor(at_once) as pool:
            for batch in batches:
                replies = list(pool.map(one, batch.pop("request")))
                names = ["reply", "error", "attempts", "seconds"]
                batch[names] = pd.DataFrame(replies, columns=names, index=batch.index, dtype=object)
                yield batch

    return run


def enrich(requests: DataFrame, client_factory: Callable, *, max_tries: int = MAX_TRIES,
           retry_delay: float = RETRY_DELAY, parallel: int | None = None, at_once: int = 1,
           per_second: float | None = None) -> DataFrame:
    """Replace the `request` of each row by `reply`, `error`, `attempts` and `seconds`.

    `parallel` sets the number of tasks; rows are then dealt out by their keys. Each task has up to `at_once`
    requests under way, each with a client of its own, and gives replies in the order of its rows. `per_second`
    bounds the tries of all tasks together: each has its share of it, as if all ran at once. A request that
    keeps failing leaves its row without a reply and with an error; the others go on.
    """
    keys = [field for field in requests.schema.fields if field.name != "request"]
    names = [field.name for field in keys]
    if per_second and not parallel:
        parallel = requests.sparkSession.sparkContext.defaultParallelism
    rows = requests.repartition(parallel, *names) if parallel else requests
    schema = ", ".join([
        *[f"{field.name} {field.dataType.simpleString()}" for field in keys],
        "reply string", "error string", "attempts int", "seconds double",
    ])
    share = per_second / parallel if per_second else None
    return rows.select(*names, F.to_json("request").alias("request")).mapInPandas(
        asker(client_factory, max_tries, retry_delay, at_once, share), schema
    )


def summary_requests(articles: DataFrame, model: str = SUMMARY_MODEL) -> DataFrame:
    """Three requests per article: a Chinese title, a Chinese summary, an English summary."""
    title, content = F.col("title"), F.col("content")
    body = F.concat(F.lit("Title: "), title, F.lit("\n\nText:\n"), content)
    wanted = {
        ZH_TITLE: (
            "Translate titles into Chinese (zh-CN) and reply with the translation only.",
            F.concat(F.lit("Title to translate:\n\n"), title),
        ),
        ZH_SUMMARY: (
            "Summarize articles in Chinese (zh-CN), briefly, in 3 to 5 sentences and without"
            " anything the article does not say.",
            F.concat(F.lit("Article to summarize in Chinese:\n\n"), body),
        ),
        EN_SUMMARY: (
            "Summarize articles in English, briefly, in 3 to 5 sentences.",
            F.concat(F.lit("Article to summarize:\n\n"), body),
        ),
    }
    each = F.array(*[
        F.struct(F.lit(kind).alias("kind"), chat_request(model, F.lit(system), user).alias("request"))
        for kind, (system, user) in wanted.items()
    ])
    ready = articles.where(~blank(content))
    return ready.select("id", F.inline(each))


def merge_summaries(replies: DataFrame) -> DataFrame:
    """The three replies of each article as one row; articles without any text are left out.

    The Chinese title and summary stand or fall together.
    """
    text = strip(F.col("reply"))

    def reply(kind):
        return F.max(F.when(F.col("kind") == kind, text))

    merged = replies.groupBy("id").agg(
        reply(ZH_TITLE).alias("_title"),
        reply(ZH_SUMMARY).alias("_summary"),
        reply(EN_SUMMARY).alias("english_summary"),
    )
    both = F.col("_title").isNotNull() & F.col("_summary").isNotNull()
    texts = merged.select(
        "id",
        F.when(both, cjk_spacing(F.col("_title"))).alias("chinese_title"),
        "english_summary",
        F.when(both, cjk_spacing(F.col("_summary"))).alias("chinese_summary"),
    )
    any_text = ~blank(F.concat(*[
        F.coalesce(F.col(name), F.lit("")) for name in ("chinese_title", "english_summary", "chinese_summary")
    ]))
    return texts.where(any_text)
