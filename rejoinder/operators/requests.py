"""Requests to models outside this library: what to ask, what has been asked, what is still open.

A request is named by the hash of its kind and text, so equal texts are asked once, whatever row they come
from. The ledger is a table that only grows: one row for every try and its outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_TRIES = 3
#: What the text of a request is looked up by; copies of a text differ in the owner, so they lie apart.
TEXT_KEY = ["request_key", "kind", "owner"]
LEDGER_SCHEMA = "request_key string, state string, asked_at timestamp"

CRITERIA_HEAD = (
    "Judge one reply to a harmful message. Be strict, and name weaknesses.\n"
    "Score each criterion from 1 to 10:\n"
    "directness - does the reply answer the claims made?\n"
    "evidence_quality - does it use facts, numbers or sound reasons?\n"
    "persuasiveness - could it change a mind?\n"
    "relevance - does it stay with the topic of the message?\n"
    "effectiveness - does it work against the harmful message as a whole?\n"
    "feedback - two or three sentences on strengths and weaknesses.\n"
)
CRITERIA_TAIL = (
    "\nAnswer with JSON only:\n"
    '{"directness": n, "evidence_quality": n, "persuasiveness": n, "relevance": n, "effectiveness": n, "feedback": "text"}'
)


def criteria_prompt(message: Column, reply: Column) -> Column:
    """The request of the five-criteria judge; null if there is no message or no reply."""
    return F.concat(F.lit(CRITERIA_HEAD), F.lit("\nmessage: "), message, F.lit("\nreply: "), reply, F.lit(CRITERIA_TAIL))


def criteria_requests(pairs: DataFrame) -> DataFrame:
    """(pair_id, prompt) of the five-criteria judge for rows with ``pair_id, proponent, opponent``."""
    return pairs.select("pair_id", criteria_prompt(F.col("proponent"), F.col("opponent")).alias("prompt"))


def request_key(kind: Column, payload: Column) -> Column:
    return F.sha2(F.concat_ws("\n", kind, payload), 256)


def as_requests(rows: DataFrame, kind: str, payload: Column, owner: Column) -> DataFrame:
    """(kind, owner, request_key, payload) for each row with a payload; an empty text asks nothing."""
    named = rows.select(F.lit(kind).alias("kind"), owner.cast("string").alias("owner"), payload.alias("payload"))
    named = named.filter(F.coalesce(F.col("payload"), F.lit("")) != "")
    return named.withColumn("request_key", request_key(F.col("kind"), F.col("payload")))


def ledger_state(ledger: DataFrame) -> DataFrame:
    """(request_key, tries, done): a request is done once one try succeeded."""
    return ledger.groupBy("request_key").agg(
        F.count("*").alias("tries"), F.coalesce(F.bool_or(F.col("state") == "done"), F.lit(False)).alias("done")
    )


def open_requests(requests: DataFrame, ledger: DataFrame, most_tries: int = MOST_TRIES) -> DataFrame:
    """(request_key, kind, payload, owners, tries): what is to be asked now, each text once.

    Left out is what is done or was tried ``most_tries`` times. Keys are grouped and joined without the texts: the text is taken from
    the row with the smallest owner, so copies of a long text are not shuffled with each other. Rows that were written by
    ``TEXT_KEY`` are not shuffled at all.
    """
    state = ledger_state(ledger)
    keys = requests.groupBy("request_key", "kind").agg(F.count("*").alias("owners"), F.min("owner").alias("owner"))
    wanted = keys.join(state, "request_key", "left").filter(
        ~F.coalesce("done", F.lit(False)) & (F.coalesce("tries", F.lit(0)) < most_tries)
    )
    chosen = wanted.select("request_key", "kind", "owner", "owners", F.coalesce("tries", F.lit(0)).cast("bigint").alias("tries"))
    texts = requests.select(*TEXT_KEY, "payload").join(chosen, TEXT_KEY)
    one = texts.groupBy(*TEXT_KEY).agg(*[F.first(c).alias(c) for c in ("payload", "owners", "tries")])  # equal keys, equal rows
    return one.select("request_key", "kind", "payload", "owners", "tries")


def asked(requests: DataFrame, state: Column) -> DataFrame:
    """Rows for the ledger: the outcome ``state`` (``done`` or ``failed``) of each request that was asked."""
    return requests.select("request_key", state.alias("state"), F.current_timestamp().alias("asked_at"))


def append_ledger(outcomes: DataFrame, path: str) -> None:
    """Add outcomes to the ledger in ``path``."""
    outcomes.write.mode("append").parquet(path)
