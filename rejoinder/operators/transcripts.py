"""Two-role transcripts: pairing, state, rendering, batching, corruption, requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rejoinder.functions import fixed_values as fixed
from rejoinder.functions.text import contains_any, strip, whole_parts
from rejoinder.operators.joins import top_per_merged
from rejoinder.operators.ordinals import with_ordinal

TURN_BLOCK = 65_536
PART_BYTES = 4 << 20
PIECES = 1 << 32  # more pieces than a block of turns can have


def extract_pairs(messages: DataFrame, key: str = "conv_id", turn_block: int | None = TURN_BLOCK) -> DataFrame:
    """Pair each opponent message with the proponent message right before it.

    ``messages`` has ``key, turn, role, content``. Other roles are skipped; the pair needs
    a non-empty proponent message as the previous kept one. The turn column is looked at
    first: if some transcript reaches beyond ``turn_block`` turns, transcripts are windowed in
    blocks of that many turns, so that one holding much of the table is spread over many
    tasks. ``None`` skips this for transcripts known to be short.
    """
    kept = messages.filter(F.col("role").isin("proponent", "opponent")).select(key, "turn", "role", "content")
    last_turn = None if turn_block is None else messages.agg(F.max("turn")).first()[0]
    if last_turn is not None and last_turn >= turn_block:
        seen = _with_previous_in_blocks(kept, key, turn_block)
    else:
        one = Window.partitionBy(key).orderBy("turn")
        seen = kept.withColumn("_before", F.lag(F.struct("role", "content")).over(one))
    before = F.col("_before")
    return seen.filter(
        (F.col("role") == "opponent") & (before["role"] == "proponent") & (before["content"] != "")
    ).select(key, "turn", before["content"].alias("proponent"), F.col("content").alias("opponent"))


def _with_previous_in_blocks(kept: DataFrame, key: str, turn_block: int) -> DataFrame:
    """Previous message per row, windowed by (transcript, block of turns).

    The last message of a block reaches the next one through a table with one row per block
    of the long transcripts.
    """
    blocked = kept.withColumn("_block", whole_parts(F.col("turn"), turn_block))
    in_block = Window.partitionBy(key, "_block").orderBy("turn")
    seen = blocked.withColumn("_inside", F.lag(F.struct("role", "content")).over(in_block))
    long_ones = blocked.filter(F.col("_block") > 0).select(key).distinct()
    block_ends = (
        blocked.join(long_ones, key, "left_semi")
        .groupBy(key, "_block")
        .agg(F.max_by(F.struct("role", "content"), "turn").alias("_end"))
    )
    over_blocks = Window.partitionBy(key).orderBy("_block")
    carried = block_ends.select(key, "_block", F.lag("_end").over(over_blocks).alias("_carried"))
    return seen.join(carried, [key, "_block"], "left").withColumn("_before", F.coalesce("_inside", "_carried"))


def debate_messages(debates: DataFrame, key: str = "debate_id") -> DataFrame:
    """Messages of debates given as arrays: ``full_debate``, or ``history`` when that is empty."""
    has_full = F.coalesce(F.size("full_debate"), F.lit(0)) > 0
    chosen = F.when(has_full, F.col("full_debate")).otherwise(F.col("history"))
    return debates.select(
        key,
        F.when(has_full, "full_debate").otherwise("history").alias("source"),
        F.posexplode(chosen).alias("turn", "_message"),
    ).select(key, "source", "turn", F.col("_message.role").alias("role"), F.col("_message.content").alias("content"))


def _ready_pairs(debates: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """Pairs of debates with ready-made ``content``, and the condition that tells these debates."""
    ready = F.coalesce(
        F.col("content.proponent").isNotNull() & F.col("content.opponent").isNotNull(), F.lit(False)
    )
    given = debates.filter(ready).select(
        key,
        F.lit("content").alias("source"),
        F.lit(0).alias("turn"),
        F.col("content.proponent").alias("proponent"),
        F.col("content.opponent").alias("opponent"),
    )
    return given, ready


def debate_pairs(debates: DataFrame, key: str = "debate_id") -> DataFrame:
    """Pairs of nested debates: ready-made ``content`` first, else the message arrays."""
    given, ready = _ready_pairs(debates, key)
    messages = debate_messages(debates.filter(~ready), key)
    # Messages of one debate come from one row, so they fit a task.
    return given.unionByName(_walked_sources(messages, key, turn_block=None))


def flat_debate_pairs(
    contents: DataFrame, messages: DataFrame, key: str = "debate_id", turn_block: int = TURN_BLOCK
) -> DataFrame:
    """Pairs of debates of any length: ready-made content first, else the message rows.

    ``contents`` has ``key, content``; ``messages`` has ``key, source, turn, role, content``,
    where the source ``full_debate`` goes before ``history``. No debate is cut.
    """
    given, _ = _ready_pairs(contents, key)
    walked = _walked_sources(messages, key, turn_block)
    has_full = messages.filter(F.col("source") == "full_debate").select(key).distinct()
    passed_over = given.select(key, F.explode(F.array(F.lit("full_debate"), F.lit("history"))).alias("source")).unionByName(
        has_full.withColumn("source", F.lit("history"))
    )
    return given.unionByName(walked.join(passed_over, [key, "source"], "left_anti"))


def _walked_sources(messages: DataFrame, key: str, turn_block: int | None) -> DataFrame:
    """Pairs inside each message source of each debate."""
    named = messages.select(F.struct(key, "source").alias("_id"), "turn", "role", "content")
    paired = extract_pairs(named, "_id", turn_block=turn_block)
    return paired.select(f"_id.{key}", "_id.source", "turn", "proponent", "opponent")


def next_turn_state(messages: DataFrame, debates: DataFrame, key: str = "conv_id", max_turns: int = fixed.MAX_TURNS) -> DataFrame:
    """Who speaks next in each debate, at which turn, with which focus."""
    progress = messages.groupBy(key).agg(
        F.count("*").alias("_said"), F.max_by("role", "turn").alias("_last")
    )
    said = F.coalesce(F.col("_said"), F.lit(0))
    turn = F.least(whole_parts(said, 2) + 1, F.lit(max_turns)).cast("bigint")
    focus = F.create_map(*[F.lit(x) for pair in fixed.TURN_FOCUS.items() for x in pair])
    return (
        debates.select(key)
        .join(progress, key, "left")
        .select(
            key,
            said.cast("bigint").alias("messages"),
            F.when(F.col("_last") == "proponent", "opponent").otherwise("proponent").alias("next_speaker"),
            turn.alias("turn_number"),
        )
        .withColumn(
            "turn_focus",
            F.coalesce(F.try_element_at(focus, F.col("turn_number").cast("int")), F.lit(fixed.TURN_FOCUS_BEYOND)),
        )
    )


def line_of(role: Column, content: Column) -> Column:
    return F.concat_ws(": ", role, content)


def with_parts(
    messages: DataFrame, key: str = "conv_id", part_bytes: int = PART_BYTES, turn_block: int = TURN_BLOCK
) -> DataFrame:
    """Messages with the number of the ``part`` of their transcript.

    A part is what begins within the same ``part_bytes`` bytes of lines of one block of
    ``turn_block`` turns, so it holds at most that and one message. Parts follow in turn order;
    their numbers grow but may leave gaps. Blocks keep a transcript with much of the table from
    meeting in one task, and grouping by block and part needs no shuffle beyond that of the blocks.
    """
    in_block = Window.partitionBy(key, "_block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length(line_of(F.col("role"), F.col("content"))).cast("bigint") + 1
    return (
        messages.withColumn("_block", whole_parts(F.col("turn"), turn_block))
        .withColumn("_piece", whole_parts(F.coalesce(F.sum(size).over(in_block), F.lit(0)), part_bytes))
        .withColumn("part", F.col("_block") * PIECES + F.col("_piece"))
    )


def render_transcript(
    messages: DataFrame, key: str = "conv_id", part_bytes: int = PART_BYTES, turn_block: int = TURN_BLOCK
) -> DataFrame:
    """``role: content`` lines in turn order, one row for each part (see ``with_parts``).

    The parts of a transcript joined with line breaks give the whole of it; ``write_transcripts``
    does that in files.
    """
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", "content"))), lambda m: line_of(m["role"], m["content"])
    )
    parts = with_parts(messages, key, part_bytes, turn_block)
    return parts.groupBy(key, "_block", "_piece").agg(
        F.first("part").alias("part"), F.array_join(lines, "\n").alias("transcript")
    ).drop("_block", "_piece")


def write_transcripts(parts: DataFrame, path: str, key: str = "conv_id") -> None:
    """The parts of every transcript as one text file, in a folder ``key=value`` of its own.

    All parts of a transcript go to one task, which sorts them (with spilling) and writes them
    one after the other, so no transcript is ever held as one row.
    """
    together = parts.repartition(key).sortWithinPartitions(key, "part")
    together.select(key, "transcript").write.partitionBy(key).text(path)


def assign_batches(df: DataFrame, order_by: list, batch_size: int = fixed.BATCH_SIZE) -> DataFrame:
    """Consecutive batches of ``batch_size`` rows, numbered from 0; the last may be short."""
    return with_ordinal(df, order_by, "position", key=order_by).withColumn(
        "batch", whole_parts(F.col("position") - 1, batch_size)
    )


def is_corrupted(text: Column) -> Column:
    return F.coalesce(contains_any(text, fixed.CORRUPTION_MARKERS), F.lit(False))


def flag_corrupted(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("corrupted", is_corrupted(F.col("opponent"))).withColumn(
        "issue_message", F.when(F.col("corrupted"), fixed.CORRUPTION_MESSAGE)
    )


def resume_pending(pairs: DataFrame, done: DataFrame, always: Column | None = None) -> DataFrame:
    """Pairs whose (topic, position, proponent) is not among the evaluated ones, and those
    that are ``always`` to be done.

    The join runs on a hash beside the texts, so the shuffle sorts eight bytes; the texts
    are still compared.
    """
    keys = ["topic", "position", "proponent"]
    left = pairs.withColumn("_key", F.xxhash64(*keys))
    right = done.select(*[F.col(k).alias(f"_{k}") for k in keys])
    right = right.withColumn("_done_key", F.xxhash64(*[f"_{k}" for k in keys]))
    same = F.col("_key") == F.col("_done_key")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    if always is not None:
        same = same & ~always
    return left.join(right, same, "left_anti").drop("_key")


PAIR_REQUEST_HEAD = (
    "Rate one exchange between a proponent of a harmful position and an opponent.\n"
    "Score every criterion from 1 to 10.\n"
    "Harmful message: representativeness, coherence, harmfulness.\n"
    "Reply: directness, evidence quality, persuasiveness.\n"
)
PAIR_REQUEST_TAIL = (
    "\nAnswer in this layout:\n"
    "HARMFUL CONTENT\nRepresentativeness: n\nCoherence: n\nHarmfulness: n\nSubtotal: n\n"
    "COUNTERSPEECH\nDirectness: n\nEvidence Quality: n\nPersuasiveness: n\nSubtotal: n\n"
    "OVERALL ASSESSMENT: one line"
)


def judge_requests(pairs: DataFrame) -> DataFrame:
    """One request text per pair, for a judge outside this library."""
    prompt = F.concat(
        F.lit(PAIR_REQUEST_HEAD),
        F.lit("\nTopic: "), F.col("topic"),
        F.lit("\nPosition: "), F.col("position"),
        F.lit("\nproponent: "), F.col("proponent"),
        F.lit("\nopponent: "), F.col("opponent"),
        F.lit(PAIR_REQUEST_TAIL),
    )
    return pairs.select("pair_id", prompt.alias("prompt"))


def split_marked_records(
    generated: DataFrame,
    marker: str = fixed.RECORD_MARKER,
    max_chars: int = fixed.RECORD_MAX_CHARS,
    per_topic: int = fixed.RECORDS_PER_TOPIC,
) -> DataFrame:
    """Cut ``generated (topic, gen_id, text)`` into records after each marker.

    Text before the first marker is no record. Each topic gives its first ``per_topic``
    records of at most ``max_chars`` characters, in (gen_id, position) order. The row limit
    is applied inside each input partition before the shuffle, and merged in two steps.
    """
    pieces = F.split("text", f"\\Q{marker}\\E")
    records = (
        generated.select("topic", "gen_id", F.posexplode(pieces).alias("position", "_piece"))
        .filter(F.col("position") > 0)
        .withColumn("record", strip(F.col("_piece")))
        .filter((F.col("record") != "") & (F.length("record") <= max_chars))
    )
    first = top_per_merged(records, ["topic"], [F.asc("gen_id"), F.asc("position")], per_topic, "record_no")
    return first.select("topic", "gen_id", F.col("record_no").cast("bigint").alias("record_no"), "record")
