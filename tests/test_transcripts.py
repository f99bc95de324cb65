import glob
import random

import pytest

from rejoinder.operators import transcripts
from rejoinder.plans.evaluate_pairs import evaluate_pairs

MESSAGES = "conv_id bigint, turn bigint, role string, content string"


def walk(messages):
    """The pairing rule, message by message."""
    pairs, held = [], None
    for _conv, turn, role, content in sorted(messages):
        if role == "proponent":
            held = content
        elif role == "opponent" and held:
            pairs.append((_conv, turn, held, content))
            held = None
    return pairs


def paired(spark, messages, **options):
    df = spark.createDataFrame(messages, MESSAGES)
    return sorted(tuple(r) for r in transcripts.extract_pairs(df, **options).collect())


@pytest.mark.parametrize(
    "roles, expected",
    [
        (["p:a", "p:b", "o:c"], [("b", "c")]),  # the later proponent wins
        (["o:x", "p:a", "o:b"], [("a", "b")]),  # opponent first
        (["p:", "o:b"], []),  # empty proponent
        (["p:a", "s:mind", "o:b"], [("a", "b")]),  # other roles are skipped
        (["p:a", "o:b", "o:c"], [("a", "b")]),  # second opponent has nothing held
        (["p:a", "o:"], [("a", "")]),  # an empty reply still closes the pair
        (["p:a", "p:", "o:b"], []),  # an empty message replaces the held one
    ],
)
def test_pairing_rules(spark, roles, expected):
    names = {"p": "proponent", "o": "opponent", "s": "system"}
    messages = [(1, n, names[r[0]], r[2:]) for n, r in enumerate(roles)]
    assert [(p, o) for _, _, p, o in paired(spark, messages)] == expected


@pytest.mark.parametrize("block", [3, 10, 65_536])
def test_pairing_equals_walk_in_blocks(spark, block):
    rng = random.Random(7)
    messages = []
    for conv, length in ((1, 200), (2, 5), (3, 40), (4, 1)):
        turns = sorted(rng.sample(range(length * 3), length))
        for turn in turns:
            role = rng.choice(["proponent", "opponent", "system", "system"])
            messages.append((conv, turn, role, rng.choice(["", "x", f"m{turn}"])))
    expected = sorted(p for c in (1, 2, 3, 4) for p in walk([m for m in messages if m[0] == c]))
    assert paired(spark, messages, turn_block=block) == expected


def test_debate_source_precedence(spark):
    schema = (
        "debate_id bigint, content struct<proponent: string, opponent: string>, "
        "full_debate array<struct<role: string, content: string>>, history array<struct<role: string, content: string>>"
    )
    talk = [("proponent", "a"), ("opponent", "b")]
    rows = [
        (1, ("p", "o"), talk, talk),
        (2, None, talk, [("proponent", "x"), ("opponent", "y")]),
        (3, None, [], talk),
        (4, ("p", None), None, talk),
        (5, None, None, None),
    ]
    found = transcripts.debate_pairs(spark.createDataFrame(rows, schema)).orderBy("debate_id").collect()
    assert [(r.debate_id, r.source, r.proponent, r.opponent) for r in found] == [
        (1, "content", "p", "o"), (2, "full_debate", "a", "b"), (3, "history", "a", "b"), (4, "history", "a", "b"),
    ]


def test_next_turn_state(spark):
    messages = [(1, 0, "proponent", "a"), (2, 0, "proponent", "a"), (2, 1, "opponent", "b")]
    messages += [(3, n, ("proponent", "opponent")[n % 2], "m") for n in range(40)]
    df = spark.createDataFrame(messages, MESSAGES)
    debates = spark.createDataFrame([(n,) for n in (0, 1, 2, 3)], "conv_id bigint")
    state = {r.conv_id: r for r in transcripts.next_turn_state(df, debates).collect()}
    assert [(state[n].next_speaker, state[n].turn_number) for n in range(4)] == [
        ("proponent", 1), ("opponent", 1), ("proponent", 2), ("proponent", 8),
    ]
    beyond = transcripts.next_turn_state(df, debates, max_turns=30).filter("conv_id = 3").first()
    assert (beyond.turn_number, beyond.turn_focus) == (21, "making your arguments")


def test_transcript_comes_in_parts_of_bytes(spark, tmp_path):
    said = {
        1: [f"m{n} é" for n in range(25)],
        2: ["x" * 1000, "", None, "short", "y" * 400],
        3: ["one"],
    }
    rows = [(conv, n, "proponent", text) for conv, texts in said.items() for n, text in enumerate(texts)]
    df = spark.createDataFrame(rows, MESSAGES)
    whole = {conv: ["proponent" if t is None else f"proponent: {t}" for t in texts] for conv, texts in said.items()}
    for turn_block in (10, 65_536):
        parts = transcripts.render_transcript(df, part_bytes=100, turn_block=turn_block)
        found = {}
        for r in parts.orderBy("conv_id", "part").collect():
            found.setdefault(r.conv_id, []).append(r)
            lines = r.transcript.split("\n")
            # Every line but the last begins and ends within the part's 100 bytes.
            assert len("\n".join(lines[:-1]).encode()) <= 100
        for conv, lines in whole.items():
            assert "\n".join(r.transcript for r in found[conv]) == "\n".join(lines)
            assert len({r.part for r in found[conv]}) == len(found[conv])
        assert len(found[1]) > 3 and len(found[3]) == 1
        place = str(tmp_path / f"files{turn_block}")
        transcripts.write_transcripts(parts, place)
        for conv, lines in whole.items():
            files = glob.glob(f"{place}/conv_id={conv}/part-*")
            assert len(files) == 1
            with open(files[0], encoding="utf-8") as file:
                assert file.read() == "\n".join(lines) + "\n"


def test_batches(spark):
    df = spark.range(23).withColumnRenamed("id", "pair_id")
    rows = transcripts.assign_batches(df, ["pair_id"]).collect()
    assert sorted((r.pair_id, r.batch) for r in rows) == [(n, n // 10) for n in range(23)]


@pytest.mark.parametrize("text, corrupted", [("fine", False), ("a ` b", True), ("x[]", True), ("{x}", False), ("}}", True), (None, False)])
def test_corruption_markers(spark, text, corrupted):
    df = spark.createDataFrame([(text,)], "opponent string")
    assert transcripts.flag_corrupted(df).first().corrupted is corrupted


def test_records(spark):
    text = "intro EXAMPLE: one EXAMPLE:  EXAMPLE:two\nlines EXAMPLE: " + "x" * 281 + "EXAMPLE:three"
    df = spark.createDataFrame([("t", 1, text), ("t", 2, "EXAMPLE: four"), ("u", 3, "none")], "topic string, gen_id bigint, text string")
    found = transcripts.split_marked_records(df, per_topic=3).orderBy("record_no").collect()
    assert [r.record for r in found] == ["one", "two\nlines", "three"]


PAIRS = "pair_id bigint, topic string, position string, proponent string, opponent string"


def test_resume_keeps_earlier_rows_and_corrupted_ones(spark):
    pairs = spark.createDataFrame(
        [(1, "t", None, "a", "b"), (2, "t", "p", "c", "d"), (3, "t", "p", "e", "f []")], PAIRS
    )
    responses = spark.createDataFrame(
        [(1, "Directness: 9"), (2, "Directness: 8")], "pair_id bigint, response string"
    )
    first = evaluate_pairs(pairs.filter("pair_id <> 2"), responses)
    again = evaluate_pairs(pairs, responses, done=first)
    assert sorted(r.pair_id for r in again.collect()) == [1, 2, 3]
    pending = transcripts.resume_pending(pairs, first)
    assert [r.pair_id for r in pending.collect()] == [2]
    assert again.filter("pair_id = 3").first().harmfulness == 8.0
