"""Conversations far longer than those of the given tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import differences
from oracles import ORACLES
from rejoinder.operators import transcripts
from rejoinder.plans import catalog, fixtures
from rejoinder.plans.catalog import CATALOG
from rejoinder.plans.evaluate_pairs import evaluate_pairs
from rejoinder.plans.fixtures import PAIR_TURNS, Inputs

TABLE = "conv_id bigint, turn bigint, role string, text string"
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def tables(spark, path, conversations):
    """The tables pairs are made of; ``conversations`` lists (conv_id, roles)."""
    rows = [(c, n, role, f"m{c}.{n}") for c, roles in conversations for n, role in enumerate(roles)]
    spark.createDataFrame(rows, TABLE).write.parquet(f"{path}/conversations.parquet")
    documents = [(c, f"d{c}", "en", f"src{c}", 2) for c, _ in conversations]
    spark.createDataFrame(documents, DOCUMENT).write.parquet(f"{path}/documents.parquet")
    return str(path)


def talk(turns, system_first=False):
    start = ["system"] if system_first else []
    return (start + ["user", "assistant"] * turns)[:turns]


def test_debates_are_not_cut(spark, tmp_path):
    path = tables(spark, tmp_path, [(1, talk(2101, True)), (2, talk(2101, True)), (3, talk(2101, True)), (4, talk(4))])
    found = {}
    for r in CATALOG["pair_source_precedence"](spark, path).collect():
        found.setdefault((r.debate_id, r.source), []).append((r.proponent, r.opponent))
    walked = {c: [(f"m{c}.{n}", f"m{c}.{n + 1}") for n in range(1, 2101, 2)] for c in (1, 2)}
    assert {k: sorted(v) for k, v in found.items()} == {
        (1_000_000, "full_debate"): sorted(walked[1]),
        (2_000_000, "history"): sorted(walked[2]),
        (3_000_000, "content"): [("m3.1", "m3.2")],
        (4_000_000, "full_debate"): [("m4.0", "m4.1"), ("m4.2", "m4.3")],
    }


@pytest.mark.parametrize("block", [3, 65_536])
def test_flat_debates_follow_the_same_precedence(spark, block):
    contents = spark.createDataFrame(
        [(1, ("p", "o")), (4, ("p", None))], "debate_id bigint, content struct<proponent: string, opponent: string>"
    )
    rows = []
    for debate, source, name in (
        (1, "full_debate", "a"), (2, "full_debate", "a"), (2, "history", "x"), (3, "history", "a"), (4, "history", "a"),
    ):
        for n in range(5):
            rows.append((debate, source, n, ["system", "proponent", "opponent"][n % 3], f"{name}{n}"))
    messages = spark.createDataFrame(rows, "debate_id bigint, source string, turn bigint, role string, content string")
    found = transcripts.flat_debate_pairs(contents, messages, turn_block=block).collect()
    assert sorted((r.debate_id, r.source, r.proponent, r.opponent) for r in found) == [
        (1, "content", "p", "o"), (2, "full_debate", "a1", "a2"), (3, "history", "a1", "a2"), (4, "history", "a1", "a2"),
    ]


def test_pairs_of_long_conversations_keep_to_themselves(spark, tmp_path):
    path = tables(spark, tmp_path, [(1, talk(150)), (2, talk(150)), (3, talk(4)), (12, talk(150))])
    inputs = Inputs(spark, path)
    pairs = {r.pair_id: r for r in inputs.pairs().collect()}
    assert len(pairs) == 75 + 75 + 2 + 75
    short = {(r.conv_id, r.opponent): n for n, r in pairs.items()}
    assert short[(1, "m1.1")] == 1_000_001 and short[(2, "m2.149")] == 2_000_149
    assert [n for n, _ in sorted(pairs.items())] == sorted(pairs, key=lambda n: (pairs[n].conv_id, int(pairs[n].opponent.split(".")[1])))
    for name in ("default_scores_corrupted", "compile_evaluated_pairs", "evaluate_pairs"):
        assert sorted(r.pair_id for r in CATALOG[name](spark, path).collect()) == sorted(pairs)
    compiled = CATALOG["compile_evaluated_pairs"](spark, path).collect()
    for r in compiled:
        assert pairs[r.pair_id].proponent == r.proponent
        named = f"Reply {r.pair_id} holds up." in (r.raw_response or "")
        assert named == (pairs[r.pair_id].conv_id == 12)  # the full layout, not marked as corrupted
    assert CATALOG["toxicity_averages"](spark, path).count() > 0
    # A second run keeps the earlier rows that are not done again, and no others go.
    first = inputs.scored_pairs()
    again = evaluate_pairs(inputs.marked_pairs(), inputs.rubric_responses(), done=first)
    assert sorted(r.pair_id for r in again.collect()) == sorted(pairs)


def test_pair_ids_at_the_edges(spark, tmp_path):
    last = 2**63 - 1
    turns = [0, 1, 98, 99, 100, 101, PAIR_TURNS - 2, PAIR_TURNS - 1, PAIR_TURNS, PAIR_TURNS + 1]
    rows = [(c, t, ["user", "assistant"][t % 2], "m") for c in (-last - 1, -1, 0, 1, last // PAIR_TURNS, last) for t in turns]
    spark.createDataFrame(rows, TABLE).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([], DOCUMENT).write.parquet(f"{tmp_path}/documents.parquet")
    inputs = Inputs(spark, str(tmp_path))
    assert len({r.pair_id for r in inputs.pairs().collect()}) == 6 * 5
    assert inputs.toxicity().select("pair_id", "hate_scores", "counter_scores").collect()


LONG_QUERIES = [
    "extract_pairs", "pair_source_precedence", "assign_ids", "assign_batches", "default_scores_corrupted", "compile_evaluated_pairs",
    "evaluate_pairs", "rank_pairs", "scan_debates", "render_transcript", "node_counts", "build_paragraphs", "judge_request_table",
]


def test_long_conversations_equal_sql(spark, tmp_path):
    """Pairs of conversations of 150 and 1,500 turns, some with a system message first, against the SQL twins."""
    path = tables(spark, tmp_path, [(1, talk(150)), (2, talk(1500, True)), (3, talk(1500)), (4, talk(150, True)), (15, talk(3))])
    con = duckdb.connect()
    for name in ("conversations", "documents"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet/*.parquet'")
    for name in LONG_QUERIES:
        assert differences(CATALOG[name](spark, path), con, ORACLES[name]) == [], name


def test_written_debates_stay_small_and_whole(spark, tmp_path, monkeypatch):
    path = tables(spark, tmp_path, [(1, talk(5000)), (2, talk(2500)), (3, talk(4)), (4, talk(1, True))])
    places = []

    def place(i, name):
        places.append(str(tmp_path / name))
        return places[-1]

    monkeypatch.setattr(catalog, "_place", place)
    parted = transcripts.with_parts
    monkeypatch.setattr(fixtures, "with_parts", lambda df: parted(df, part_bytes=20_000))
    rows = CATALOG["scan_debates"](spark, path).collect()
    lines = spark.read.text(places[0])
    assert lines.count() == len(rows) and len({(r.debate_id, r.part) for r in rows}) == len(rows)
    # A part holds lines of 20,000 bytes and at most one line more; JSON adds names and quotes.
    assert lines.agg(F.max(F.length("value"))).first()[0] < 80_000
    said = {}
    for r in rows:
        conv = r.debate_id // 1_000_000
        said[conv] = said.get(conv, 0) + r.full_debate_messages + r.history_messages
    assert said == {1: 5000, 2: 2500, 3: 0, 4: 1}
    assert sum(r.debate_id == 1_000_000 for r in rows) > 3
    assert [r.proponent for r in rows if r.debate_id == 3_000_000] == ["m3.0"]
