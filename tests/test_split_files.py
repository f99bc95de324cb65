"""Files whose records hold line breaks, cut into many byte ranges, against the unsplit readers and the Python ones."""

import csv
import json
import random

import pytest

from rejoinder.sources import files, split

ALPHABET = ['"', ",", "\n", "\r", "{", "}", "[", "]", "\\", "é", " ", "word", "x"]


def texts(seed, many):
    chance = random.Random(seed)
    return ["".join(chance.choices(ALPHABET, k=chance.choice([0, 1, 3, 30]))) for _ in range(many)] + ["long " * 3000 + '"\n"', "end"]


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_with_line_breaks(spark, tmp_path, small_ranges):
    rows = [(str(n), t) for n, t in enumerate(texts(1, 600))]
    for name, part in (("a", rows[:400]), ("b", rows[400:])):
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator="\n", quoting=csv.QUOTE_ALL)
            writer.writerow(["id", "text"])
            writer.writerows(part)
    table = files.read_csv(spark, str(tmp_path))
    assert split._lines(spark, str(tmp_path), split.CSV_LINES).rdd.getNumPartitions() > 8
    assert sorted((r.id, r.text) for r in table.collect()) == sorted(rows)


def test_csv_equals_the_unsplit_reader(spark, tmp_path, small_ranges):
    source = spark.createDataFrame([(n, t, None if n % 7 == 0 else float(n)) for n, t in enumerate(texts(2, 400)) if "\r" not in t], "id bigint, text string, score double")
    files.write_csv(source, str(tmp_path / "out"))
    unsplit = spark.read.options(**files.CSV_OPTIONS, nullValue="\\N", multiLine=True).csv(str(tmp_path / "out"))
    assert sorted(map(repr, files.read_csv(spark, str(tmp_path / "out")).collect())) == sorted(map(repr, unsplit.collect()))


@pytest.mark.parametrize("indent", [None, 2])
def test_one_json_array(spark, tmp_path, small_ranges, indent):
    rows = [{"id": n, "text": t, "inner": {"list": [{"k": t}, {"k": "}]"}]}} for n, t in enumerate(texts(3, 300))]
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False), encoding="utf-8", newline="")
    found = split.read_json_array(spark, str(tmp_path), "id bigint, text string, inner struct<list: array<struct<k: string>>>")
    got = sorted((r.id, r.text, tuple(x.k for x in r.inner.list)) for r in found.collect())
    assert got == [(r["id"], r["text"], tuple(x["k"] for x in r["inner"]["list"])) for r in rows]


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("id,text\n")
    assert files.read_csv(spark, str(tmp_path / "e.csv")).collect() == []
    (tmp_path / "e.json").write_text("[]\n")
    assert split.read_json_array(spark, str(tmp_path / "e.json"), "id bigint").collect() == []
