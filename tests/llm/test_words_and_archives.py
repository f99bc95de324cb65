"""Phrase mining, spelling groups and archives against brute force, on hard rows."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rejoinder.llm import collocations, spelling, warc
from rejoinder.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, word string, id int, a double, x string, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hard_rows():
    chance = random.Random(11)
    words = ["Alpha", "beta", "gamma", "délta", "DÉLTA", "the", "of", "x", "alphas", "alpha", "betta", "gama", "señor", "senor", "q" * 90]
    texts = [" ".join(chance.choices(words, k=chance.randint(0, 60))) for _ in range(50)]
    texts += [None, "", " \t ", "...", "a.b,c;d", "the of the of the of the of", "beta gamma. beta gamma\nbeta\tgamma  beta gamma", "ßeta÷betta×", "IıK kelvin İstanbul"]
    texts += ["the of " * 400_000, "w" * 3_000_000, ("alpha " * 30 + "beta. ") * 20_000]
    rows = [(i, t, chance.choice(["en", "fr", None, "und", ""])) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[4], "en"), (None, None, None), (-7, "alpha beta gamma", "en")]


@pytest.fixture(scope="module")
def rows():
    return hard_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "w", 1, 0.5, "y", 2) for i, t, lang in rows], SCHEMA).repartition(5).cache()


def phrases_by_hand(rows, least):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(zip(*(words[k:] for k in range(size)), strict=False))
    out = set()
    for lang, found in counts.items():
        found = {p: a for p, a in found.items() if a >= least}
        kept = []
        for p, a in found.items():
            if len(p) < 2 or any(len(o) > len(p) and 100 * b >= 100 * a and any(o[k : k + len(p)] == p for k in range(len(o))) for o, b in found.items()):
                continue
            score, _, k = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k, k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:2000], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def test_phrases_equal_brute_force(docs, rows):
    for least in (3, 100):
        got = [tuple(r) for r in collocations.collocations(docs, least=least).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
        assert len(got) == len(set(got))
        assert set(got) == phrases_by_hand(rows, least)


def test_phrases_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(none).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None, None, None, None)], SCHEMA)
    assert collocations.collocations(blank).collect() == []


def test_tiles_add_up_dense_and_sparse():
    chance = np.random.default_rng(3)
    for high, many in ((900, 200_000), (30_000, 5_000)):
        packs = [chance.integers(-1, high, many) for _ in range(5)]
        want, got, tiles = Counter(), Counter(), defaultdict(list)
        for places in packs:
            both = (places[:-1] >= 0) & (places[1:] >= 0)
            want.update(zip(places[:-1][both].tolist(), places[1:][both].tolist(), strict=True))
            for r, c, cells, counts in collocations.cell_counts(places):
                tiles[r, c].append(collocations._block(cells, counts))
        for (r, c), blocks in tiles.items():
            cells, counts = collocations.added(blocks, collocations._cells_of(r, c))
            wide = int(collocations.band_width(c))
            for cell, n in zip(cells.tolist(), counts.tolist(), strict=True):
                got[int(collocations.band_start(r)) + cell // wide, int(collocations.band_start(c)) + cell % wide] += n
        assert got == want


def test_sums_of_many_packs_take_several_rounds(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(collocations, "FAN_IN", 2)
    got = {tuple(r) for r in collocations.collocations(docs.repartition(24), least=5).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == phrases_by_hand(rows, 5)


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000_000, [5_000_000_000_000, 3_000_000_000_000], [4_000_000_000_000, 3_000_000_000_000], 90_000_000_000_000)], "a bigint, fronts array<bigint>, backs array<bigint>, n bigint")
    cut = big.select(collocations._cuts(2).alias("c")).first().c
    assert cut.score == 1000 * 3_000_000_000_000 * 90_000_000_000_000 // (5_000_000_000_000 * 4_000_000_000_000)


def spellings_by_hand(rows):
    counts = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 3}
    near = defaultdict(set)
    gaps = defaultdict(set)
    for w in n:
        for k in range(len(w)):
            less = w[:k] + w[k + 1 :]
            gaps[k, less].add(w)
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for same in gaps.values():
        for a in same:
            near[a] |= same - {a}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda o: (-n[o], o))
            if n[best] >= 2 * n[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def many_spellings():
    """Words that share beginnings and ends, chains of forms, and equal counts."""
    chance = random.Random(2)
    stems = ["abcabc", "abcabd", "aaaaaa", "aaaaa", "zürich", "zurich"] + ["".join(chance.choices("abc", k=chance.randint(5, 8))) for _ in range(300)]
    out = []
    for s in stems:
        out += [s] * chance.choice([3, 3, 6, 12, 30])
        k = chance.randrange(len(s))
        out += [s[:k] + chance.choice("abcé") + s[k + chance.choice([0, 1]) :]] * chance.choice([1, 3, 7])
    chance.shuffle(out)
    return [(k, " ".join(out[k::40]), "en") for k in range(40)]


@pytest.mark.parametrize("block", [40_000, 15])
def test_spellings_equal_brute_force(spark, docs, rows, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)  # the second deals beginnings over several blocks
    more = many_spellings()
    extra = spark.createDataFrame([(i, t, lang, "w", 1, 0.5, "y", 2) for i, t, lang in more], SCHEMA)
    got = [tuple(r) for r in spelling.spelling_variants(docs.unionByName(extra)).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    assert set(got) == spellings_by_hand(rows + more)


def test_spellings_of_nothing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, None, None, None, None, None, None, None)], SCHEMA)).collect() == []


def test_crc_is_joined_without_the_bytes():
    first, words = [b"12:", b"-9:", b":"], [b"a", b"hello", "é".encode() * 30]
    for a in first:
        for b in words:
            got = spelling.joined_crc(np.array([zlib.crc32(a)], np.uint64), np.array([zlib.crc32(b)], np.uint64), np.array([len(b)]))
            assert int(got[0]) == zlib.crc32(a + b)


def test_index_finds_one_error_after_the_exact_part():
    chance = random.Random(8)
    words = sorted({"".join(chance.choices("ab", k=chance.randint(1, 7))) for _ in range(120)})
    size = np.array([len(w) for w in words])
    letters = np.frombuffer("".join(words).encode(), np.uint8).astype(np.int64) - 96
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    exact = size // 2
    q, j = spelling.OneError(letters, size).search(letters, first, size, exact)

    def right(x, y, h):
        if y[:h] != x[:h]:
            return False
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y, strict=True)) == 1
        return len(y) == len(x) + 1 and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))

    want = {(a, b) for a, x in enumerate(words) for b, y in enumerate(words) if right(x, y, len(x) // 2)}
    got = list(zip(q.tolist(), j.tolist(), strict=True))
    assert len(got) == len(set(got))
    assert set(got) == want


PAGES = "page_id bigint, url string, html string, key string, file string, digest string, last int, payload string"


def hard_pages():
    chance = random.Random(4)
    html = ["<p>one</p>", "<p>two é</p>", "", None, "x" * 3_000_000, "\r\n\r\nWARC/1.1\r\n", "short"]
    urls = ["http://www.Example.com/a?b=1#top", "https://example.com:443/a", "https://example.com:8080/", None, "", "no url at all", "http://[bad", "http://ex.org/tab\there\nline", "ftp://é.example/ü"]
    out = [(i, urls[i % len(urls)] if i % 3 else "http://hot.example/", html[i % len(html)]) for i in range(60)]
    out += [(1000 + i, "http://hot.example/", f"<p>{chance.random()}</p>") for i in range(1500)]
    return out + [out[4], out[0], (None, urls[0], html[0]), (None, None, "only here"), (None, None, None)]


def archive_by_hand(pages, least):
    last = {}
    for i, _, html in pages:
        if i is not None:
            last[html or ""] = max(last.get(html or "", i), i)
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        to = last.get(html or "")
        again = len(data) >= least and to is not None and (i is None or i < to)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", to if again else None))
    return Counter(out)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "k", "f", "d", 1, "p") for p in hard_pages()], PAGES).repartition(4).cache()


@pytest.mark.parametrize("least", [0, 7])
def test_archives_equal_brute_force(pages, least):
    got = warc.archive_report(pages, least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert Counter(tuple(r) for r in got) == archive_by_hand(hard_pages(), least)


def test_archives_of_nothing(spark):
    assert warc.archive_report(spark.createDataFrame([], PAGES)).collect() == []


def test_lookup_reads_only_what_is_asked(spark, pages):
    archives, index = scratch_path(spark, "test-archives"), scratch_path(spark, "test-index")
    ranges = warc.write_index(warc.write_archives(pages, archives), index)
    asked = spark.createDataFrame([("com,example,www)/a?b=1",), ("com,example,www)/a?b=1",), ("com,example)/a",), ("zz)/missing",), ("",)], "key string")
    got = warc.lookup(asked, ranges, index, archives).collect()
    want = [p for p in hard_pages() if warc.url_key(p[1]) in {"com,example,www)/a?b=1", "com,example)/a", ""}]
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u.replace("#top", "#top") if u else u) for i, u, _ in want)
    texts = {i: (h or "").encode() for i, _, h in want}
    assert all(r.payload is None if r.record_type == "revisit" else bytes(r.payload) == texts[r.page_id] for r in got if r.page_id is not None)


def test_archive_is_gzip_of_whole_records(spark, pages):
    folder = scratch_path(spark, "test-archive")
    rows = warc.write_archives(pages, folder).collect()
    store, root = warc._place(folder)
    whole = {f: gzip.decompress(store.open_input_stream(f"{root}/{f}", compression=None).read()) for f in {r.file for r in rows}}
    assert sum(len(re.findall(rb"WARC-Type: (?:response|revisit)\r\n", w)) for w in whole.values()) == len(hard_pages())
    assert all(w.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") for w in whole.values())


def test_url_keys():
    assert warc.url_key("https://www.Example.com:443/a b?q=1#x") == "com,example,www)/a%20b?q=1"
    assert warc.url_key("http://example.com:81") == "com,example:81)/"
    assert warc.url_key(None) == ""
    assert warc.url_key("plain") == ")plain"


def test_damaged_payload_is_told():
    good = warc.record(5, "http://a/", b"body")
    assert warc.parsed(good)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parsed(good.replace(b"body\r\n", b"bodY\r\n"))


def test_counted_runs_of_one_batch():
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, None]), "text": pa.array(["Éclair ÉCLAIR éclair", None])})
    assert dict(zip(*spelling.counted_runs(batch, one_in=10**9).to_pydict().values(), strict=True)) == {"Éclair": 2, "éclair": 1}
