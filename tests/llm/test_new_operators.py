"""Collocations, WARC bundles and spelling variants, against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from histload.llm import collocations, spelling, warc
from histload.session import scratch_path

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# --- spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:n] + b[n + 1 :] == a for n in range(len(b)))


def variants_by_force(rows, shortest=7, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    out, forms = {}, {}
    for word, n in counts.items():
        near = [w for w in counts if abs(len(w) - len(word)) < 2 and one_edit(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        forms[word] = form
        out[word] = [form, None, n, len(near), counts[form] if form else None]
    for word, row in out.items():
        root = word
        while forms[root]:
            root = forms[root]
        row[1] = root
    return {(w, *row) for w, row in out.items()}


def misspelt(seed=4):
    """Words of a small alphabet, their variants, and chains of them."""
    rng, rows = random.Random(seed), []
    letters = "abcé"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 12))) for _ in range(40)]
    stems += ["abcabca", "bcabcab", "aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "x" * 300, "x" * 301, "Ünïcöde×÷ÿ"]
    for doc_id in range(60):
        out = []
        for _ in range(200):
            word = stems[min(int(rng.expovariate(0.15)), len(stems) - 1)]
            if rng.random() < 0.3:
                place = rng.randrange(len(word))
                word = word[:place] + rng.choice(["", rng.choice(letters), word[place] * 2]) + word[place + 1 :]
            out.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((doc_id, " ".join(out)))
    return rows + [(None, "éabcabca " * 9), (7, None), (8, ""), (9, "short words only"), (None, None), (1, rows[1][1])]


@pytest.mark.parametrize("size", [spelling.LIST, 3])
def test_variants(spark, monkeypatch, size):
    monkeypatch.setattr(spelling, "LIST", size)
    rows = misspelt()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "text AS word", "1 AS n").repartition(3)
    found = spelling.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()
    wanted = variants_by_force(rows)
    assert sum(row[1] is not None for row in wanted) > 20
    assert len(found) == len(wanted) and set(map(tuple, found)) == wanted


def test_variants_of_nothing(corpus, nothing):
    assert spelling.spelling_variants(nothing).collect() == []
    rows = [(row["doc_id"], row["text"]) for row in corpus.select("doc_id", "text").collect()]
    found = spelling.spelling_variants(corpus).collect()
    assert set(map(tuple, found)) == variants_by_force(rows)


def test_scan_of_a_list():
    rng = random.Random(9)
    for _ in range(60):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 7))) for _ in range(30)})
        wanted = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]
        assert sorted(spelling.near_pairs(words)) == wanted


# --- collocations


def phrases_by_force(rows, least, top):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = {}
    for (lang, words), a in counts.items():
        if len(words) == 1 or a < least:
            continue
        longer = [
            n for (other, more), n in counts.items()
            if other == lang and len(words) == 2 and len(more) == 3 and n >= least and words in (more[:2], more[1:])
        ]
        if any(100 * n >= 50 * a for n in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = set()
    for lang, own in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def prose(seed=2):
    rng, rows = random.Random(seed), []
    for n in range(400):
        words = [f"{rng.choice('aDé')}{min(int(rng.expovariate(0.4)), 12)}" for _ in range(rng.randint(0, 60))]
        for _ in range(len(words) // 6):
            words.insert(rng.randrange(len(words)), rng.choice([".", ",", "\n", "\t", "New York City", "ab, cd"]))
        rows.append((rng.choice(["en", "de", None, "und", ""]), " ".join(words).replace(" . ", ". ")))
    return rows + [("en", None), (None, None), ("en", ""), ("de", "..,,"), rows[0], rows[0]]


@pytest.mark.parametrize("least,top,held", [(10, 2000, None), (3, 7, None), (10, 2000, 40)])
def test_phrases(spark, monkeypatch, least, top, held):
    if held:
        monkeypatch.setattr(collocations, "HELD", held)
        monkeypatch.setattr(collocations, "WORDS_HELD", held)
        monkeypatch.setattr(collocations, "SLICE", 64)
    rows = prose()
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "text AS word", "1 AS id", "2 AS f")
    found = collocations.collocations(df.repartition(3), least, top).collect()
    wanted = phrases_by_force(rows, least, top)
    assert len(wanted) > 20
    assert len(found) == len(wanted) and set(map(tuple, found)) == wanted


def test_phrases_of_nothing(corpus, nothing):
    corpus, nothing = (df.withColumn("lang", F.col("source")) for df in (corpus, nothing))
    assert collocations.collocations(nothing).collect() == []
    rows = [(row["lang"], row["text"]) for row in corpus.select("lang", "text").collect()]
    assert set(map(tuple, collocations.collocations(corpus, 5).collect())) == phrases_by_force(rows, 5, 2000)


def test_slices_count_every_phrase_once():
    """One text in many slices, and many flushes, give the counts of one filter."""
    import pyarrow as pa

    rng = random.Random(1)
    text = " ".join(rng.choice(["a", "b", "c", "d."]) for _ in range(500))
    batch = pa.RecordBatch.from_pydict({"lang": ["x"], "text": [text]})
    results, every = [], (b"\xff" * 4096, 15)
    for size, held in ((collocations.SLICE, collocations.HELD), (7, 10)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(collocations, "SLICE", size)
            patch.setattr(collocations, "HELD", held)
            patch.setattr(collocations, "WORDS_HELD", held)
            words, filters = Counter(), []
            for out in collocations._count_words(iter([batch])):
                for row in out.to_pylist():
                    words[row["word"]] += row["n"]
            for out in collocations._Filler(2, 0, 7, every)(iter([batch])):
                filters += [collocations.unpack_filter(raw) for raw in out.column("filter").to_pylist()]
            columns, counts = collocations.merged(filters)
            results.append((words, [c.tolist() for c in columns], counts.tolist()))
    assert results[0] == results[1] and results[0][0]["a"] > 50 and sum(results[0][2]) > 200


@pytest.mark.parametrize("order", [2, 3])
def test_filters_lose_nothing(order):
    rng = np.random.default_rng(order)
    for size in (1, 5, 3000):
        grams = [rng.integers(0, 2**64, size, dtype=np.uint64) for _ in range(order)]
        grams[1][: size // 2] = 0
        columns = collocations.permuted(grams)
        assert all((a == b).all() for a, b in zip(collocations.permuted(columns, back=True), grams))
        counts = rng.integers(1, 2 ** rng.integers(1, 50), size)
        packed = collocations.merged([(columns, counts), (columns, counts)])
        again = collocations.unpack_filter(collocations.pack_filter(*packed))
        assert (again[1] == packed[1]).all() and packed[1].sum() == 2 * counts.sum()
        assert all((a == b).all() for a, b in zip(again[0], packed[0]))
    # The same first column for different n-grams, out of order in the others.
    one = [np.array([5, 5, 5], np.uint64), np.array([2, 1, 2], np.uint64)]
    columns, counts = collocations.merged([(one, np.array([1, 1, 1]))])
    assert [c.tolist() for c in columns] == [[5, 5], [1, 2]] and counts.tolist() == [1, 2]


@pytest.mark.parametrize("values", [[], [0], [127, 128, 0, 1], [2**64 - 1, 3, 2**35]])
def test_varints(values):
    raw = collocations.varints(np.array(values, np.uint64))
    assert collocations.from_varints(raw).tolist() == values


# --- WARC bundles


def pages_of(spark):
    long_page = "<p>" + "long page " * 60_000
    rows = [
        (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, None), (4, "x\r\nWARC-Type: evil", ""),
        (5, "http://a/5", long_page), (6, "http://a/6", long_page + "!"), (7, "http://a/ü", "Ünïcode\r\n\r\nWARC/1.1\r\n數"),
        (8, "u", "<p>one</p>"), (8, "u", "<p>one</p>"), (8, "u", "<p>two</p>"), (None, "u", "<p>one</p>"),
        (None, None, "only without id"), (None, "v", "only without id"), (9, "u", "a"), (10, "u", "a"),
    ]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return df.selectExpr("*", "html AS sha", "1 AS lead", "true AS revisit"), rows


@pytest.mark.parametrize("least,frame,frames", [(0, 200, 3), (0, warc.FRAME, 256), (5, 500, 2)])
def test_records_read_back(spark, least, frame, frames):
    df, rows = pages_of(spark)
    path = scratch_path(spark, "warc")
    warc.write_bundles(df.repartition(2), path, least, frame, frames)
    leads = {}
    for page_id, _, html in rows:
        leads.setdefault(html or "", []).append(page_id)
    wanted = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        ids = [i for i in leads[html or ""] if i is not None]
        lead = max(ids, default=None)
        again = len(body) >= least and len(leads[html or ""]) > 1 and page_id != lead
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        wanted.append((page_id, len(body), digest, "revisit" if again else "response", lead if again else None))
    records = warc.read_records(spark, path)
    found = warc.resolved(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    texts = {row["payload"] for row in records.collect() if row["record_type"] == "response"}
    assert texts == {html or "" for _, _, html in rows}


def test_bundles_are_seekable_files(spark):
    df, rows = pages_of(spark)
    path = scratch_path(spark, "warc")
    warc.write_bundles(df.coalesce(1), path, frame=300, frames=4)
    bundles = {}
    for row in spark.read.parquet(f"{path}/bundles").collect():
        bundles.setdefault(row["bundle"], []).append((row["place"], bytes(row["data"])))
    index = spark.read.parquet(f"{path}/index").collect()
    assert len(bundles) > 1 and len(index) == len(rows)
    for bundle, parts in bundles.items():
        data = b"".join(raw for _, raw in sorted(parts))
        places = warc.frame_places(data)
        assert len(places) == len(parts) - 1
        # A plain reader sees the records in order and passes over the table.
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(plain) == sum(size for _, _, size in places)
        assert sum(1 for _ in warc.parse_records(plain)) == sum(row["bundle"] == bundle for row in index)
        for row in index:
            if row["bundle"] == bundle:
                start, packed, size = places[row["frame"]]
                one = zstandard.ZstdDecompressor().decompress(data[start : start + packed])
                assert len(one) == size
                own = one[row["offset"] : row["offset"] + row["length"]]
                ((_, head, _),) = warc.parse_records(own)
                assert head["WARC-Record-ID"] == row["record_id"] and "evil" not in head["WARC-Type"]


def test_fetch_of_single_records(spark):
    df, _ = pages_of(spark)
    path = scratch_path(spark, "warc")
    warc.write_bundles(df, path, frame=300)
    name = warc.record_name(7, hashlib.sha256("Ünïcode\r\n\r\nWARC/1.1\r\n數".encode()).digest())
    (row,) = warc.fetch(spark, path, [name]).collect()
    assert row["page_id"] == 7 and row["payload"].endswith("數") and row["target_uri"] == "http://a/ü"
    assert warc.fetch(spark, path, ["nothing"]).collect() == []


def test_bundles_of_nothing(spark):
    df, _ = pages_of(spark)
    path = scratch_path(spark, "warc")
    warc.write_bundles(df.where("false"), path)
    assert warc.resolved(warc.read_records(spark, path)).collect() == []
    assert spark.read.parquet(f"{path}/index").collect() == []


def test_many_payloads_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(warc, "maybe_broadcast", lambda df, size: df)
    df, rows = pages_of(spark)
    path = scratch_path(spark, "warc")
    warc.write_bundles(df, path)
    assert warc.read_records(spark, path).where("record_type = 'revisit'").count() == 5
