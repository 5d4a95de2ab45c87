"""Encoding, token files and counts that follow edits, against whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from histload.llm import edit_counts, encoding, token_files
from histload.llm.words import find_words, small_batches, text_bytes
from histload.session import scratch_path

ODD = [
    "", " ", "a\x1cb \x85 q w　z", "<|endoftext|>hi <|startoftext|> 's don't I'VE", "é ́a Σας ΑΣ İx",
    "日本語 テスト ①②", " x​y", "x" * 3000, "\x0b a\x0c b\x00c", "it's 3.14 'dog ''s !'s", "ŸÿßÀ×÷µ",
]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(encoding.TOKENIZER))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def decoded(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_the_whole_text(whole, text):
    assert decoded(encoding.encoder().ids(text.encode())) == whole(text)


def test_ids_of_documents_with_a_small_cache(spark, whole, monkeypatch):
    monkeypatch.setattr(encoding, "CACHE_PIECES", 200)
    encoder = encoding.Encoder(public_tokenizers.path(encoding.TOKENIZER))
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for (text,) in rows:
        assert decoded(encoder.ids((text or "").encode())) == whole(text or "")


@pytest.mark.parametrize("unit", [1, 8])
@pytest.mark.parametrize("ids", [[], [0], [7] * 9, list(range(0, 70_000, 7)), [49407, 0, 2**31]])
def test_planes_round_trip(ids, unit):
    block = np.array(ids, np.uint32)
    planes = token_files.pack(block, unit)
    assert token_files.unpack(planes, len(block), unit).tolist() == ids


@pytest.mark.parametrize("block", [3, 64, 1 << 16])
def test_files_hold_every_document(spark, corpus, whole, block):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(corpus, path, block=block, unit=1 if block > 3 else 8)
    rows = token_files.read_documents(spark, path).orderBy("start").collect()
    texts = {}
    for row in corpus.select("doc_id", "text").collect():
        texts.setdefault(row["doc_id"], []).append(row["text"] or "")
    place, order = 0, [row["doc_id"] for row in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert len(rows) == corpus.count()
    for row in rows:
        found = [
            np.array([*whole(text), token_files.END_ID], "<u4") for text in texts[row["doc_id"]]
        ]
        checks = {(len(ids), zlib.crc32(ids.tobytes())) for ids in found}
        assert row["start"] == place
        assert (row["n_tokens"], row["ids_crc32"]) in checks
        place += row["n_tokens"]
    index = spark.read.parquet(f"{path}/index")
    assert index.agg(F.sum("n_ids")).first()[0] == place
    assert index.where(F.col("n_ids") > block).isEmpty()


def test_files_of_no_documents(spark, nothing):
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(nothing, path)
    assert token_files.read_documents(spark, path).collect() == []


def test_tree_follows_random_edits(whole, monkeypatch):
    monkeypatch.setattr(edit_counts, "LEAF", 16)
    count = edit_counts._counter(None)
    rng = random.Random(5)
    words = ["the", "it's", "x", "naïve", "<|endoftext|>", "1234", "a-b"]
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 30, 200])))
        tree = edit_counts.Tree.of(text, count)
        for _ in range(8):
            begin = rng.randint(0, len(text))
            end = min(len(text), begin + rng.choice([0, 1, 7, 60]))
            new = rng.choice(["", " ", "y", "'s", "\n", " new words ", "w" * 50, "a b c d " * 9])
            wanted = text[:begin] + new + text[end:]
            text, _ = tree.edit(text, begin, end, new, count)
            assert text == wanted
            assert tree.tokens == len(whole(text))
            assert int(tree.sums[0, 1]) == len(text)


def test_edits_of_a_table(spark, corpus, nothing, whole):
    state = edit_counts.count_tokens(corpus)
    edits = spark.createDataFrame(
        [(1, 2, 0, 3, "A"), (1, 1, 4, 9, None), (5, 1, 10**9, None, " more"), (3, 1, None, None, "new"), (99, 1, 0, 0, "x")],
        "doc_id bigint, number int, begin bigint, end bigint, replacement string",
    )
    rows = edit_counts.apply_edits(edit_counts.with_edits(state, edits)).collect()
    assert len(rows) == corpus.count()
    for row in rows:
        assert row["n_tokens"] == len(whole(row["text"]))
    texts = {row["doc_id"]: row["text"] for row in rows}
    assert texts[1].startswith("A  brown fox")
    assert texts[3] == "new" and texts[5].endswith(". more")
    assert edit_counts.apply_edits(edit_counts.with_edits(edit_counts.count_tokens(nothing), edits)).count() == 0


def test_words_of_slices(monkeypatch):
    import histload.llm.words as module

    monkeypatch.setattr(module, "SLICE_BYTES", 7)
    column = pa.array(["ab cd", "ef", None, "", "Gh ij", "k" * 50, "l" * 30 + " mm", "AB"])
    words = find_words(*text_bytes(column))
    assert np.diff(words.bounds).tolist() == [2, 1, 0, 0, 2, 1, 2, 1]
    assert words.hashes[0] == words.hashes[-1]  # lower-cased
    batch = pa.RecordBatch.from_arrays([column], names=["text"])
    parts = list(small_batches([batch], "text", limit=10))
    assert pa.concat_arrays([part.column("text") for part in parts]).equals(column)


def test_a_long_word_changes_alone(whole):
    """An edit inside a long word encodes its leaf again, whatever the document's size; a leaf that
    grows is cut, and all sums stay right."""
    count = edit_counts._counter(None)
    text = "some words here " * 2000 + "x" * 2000 + " more words follow" * 2000
    tree = edit_counts.Tree.of(text, count)
    place = text.index("xxxx") + 1000
    edited, encoded = tree.edit(text, place, place + 1, "y", count)
    assert encoded < 3000 and tree.tokens == len(whole(edited))
    grown, encoded = tree.edit(edited, 5, 5, "and many more words " * 300, count)
    assert encoded < 7000 and tree.tokens == len(whole(grown))
    assert tree.leaves()[0].max() < 3000 and tree.sums[0, 1] == len(grown)
    rng = random.Random(6)
    for _ in range(40):
        begin = rng.randrange(len(grown))
        new = rng.choice(["", " ", "z" * 1500, "word " * 400, "a b"])
        grown, encoded = tree.edit(grown, begin, begin + rng.choice([0, 3, 900]), new, count)
        assert encoded < len(grown) / 4 and tree.sums[0, 1] == len(grown)
    assert tree.tokens == len(whole(grown))
