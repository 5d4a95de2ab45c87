"""Exact and near duplicates and benchmark passages, against brute force."""

import random
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from histload.llm import decontamination, exact_dedup, ordered_minhash
from histload.llm.components import components

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def test_exact_groups(corpus, nothing):
    rows = corpus.select("doc_id", "text").collect()
    wanted = {}
    for row in rows:
        norm = re.sub("[\x20\x09-\x0d]+", " ", row["text"] or "")
        wanted.setdefault(norm, []).append(row["doc_id"])
    found = exact_dedup.exact_duplicates(corpus).collect()
    expected = []
    for norm, ids in wanted.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = sha256(norm.encode()).hexdigest()
        expected += [(i, keep, len(ids), i == keep, digest) for i in ids]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert exact_dedup.exact_duplicates(nothing).collect() == []


def test_exact_groups_of_one_digest(corpus, monkeypatch):
    plain = sorted(map(str, exact_dedup.exact_duplicates(corpus).collect()))
    monkeypatch.setattr(exact_dedup, "_shared_digest", lambda groups: True)
    assert sorted(map(str, exact_dedup.exact_duplicates(corpus).collect())) == plain


def common(a, b):
    rows = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, rows[j] = rows[j], max(rows[j], rows[j - 1]) if x != y else before + 1
    return rows[-1]


def is_similar(a, b):
    if not a or not b:
        return len(a) == len(b)
    length = common(a, b)
    return length / (len(a) + len(b) - length) >= ordered_minhash.THRESHOLD - 1e-12


def test_alignment_is_exact():
    rng = random.Random(11)
    for _ in range(400):
        a = [rng.randint(0, rng.choice([5, 1000])) for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            place = rng.randint(0, len(b))
            b[place : place + rng.randint(0, 2)] = [rng.randint(0, 9)] * rng.randint(0, 2)
        arrays = (np.array(x, np.uint64) for x in (a, b))
        assert ordered_minhash.similar(*arrays) == is_similar(a, b)


def shingles(text):
    w = words(text)
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def classes_by_force(rows):
    """(doc_id, text) to class: components of all similar pairs."""
    each = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i in range(len(rows)):
        for j in range(i):
            if is_similar(each[i], each[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    lowest = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[root(n)] = min(lowest.get(root(n), doc_id), doc_id)
    return [lowest.get(root(n)) for n in range(len(rows))]


def families(seed=3):
    """Near copies of all kinds, passages that unlike texts share, and texts of few words."""
    rng = random.Random(seed)

    def text(size):
        return [f"{rng.choice('abcdefgh')}{rng.randint(0, 400)}" for _ in range(size)]

    passage, out = text(40), []
    for size in (12, 30, 60, 120, 120):
        base = text(size)
        out.append(base)
        for _ in range(6):
            copy = list(out[-1] if rng.random() < 0.4 else base)
            for _ in range(rng.randint(0, max(1, size // 30))):
                copy[rng.randrange(len(copy))] = "edit"
            out.append(copy)
        out.append(base[size // 2 :] + base[: size // 2])  # another order
        out.append(base[: int(size * 0.9)])
    out += [text(8) + passage + text(6) for _ in range(12)]
    out += [["just"], ["just"], ["two", "words"], [], []]
    return [(n, " ".join(w)) for n, w in enumerate(out)]


@pytest.mark.parametrize("leaders", [(1, 64), (1, 1)])
def test_near_classes(spark, monkeypatch, leaders):
    monkeypatch.setattr(ordered_minhash, "LEADERS", leaders)
    rows = families()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = ordered_minhash.near_duplicates(df).collect()
    got = {row["doc_id"]: row["class_id"] for row in found}
    wanted = dict(zip([doc_id for doc_id, _ in rows], classes_by_force(rows)))
    assert got == wanted
    for row in found:
        assert row["kept"] == (row["doc_id"] == row["class_id"])
        assert row["class_size"] == sum(c == row["class_id"] for c in wanted.values())


def test_split_keeps_all_similar_pairs(spark):
    rng, rows = random.Random(8), []
    base = [rng.randint(0, 1 << 40) for _ in range(60)]
    for _ in range(120):  # pairs about as similar as the threshold
        own = list(base)
        for place in rng.sample(range(60), rng.randint(2, 8)):
            own[place] = rng.choice([rng.randint(0, 1 << 40), base[0]])
        rows.append(own)
    rows += [base[:20] + [rng.randint(0, 1 << 40) for _ in range(40)] for _ in range(40)]
    arrays = [np.array(own, np.uint64) for own in rows]
    table = [(n, bytearray(own.tobytes())) for n, own in enumerate(arrays)]
    shingles = spark.createDataFrame(table, "node bigint, shingles binary")
    divided = shingles.selectExpr("7L AS bucket", "node", "node AS label")
    found = {}
    for row in ordered_minhash._split(divided, shingles, 64).collect():
        found.setdefault(row["bucket"], set()).add(row["node"])
    met = {(a, b) for own in found.values() for a in own for b in own if a < b}
    similar = [
        (a, b) for b in range(160) for a in range(b) if ordered_minhash.similar(arrays[a], arrays[b])
    ]
    assert len(similar) > 500 and met.issuperset(similar)
    assert not any(b >= 120 for _, b in met)


def test_few_alignments_of_copies_with_many_edits(spark, monkeypatch):
    rng, made = random.Random(5), []
    base = [f"w{rng.randint(0, 1 << 30)}" for _ in range(140)]
    rows = []
    for n in range(160):
        copy = list(base)
        for place in rng.sample(range(140), rng.choice([1, 2, 5, 6, 7])):
            copy[place] = rng.choice([f"e{rng.randint(0, 4)}", f"w{rng.randint(0, 1 << 30)}"])
        rows.append((n, " ".join(copy)))
    verify = ordered_minhash._verify

    def counted(pairs, shingles):
        made.append(pairs.count())
        return verify(pairs, shingles)

    monkeypatch.setattr(ordered_minhash, "_verify", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {row["doc_id"]: row["class_id"] for row in ordered_minhash.near_duplicates(df).collect()}
    assert got == dict(zip(range(160), classes_by_force(rows)))
    assert sum(made) < 6 * len(rows)


def test_parity_bounds_what_is_common():
    rng, texts = random.Random(6), []
    for size in (1, 5, 40, 40, 300, 3000):
        base = [f"w{rng.randint(0, size)}" for _ in range(size)]
        for edits in (0, size // 40, size // 8):
            copy = list(base)
            for place in rng.sample(range(size), edits):
                copy[place] = f"e{rng.randint(0, 9)}"
            texts.append(" ".join(copy))
    own = ordered_minhash.Shingles(pa.array([*texts, ""]))
    bits = ordered_minhash.parity(own)
    sizes = np.diff(own.bounds)
    sets = [set(own.labelled()[a:b].tolist()) for a, b in zip(own.bounds[:-1], own.bounds[1:])]
    for i in range(len(sizes)):
        for j in range(i):
            differ = int(np.bitwise_count(bits[i] ^ bits[j]).sum())
            assert differ <= len(sets[i] ^ sets[j])
            assert differ > 0 or sets[i] == sets[j] or len(sets[i] ^ sets[j]) > 9
    assert sizes[-1] == 0 and not bits[-1].any()


def test_near_classes_of_odd_rows(corpus, nothing):
    found = ordered_minhash.near_duplicates(corpus).collect()
    assert len(found) == corpus.count()
    by_id = {row["doc_id"]: row["class_id"] for row in found if row["doc_id"] is not None}
    assert by_id[1] == by_id[2] == 1 and by_id[5] == by_id[6] == 5 and by_id[3] == by_id[4] == 3
    kept = [(row["doc_id"], row["class_id"]) for row in found if row["kept"]]
    assert all(doc_id == class_id for doc_id, class_id in kept)
    assert ordered_minhash.near_duplicates(nothing).collect() == []


def test_components_of_chains(spark):
    pairs = [(n, n + 1) for n in range(0, 40) if n % 10 != 9] + [(100, 5), (7, 7)]
    labels = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    wanted = {n: n // 10 * 10 for n in range(40)} | {100: 0}
    assert {row["node"]: row["label"] for row in labels} == wanted


def hits_by_force(text, items):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        own = words(item)
        wins = [own[i : i + 10] for i in range(max(1, len(own) - 9))] if own else []
        for win in wins:
            for at in range(len(w) - len(win) + 1):
                if w[at : at + len(win)] == win:
                    hit.update(range(at, at + len(win)))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_BYTES, 300])
def test_benchmark_hits(spark, corpus, limit):
    items = [
        (1, "QUICK brown fox jumps over the lazy dog near the old river bank"),
        (10, "over the lazy dog near the old river bank today. Of"),
        (2, "one"), (3, "again and"), (4, None), (5, "..."), (None, "wörds ÄÖÜ"), (2, "wörds äöü"),
        (6, "word3 and3 word4 and4 word5 and5 word6 and6 word7 and7 word8"),
        (7, "and again and"), (8, "words that nothing has"),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("win", F.lit(1))
    rows = decontamination.contaminated(corpus, benchmark, broadcast_bytes=limit).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows), key=str)
    texts = corpus.select("doc_id", "text").collect()
    wanted = [(r["doc_id"], *hits_by_force(r["text"], items)) for r in texts]
    assert got == sorted(wanted, key=str)


def test_benchmark_of_nothing(spark, corpus, nothing):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontamination.contaminated(corpus, empty).collect()
    assert len(rows) == corpus.count() and all(row["n_hit"] == 0 for row in rows)
    one = spark.createDataFrame([(1, "one")], empty.schema)
    assert decontamination.contaminated(nothing, one).collect() == []
