"""SimHash components and MinHash fingerprints against brute force."""

import hashlib
import itertools

import numpy as np
import pytest
import xxhash

from rollsight.llm import catalog, fingerprints, simhash_index
from rollsight.llm.components import connected_components
from tests.llm.rows import empty_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"


def plain_simhash(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        str.maketrans({c: " " for c in "\t\n\v\f\r"})
    ).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(shingles))


def plain_components(points, distance=3):
    """points: {fingerprint: smallest id} -> {fingerprint: smallest id of its component}."""
    prints = list(points)
    top = {p: p for p in prints}

    def find(p):
        while top[p] != p:
            p = top[p]
        return p

    array = np.array(prints, dtype=np.uint64)
    for k, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[k]) <= distance):
            top[find(p)] = find(prints[j])
    low = {}
    for p in prints:
        root = find(p)
        low[root] = min(low.get(root, points[p]), points[p])
    return {p: low[find(p)] for p in prints}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: plain_simhash(r["text"]) for r in docs}
    points = {}
    for doc, p in prints.items():
        points[p] = min(points.get(p, doc), doc)
    expected = plain_components(points)
    got = catalog.QUERIES["op4_simhash_components"](spark, SF_DIR).collect()
    assert len(got) == len(docs)
    for r in got:
        assert int(r["fingerprint"], 16) == prints[r["doc_id"]] and len(r["fingerprint"]) == 16
        assert r["component_id"] == expected[prints[r["doc_id"]]]


@pytest.mark.parametrize("bucket_rows", [256, 2])
def test_pairs_equal_brute_force(spark, bucket_rows):
    """With tiny buckets every shared half goes the way of crowded ones."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2 ** 63, 20)
    prints = {int(b) for b in base}
    for b in base.tolist():
        for _ in range(25):
            flips = draw.choice(64, draw.integers(1, 6), replace=False)
            prints.add(int(np.int64(np.uint64(b) ^ np.uint64(sum(1 << int(f) for f in flips)))))
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {(r["a"], r["b"]) for r in simhash_index.near_pairs(frame, bucket_rows=bucket_rows).collect()}
    mask = (1 << 64) - 1
    expected = {
        (min(a, b), max(a, b)) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & mask).bit_count() <= 3
    }
    assert got == expected and len(got) > 20


def test_components_of_chains_stars_and_nothing(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (5, 4), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = {r["node"]: r["root"] for r in connected_components(frame, "a", "b").collect()}
    assert found == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}}
    assert connected_components(frame.where("a < 0"), "a", "b").count() == 0


def test_simhash_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = simhash_index.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in by[1] + by[2]] == [1, 1, 1]
    assert {by[k][0]["fp"] for k in (3, 4, 5)} == {0} and {by[k][0]["component_id"] for k in (3, 4, 5)} == {3}
    assert sorted(r["component_id"] or -1 for r in by[None]) == [-1, 3]
    kept = simhash_index.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    # 8 and 9 share most shingles, but not enough for three bits; the copies of 1 and 4, 5 go.
    assert ids.count("1") == 1 and "2" not in ids and "4" not in ids and ids.count("None") == 2
    assert simhash_index.first_of_each(empty_documents(spark)).count() == 0
    assert simhash_index.near_duplicates(empty_documents(spark)).count() == 0


def jaccard(a, b):
    a, b = set(fingerprints.shingle_set(a).tolist()), set(fingerprints.shingle_set(b).tolist())
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_fingerprints_estimate_likeness(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in catalog.QUERIES["op10_minhash_fingerprints"](spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    prints, off = {}, []
    for row, after in zip(docs, docs[1:] + docs[:1]):
        text, n = row["text"], len(row["text"])
        edited = text[:n - n // 4] + after["text"][:n // 4]
        r = got[row["doc_id"]]
        assert r["n_chars"] == n and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        off.append(r["near_edited"] - jaccard(text, edited))
        off.append(r["near_next"] - jaccard(text, after["text"]))
    assert abs(np.mean(off)) < 0.005 and np.sqrt(np.mean(np.square(off))) < 0.03 and np.max(np.abs(off)) < 0.2


def test_fingerprints_of_odd_rows(spark):
    docs = odd_documents(spark)
    got = fingerprints.compared_with_next(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by[1]) == 2 and by[1][0]["near_next"] == 1.0
    assert by[3][0]["fingerprint"] == "" and by[3][0]["near_next"] == 1.0 and by[5][0]["near_next"] == 0.0
    assert by[7][0]["n_chars"] == len("alpha beta " * 40_000)
    assert len(by[None]) == 2
    assert fingerprints.compared_with_next(empty_documents(spark)).count() == 0
    one = fingerprints.compared_with_next(docs.where("doc_id = 2")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0 and one[0]["near_edited"] < 1.0


def test_packed_bits_hold_the_signature():
    maker = fingerprints.Bins(64, 2)
    made = maker.signature(np.arange(1, 6, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    digits = maker.packed(made)
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(digits), np.uint8)).reshape(64, 2)
    assert (bits[:, 0] * 2 + bits[:, 1] == made).all()
