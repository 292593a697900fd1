"""The pipeline's near-duplicate stage against brute force at a likeness of 0.8."""

import numpy as np
import pytest

import corpus_pipeline
from rollsight.llm import fingerprints, resemblance
from tests.llm.rows import empty_documents, odd_documents


def plain_kept(texts):
    """texts: {id: text} -> ids that stay, by comparing all pairs."""
    sets = {k: set(fingerprints.shingle_set(t).tolist()) for k, t in texts.items()}
    top = {k: k for k in texts}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in texts:
        for b in texts:
            both = len(sets[a] | sets[b])
            if a < b and (not both or len(sets[a] & sets[b]) / both >= 0.8):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    return {k for k in texts if find(k) == k}


def edited_texts():
    draw = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    texts, formula = [], "this work may be copied by anyone who asks for it"
    for size in (30, 60, 200):
        for _ in range(4):
            base = draw.choice(words, size).tolist()
            texts.append(" ".join(base))
            for edits in (1, 1, 2, 3, 5):
                copy = list(base)
                for place in draw.choice(size, edits, replace=False):
                    copy[place] = str(draw.choice(words))
                texts.append(" ".join(copy) + (f" {formula}" if draw.random() < 0.3 else ""))
    texts += [f"{formula} {k}" for k in range(12)] + ["", "one", "One", "two words", "a b c d e", "a b c d f"]
    return dict(enumerate(texts))


@pytest.mark.parametrize("bucket_rows", [16, 2])
def test_stage_equals_brute_force(spark, monkeypatch, bucket_rows):
    """With tiny buckets every shared shingle goes the way of crowded ones."""
    monkeypatch.setattr(resemblance, "BUCKET_ROWS", bucket_rows)
    texts = edited_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "")
    expected = plain_kept(texts)
    assert {r["doc_id"] for r in kept.collect()} == expected and len(expected) < len(texts) - 20


def test_shingles_are_those_of_the_fingerprints():
    texts = ["a b c d e f a b c d e", "two Words", None, "", "x " * 50, *edited_texts().values()]
    for text, found in zip(texts, resemblance.shingle_sets(texts, resemblance._Known()), strict=True):
        assert set(found.view(np.uint64).tolist()) == set(fingerprints.shingle_set(text).tolist())


def test_stage_of_odd_rows(spark):
    docs = odd_documents(spark)
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "")
    ids = sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect())
    assert kept.columns == docs.columns
    assert ids.count("1") == 1 and "2" not in ids and "3" in ids and "4" not in ids and "5" not in ids
    assert ids.count("None") == 2 and "8" in ids and "9" not in ids
    assert corpus_pipeline.without_near_duplicates(spark, empty_documents(spark), "").count() == 0


def test_stage_goes_through_the_simhash_index(spark, monkeypatch):
    """Sets at most three bits apart are found by the index; what it links is not paired again."""
    added, left = [], []
    add, apart = resemblance._Links.add, resemblance._Links.apart

    def noted(self, pairs):
        pairs = pairs.persist()
        added.append({frozenset((r["a"], r["b"])) for r in pairs.collect()})
        add(self, pairs)

    def shown(self, pairs):
        pairs = pairs.distinct().persist()
        kept = apart(self, pairs).persist()
        left.append((pairs.count(), kept.count()))
        return kept

    monkeypatch.setattr(resemblance._Links, "add", noted)
    monkeypatch.setattr(resemblance._Links, "apart", shown)
    base = " ".join(f"w{k}" for k in range(3000))
    texts = {1: base, 2: base + " more", 3: "first " + base, 4: " ".join(f"v{k}" for k in range(50)), 5: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = list(resemblance.shingle_sets([texts[k] for k in (1, 2, 3)], resemblance._Known()))
    prints = [resemblance.set_simhash(found) & (2 ** 64 - 1) for found in sets]
    for bit in range(64):
        voted = 2 * sum(int(h) >> bit & 1 for h in sets[0].view(np.uint64)) > len(sets[0])
        assert (prints[0] >> bit & 1) == voted
    assert all((prints[0] ^ other).bit_count() <= 3 for other in prints[1:])
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == plain_kept(texts) == {1, 4, 5}
    assert len(added[0]) == 2 and left == [(left[0][0], 0)] and left[0][0] > 0


def test_sketches_differ_in_no_more_bits_than_the_sets_do():
    draw = np.random.default_rng(8)
    for size, changed in ((0, 0), (5, 0), (90, 15), (700, 90), (5000, 600)):
        one = draw.integers(-2 ** 63, 2 ** 63, size, dtype=np.int64)
        other = np.concatenate((one[changed:], draw.integers(-2 ** 63, 2 ** 63, changed, dtype=np.int64)))
        bits = resemblance.set_sketch(one) ^ resemblance.set_sketch(other)
        assert len(bits) == resemblance.SKETCH_WORDS
        apart = sum(int(word).bit_count() for word in bits.view(np.uint64))
        assert apart <= len(set(one.tolist()) ^ set(other.tolist()))
        assert size > 700 or changed == 0 or apart > changed


def test_crowd_below_the_likeness_is_not_paired(spark, monkeypatch):
    """Near copies that are not alike share crowded shingles; their pairs do not become rows."""
    made, add = [], resemblance._Links.add

    def counted(self, pairs):
        pairs = pairs.persist()
        made.append(pairs.count())
        add(self, pairs)

    monkeypatch.setattr(resemblance._Links, "add", counted)
    draw = np.random.default_rng(9)
    base = [f"w{k}" for k in range(100)]
    texts = {}
    for number in range(120):
        copy = list(base)
        for place in draw.choice(100, 2, replace=False):
            copy[place] = f"own{number}"
        texts[number] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "")
    expected = plain_kept(texts)
    assert {r["doc_id"] for r in kept.collect()} == expected and 20 < len(expected) < 120
    assert len(made) == 2 + resemblance.LEADER_ROUNDS and made[-1] < 5 * len(texts)
