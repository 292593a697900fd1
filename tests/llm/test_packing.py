"""Bin completion and packed rows against brute force and exact round trips."""

import functools
import itertools
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rollsight.llm import bin_completion as B
from rollsight.llm import catalog, packed_ids
from rollsight.llm.tokens import Encoder
from tests.llm.rows import empty_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"
PATH = catalog.tokenizer_path()


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def fewest(sizes, capacity):
    """Exact optimum of small instances by dynamic programming over subsets."""
    n = len(sizes)

    @functools.cache
    def best(mask):
        """(full bins, fill of the last one), smallest."""
        if not mask:
            return 1, 0
        found = (n + 1, 0)
        for k in range(n):
            if mask >> k & 1:
                bins, fill = best(mask & ~(1 << k))
                found = min(found, (bins, fill + sizes[k]) if fill + sizes[k] <= capacity else (bins + 1, sizes[k]))
        return found

    return best((1 << n) - 1)[0]


def test_search_finds_the_optimum_of_small_instances():
    draw = np.random.default_rng(5)
    for _ in range(60):
        capacity = int(draw.integers(8, 40))
        sizes = draw.integers(1, capacity + 1, int(draw.integers(1, 12))).tolist()
        counts = np.bincount(sizes, minlength=capacity + 1)
        plan = B.solve(counts)
        held = np.zeros(capacity + 1, dtype=int)
        for filling, times in plan.patterns:
            assert sum(s * k for s, k in filling) <= capacity
            for s, k in filling:
                held[s] += k * times
        assert (held == counts).all() and plan.sequences == sum(t for _, t in plan.patterns)
        assert plan.sequences == fewest(sizes, capacity)
        assert B.lower_bound(counts) <= plan.sequences


def as_counts(sizes, capacity):
    return np.bincount(sizes, minlength=capacity + 1)


@pytest.mark.parametrize("times", [4, 50, 1000])
def test_pieces_that_fit_without_waste(times):
    """1000 + 2 * 524, 900 + 700 + 448 and 2 * 850 + 348; 700 + 348 beside 1000 is a wrong start."""
    plan = B.solve(as_counts([1000, 524, 524, 900, 700, 448, 850, 850, 348], 2048) * times)
    assert plan.sequences == plan.bound == 3 * times and plan.proven


def fewest_by_counts(sizes, capacity):
    """Exact optimum of many pieces of few lengths: every way to fill a bin, over counts left."""
    lengths = sorted(set(sizes), reverse=True)

    def ways(left, room, place=0):
        if place == len(lengths):
            yield ()
            return
        for n in range(min(left[place], room // lengths[place]), -1, -1):
            for rest in ways(left, room - n * lengths[place], place + 1):
                yield (n, *rest)

    @functools.cache
    def best(left):
        if not any(left):
            return 0
        first = next(k for k, n in enumerate(left) if n)
        return 1 + min(best(tuple(a - b for a, b in zip(left, way))) for way in ways(left, capacity) if way[first])

    return best(tuple(sizes.count(length) for length in lengths))


def test_search_finds_the_optimum_of_forty_pieces_of_few_lengths():
    draw = np.random.default_rng(11)
    for _ in range(12):
        capacity = int(draw.integers(30, 60))
        lengths = draw.integers(capacity // 5, capacity * 2 // 3, 4)
        sizes = draw.choice(lengths, int(draw.integers(25, 41))).tolist()
        plan = B.solve(as_counts(sizes, capacity))
        fewest = fewest_by_counts(sizes, capacity)
        assert plan.sequences == fewest and plan.bound <= fewest


def test_search_finds_packings_without_waste():
    """Whole sequences cut at random places; their number is the optimum."""
    draw = np.random.default_rng(3)
    found = 0
    for _ in range(20):
        sizes = []
        for _ in range(12):
            sizes += np.diff([0, *np.sort(draw.choice(np.arange(1, 2048), 2, replace=False)), 2048]).tolist()
        plan = B.solve(as_counts(sizes, 2048))
        assert plan.bound == 12 and plan.sequences <= 13
        found += plan.sequences == 12
    assert found >= 18


def test_fillings_are_those_that_nothing_dominates():
    """Against all fillings; a dominated one has a piece, or several, that a longer one can replace."""
    draw = np.random.default_rng(7)

    def parts(filling):
        flat = [s for s, n in filling for _ in range(n)]
        return {sum(s for k, s in enumerate(flat) if mask >> k & 1) for mask in range(2 ** len(flat))}

    for _ in range(40):
        room = int(draw.integers(5, 25))
        counts = as_counts(draw.integers(1, 20, 7), 30)
        sizes = np.flatnonzero(counts).tolist()
        every = []
        for taken in itertools.product(*[range(counts[s] + 1) for s in sizes]):
            total = sum(s * n for s, n in zip(sizes, taken))
            if total <= room:
                every.append((total, tuple((s, n) for s, n in zip(sizes[::-1], taken[::-1]) if n)))
        expected = {
            filling for total, filling in every
            if not any(have < t <= have + room - total and counts[t] > dict(filling).get(t, 0)
                       for have in parts(filling) for t in sizes)
        }
        listed = [f for f in B.fillings(counts, room) if f is not None]
        assert len(listed) == len(set(listed)) and set(listed) == expected
        totals = [sum(s * n for s, n in f) for f in listed]
        assert totals == sorted(totals, reverse=True)


def test_a_search_that_ends_early_proves_nothing():
    plan = B.solve(as_counts(np.random.default_rng(2).integers(500, 1100, 200), 2048), steps=1)
    assert plan.sequences > plan.bound and not plan.proven


def test_large_instance_comes_close_to_the_bound():
    counts = np.bincount(np.random.default_rng(1).integers(1, 2049, 20_000), minlength=2049)
    plan, bound = B.solve(counts), B.lower_bound(counts)
    assert plan.sequences <= bound * 1.005 and plan.sequences <= sum(n for _, n in B.best_fit(counts))


def check_packing(rows, documents, plain, capacity):
    """Every id of every document is in exactly one piece and sequences are gapless."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in documents:
        ids = [*plain(text), 0]
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert all(r["length"] == capacity for r in pieces[1:])
        at = 0
        for r in pieces:
            own = np.array(ids[at:at + r["length"]], dtype="<u4")
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(own.tobytes())
            at += r["length"]
        assert at == len(ids)


def test_query_packs_every_id(spark, plain):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = catalog.QUERIES["op6_bin_completion"](spark, SF_DIR).collect()
    check_packing(rows, docs, plain, 2048)
    total = sum(r["length"] for r in rows)
    counts = np.bincount([r["length"] for r in rows], minlength=2049)
    used = len({r["sequence_id"] for r in rows})
    assert {(r["bound"], r["proven"]) for r in rows} == {(used, True)}
    assert used == B.lower_bound(counts) and used - total / 2048 < max(3, 0.01 * used)


def test_packing_of_odd_rows(spark, plain):
    docs = odd_documents(spark).repartition(3)
    digest = {"ids_crc32": ("long", B.crc_of)}
    rows = B.packed(docs, PATH, capacity=64, derive=digest).collect()
    known = {(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in (None, 1)}
    check_packing([r for r in rows], [], plain, 64)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for doc, text in known:
        assert sum(r["length"] for r in by[doc]) == len(plain(text)) + 1
    assert len(by[1]) == 2 and len(by[None]) == 2 and by[3][0]["length"] == 1
    whole = B.packed(docs.where("doc_id = 11"), PATH).collect()
    assert whole[0]["ids"] == [*plain(docs.where("doc_id = 11").first()["text"]), 0]
    assert B.packed(empty_documents(spark), PATH).count() == 0


def test_encoder_equals_the_tokenizer(plain):
    texts = ["", " ", "  a b", "a  b ", "x\n\n y", "tab\tand\u00a0nbsp \u3000wide", "it's  'll", "a \n", "né ñ 12 <|endoftext|>", " lead"]
    texts += [" ".join(texts), "Émile straße\r\n\r\nx"]
    flat, lengths = Encoder(PATH).encode(texts)
    at = 0
    for text, n in zip(texts, lengths):
        assert flat[at:at + n].tolist() == plain(text)
        at += n


def test_room_tree_finds_the_least_room():
    draw, tree, held = np.random.default_rng(2), packed_ids.RoomTree(37), []
    for _ in range(2_000):
        if held and draw.random() < 0.4:
            tree.add(held.pop(int(draw.integers(len(held)))), -1)
        else:
            held.append(int(draw.integers(38)))
            tree.add(held[-1], 1)
        need = int(draw.integers(38))
        assert tree.least(need) == min((h for h in held if h >= need), default=None)


def test_packed_rows_round_trip(spark, plain, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    rows = packed_ids.write_packed(docs, str(tmp_path / "rows"), PATH, row_length=512)
    found = {}
    for r in packed_ids.unpacked(rows).collect():
        found.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert set(found) == set(texts)
    for doc, text in texts.items():
        assert [i for _, ids in sorted(found[doc]) for i in ids] == [*plain(text), packed_ids.END_ID]
    for r in rows.collect():
        ids = np.frombuffer(r["ids"], "<u2")
        assert len(ids) == 512 and r["n_tokens"] == r["cu_seqlens"][-1] <= 512
        assert r["position_resets"] == r["cu_seqlens"][:-1] and (ids[r["n_tokens"]:] == packed_ids.PAD_ID).all()


def test_packed_rows_of_odd_rows(spark, tmp_path):
    rows = packed_ids.packed_rows(odd_documents(spark), PATH, row_length=100, group_tokens=5_000)
    assert sorted(d for r in rows.collect() for d, p in zip(r["doc_ids"], r["pieces"]) if p == 0 and d) == [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert packed_ids.packed_rows(empty_documents(spark), PATH).count() == 0
    assert packed_ids.packed_rows(odd_documents(spark, [(1, ""), (2, None)]), PATH, end_id=None).count() == 0


def test_search_holds_few_listings():
    """A search that runs out of steps leaves thousands of branches open, but not their sums."""
    import tracemalloc

    counts = np.bincount(np.random.default_rng(1).integers(200, 1000, 3000), minlength=2049)
    tracemalloc.start()
    try:
        plan = B.solve(counts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (plan.sequences, plan.bound, plan.proven) == (890, 886, False)
    assert peak < 30e6


def test_parked_listings_change_nothing(monkeypatch):
    draw = np.random.default_rng(2)
    for size in (40, 200):
        counts = np.bincount(draw.integers(200, 1000, size), minlength=2049)
        monkeypatch.setattr(B, "LISTINGS", 1)
        parked = B.solve(counts, steps=600)
        monkeypatch.setattr(B, "LISTINGS", 10_000)
        assert B.solve(counts, steps=600) == parked
