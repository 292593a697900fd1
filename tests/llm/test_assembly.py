"""Fill-in-middle, conversation repair and rendezvous shards against brute force and round trips."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollsight.functions.session import scratch_folder
from rollsight.llm import catalog, conversation_repair as R, fill_middle as M, rendezvous as S
from tests.compare import check_engine, difference
from tests.llm.rows import empty_documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_conversation_repair", "op13_rendezvous_shards"])
def test_queries_match_their_sql(spark, name):
    assert difference(catalog.QUERIES[name](spark, SF_DIR), check_engine(SF_DIR), catalog.CHECKS[name]) is None


# Fill-in-middle

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_fim(doc_id, text):
    """Straight from the definition, on one whole text."""
    text = text or ""
    digits = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not n or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ODD_TEXTS = [
    "", None, "a", "<", "<P", "P>", "<S", "ends in <", "ends in <M", "S> starts", "has <M> inside", "<<P>>", "😀é" * 50,
    "<" * 40, "<S" * 40, ">" * 7, "x" * 5_000, "line\nline\n",
]


@pytest.mark.parametrize("units", [1, 2, 3, 7, 16_384])
def test_outputs_and_rebuilt_texts_for_every_chunk_size(spark, units):
    rows = [(k, text) for k, text in enumerate(ODD_TEXTS * 6)] + [(3, "same"), (3, "same"), (None, "x y z"), (None, None)]
    if units < 3:
        rows = [(k, (t or "")[:200]) for k, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter(expected_fim(*row) for row in rows)
    assert Counter(map(tuple, M.transformed(docs, units).collect())) == want
    digests = Counter({(*w[:5], sha(w[5]), None): c for w, c in want.items()})
    got = M.digests(docs, units).collect()
    assert Counter((*r[:6], None) for r in got) == digests
    assert Counter((r[0], r[6]) for r in got) == Counter((i, sha(t or "")) for i, t in rows)


def test_marks_are_found_in_streams_of_any_cut():
    draw = random.Random(3)
    for _ in range(400):
        text = "".join(draw.choice("<PSM>a") for _ in range(draw.randrange(1, 14)))
        if re.search("<[PSM]>", text):
            continue
        a, b = sorted(draw.choices(range(len(text) + 1), k=2))
        form = draw.choice(["psm", "spm"])
        output = "".join(mark + body for mark, body in M.parts(text, form, a, b - a))
        cuts = sorted(draw.choices(range(len(output) + 1), k=4))
        chunks = [output[i:j] for i, j in zip([0, *cuts], [*cuts, len(output)])]
        assert "".join(chunk for _, chunk in sorted(M.origins(form, chunks))) == text
    with pytest.raises(ValueError):
        list(M.origins("psm", ["<P>only"]))


def test_second_sort_moves_nothing(spark):
    docs = spark.createDataFrame([(k, f"text {k} " * 9) for k in range(50)], "doc_id long, text string")
    lineage = M.restored(M.assembled(docs, 5))._jrdd.rdd().toDebugString()
    assert lineage.count("ShuffledRDD") + lineage.count("PairwiseRDD") == 2  # one shuffle: its write and its read


def test_fill_middle_on_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    got = Counter(map(tuple, M.transformed(docs).collect()))
    assert got == Counter(expected_fim(r["doc_id"], r["text"]) for r in docs.collect())
    assert M.digests(empty_documents(spark)).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert dict(M.digests(named).dtypes)["doc_id"] == "string"


# Conversation repair

def faults_of(rows):
    """(role, text, fault) from (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        core = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else None
        if fault is None and core[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """All edit sequences of a short conversation: (cost, audit, repaired text), the least."""
    best = None
    longest = 2 * len(rows) + 2

    def walk(k, cost, audit, out):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(rows):
            initials = "".join(line[:1] for line in out)
            if re.fullmatch("(s?(ua)+)?", initials):
                found = cost, audit, "\n".join(out)
                best = found if best is None else min(best, found)
        if len(out) < longest:
            for role in ("user", "assistant"):
                if audit[-2:] != "II":
                    walk(k, cost + 3, audit + "I", [*out, f"{role}:"])
                    if k < len(rows) and rows[k][2] not in ("blank", "duplicate"):
                        extra = 3 * (rows[k][2] == "truncated")
                        walk(k + 1, cost + 3 + extra, audit + "R", [*out, f"{role}:{rows[k][1]}"])
                elif k < len(rows) and rows[k][2] not in ("blank", "duplicate"):
                    extra = 3 * (rows[k][2] == "truncated")
                    walk(k + 1, cost + 3 + extra, audit + "R", [*out, f"{role}:{rows[k][1]}"])
        if k < len(rows):
            if rows[k][2] not in ("blank", "duplicate"):
                walk(k + 1, cost + 3 * (rows[k][2] == "truncated"), audit + "K", [*out, f"{rows[k][0]}:{rows[k][1]}"])
            walk(k + 1, cost + 4, audit + "D", out)

    # A bound to start from: everything deleted.
    best = 4 * len(rows), "D" * len(rows), ""
    walk(0, 0, "", [])
    return best


def searched(rows):
    search = R.Search()
    edits = []
    for row in rows:
        edits += search.push((0, *row))
    edits += search.finish()
    lines = [f"{role}:{text}" for letter, _, _, role, text in edits if letter != "D"]
    return search.cost, "".join(e[0] for e in edits), "\n".join(lines)


ROLES = ["user", "assistant", "system", "tool", "u", ""]


def test_search_finds_the_least_of_all_edit_sequences():
    draw = random.Random(12)
    for _ in range(120):
        rows = [
            (draw.choice(ROLES), f"t{k}.", draw.choice([None, None, "truncated", "blank", "duplicate"]))
            for k in range(draw.randrange(0, 5))
        ]
        assert searched(rows) == cheapest(rows), rows


def by_tables(rows):
    """The same optimum from whole strings per state, without a tree or survivors' places."""
    states = {0: (0, "", ())}
    steps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def closed(now):
        for _ in range(3):
            for state, (cost, audit, out) in list(now.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    into = steps[state].get(initial)
                    if into is not None:
                        made = cost + 3, audit + "I", (*out, f"{role}:")
                        if into not in now or made < now[into]:
                            now[into] = made
        return now

    for role, text, fault in rows:
        grown = {}
        for state, (cost, audit, out) in closed(states).items():
            options = [(state, (cost + 4, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                for name, price, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                    into = steps[state].get(name[:1])
                    if into is not None:
                        options.append((into, (cost + extra + price, audit + letter, (*out, f"{name}:{text}"))))
            for into, made in options:
                if into not in grown or made < grown[into]:
                    grown[into] = made
        states = grown
    states = closed(states)
    cost, audit, out = min(states[k] for k in (0, 3) if k in states)
    return cost, audit, "\n".join(out)


def test_search_on_long_conversations_of_every_kind():
    draw = random.Random(7)
    for roles, odds in itertools.product([ROLES, ["tool"], ["user", "assistant"], ["system"]], [0.0, 0.2, 0.7]):
        for _ in range(12):
            rows = [
                (draw.choice(roles), f"t{k}.", draw.choice(["truncated", "blank", "duplicate"]) if draw.random() < odds else None)
                for k in range(draw.randrange(0, 60))
            ]
            assert searched(rows) == by_tables(rows), rows


def open_nodes(search):
    count, todo = 0, [search.base]
    while todo:
        node = todo.pop()
        count += 1
        todo += node.children
    return count


def test_memory_stays_small_and_edits_come_out_early():
    search, emitted, most = R.Search(), 0, 0
    draw = random.Random(1)
    for k in range(20_000):
        role = ("user", "assistant")[k % 2] if draw.random() > 0.2 else draw.choice(ROLES)
        emitted += sum(1 for _ in search.push((k, role, "x.", draw.choice([None, None, None, "truncated"]))))
        most = max(most, open_nodes(search))
    assert most < 300 and emitted > 19_000


def test_unresolved_ties_of_a_whole_conversation():
    rows = [("tool", f"t{k}.", None) for k in range(20_001)]
    cost, audit, _ = searched(rows)
    # One row too many: of all rows that could be deleted the first comes first in ASCII order.
    assert (cost, audit) == (3 * 20_000 + 4, "D" + "R" * 20_000)


CONVERSATIONS = "conv_id long, turn long, role string, text string, cost long, kind int"


def test_repair_of_odd_conversations(spark):
    rows = [
        (1, None, "user", "no turn.", 0, 0), (1, None, None, None, 0, 0), (1, 3, "assistant", "ok.", 0, 0),
        (1, 3, "assistant", "ok.", 0, 0), (1, 7, "user", "unfinished", 0, 0), (None, 1, "user", "null id.", 0, 0),
        (None, 2, "assistant", "   ", 0, 0), (2, None, "user", "hi.", 0, 0), (3, 5, "assistant", "x" * 100_000 + ".", 0, 0),
    ]
    table = spark.createDataFrame(rows, CONVERSATIONS)
    got = {r["conv_id"]: r for r in R.summaries(table).collect()}
    assert set(got) == {1, 2, 3, None}
    kept = {}
    for conv_id, turn, role, text, *_ in rows:
        kept.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv_id, turns in kept.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        marked = faults_of(turns)
        cost, audit, out = by_tables(marked)
        r = got[conv_id]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, sha(out))
        faults = Counter(f for *_, f in marked)
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults[f] for f in R.FAULTS]
    assert got[1]["gaps"] == 3 and got[2]["gaps"] == 0
    edits = R.repaired(table).collect()
    assert {(r["conv_id"], r["edit"]) for r in edits if r["turn"] is None and r["edit"] == "I"} >= {(2, "I")}
    assert R.summaries(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_damage_and_conversations_without_rows_left(spark):
    rows = [(c, t, "user", "All. Is! Well?") for c in range(40) for t in range(4)] + [(None, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    number = {(c, t): zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, *_ in rows}
    got = Counter((r["conv_id"], r["turn"], r["dropped"], r["text"]) for r in R.damaged(table).collect())
    want = Counter()
    for c, t, _, text in rows:
        text, kind = " " if text is None else text, number[c, t]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want[c, t, kind == 0, text] += 2 if kind == 3 else 1
    assert got == want
    gone = R.damaged(table).withColumn("dropped", F.lit(True))
    row = R.summaries(gone).where("conv_id = 5").first()
    assert tuple(row)[1:8] == (0, 0, 0, 0, 0, 0, "") and row["repaired_sha256"] == sha("")


def test_duplicates_in_crowds_of_one_row(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "same text.") for t in range(300) for _ in range(2)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    row = R.summaries(table).first()
    assert (row["duplicate"], row["gaps"], row["cost"]) == (598, 0, 4 * 598)


# Rendezvous shards

def owner(key, weights):
    import math

    def cost(shard):
        digits = sha(f"{key}:{shard // 5}")[shard % 5 * 12:shard % 5 * 12 + 12]
        return -math.log((int(digits, 16) + 0.5) / 16 ** 12) / weights[shard]

    return min((cost(s), s) for s, w in weights.items() if w > 0)[1]


def shards(spark, n, weights):
    found = spark.range(n).select("id", S.shard_of(F.col("id"), weights).alias("shard")).collect()
    return {r["id"]: r["shard"] for r in found}


def test_shards_follow_weights_and_move_few_records(spark):
    weights = {0: 1.0, 1: 2.0, 2: 0.0, 3: 1.0, 7: 4.0}
    before = shards(spark, 4_000, weights)
    assert before == {k: owner(k, weights) for k in before}
    share = Counter(before.values())
    assert share[2] == 0 and all(abs(share[s] / 4_000 - w / 8) < 0.03 for s, w in weights.items())
    grown = shards(spark, 4_000, {**weights, 8: 1.0})
    moved = {k for k in before if before[k] != grown[k]}
    assert {grown[k] for k in moved} == {8} and abs(len(moved) / 4_000 - 1 / 9) < 0.03
    shrunk = shards(spark, 4_000, {**weights, 1: 0.0})
    assert all(shrunk[k] == s for k, s in before.items() if s != 1)
    heavier = shards(spark, 4_000, {**weights, 3: 1.5})
    assert {heavier[k] for k in before if before[k] != heavier[k]} == {3}
    assert shards(spark, 5, {4: 1.0}) == dict.fromkeys(range(5), 4)


@pytest.mark.parametrize("bad", [{}, {0: 0.0}, {-1: 1.0}, {0: -1.0}, {0: float("nan")}])
def test_wrong_weights_are_refused(spark, bad):
    with pytest.raises(ValueError):
        S.shard_of(F.lit(1), bad)


def test_written_shards_keep_all_rows_and_slots_have_no_gaps(spark):
    docs = odd_documents(spark)
    stored = S.write_shards(docs, scratch_folder(spark, "shards"), dict.fromkeys(range(4), 1.0), ties=("text",))
    rows = stored.collect()
    names = docs.columns
    assert Counter(str([r[n] for n in names]) for r in rows) == Counter(str(list(r)) for r in docs.collect())
    for shard in {r["shard"] for r in rows}:
        held = sorted((r["slot"], -1 if r["doc_id"] is None else r["doc_id"]) for r in rows if r["shard"] == shard)
        assert [slot for slot, _ in held] == list(range(len(held)))
        assert [key for _, key in held] == sorted(key for _, key in held)
    empty = S.write_shards(empty_documents(spark), scratch_folder(spark, "shards"), {0: 1.0})
    assert empty.count() == 0
    with pytest.raises(ValueError):
        S.write_shards(docs.withColumn("Slot", F.lit(1)), "unused", {0: 1.0})


def test_one_hot_record_is_spread_over_files(spark):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("same").alias("text")
    )
    folder = scratch_folder(spark, "hot")
    stored = S.write_shards(rows, folder, dict.fromkeys(range(4), 1.0), ties=("text",))
    per_file = spark.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("f"), "shard").count()
    assert per_file.agg(F.max("count")).first()[0] < 15_000
    got = stored.groupBy("shard").agg(F.min("slot"), F.max("slot"), F.countDistinct("slot"), F.count("*")).collect()
    assert all(r[1] == 0 and r[2] + 1 == r[3] == r[4] for r in got)
